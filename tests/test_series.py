"""Per-station yearly series (FIXTURES.md section 3) and its invariants."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import series as S
from rankloom.sources.tables import lineitem_readings
from rankloom.sources.text import read_readings

READINGS = """S1,18000101,TMAX,-75
S1,18000101,TMIN,-148
S1,18000102,TMAX,25
S1,18010101,TMIN,-10
S1,18000103,PRCP,7
S2,18990704,TMAX,300
S2,19000704,TMAX,x
"""

EXPECTED = [
    "S1,[(1800,-148.0,-25.0)(1801,-10.0,-9999.0)]",
    "S2,[(1899,-9999.0,300.0)(1900,-9999.0,NaN)]",
]


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("readings") / "r.csv"
    path.write_text(READINGS)
    return read_readings(spark, str(path))


def test_rendered_series_golden(readings):
    got = sorted(r["value"] for r in S.render_series(S.station_series(readings)).collect())
    assert got == EXPECTED


def test_measure_filter_and_year(readings):
    rows = S.measure_readings(readings).collect()
    assert len(rows) == 6 and {r["mtype"] for r in rows} == {"TMAX", "TMIN"}
    assert {r["year"] for r in rows} == {1800, 1801, 1899, 1900}


def test_year_breaks(readings):
    got = sorted((r["station"], r["year"], r["prev_year"]) for r in S.year_breaks(readings).collect())
    assert got == [("S1", 1800, None), ("S1", 1801, 1800), ("S2", 1899, None), ("S2", 1900, 1899)]


def test_extra_and_missing_fields(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("S9,20000101,TMIN,5,extra,fields\nS9,20000102,TMIN,\nS9,2000\n")
    means = S.yearly_means(read_readings(spark, str(path))).collect()
    assert [(r["station"], r["year"], r["mean_tmin"], r["mean_tmax"]) for r in means] == [
        ("S9", 2000, 5.0, -9999.0)
    ]


def test_series_years_ascend_on_driver_table(spark):
    series = S.flatten_series(S.station_series(lineitem_readings(spark, "/root/testdata/sf0.001")))
    bad = series.select(
        "station", "year", F.lag("year").over(
            __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("station").orderBy("pos")
        ).alias("prev")
    ).where(F.col("prev") >= F.col("year"))
    assert bad.count() == 0


def test_secondary_sort_is_one_range_exchange(spark):
    df = S.secondary_sort(S.measure_readings(lineitem_readings(spark, "/root/testdata/sf0.001")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_secondary_sort_output_is_ordered(spark):
    df = S.secondary_sort(S.measure_readings(lineitem_readings(spark, "/root/testdata/sf0.001")))
    keys = [(r["station"], r["year"]) for r in df.select("station", "year").collect()]
    assert keys == sorted(keys)


def test_readings_from_a_file_kept_by_hand(spark):
    """The text lines hold every kind of bad field, and the means every kind of missing value."""
    import math

    from rankloom.plans.queries import QUERIES
    from rankloom.sources.tables import reading_lines

    lines = [r["value"].split(",") for r in reading_lines(spark, "/root/testdata/sf0.01").collect()]
    assert {len(f) for f in lines} >= {2, 3, 4, 7}
    values = [f[3] for f in lines if len(f) > 3]
    assert "" in values and any(v.startswith("n/a") for v in values) and any(v.startswith("  ") for v in values)
    rows = QUERIES["yearly_means_csv"](spark, "/root/testdata/sf0.01").collect()
    assert any(r["mean_tmin"] == -9999.0 and math.isnan(r["mean_tmax"]) for r in rows)
    assert any(r["mean_tmin"] == -9999.0 and r["mean_tmax"] > 0 for r in rows)
    assert any(r["mean_tmin"] > 0 and r["mean_tmax"] == -9999.0 for r in rows)
