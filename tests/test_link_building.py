"""Links of the larger tables: small groups are windows, large ones are split over ranges, ranks
run on 64-bit keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankloom.functions.text import strip_whitespace
from rankloom.operators import ordered
from rankloom.operators import rank as R
from rankloom.sources.tables import part_follow_graph


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("group_rows", [1, 10, 60, 10_000])
def test_large_groups_and_small_ones(spark, group_rows):
    rows = [(1, i // 3, i // 3, i) for i in range(300)] + [(2, i, i, i) for i in range(40)]
    rows += [(None, i, i, i) for i in range(70)] + [(k, 0, k, 0) for k in range(3, 50)]
    df = spark.createDataFrame(rows, "k int, o int, v int, t long").repartition(4)
    w = Window.partitionBy("k").orderBy("o", "v", "t")
    want = sorted(map(tuple, df.select("k", "o", "v", F.lead("v").over(w)).collect()), key=str)
    got = ordered.next_in_group(df, "k", ["o", "v"], "v", ties=["t"], group_rows=group_rows)
    assert got.columns == ["k", "o", "v", "next"]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_a_large_group_goes_through_ranges(spark):
    df = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    few = _plan(ordered.next_in_group(df, "k", ["o"], "o"))
    assert few.count("Exchange") == 1 and "hashpartitioning(k" in few and "from_json" not in few and "aggregate(" not in few
    assert "aggregate(" in _plan(ordered.next_in_group(df, "k", ["o"], "o", group_rows=1_000))


def follow_tables(spark, at, lines):
    spark.createDataFrame([(p, p % 50) for p in range(100)], "p_partkey long, p_size int").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"
    ).write.parquet(f"{at}/lineitem.parquet")


def test_follow_graph_with_nulls_and_repeated_lines(spark, tmp_path):
    follow_tables(spark, tmp_path, [(1, 1, 5, 1), (1, 1, 5, 1), (1, 2, 45, 1), (1, 3, 7, 1), (2, 1, None, 1), (2, 2, 8, 1), (2, 3, 9, 1),
                              (None, 1, 10, 1), (None, 2, 11, 1), (3, None, 12, 1), (3, 1, 13, 1)])
    g = part_follow_graph(spark, str(tmp_path), returnflag=None, linestatus=None)
    want = [("10", "11"), ("12", "13"), ("5", "45"), ("5", "5"), ("8", "9")]  # 45 is no page
    assert sorted(map(tuple, g.edges.collect())) == want


def test_ranks_run_on_long_keys(spark, fixture_graph, monkeypatch):
    models = []
    prepare = R.prepare
    monkeypatch.setattr(R, "prepare", lambda *a, **k: models.append(prepare(*a, **k)) or models[-1])
    by_key = {r["node"]: r["rank"] for r in R.pagerank(fixture_graph, "total").collect()}
    R.scaled_ranks(fixture_graph, "list")
    assert [m.keyed for m in models] == [True, True]
    # any clash of keys: the names are the keys
    monkeypatch.setattr(R, "_key", lambda c: F.when(c.isNotNull(), F.length(c).cast("long")))
    by_name = {r["node"]: r["rank"] for r in R.pagerank(fixture_graph, "total").collect()}
    assert not models[-1].keyed and len(by_name) == 6
    assert all(abs(by_key[n] - by_name[n]) < 1e-12 for n in by_name)


def test_a_clash_of_keys_leaves_no_table(spark, fixture_graph, monkeypatch):
    monkeypatch.setattr(R, "_key", lambda c: F.when(c.isNotNull(), F.lit(3).cast("long")))
    with R.prepare(fixture_graph, R.PRESETS["total"], keys="hash") as model:
        assert not model.keyed and len(model.scratch.held) == 2


def test_every_whitespace_character_is_stripped(spark):
    texts = ["", "a", " ", "a b", "\ta\n\x0bb\f\r", "a b ", "\x1c\x85", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for got, want in df.select(strip_whitespace("t"), F.regexp_replace("t", r"\s", "")).collect():
        assert got == want
