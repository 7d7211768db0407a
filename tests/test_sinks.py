"""Text sinks (ops 6-9)."""

import os

import pytest
from pyspark.sql import functions as F

from rankloom.sources import sinks
from rankloom.sources.text import read_lines_in_order


def _read(path):
    out = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            with open(os.path.join(path, f)) as fh:
                out += fh.read().splitlines()
    return out


def test_report_and_key_value(spark, tmp_path):
    df = spark.createDataFrame([("A", 0.25), ("B", 1.0e-4), ("C", 0.5)], "node string, rank double")
    sinks.write_report(df, str(tmp_path / "report"))
    files = [f for f in os.listdir(tmp_path / "report") if f.startswith("part-")]
    assert len(files) == 1
    assert _read(str(tmp_path / "report")) == ["C 0.5", "A 0.25", "B 1.0E-4"]
    sinks.write_key_value(df, "node", "rank", str(tmp_path / "kv"))
    assert sorted(_read(str(tmp_path / "kv"))) == ["A\t0.25", "B\t1.0E-4", "C\t0.5"]
    sinks.write_lines(df.select(F.concat_ws("|", "node", "rank").alias("t")), "t", str(tmp_path / "lines"))
    assert sorted(_read(str(tmp_path / "lines"))) == ["A|0.25", "B|1.0E-4", "C|0.5"]


def test_key_value_keeps_odd_keys(spark, tmp_path):
    df = spark.createDataFrame([("#x", 1.0), ("", 2.0), ('a"b', 3.0), (None, 4.0)], "k string, v double")
    sinks.write_key_value(df, "k", "v", str(tmp_path / "odd"))
    assert sorted(_read(str(tmp_path / "odd"))) == sorted(["#x\t1.0", "\t2.0", 'a"b\t3.0', "null\t4.0"])


def test_single_file_has_a_bound(spark, tmp_path):
    df = spark.range(50).repartition(4).select(F.col("id").cast("string").alias("t"))
    sinks.write_single_file(df, "t", str(tmp_path / "fits"), max_rows=50)
    assert sorted(map(int, _read(str(tmp_path / "fits")))) == list(range(50))
    assert len([f for f in os.listdir(tmp_path / "fits") if f.startswith("part-")]) == 1
    with pytest.raises(Exception, match="more than 49 rows for a single file"):
        sinks.write_single_file(df, "t", str(tmp_path / "large"), max_rows=49)
    ordered = df.orderBy(F.col("t").cast("int").desc())  # the order stays
    sinks.write_single_file(ordered, "t", str(tmp_path / "ordered"), max_rows=50)
    assert _read(str(tmp_path / "ordered")) == [str(i) for i in range(49, -1, -1)]


def test_lines_come_back_in_order(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(3000).repartitionByRange(4, "id").sortWithinPartitions("id").select(
        F.concat(F.lit("line "), F.col("id").cast("string")).alias("t")
    ).write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # files are split
    try:
        rows = read_lines_in_order(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["pos"], r["line"]) for r in rows) == [(i, f"line {i}") for i in range(3000)]
