"""Line-oriented inputs: ``name:html`` page lines and ``station,yyyymmdd,type,value`` readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READINGS_SCHEMA = "station STRING, date STRING, mtype STRING, value STRING"


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per input line: ``value STRING`` (splittable text scan)."""
    return spark.read.text(path)


def read_lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, line)``: the lines of the files of ``path`` (in the order of their names), numbered
    from 0.  Files may be split over tasks; no task sees more than its own part."""
    from rankloom.operators.ordered import dense_index

    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    return dense_index(lines, ["_file", "_block", "_at"], "pos", start=0).select("pos", "line")


def split_page_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split each line at its FIRST ':' into (name, html); lines without ':' are dropped."""
    at = F.instr(F.col(col), ":")
    return lines.where(at > 0).select(
        F.substring_index(F.col(col), ":", 1).alias("name"),
        F.expr(f"substr({col}, instr({col}, ':') + 1)").alias("html"),
    )


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated readings; the first four fields as text, extra fields ignored.

    Fields are split on every comma (no quoting), missing fields become NULL and the value
    is parsed later with :func:`rankloom.functions.lenient_double`.
    """
    return (
        spark.read.schema(READINGS_SCHEMA)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
