"""Text sinks.  Writers are distributed; only a bounded (top-k) frame is ever coalesced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import java_double_text


def write_key_value(df: DataFrame, key: str, value: str, path: str, mode: str = "overwrite") -> None:
    """``key TAB value`` lines, one file per partition; a NULL key is written as ``null``.

    Lines are rendered as text: a CSV writer would escape keys that are empty or start with
    a comment character."""
    line = F.concat_ws("\t", F.coalesce(F.col(key).cast("string"), F.lit("null")), java_double_text(value))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_lines(df: DataFrame, text: str, path: str, mode: str = "overwrite") -> None:
    """Value-only text lines (one column rendered upstream), one file per partition."""
    df.select(F.col(text).alias("value")).write.mode(mode).text(path)


SINGLE_FILE_ROWS = 100_000  # rows one task may write as one file


def write_single_file(df: DataFrame, text: str, path: str, mode: str = "overwrite", max_rows: int = SINGLE_FILE_ROWS) -> None:
    """Value-only lines in ONE file, for k-row results (reports), never for edge lists: a frame of
    more than ``max_rows`` rows fails the write.  No task sends more than one row beyond that."""
    one = df.select(F.col(text).alias("value")).limit(max_rows + 1).coalesce(1)
    # in a single partition the ids count from 0
    within = F.monotonically_increasing_id() < max_rows
    message = F.lit(f"more than {max_rows} rows for a single file")
    one.select(F.when(within, F.col("value")).otherwise(F.raise_error(message)).alias("value")).write.mode(mode).text(path)


def report_lines(topk: DataFrame, node: str = "node", rank: str = "rank") -> DataFrame:
    """``node rank`` lines of a top-k frame, rank printed as the JVM prints doubles."""
    return topk.select(
        F.concat_ws(" ", F.coalesce(F.col(node), F.lit("null")), java_double_text(rank)).alias("value")
    )


def write_report(topk: DataFrame, path: str, node: str = "node", rank: str = "rank") -> None:
    """Report sink: the top-k rows as ``node rank`` lines in one file, in rank order."""
    lines = report_lines(topk.orderBy(F.desc(rank), F.asc_nulls_last(node)), node, rank)
    write_single_file(lines, "value", path)
