"""Top-k reports.  All three forms plan as ``TakeOrderedAndProject`` (per-task partial
top-k, then a merge of at most k rows per task) - nothing is collected or fully sorted; for
distinct values each task first selects its own k.

Give them a value that keeps its size when the graph grows (``rank_n`` of
:func:`rankloom.operators.rank.scaled_ranks`): ``digits`` rounds on an absolute grid, which
would make one tie of all ranks below it."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.fixed import TOP_K
from rankloom.session import ship_package


def _value(df: DataFrame, value: str, digits: int | None) -> DataFrame:
    return df if digits is None else df.withColumn(value, F.round(value, digits))


def top_k(
    df: DataFrame, k: int = TOP_K, value: str = "rank", key: str = "node", digits: int | None = None
) -> DataFrame:
    """The k largest values, ties kept and ordered by key (ascending)."""
    return _value(df, value, digits).orderBy(F.desc(value), F.asc_nulls_last(key)).limit(k)


def _best(table: pa.Table, k: int) -> pa.Table:
    """The k largest distinct values of ``(value, key)``, each with its greatest key.  Order as
    in Spark: NaN above all numbers, null below."""
    if pa.types.is_floating(table.schema.field("value").type):
        value = pc.add(table.column("value"), 0.0)  # -0.0 is 0.0
        order = [("nan", "descending"), ("value", "descending")]
    else:
        value, order = table.column("value"), [("value", "descending")]
    t = pa.table({"value": value, "key": table.column("key")}).group_by("value").aggregate([("key", "max")])
    t = pa.table({"value": t.column("value"), "key": t.column("key_max")})
    if t.num_rows > k:
        if len(order) > 1:
            nan = pc.fill_null(pc.is_nan(t.column("value")), False)
            t = t.append_column("nan", pc.cast(nan, pa.int8()))
        t = t.sort_by(order).select(["value", "key"]).slice(0, k)
    return t


def task_top_k_distinct(df: DataFrame, k: int, value: str, key: str) -> DataFrame:
    """``(value, key)`` of at most k rows a task: the k largest distinct values the task saw,
    each with its greatest key.  A task holds k rows and one batch."""
    ship_package(df.sparkSession)

    def run(batches):
        best = None
        for batch in batches:
            some = _best(pa.Table.from_batches([batch]), k)
            best = some if best is None else _best(pa.concat_tables([best, some]), k)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    two = df.select(F.col(value).alias("value"), F.col(key).alias("key"))
    return two.mapInArrow(run, two.schema)


def top_k_distinct(
    df: DataFrame, k: int = TOP_K, value: str = "rank", key: str = "node", digits: int | None = None
) -> DataFrame:
    """The k largest DISTINCT values; a tie collapses to the greatest key.

    With rounded values, those one ulp apart count as one.  Every task selects its k first, so
    at most k rows of it are shuffled, however many values and ties there are.
    """
    best = task_top_k_distinct(_value(df, value, digits), k, value, key)
    merged = best.groupBy("value").agg(F.max("key").alias("key")).orderBy(F.desc("value")).limit(k)
    return merged.select(F.col("key").alias(key), F.col("value").alias(value))


def top_k_skip_first(
    df: DataFrame, k: int = TOP_K, value: str = "rank", key: str = "node", digits: int | None = None
) -> DataFrame:
    """Ranks 2..k+1 of the descending order when k+1 rows exist, otherwise every row.

    The window runs over the k+1 rows left by the top-(k+1) plan node, a bounded frame.
    """
    order = [F.desc(value), F.asc_nulls_last(key)]
    head = _value(df, value, digits).orderBy(*order).limit(k + 1)
    numbered = head.select(
        key,
        value,
        F.row_number().over(Window.orderBy(*order)).alias("_pos"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"),
    )
    return numbered.where((F.col("_pos") > 1) | (F.col("_n") <= k)).select(key, value)
