"""Order-dependent operators that stay skew-safe: dense numbering and "the next row".

Neither has a window over one huge partition (a single task holding a third of the rows):

* :func:`dense_index` numbers rows 1..n in a global order with a range shuffle, a
  per-partition count (one row per partition, so it can be broadcast) and each row's
  position inside its partition.
* :func:`next_row` gives every row the one that follows it in a global order.  The order keys
  are range-sorted, and the first key of each range becomes a bound; every row finds its range
  by binary search among the bounds and is shuffled to it, the first row of a range to the
  range before it as well.  The window then runs inside a range, whatever the keys are.
* :func:`next_in_group` is ``lead(value) OVER (PARTITION BY key ORDER BY ...)``.  Groups of up to
  ``GROUP_ROWS`` rows are windows of their own; the rows of larger ones go through
  :func:`next_row`, where the next row counts if it is of the same group, so that a group of any
  size is split.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.session import checkpoint_dir


def dense_index(df: DataFrame, order: list[str], id_col: str = "id", start: int = 1) -> DataFrame:
    """``df`` plus ``id_col`` = position (from ``start``) in ascending ``order``.

    The range layout is frozen with a checkpoint: range bounds are sampled, and the
    per-partition counts and the numbered rows must see the same partitions.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    # no explicit count: adaptive execution may merge adjacent ranges (still ordered), and
    # the partition ids and positions below are taken after that
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_rid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    local = F.col("_rid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(id_col, F.col("_off") + local + start)
        .drop("_pid", "_rid", "_off")
    )


def _bounds(df: DataFrame, names: list[str], ranges: int | None) -> list[dict]:
    """The least key of each range of a range partitioning by ``names``, in order: a row per
    partition.  Without ``ranges`` adaptive execution picks their number by the keys' bytes."""
    ranged = df.repartitionByRange(*names) if ranges is None else df.repartitionByRange(ranges, *names)
    least = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*names)).alias("key"))
    keys = [r["key"] for r in least.collect()]
    return [k.asDict() for k in sorted(keys, key=lambda k: [(v is not None, v) for v in k])]


def next_row(
    df: DataFrame,
    order: list[Column],
    carried: list[str],
    out: str = "next",
    ranges: int | None = None,
    wrap: bool = False,
    keys: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus ``out``: a struct of the ``carried`` columns of the next row in ascending
    ``order`` (nulls first), NULL for the last row or, with ``wrap``, those of the first.

    ``order`` has to be total (end it with a unique column, e.g. file and row of a scan): ranges
    can then split even equal keys, and every row has one place.  ``df`` is read twice and must
    give the same rows both times.  ``ranges`` is the number of ranges, for rows much wider
    than their keys; ``keys`` are the values of ``order`` of all rows, where they are at hand
    (written, so that wide rows are read once)."""
    names = [f"_o{i}" for i in range(len(order))]
    keys = df.select(*[c.alias(n) for c, n in zip(order, names)]) if keys is None else keys.toDF(*names)
    types = keys.schema
    bounds = _bounds(keys, names, ranges)
    if not bounds:
        return df.withColumn(out, F.struct(*carried))
    at = lambda i: F.get(F.from_json(F.lit(json.dumps(bounds)), f"array<{types.simpleString()}>"), i)
    key = F.struct(*names)
    jumps = [1 << b for b in reversed(range((len(bounds) - 1).bit_length()))]
    place = F.aggregate(
        F.array(*[F.lit(j) for j in jumps]).cast("array<int>"),
        F.lit(0),
        lambda i, jump: F.when(F.coalesce(at(i + jump) <= key, F.lit(False)), i + jump).otherwise(i),
    )
    target = lambda r, extra: F.struct(r.alias("_to"), F.lit(extra).alias("_extra"))
    here = target(F.col("_range"), False)
    before = target(F.pmod(F.col("_range") - 1, F.lit(len(bounds))), True)
    first = at(F.col("_range")) == key
    if not wrap:
        first = first & (F.col("_range") > 0)
    dealt = (
        df.select("*", *[c.alias(n) for c, n in zip(order, names)])
        .withColumn("_range", place)
        .withColumn("_target", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))))
        .select(*df.columns, *names, "_target._to", "_target._extra")
    )
    follow = F.lead(F.struct(*carried)).over(Window.partitionBy("_to").orderBy("_extra", *names))
    return dealt.withColumn(out, follow).where(~F.col("_extra")).select(*df.columns, out)


GROUP_ROWS = 1_000_000  # rows of a group that one task may sort
SLOTS = 1 << 16  # counts of hashed keys


def next_in_group(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    out: str = "next",
    ranges: int | None = None,
    ties: list[str] | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``df`` plus ``out`` = ``value`` of the next row of the same ``key`` group in ``order``
    (NULL for a group's last row).

    ``order`` and ``ties`` together have to be total, see :func:`next_row`; name as ``ties`` the
    columns that only tell rows apart which are alike in ``order`` and ``value``: they are dropped,
    and small groups do without them.  With ``ranges`` all rows are dealt over that many ranges."""
    ties = ties or []
    whole = df.drop(*ties)
    if ranges is not None:
        return _next_by_ranges(df, key, [*order, *ties], value, out, ranges).select(*whole.columns, out)
    large = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > group_rows)
    large = large.select("_key")
    follow = F.lead(value).over(Window.partitionBy(key).orderBy(*order))
    if not _may_have_large(df, key, group_rows):
        return whole.withColumn(out, follow)
    # fewer keys than df has times group_rows
    is_large = F.col(key).eqNullSafe(F.col("_key"))
    few = whole.join(F.broadcast(large), is_large, "left_anti").withColumn(out, follow)
    many = _next_by_ranges(df.join(F.broadcast(large), is_large, "left_semi"), key, [*order, *ties], value, out, None)
    return few.unionByName(many.select(*whole.columns, out))


def _may_have_large(df: DataFrame, key: str, group_rows: int) -> bool:
    """False only if no group has more than ``group_rows`` rows: the groups are counted by the hash of
    their key, so that a task sends at most ``SLOTS`` counts."""
    slots = df.groupBy(F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("slot")).agg(F.count(F.lit(1)).alias("rows"))
    return (slots.agg(F.max("rows")).first()[0] or 0) > group_rows


def _next_by_ranges(
    df: DataFrame, key: str, order: list[str], value: str, out: str, ranges: int | None
) -> DataFrame:
    followed = next_row(df, [F.col(c) for c in [key, *order]], [key, value], "_next", ranges)
    same = F.col(f"_next.{key}").eqNullSafe(F.col(key))
    return followed.withColumn(out, F.when(same, F.col(f"_next.{value}"))).drop("_next")
