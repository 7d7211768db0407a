"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a join with a per-node minimum and a distinct; edges are written to the shared
folder after each round, so lineage stays short and nothing but a count and a checksum
reaches the driver.  Hot nodes are pre-aggregated (min) before the shuffle, and AQE can split
them in the join, whose other side has unique keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm._work import Workspace


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"), F.sum(F.hash("u", "v").cast("long")).alias("s")
    ).first()
    return row["n"], row["x"], row["s"]


def components(edges: DataFrame, work: Workspace, name: str = "cc") -> DataFrame:
    """``edges(u, v)`` of an orderable type -> ``(node, root)`` for every node with an edge;
    ``root`` is the smallest node of its component."""
    cur = work.save(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0"
    )
    before, step = _state(cur), 0
    while before[0]:
        # large star: every larger neighbour of u is hung on u's smallest neighbour (or u)
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "k")
        large = both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are hung on the smallest of them
        small_min = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = (
            large.join(small_min, F.col("u") == F.col("k"))
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u != v")
            .distinct()
        )
        nxt = work.save(small, f"{name}-{step + 1}")
        work.drop(f"{name}-{step}")
        step += 1
        after = _state(nxt)
        cur = nxt
        if after == before:
            break
        before = after
    roots = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
