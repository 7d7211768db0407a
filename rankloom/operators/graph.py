"""Graph tables derived from a page set and its (multi)set of links.

A graph is two DataFrames:

* ``pages(node STRING)`` - one row per parsed page (the page count N counts these rows)
* ``edges(src STRING, dst STRING)`` - one row per link occurrence (duplicates and
  self-links kept); ``src`` is always a page, ``dst`` may be any name.

Every function returns a DataFrame and leaves planning to Catalyst.  The only place a
scalar comes back to the driver is a row count (``n_pages``, ``n_nodes``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import strip_whitespace
from rankloom.session import Scratch, materialise


class Graph(NamedTuple):
    pages: DataFrame  # node STRING
    edges: DataFrame  # src STRING, dst STRING


def normalise_edges(edges: DataFrame) -> DataFrame:
    """Strip whitespace from both link ends and drop links whose target becomes empty."""
    return (
        edges.select(strip_whitespace("src").alias("src"), strip_whitespace("dst").alias("dst"))
        .where(F.col("dst") != "")
    )


def adjacency_to_graph(adjacency: DataFrame) -> Graph:
    """``(name, links ARRAY<STRING>)`` -> Graph (one edge per list element)."""
    pages = adjacency.select(strip_whitespace("name").alias("node"))
    edges = adjacency.select(F.col("name").alias("src"), F.explode("links").alias("dst"))
    return Graph(pages, normalise_edges(edges))


def page_count(g: Graph) -> DataFrame:
    return g.pages.agg(F.count(F.lit(1)).alias("n_pages"))


def n_pages(g: Graph) -> int:
    return g.pages.count()


def node_universe(g: Graph) -> DataFrame:
    """Pages plus every link target, one row per name, with flags (partial aggregation)."""
    flags = g.pages.select("node", F.lit(True).alias("is_page"), F.lit(False).alias("has_in")).unionByName(
        g.edges.where(F.col("dst").isNotNull()).select(
            F.col("dst").alias("node"), F.lit(False).alias("is_page"), F.lit(True).alias("has_in")
        )
    )
    return flags.groupBy("node").agg(
        F.max("is_page").alias("is_page"), F.max("has_in").alias("has_in")
    )


def edge_multiplicity(g: Graph) -> DataFrame:
    """(src, dst, m): each distinct link with how often it occurs."""
    return g.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))


def distinct_edges(g: Graph) -> DataFrame:
    return g.edges.dropDuplicates(["src", "dst"])


def out_degree(g: Graph, distinct: bool = False) -> DataFrame:
    """Out-degree of every page with at least one link (multiset or distinct targets)."""
    if distinct:
        return distinct_edges(g).groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")).withColumnRenamed(
            "src", "node"
        )
    return g.edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")).withColumnRenamed("src", "node")


def sources(g: Graph) -> DataFrame:
    """Distinct link sources as ``node`` (partially aggregated: one row per source per task,
    so a source with a huge list never lands on the un-splittable side of an anti join)."""
    return g.edges.select(F.col("src").alias("node")).distinct()


def dangling_pages(g: Graph) -> DataFrame:
    """Pages with an empty link list (link-only targets are NOT included)."""
    return g.pages.join(sources(g), "node", "left_anti")


def dangling_nodes(g: Graph) -> DataFrame:
    """Every node without out-links: dangling pages plus link-only targets."""
    return node_universe(g).join(sources(g), "node", "left_anti").select("node", "is_page")


def adjacency(g: Graph) -> DataFrame:
    """Adjacency lists as rows: (node, link, m), one row per distinct link of a page with its
    multiplicity; a page without links has one row (node, NULL, 0).

    This is the sorted list with duplicates in multiset form - no per-page ``collect_list``,
    so a page with millions of links is spread over tasks like any other aggregate.
    """
    linked = edge_multiplicity(g).select(F.col("src").alias("node"), F.col("dst").alias("link"), "m")
    empty = dangling_pages(g).select(
        "node", F.lit(None).cast("string").alias("link"), F.lit(0).cast("long").alias("m")
    )
    return linked.unionByName(empty)


def transition_matrix(g: Graph, distinct: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Sparse column-stochastic matrix in COO form: (dst, src, w) with w = m / out-degree.

    Pairs and degrees are written once each: the links are derived once, and a join of two
    plain scans is one whose hot sources adaptive execution can split.  They belong to
    ``scratch`` where one is given."""
    pairs = edge_multiplicity(g)
    if distinct:
        pairs = pairs.withColumn("m", F.lit(1).cast("long"))
    pairs = materialise(pairs, "pairs", scratch)
    deg = materialise(pairs.groupBy("src").agg(F.sum("m").alias("deg")), "degrees", scratch)
    return pairs.join(deg, "src").select("dst", "src", (F.col("m") / F.col("deg")).alias("w"))


def matrix_rows(g: Graph, scratch: Scratch | None = None) -> DataFrame:
    """Row view of the matrix: COO entries range-partitioned and sorted by (dst, src), so
    each target's entries are contiguous and ordered.  A target with a huge in-degree is
    split across tasks by the range bounds instead of being gathered into one array."""
    return transition_matrix(g, scratch=scratch).orderBy("dst", "src")


def matrix_row_summary(g: Graph, scratch: Scratch | None = None) -> DataFrame:
    """Per target row: number of entries and total incoming weight (partial aggregation)."""
    return transition_matrix(g, scratch=scratch).groupBy("dst").agg(
        F.count(F.lit(1)).alias("nnz"), F.sum("w").alias("in_weight")
    )


def node_alias(nodes: DataFrame, col: str = "node") -> DataFrame:
    """Dense ids 1..|V| in binary name order (no single-partition window): see
    :func:`rankloom.operators.ordered.dense_index`."""
    from rankloom.operators.ordered import dense_index

    return dense_index(nodes.select(col), [col]).select(col, "id")


def edges_by_id(g: Graph, alias: DataFrame | None = None) -> DataFrame:
    """Distinct links with multiplicity, both ends mapped to their dense ids (two equi-joins)."""
    alias = alias if alias is not None else node_alias(node_universe(g).select("node"))
    pairs = edge_multiplicity(g)
    src_ids = alias.select(F.col("node").alias("src"), F.col("id").alias("src_id"))
    dst_ids = alias.select(F.col("node").alias("dst"), F.col("id").alias("dst_id"))
    return pairs.join(src_ids, "src").join(dst_ids, "dst").select("src", "dst", "src_id", "dst_id", "m")
