"""Sanity values on the driver tables (FIXTURES.md section 4), computed by Spark at sf0.01."""

import pytest
from pyspark.sql import functions as F

from rankloom.operators import graph as G
from rankloom.operators import rank as R
from rankloom.sources.tables import part_follow_graph

SF = "/root/testdata/sf0.01"

SANITY = {  # preset: (rows, sum of ranks rounded to 9 places, max)
    "list": (1877, 0.404178, 0.001285802),
    "unnormalised_phantom": (772, 307.854791, 36.264519104),
}


@pytest.fixture(scope="module")
def g(spark):
    return part_follow_graph(spark, SF)


def test_graph_shape(g):
    assert G.n_pages(g) == 1605
    assert g.edges.count() == 2231
    assert G.distinct_edges(g).count() == 2230
    assert G.dangling_pages(g).count() == 385
    link_only = G.node_universe(g).where(~F.col("is_page")).count()
    assert link_only == 272


@pytest.mark.parametrize("preset", sorted(SANITY))
def test_rank_sanity(g, preset):
    r = R.pagerank(g, preset).select(F.round("rank", 9).alias("r"))
    rows, total, top = r.agg(F.count("*"), F.round(F.sum("r"), 6), F.max("r")).first()
    assert (rows, total, top) == SANITY[preset]


def test_hash_keys_match_name_keys_on_dense_graph(spark):
    g = part_follow_graph(spark, "/root/testdata/sf0.001", returnflag=None, linestatus=None)
    for preset in ("total", "list", "unnormalised_phantom"):
        by_hash = {r["node"]: r["rank"] for r in R.pagerank(g, preset, keys="hash").collect()}
        by_name = {r["node"]: r["rank"] for r in R.pagerank(g, preset, keys="name").collect()}
        assert set(by_hash) == set(by_name)
        assert all(abs(by_hash[n] - by_name[n]) < 1e-12 for n in by_name), preset
