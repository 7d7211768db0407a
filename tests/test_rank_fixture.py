"""Golden ranks on the 6-node fixture graph (FIXTURES.md section 2), tolerance 1e-8."""

import pytest

from rankloom.operators import rank as R
from rankloom.session import checkpoint_dir

TOL = 1e-8

GOLDEN = {
    ("list", 1): dict(A=0.228331633, B=0.1149983, C=0.2849983, D=0.086664967, E=0.0299983, X=0.1149983),
    ("list", 2): dict(A=0.238528814, B=0.161321444, C=0.259069999, D=0.145030018, E=0.0642805, X=0.077029777),
    ("list", 9): dict(A=0.145017518, B=0.093191614, C=0.174889935, D=0.081133759, E=0.03, X=0.04275),
    ("matrix_row", 10): dict(A=0.263363566, B=0.141619621, C=0.261858567, D=0.104181783, E=0.2, X=0.115),
    ("matrix_col", 1): dict(A=0.228333333, B=0.115, C=0.285, D=0.086666667, X=0.115),
    ("matrix_col", 10): dict(A=0.116544934, B=0.080436976, C=0.149764422, D=0.073272467, X=0.03),
    ("unnormalised_phantom", 1): {"A": 1.0, "B": 0.575, "C": 1.425, "D": 0.575, "X": 0.575, None: 1.0},
    ("unnormalised_phantom", 10): {
        "A": 0.412994798, "B": 0.327940461, "C": 0.609650659, "D": 0.412994798, None: 0.505880922
    },
    ("unnormalised", 10): {"A": 0.412994798, "B": 0.327940461, "C": 0.609650659, "D": 0.412994798},
    ("total", 10): dict(
        A=0.252695628, B=0.163998074, C=0.30334132, D=0.142630943, E=0.056633431, X=0.080700604
    ),
}


def ranks(graph, preset, sweeps, **kw):
    spec = R.PRESETS[preset].with_(iterations=sweeps)
    return {r["node"]: r["rank"] for r in R.pagerank(graph, spec, **kw).collect()}


@pytest.mark.parametrize("preset,sweeps", sorted(GOLDEN, key=str))
def test_golden_ranks(fixture_graph, preset, sweeps):
    got = ranks(fixture_graph, preset, sweeps)
    want = GOLDEN[(preset, sweeps)]
    assert set(got) == set(want)
    for node, value in want.items():
        assert abs(got[node] - value) < TOL, (node, got[node], value)


def test_total_conserves_mass_every_sweep(fixture_graph):
    for sweeps in (1, 2, 5):
        assert abs(sum(ranks(fixture_graph, "total", sweeps).values()) - 1.0) < 1e-12


def test_list_exact_differs_from_literal_only_by_dangling_term(fixture_graph):
    exact = ranks(fixture_graph, "list_exact", 1)
    literal = ranks(fixture_graph, "list", 1)
    # sweep 1: exact mass = (1/5)/5 (page D), literal = -1/(1e5*5); same difference everywhere
    diffs = {round(exact[n] - literal[n], 12) for n in exact}
    assert diffs == {round(0.85 * (0.2 / 5 + 1 / (1e5 * 5)), 12)}


def test_blocks_give_the_same_ranks(fixture_graph):
    """C has half of the pairs: with more buckets than one it is a hub of several blocks."""
    plain = ranks(fixture_graph, "total", 10)
    with R.prepare(fixture_graph, R.PRESETS["total"], buckets=8) as model:
        blocks = {r["node"]: r["blocks"] for r in model.nodes.collect()}
        assert blocks["C"] > 1 and blocks["X"] == 1
        split = {r["node"]: r["rank"] for r in R.ranks(model, R.iterate(model)).collect()}
    assert set(plain) == set(split)
    assert all(abs(plain[n] - split[n]) < 1e-12 for n in plain)


def test_blocks_with_the_phantom_node(fixture_graph):
    got = ranks(fixture_graph, "unnormalised_phantom", 10, buckets=8)
    want = GOLDEN[("unnormalised_phantom", 10)]
    assert set(got) == set(want) and all(abs(got[n] - want[n]) < TOL for n in want)


def test_spec_validation():
    with pytest.raises(ValueError):
        R.RankSpec(unlinked="nowhere")
    with pytest.raises(ValueError):
        R.RankSpec(iterations=-1)


def made_by_us(spark):
    import os

    root = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    folders = {f for f in os.listdir(root) if f.startswith("rankloom_")} if os.path.isdir(root) else set()
    return {t.name for t in spark.catalog.listTables() if t.name.startswith("rankloom_")}, folders


def test_a_model_leaves_nothing_behind(spark, fixture_graph):
    tables, folders = made_by_us(spark)
    with R.prepare(fixture_graph, R.PRESETS["total"].with_(iterations=4)) as model:
        final = R.iterate(model)
        kinds = sorted(n.split("_")[1] for n in made_by_us(spark)[0] - tables)
        assert kinds == ["links", "nodes", "rank4"]  # no pairs and no earlier vector
        assert abs(sum(r["rank"] for r in final.collect()) - 1.0) < 1e-12
    assert made_by_us(spark) == (tables, folders)


def test_a_rank_frame_leaves_its_vector_only(spark, fixture_graph):
    tables, folders = made_by_us(spark)
    df = R.pagerank(fixture_graph, "total")
    after = made_by_us(spark)
    assert after[0] == tables and len(after[1] - folders) == 1
    assert df.sparkSession is spark and abs(sum(r["rank"] for r in df.collect()) - 1.0) < 1e-12


def test_two_models_run_side_by_side(spark, fixture_graph):
    """Each has a session of its own: neither sees the other's shuffle width nor the caller's change."""
    from concurrent.futures import ThreadPoolExecutor

    key = "spark.sql.shuffle.partitions"
    width = spark.conf.get(key)

    def job(buckets):
        with R.prepare(fixture_graph, R.PRESETS["total"], buckets=buckets) as model:
            state = R.iterate(model)
            assert model.scratch.spark.conf.get(key) == str(buckets)
            assert spark.conf.get(key) == width
            return {r["node"]: r["rank"] for r in state.collect()}

    with ThreadPoolExecutor(2) as pool:
        one, other = pool.map(job, [2, 5])
    assert one.keys() == other.keys() and all(abs(one[n] - other[n]) < 1e-12 for n in one)
    assert spark.conf.get(key) == width


def test_empty_graph(spark):
    from rankloom.operators.graph import Graph

    g = Graph(spark.createDataFrame([], "node string"), spark.createDataFrame([], "src string, dst string"))
    for preset in ("total", "list", "unnormalised_phantom"):
        assert R.pagerank(g, preset).count() == 0


def test_name_keys_and_hash_keys_agree(fixture_graph):
    by_hash = ranks(fixture_graph, "unnormalised_phantom", 10, keys="hash")
    model = R.prepare(fixture_graph, R.PRESETS["unnormalised_phantom"], keys="name")
    assert not model.keyed
    by_name = {r["node"]: r["rank"] for r in R.ranks(model, R.iterate(model)).collect()}
    assert set(by_hash) == set(by_name) and all(abs(by_hash[n] - by_name[n]) < 1e-12 for n in by_hash)
    assert R.prepare(fixture_graph, R.PRESETS["total"], keys="hash").keyed
    assert not R.prepare(fixture_graph, R.PRESETS["total"]).keyed  # names unless asked
