"""Held-out accuracy of the classifiers, mixture weights, and the pipeline's stages."""

import zlib

import numpy as np

import corpus_pipeline
from rankloom.llm import interpolation_lm, quality_qda, queries, toxicity_nnpu
from tests.conftest import SF_CHECK, SF_SMALL


def held_out(spark, name, label):
    rows = {r.doc_id: r for r in queries.QUERIES[name](spark, SF_CHECK).collect()}
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    some = [(labels[i], r.predicted) for i, r in rows.items() if r.held_out and i in labels]
    return sum(y == p for y, p in some) / len(some)


def test_quality_held_out(spark):
    assert held_out(spark, "op1_quality_classifier", "quality") > 0.95


def test_toxicity_held_out(spark):
    assert held_out(spark, "op4_toxicity", "toxic") > 0.85


def test_gaussians_match_direct_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(50, 3)), rng.normal(2, 3, size=(80, 3))]
    g = quality_qda.from_moments([len(a) for a in x], np.stack([a.sum(0) for a in x]), np.stack([a.T @ a for a in x]), shrink=0, diagonal=0)
    z = rng.normal(1, 2, size=(20, 3))
    d = []
    for a in x:
        c = np.cov(a.T, bias=True) + 1e-6 * np.eye(3)
        m = z - a.mean(0)
        d.append(np.log(len(a) / 130) - 0.5 * np.einsum("ij,jk,ik->i", m, np.linalg.inv(c), m) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(g.score(z), 1 / (1 + np.exp(d[0] - d[1])), atol=1e-4)


def test_nonnegative_risk_does_not_mark_all_unlabelled_negative():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.random((100, 1)) > 0.2, rng.random((200, 1)) > 0.2, rng.random((800, 1)) > 0.98]).astype(np.float32)
    w, b = toxicity_nnpu.train(x, np.arange(1100) < 100, prior=0.2)
    assert w[0] + b > 0 > b


def test_em_finds_the_better_estimate():
    cell = lambda p: int(-np.log2(p) * interpolation_lm.GRID)
    good, bad = cell(0.5), cell(0.001)
    code = np.array([(3 << 20) | (good << 10) | bad, (6 << 20) | (1023 << 10) | good])
    w = interpolation_lm.mixture_weights(code, np.array([100, 100]), types=1000)
    assert w[3][0] > 0.9 and w[6][1] > 0.9 and np.allclose(w.sum(axis=1), 1) and w[0][0] == 0


def test_sorted_keys_and_counts_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 2, 1000):
        k = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
        assert (interpolation_lm.unpack_sorted(interpolation_lm.pack_sorted(k), len(k)) == k).all()
        c = rng.integers(0, 10**6, n)
        assert (interpolation_lm.unpack_counts(interpolation_lm.pack_counts(c), n) == c).all()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > counts[4] > 0 and counts[2] == counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    whole = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert whole == {(r.doc_id, r.piece, r.ids_crc32) for r in packed}
