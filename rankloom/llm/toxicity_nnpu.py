"""Toxicity by non-negative positive-unlabelled learning.

Training sees confirmed toxic texts (P) and unlabelled texts (U), never a "clean" label.  A
linear classifier over words and word beginnings is trained in numpy on the non-negative
risk estimate

    R = prior * Rp(+)  +  max(0, Ru(-) - prior * Rp(-))

with the logistic loss; where the second term falls below zero its gradient is turned round,
so the model cannot profit from fitting U as all negative.  ``prior`` is the share of toxic
documents, by default that among the labelled training rows.

The classifier is fitted on a bounded sample: ``max_positive`` toxic and ``max_unlabelled``
other training documents, those with the least xxhash64(doc_id), and a vocabulary of
``features`` hashes that toxic texts use most beyond the others (their number of toxic texts
times the log ratio of the shares must pass ``least_gain``, about the log of the number of
words tried, so that chance words of a small sample stay out).  Everything else - the prior,
the scores - covers all rows: scoring is one narrow pass over the whole texts.

Defined cases: null and empty texts score the bias; without positives or unlabelled texts
every score is the prior; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm._work import Workspace, arrow_map

STARTS = (5, 6, 7, 8)  # bytes of a word's beginning that are features besides the word


def word_features(data: np.ndarray, off: np.ndarray):
    """Hashes of the words (runs of letters and digits, A-Z lower-cased) and of their
    beginnings, with the document of each."""
    s, e = B.runs(B.ALNUM[data], off)
    doc = B.owner(off, s)
    c = B.prefix(B.LOWER[data])
    hashes, docs = [B.span_hash(c, s, e)], [doc]
    for k in STARTS:
        longer = np.flatnonzero(e - s > k)
        at = s[longer]
        hashes.append(B.span_hash(c, at, at + k) + B.U(k))
        docs.append(doc[longer])
    return np.concatenate(hashes), np.concatenate(docs)


def _distinct(doc: np.ndarray, h: np.ndarray):
    """Distinct (document, feature), ordered by document."""
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return d[new], x[new]


class Vocabulary:
    """Sorted feature hashes with a 16-bit table that rules most others out."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.view(B.U))
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.hashes & B.U(0xFFFF)).astype(np.int64)] = True

    def find(self, data, off):
        """(document, index) of the vocabulary's features in each text, once each."""
        h, doc = word_features(data, off)
        maybe = np.flatnonzero(self.table[(h & B.U(0xFFFF)).astype(np.int64)])
        h, doc = h[maybe], doc[maybe]
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        ok = self.hashes[at] == h
        return _distinct(doc[ok], at[ok])


def train(x: np.ndarray, positive: np.ndarray, prior: float, rounds: int = 300, rate: float = 0.05, decay: float = 1e-3, beta: float = 0.0):
    """Non-negative PU risk by full-batch Adam: rows ``x``, ``positive`` marks P -> (w, b)."""
    xp, xu = x[positive], x[~positive]
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    soft = lambda z: np.logaddexp(0, z)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, rounds + 1):
        zp, zu = xp @ w[:-1] + w[-1], xu @ w[:-1] + w[-1]
        negative = soft(zu).mean() - prior * soft(zp).mean()
        # gradients of the losses in z: l(+) = log(1 + e^-z), l(-) = log(1 + e^z)
        gp, gu = sig(zp) / len(zp), sig(zu) / len(zu)
        if negative >= -beta:
            dp, du = prior * (sig(zp) - 1) / len(zp) - prior * gp, gu
        else:
            dp, du = prior * gp, -gu
        g = np.r_[dp @ xp + du @ xu, dp.sum() + du.sum()]
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], w[-1]


def _sample_features(sample: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, _, data, off in B.pieces(batch.column(2)):
                h, doc = word_features(data, off)
                d, x = _distinct(doc, h)
                yield pa.RecordBatch.from_arrays([pa.array(toxic[lo + d]), pa.array(B.signed(x))], names=["toxic", "h"])

    return arrow_map(sample, run, "toxic boolean, h long")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None, max_positive: int = 3000,
        max_unlabelled: int = 6000, features: int = 1024, least_gain: float = 10.0, least_lift: float = 1.5, folds: int = 5):
    """-> (vocabulary hashes, weights, bias, prior)."""
    work = Workspace(docs.sparkSession, "nnpu")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter((fold != 0) & F.col("y").isin(0, 1))
    if prior is None:
        prior = lab.agg(F.avg("y")).first()[0]
    prior = min(0.95, max(0.005, prior or 0.005))
    toxic = lab.filter("y = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).limit(max_positive)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(fold != 0).distinct()
    known = lab.filter("y = 1").select(F.col("doc_id").alias("k")).distinct()
    other = ids.join(known, F.col("doc_id") == F.col("k"), "left_anti").orderBy(F.xxhash64("doc_id")).limit(max_unlabelled)
    chosen = work.save(
        toxic.withColumn("toxic", F.lit(True)).union(other.withColumn("toxic", F.lit(False))).withColumnRenamed("doc_id", "c_id"), "chosen"
    )
    # at most max_positive + max_unlabelled rows are broadcast
    sample = work.save(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("c_id"))
        .select("doc_id", "toxic", "text"),
        "sample",
    )
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    np_, nu = sizes.get(True, 0), sizes.get(False, 0)
    if not np_ or not nu:
        return np.empty(0, np.int64), np.empty(0), float(np.log(prior / (1 - prior))), prior
    p, u = F.sum(F.col("toxic").cast("int")), F.sum((~F.col("toxic")).cast("int"))
    counts = _sample_features(sample).groupBy("h").agg(p.alias("p"), u.alias("u")).filter("p >= 3")
    lift = F.log(((F.col("p") + 0.5) / np_) / ((F.col("u") + 0.5) / nu))
    vocab = counts.withColumn("gain", F.col("p") * lift).filter((F.col("gain") > least_gain) & (lift > least_lift)).orderBy(F.desc("gain"), "h").limit(features)
    hashes = np.array(sorted(r["h"] for r in vocab.select("h").collect()), np.int64)
    if not len(hashes):
        return hashes, np.empty(0), float(np.log(prior / (1 - prior))), prior
    voc = Vocabulary(hashes)

    def rows(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, n, data, off in B.pieces(batch.column(2)):
                d, at = voc.find(data, off)
                yield pa.RecordBatch.from_arrays([pa.array(toxic[lo : lo + n]), B.lists(d, at.astype(np.int32), n)], names=["toxic", "at"])

    got = arrow_map(sample, rows, "toxic boolean, at array<int>").toPandas()
    x = np.zeros((len(got), len(hashes)), np.float32)
    for i, at in enumerate(got["at"]):
        x[i, np.asarray(at, int)] = 1.0  # presence
    w, b = train(x, got["toxic"].to_numpy(bool), prior)
    return hashes, w, float(b), prior


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, folds: int = 5, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document row; labels of documents
    with crc32(doc_id as text) mod ``folds`` = 0 are not used."""
    hashes, w, b, _ = fit(docs, labels, label, folds=folds, **options)
    voc = Vocabulary(hashes) if len(hashes) else None

    def run(batches):
        for batch in batches:
            for lo, n, data, off in B.pieces(batch.column(1)):
                z = np.full(n, b)
                if voc is not None:
                    doc, at = voc.find(data, off)
                    z += np.bincount(doc, weights=w[at], minlength=n)
                score = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = arrow_map(d, run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")
