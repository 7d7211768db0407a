"""Quality classifier: regularised quadratic discriminant over document statistics.

``document_features`` turns every whole text into transformed statistics (log sizes, logit
shares); ``fit`` estimates one Gaussian per class from moments that Spark sums over all
labelled training rows, shrinks each covariance towards the pooled one and its diagonal, and
caches the Cholesky factors; ``score`` is the logistic function of the difference of the
log densities (Mahalanobis terms by the cached factors) plus the log prior ratio.

Nothing is sampled: moments are sums, so training is one narrow pass and an aggregate of
``2 * (1 + d + d*d)`` numbers, whatever the number of labelled rows.  Texts are read once, by
the pass that writes the features.

Defined cases: null and empty texts have the features of an empty text and a score like any
other; a label of a missing document is ignored, of a repeated document counts once per row;
null labels are ignored; without two rows of both classes every score is the share of label 1
(0.5 without labels); extra columns are ignored.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm import quality_rules
from rankloom.llm._work import Workspace, arrow_map

FOLDS = 5


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_UPPER, _LOWER, _DIGIT = (_mask(bytes(range(a, b))) for a, b in ((65, 91), (97, 123), (48, 58)))
_TAIL = _mask(bytes(range(128, 192)))
_CLASSES = np.stack(
    [
        _UPPER, _DIGIT, _mask(b".,;:"), _mask(b"!"), _mask(b"?"), _mask(b"|"), _mask(b"#*$%&<>"), _mask(b"-_/@=+~^"),
        _mask(bytes(range(192, 256))), _mask(b"\n"),
    ],
    axis=1,
).astype(np.float64)
NAMES = (
    "log_words log_chars log_word_length upper digit stops exclaim question bar symbol mark non_ascii newline "
    "log_line_words dup_lines repeat_words distinct_words short_words long_words upper_words entropy"
).split()


def _logit(share: np.ndarray, at: float = 0.002) -> np.ndarray:
    return np.log((share + at) / (1 + at - np.minimum(share, 1)))


def _features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    stats = quality_rules._stats(data, off)
    words = stats["n_words"].astype(float)
    some = np.maximum(words, 1)
    hist = np.stack([np.bincount(data[off[i] : off[i + 1]], minlength=256) for i in range(n)]).astype(float)
    chars = hist[:, ~_TAIL].sum(axis=1)
    shares = hist @ _CLASSES / np.maximum(chars, 1)[:, None]
    p = hist / np.maximum(hist.sum(axis=1), 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    s, e, doc = B.words(data, off)
    size = e - s
    per = lambda w: B.per_doc(doc, n, w) / some
    key = np.unique(B.mix(B.span_hash(B.prefix(B.LOWER[data]), s, e) + doc.astype(B.U) * quality_rules.IN_DOC), return_index=True)[1]
    distinct = B.per_doc(doc[key], n) / some
    lines = hist[:, 10] + 1
    return np.column_stack(
        [
            np.log1p(words), np.log1p(chars), np.log1p(stats["word_chars"] / some), _logit(shares), np.log1p(words / lines),
            _logit(stats["n_dup_lines"] / lines), _logit(stats["n_repeat_words"] / some), distinct * np.log1p(words),
            _logit(per(size <= 3)), _logit(per(size >= 12)), _logit(per(_UPPER[data[s]])), entropy,
        ]
    )


def document_features(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the transformed statistics of every document row."""

    def run(batches):
        for batch in batches:
            for lo, rows, data, off in B.pieces(batch.column(1)):
                x = _features(data, off)
                bound = pa.array(np.arange(rows + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), pa.ListArray.from_arrays(bound, pa.array(x.ravel()))], names=["doc_id", "x"]
                )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(d, run, "doc_id long, x array<double>")


@dataclasses.dataclass
class Gaussians:
    """Two classes: log priors, means, inverse Cholesky factors, log determinants."""

    prior: np.ndarray
    mean: np.ndarray | None = None
    inverse: np.ndarray | None = None
    logdet: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.prior[1])
        x = np.clip(x, self.low, self.high)
        density = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.inverse[k].T
            density.append(np.log(self.prior[k]) - 0.5 * (z * z).sum(axis=1) - 0.5 * self.logdet[k])
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def from_moments(n, total, outer, shrink: float = 0.3, diagonal: float = 0.05) -> Gaussians:
    """Class counts, sums and sums of outer products -> shrunken Gaussians."""
    n = np.asarray(n, float)
    if n.min() < 2:
        return Gaussians(n / n.sum() if n.sum() else np.array([0.5, 0.5]))
    mean = total / n[:, None]
    cov = outer / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
    spread = np.sqrt(np.maximum(np.diag(pooled), 0)) + 1e-6
    grand = total.sum(axis=0) / n.sum()
    inverse, logdet = [], []
    for k in (0, 1):
        c = (1 - shrink) * cov[k] + shrink * pooled
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(c))
        factor = np.linalg.cholesky(c)
        inverse.append(np.linalg.inv(factor))
        logdet.append(2 * np.log(np.diag(factor)).sum())
    return Gaussians(n / n.sum(), mean, np.stack(inverse), np.array(logdet), grand - 10 * spread, grand + 10 * spread)


def _rows(col) -> np.ndarray:
    off = col.offsets.to_numpy()
    return col.values.to_numpy()[off[0] : off[-1]].reshape(len(col), -1)


def fit(features: DataFrame, labels: DataFrame, label: str = "quality", **shrinkage) -> Gaussians:
    """``features(doc_id, x)`` and ``labels(doc_id, <label>)``; every given label is used."""
    lab = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)")
    d = len(NAMES)

    def moments(batches):
        out = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            if batch.num_rows:
                x, y = _rows(batch.column(0)), batch.column(1).to_numpy()
                for k in (0, 1):
                    z = x[y == k]
                    out[k] += np.r_[len(z), z.sum(axis=0), (z.T @ z).ravel()]
        if out.any():
            at = np.arange(out.size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out.ravel())], names=["at", "v"])

    joined = features.join(lab, F.col("doc_id") == F.col("l_id")).select("x", "y")
    sums = arrow_map(joined, moments, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((2, 1 + d + d * d))
    for r in sums:
        m[divmod(r["at"], m.shape[1])] = r["v"]
    return from_moments(m[:, 0], m[:, 1 : 1 + d], m[:, 1 + d :].reshape(2, d, d), **shrinkage)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, folds: int = FOLDS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document row; labels of documents
    with crc32(doc_id as text) mod ``folds`` = 0 are not used."""
    work = Workspace(docs.sparkSession, "qda")
    features = work.save(document_features(docs), "features")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    model = fit(features, labels.filter(fold != 0), label)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                score = model.score(_rows(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
                )

    scored = arrow_map(features, run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")
