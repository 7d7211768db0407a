"""SimHash near-duplicates by covering locality-sensitive hashing.

``fingerprints`` gives the 64-bit SimHash of every text (word shingles, XXH64); ``near_groups``
links fingerprints within ``radius`` differing bits and returns the component of every
document.

Covering family: bit i gets the vector ``1 + i mod (2**(r+1) - 1)`` of r+1 bits, and every
non-zero vector v gives one mask that keeps bit i where the inner product <v, vector(i)> is
odd.  Up to r differing bits have r vectors in a space of r+1 dimensions, so some non-zero v
is orthogonal to all of them: that mask drops every differing bit and the pair collides in
its table.  No pair within the radius is missed (31 tables for r = 4, each keeping 32 to 34
bits), and every candidate is compared exactly.

Plan: distinct fingerprints only (a group of exact copies is one row); rows of buckets with
one member are dropped after a pre-aggregated count.  Members of a bucket differ in the bits
its mask drops only, so a bucket above ``block`` members is split by each of r+1 parts of
those bits: a pair within the radius agrees in one of them.  What is still above ``block`` is
cut into blocks by hash, and each pair of blocks is its own group, so no task holds an unbounded
bucket and no pair is skipped.  A group returns a spanning forest of its links, not its
pairs; components are found by alternating stars over those.

Defined cases: null and empty texts have fingerprint zero and link like any other; repeated
rows get the same result each; a null doc_id keeps its row and is never the smallest unless
the component has no other; extra columns of the input are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from rankloom.llm._components import components
from rankloom.llm._work import Workspace, arrow_map

SEED = 42
BLOCK = 2048
STEP = 1 << 16  # shingles unpacked at once


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text: bit set where over half the shingle hashes have it."""
    ws = (text or "").encode().lower().split()  # bytes.lower is A-Z only; split is \x20 \x09-\x0D
    if not ws:
        return 0
    line = b" ".join(ws)
    if len(ws) < shingle:
        digests = [xxh64_digest(line, SEED)]
    else:
        ends = [x + i for i, x in enumerate(accumulate(map(len, ws)))]
        starts = [0, *[x + 1 for x in ends]]
        digests = [xxh64_digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])]
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), STEP):
        ones += np.unpackbits(raw[at : at + STEP], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(raw)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp)``: one row per document row, ``fp`` the fingerprint as a signed
    long, ``text_key`` a 64-bit key of the text."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            col = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), col], names=["doc_id", "text_key", "fp"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    return arrow_map(d, run, "doc_id long, text_key long, fp long")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    size = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if (v & (1 + i % size)).bit_count() & 1) for v in range(1, size + 1)
    ]


def dropped_parts(mask: int, radius: int, bits: int = 64) -> list[int]:
    """The bits that ``mask`` drops, in ``radius + 1`` parts."""
    dropped = [i for i in range(bits) if not mask >> i & 1]
    return [sum(1 << i for i in dropped[p :: radius + 1]) for p in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (smallest index) of n nodes under links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _group_links(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (node, smaller node) inside runs of equal ``group``."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    bits = fp.view(np.uint64)
    out_a, out_b = [], []
    small = np.repeat(size <= 64, size)
    end = np.repeat(start + size, size)
    at = np.flatnonzero(small)
    a_s, b_s, d = [], [], 1
    while len(at := at[at + d < end[at]]):
        near = at[np.bitwise_count(bits[at] ^ bits[at + d]) <= radius]
        a_s.append(near)
        b_s.append(near + d)
        d += 1
    if a_s:
        a, b = np.concatenate(a_s), np.concatenate(b_s)
        if len(a):
            label = _min_labels(len(fp), a, b)
            hung = np.flatnonzero(label != np.arange(len(fp)))
            out_a.append(fp[hung])
            out_b.append(fp[label[hung]])
    for s, m in zip(start[size > 64], size[size > 64]):
        x = bits[s : s + m]
        a_s, b_s = [], []
        for r in range(0, m, 256):
            i, j = np.nonzero(np.bitwise_count(x[r : r + 256, None] ^ x[None, :]) <= radius)
            keep = i + r < j
            a_s.append(i[keep] + r)
            b_s.append(j[keep])
        a, b = np.concatenate(a_s), np.concatenate(b_s)
        if len(a):
            label = _min_labels(m, a, b)
            hung = np.flatnonzero(label != np.arange(m))
            out_a.append(fp[s + hung])
            out_b.append(fp[s + label[hung]])
    if not out_a:
        z = np.empty(0, np.int64)
        return z, z
    return np.concatenate(out_a), np.concatenate(out_b)


def candidate_groups(distinct: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """``(fp, g)``: groups of distinct fingerprints such that every pair within ``radius`` bits
    shares one; no group has more than ``2 * block`` members."""
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    rows = distinct.select("fp", F.explode(tables).alias("b")).select("fp", "b.t", "b.key")
    buckets = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    few = rows.join(buckets.filter(F.col("n") <= block), ["t", "key"]).select("fp", F.xxhash64("t", "key").alias("g"))
    parts = F.array(*[F.array(*[F.lit(_signed(x)) for x in dropped_parts(m, radius)]) for m in masks])
    split = (
        rows.join(buckets.filter(F.col("n") > block).drop("n"), ["t", "key"])
        .select("fp", "t", "key", F.posexplode(F.get(parts, F.col("t"))).alias("p", "m"))
        .select("fp", "t", "key", "p", F.col("fp").bitwiseAND(F.col("m")).alias("sub"))
    )
    sub = ["t", "key", "p", "sub"]
    cut = F.ceil(F.col("n") / block).cast("int")
    many = (
        split.join(split.groupBy(*sub).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), sub)
        .withColumn("cut", cut)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cut")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
        .select("fp", F.xxhash64(*sub, F.least("own", "other"), F.greatest("own", "other")).alias("g"))
    )
    return few.unionByName(many)


def near_links(distinct: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` within ``radius`` bits: enough of
    them to connect every component, each of them a true link or a path of true links."""
    members = candidate_groups(distinct, radius, block)

    def links(batches):
        carry_fp, carry_g = np.empty(0, np.int64), np.empty(0, np.int64)

        def emit(fp, g):
            u, v = _group_links(fp, g, radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            fp = np.concatenate([carry_fp, batch.column(0).to_numpy(zero_copy_only=False)])
            g = np.concatenate([carry_g, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(g):
                continue
            last = int(np.searchsorted(g, g[-1]))  # the last group may go on in the next batch
            if last:
                yield emit(fp[:last], g[:last])
            carry_fp, carry_g = fp[last:], g[last:]
        if len(carry_g):
            yield emit(carry_fp, carry_g)

    return arrow_map(members.repartition("g").sortWithinPartitions("g"), links, "u long, v long").distinct()


def _roots(docs: DataFrame, shingle: int, radius: int, block: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, text_key, fp`` per document row, ``node, root`` per fingerprint with a link),
    both written: a join of two plain scans is one whose hot keys AQE can split."""
    fps = work.save(fingerprints(docs, shingle), "fingerprints")
    roots = components(near_links(fps.select("fp").distinct(), radius, block), work)
    return fps, work.save(roots, "roots")


def near_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest doc_id reachable over links of at most
    ``radius`` differing bits, for every document row."""
    work = Workspace(docs.sparkSession, "simhash")
    fps, roots = _roots(docs, shingle, radius, block, work)
    # copies are reduced to their fingerprint first, and components to one row each
    least = fps.groupBy(F.col("fp").alias("f")).agg(F.min("doc_id").alias("least"))
    rooted = work.save(least.join(roots, F.col("f") == F.col("node"), "left").select("f", F.coalesce("root", "f").alias("root"), "least"), "rooted")
    first = work.save(rooted.groupBy(F.col("root").alias("c")).agg(F.min("least").alias("component_id")), "components")
    ids = work.save(rooted.join(first, F.col("root") == F.col("c")).select("f", "component_id"), "ids")
    return fps.join(ids, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the one with the smallest doc_id
    (a null id only where the group has no other; one row where rows repeat); columns stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("k")
    fps, roots = _roots(docs, shingle, radius, block, Workspace(docs.sparkSession, "simhash"))
    keep = (
        fps.join(roots, F.col("fp") == F.col("node"), "left")
        .select("doc_id", "text_key", F.coalesce("root", "fp").alias("root"))
        .groupBy("root")
        .agg(first)
        .select(F.coalesce("k.doc_id", F.lit(0)).alias("k_id"), F.col("k.text_key").alias("k_key"))
        .distinct()
    )
    packed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_key"),
        F.col("doc_id").isNull().alias("_no_id"),
    )
    kept = packed.join(keep, (F.col("_id") == F.col("k_id")) & (F.col("_key") == F.col("k_key")))
    # repeated rows meet in the join's own partitioning, so this adds no exchange
    one = Window.partitionBy("_id", "_key").orderBy("_no_id")
    return kept.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select("row.*")
