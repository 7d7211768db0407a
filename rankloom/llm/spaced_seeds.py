"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits (any non-ASCII byte counts as a letter), lower-cased
A-Z.  Each fixed mask hashes the tokens at its 1-positions and ignores those at its
0-positions, so a substitution at an ignored place does not hide an overlap.

1. Seeds of the benchmark items are made with all masks.
2. One pass over the texts makes their seeds and keeps those in a Bloom filter of the
   benchmark's seeds.  The filter has a fixed size (``bloom_bits``, 2 MB by default) whatever
   the tables' sizes; a fuller one only lets more rows through to the exact join.
3. Surviving seeds are cut into segments of at most ``SPREAD`` places, which carry the token
   hashes around them, and are joined exactly, by a shuffle, with the benchmark's seeds.  A hit
   is a segment, an item and their alignment, once, and ships the segment and the part of the
   item beside it: a bounded number of tokens, however many items a document holds.
4. Each hit is verified: on its alignment some window of ``window`` tokens (the whole item
   where it is shorter) must agree in ``share`` of its tokens.

A passage of ``window`` tokens is found whatever its place, with up to ``(1 - share) *
window`` tokens replaced, if one mask meets no replaced token; see the tests for the rate.

Items shorter than ``SHORT`` tokens have masks of their own length (``short_masks``) that find
every copy with up to ``(1 - share)`` of the tokens replaced; items shorter than ``WHOLE`` are
found where all their tokens are.  The texts are only given the masks of lengths that the
benchmark has.

Defined cases: null and empty texts and items have no tokens and no hits; items shorter than
``least`` tokens are ignored (none by default); repeated rows give one pair; a null doc_id or item_id stays null in
pairs; extra columns are ignored by ``contaminated_pairs`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm._work import Workspace, arrow_map

MASKS = ("11010111", "1100101011", "1110010011", "1011001101")  # fixed; weight 6
WINDOW, SHARE, LEAST = 13, 0.8, 1
WHOLE, SHORT = 8, 12
SPREAD = 64  # places from a segment's first seed to its last
BLOOM_BITS = 1 << 24
KEYS = B.mix(np.arange(501, 501 + 16, dtype=B.U) * B.U(B.BASE)) | B.U(1)


def tokens(data: np.ndarray, off: np.ndarray):
    """Token hashes and the document of each."""
    s, e = B.runs(B.ALNUM[data], off)
    return B.span_hash(B.prefix(B.LOWER[data]), s, e), B.owner(off, s)


def short_masks(n: int, window: int = WINDOW, share: float = SHARE) -> tuple[str, ...]:
    """Masks of items of n tokens that need their own: cut into blocks, r replaced tokens leave
    all but r of them whole, so one choice of that many blocks meets no replaced token."""
    if n < WHOLE:
        return ("1" * n,) if n else ()
    if n >= SHORT or n > window:
        return ()
    r = n - math.ceil(share * n)
    if not r:
        return ("1" * n,)
    blocks = min(r + 2, n)
    block = [i * blocks // n for i in range(n)]
    return tuple("".join("01"[b in kept] for b in block) for kept in itertools.combinations(range(blocks), blocks - r))


def seeds(h: np.ndarray, doc: np.ndarray, masks=MASKS):
    """(start token, seed) of every mask at every place inside one document."""
    at, out = [], []
    for mask in masks:
        n = len(h) - len(mask) + 1
        if n < 1:
            continue
        x = np.full(n, int(KEYS[15]) * (2 * int(f"1{mask}", 2) + 1) % (1 << 64), B.U)
        for j, bit in enumerate(mask):
            if bit == "1":
                x = x + h[j : j + n] * KEYS[j]
        ok = np.flatnonzero(doc[:n] == doc[len(mask) - 1 :])
        at.append(ok)
        out.append(B.mix(x[ok]))
    if not at:
        return np.empty(0, np.int64), np.empty(0, B.U)
    return np.concatenate(at), np.concatenate(out)


def _item_rows(items: DataFrame, masks, window: int, share: float, least: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, rows, data, off in B.pieces(batch.column(1)):
                h, doc = tokens(data, off)
                bound = np.searchsorted(doc, np.arange(rows + 1))
                for i in range(rows):
                    t = h[bound[i] : bound[i + 1]]
                    if len(t) < least:
                        continue
                    at, seed = seeds(t, np.zeros(len(t), np.int64), short_masks(len(t), window, share) or masks)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo + i, 1), pa.array([B.signed(t)]), pa.array([at.astype(np.int32)]), pa.array([B.signed(seed)])],
                        names=["item_id", "tokens", "at", "seeds"],
                    )

    return arrow_map(
        items.select(F.col("item_id").cast("long").alias("item_id"), "text"), run,
        "item_id long, tokens array<long>, at array<int>, seeds array<long>",
    )


def _probes(seed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = B.U(bits - 1)
    return (seed & m).astype(np.int64), ((seed >> B.U(32)) & m).astype(np.int64)


def bloom(seed_rows: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """The filter as bytes: set words are merged by ``bit_or`` per 64-bit word before they
    reach the driver, so at most ``bits / 64`` rows do."""
    m = bits - 1
    place = F.explode(F.array(F.col("seed").bitwiseAND(F.lit(m)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(m))))
    words = (
        seed_rows.select(place.alias("b"))
        .groupBy(F.shiftright("b", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("v"))
        .toPandas()
    )
    out = np.zeros(bits // 64, B.U)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).view(B.U)
    return out


def _has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (filter_[at >> 6] >> (at & 63).astype(B.U)) & B.U(1) != 0


def _segments(docs: DataFrame, filter_: np.ndarray, masks, reach: int, bits: int) -> DataFrame:
    """Per run of surviving seeds: the document, the tokens around it, places and seeds."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_)
    span = max(map(len, masks))

    def run(batches):
        f = shared.value
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for lo, rows, data, off in B.pieces(batch.column(2)):
                h, doc = tokens(data, off)
                at, seed = seeds(h, doc, masks)
                a, b = _probes(seed, bits)
                ok = np.flatnonzero(_has(f, a))
                ok = ok[_has(f, b[ok])]
                if not len(ok):
                    continue
                at, seed = at[ok], seed[ok]
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order]
                first = np.searchsorted(doc, doc[at])
                last = np.searchsorted(doc, doc[at], "right")
                new = np.ones(len(at), bool)
                new[1:] = (doc[at[1:]] != doc[at[:-1]]) | (at[1:] - at[:-1] > 2 * reach + span)
                part = (at - at[np.flatnonzero(new)][np.cumsum(new) - 1]) // SPREAD
                new[1:] |= part[1:] != part[:-1]
                heads = np.flatnonzero(new)
                ends = np.r_[heads[1:], len(at)]
                take = lo + doc[at[heads]]
                starts = np.maximum(first[heads], at[heads] - reach)
                stops = np.minimum(last[heads], at[ends - 1] + span + reach)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(take)), keys.take(pa.array(take)),
                        pa.array([int(x - y) for x, y in zip(starts, first[heads])], pa.int64()),
                        pa.array([B.signed(h[s:e]) for s, e in zip(starts, stops)], pa.list_(pa.int64())),
                        pa.array([(at[i:j] - s).astype(np.int32) for i, j, s in zip(heads, ends, starts)], pa.list_(pa.int32())),
                        pa.array([B.signed(seed[i:j]) for i, j in zip(heads, ends)], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "key", "first", "tokens", "at", "seeds"],
                )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return arrow_map(d, run, "doc_id long, key long, first long, tokens array<long>, at array<int>, seeds array<long>")


def best_window(text: np.ndarray, item: np.ndarray, shift: int, w: int) -> tuple[int, int, int]:
    """Most agreeing tokens in a window of ``w`` of the alignment text[i + shift] ~ item[i]:
    (matches, window length, first text token)."""
    lo, hi = max(0, -shift), min(len(item), len(text) - shift)
    if hi - lo < w:
        return 0, w, 0
    eq = np.r_[0, np.cumsum(text[lo + shift : hi + shift] == item[lo:hi])]
    score = eq[w:] - eq[:-w]
    best = int(score.argmax())
    return int(score[best]), w, best + lo + shift


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, masks=MASKS, window: int = WINDOW, share: float = SHARE,
    least: int = LEAST, bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """``(doc_id, key, item_id, matched, length, first_token)`` for every document row (key:
    xxhash64 of its text) and item that overlap."""
    good = verified(aligned(docs, benchmark, masks, window, share, least, bloom_bits), share)
    best = F.max(F.struct("matched", (-F.col("first_token")).alias("at"), "length")).alias("b")
    return good.groupBy("doc_id", "key", "item_id").agg(best).select(
        "doc_id", "key", "item_id", F.col("b.matched").alias("matched"), F.col("b.length").alias("length"),
        (-F.col("b.at")).alias("first_token"),
    )


def aligned(
    docs: DataFrame, benchmark: DataFrame, masks=MASKS, window: int = WINDOW, share: float = SHARE,
    least: int = LEAST, bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """The hits: a segment's tokens beside the item's, and how they are aligned."""
    work = Workspace(docs.sparkSession, "seeds")
    items = work.save(_item_rows(benchmark, masks, window, share, least), "items")
    lengths = items.select(F.size("tokens").alias("n")).filter(F.col("n") < SHORT).distinct().collect()  # < SHORT rows
    masks = tuple(dict.fromkeys([*masks, *(m for r in sorted(lengths) for m in short_masks(r["n"], window, share))]))
    item_seeds = items.select("item_id", F.explode(F.arrays_zip("at", "seeds")).alias("z")).select(
        "item_id", F.col("z.at").alias("i_at"), F.col("z.seeds").alias("seed")
    )
    filter_ = bloom(item_seeds, bloom_bits)
    reach = window + max(map(len, masks))
    found = work.save(_segments(docs, filter_, masks, reach, bloom_bits).withColumn("segment", F.monotonically_increasing_id()), "segments")
    hits = (
        found.select("segment", F.explode(F.arrays_zip("at", "seeds")).alias("z"))
        .select("segment", F.col("z.at").alias("at"), F.col("z.seeds").alias("d_seed"))
        .join(item_seeds, F.col("d_seed") == F.col("seed"))
        .select("segment", "item_id", (F.col("at") - F.col("i_at")).alias("shift"))
        .distinct()
    )
    # of an item only what lies beside the segment
    start, stop = F.greatest(F.lit(0), -F.col("shift")), F.least(F.size("item"), F.size("tokens") - F.col("shift"))
    return (
        hits.join(found.select(F.col("segment").alias("f_segment"), "doc_id", "key", "first", "tokens"), F.col("segment") == F.col("f_segment"))
        .join(items.select(F.col("item_id").alias("t_id"), F.col("tokens").alias("item")), F.col("item_id").eqNullSafe(F.col("t_id")))
        .select(
            "doc_id", "key", "first", "tokens", F.slice("item", start + 1, F.greatest(stop - start, F.lit(0))).alias("item"),
            "item_id", (F.col("shift") + start).alias("shift"), F.least(F.lit(window), F.size("item")).alias("w"),
        )
    )


def verified(hits: DataFrame, share: float) -> DataFrame:
    """Hits of which some window agrees in ``share`` of its tokens."""

    def verify(batches):
        for batch in batches:
            rows = []
            firsts, shifts, ws = (batch.column(c).to_pylist() for c in (2, 6, 7))
            for i in range(batch.num_rows):
                text, item = batch.column(3)[i].values.to_numpy(), batch.column(4)[i].values.to_numpy()
                m, w, at = best_window(text, item, shifts[i], ws[i])
                rows.append((m, w, firsts[i] + at, m >= math.ceil(share * w)))
            m, w, at, ok = (np.array(x) for x in zip(*rows)) if rows else (np.empty(0, np.int64),) * 4
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep), batch.column(5).take(keep), *(pa.array(x[keep.to_numpy()].astype(np.int64)) for x in (m, w, at))],
                names=["doc_id", "key", "item_id", "matched", "length", "first_token"],
            )

    return arrow_map(hits, verify, "doc_id long, key long, item_id long, matched long, length long, first_token long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text overlaps a benchmark item; columns stay."""
    bad = contaminated_pairs(docs, benchmark, **options).select(F.col("doc_id").alias("b_id"), F.col("key").alias("b_key")).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_key"))
    same = F.col("_id").eqNullSafe(F.col("b_id")) & (F.col("_key") == F.col("b_key"))
    return packed.join(bad, same, "left_anti").select("row.*")
