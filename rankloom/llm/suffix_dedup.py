"""Repeated passages by longest-previous-factor arrays over suffix order.

``repeated_spans`` finds every byte of every text that lies in a ``length``-byte string which
also starts somewhere else (``keep="none"``) or has an earlier copy (``keep="first"``: the
copy at the smallest (doc_id, text key, position) stays).  Matches never cross documents.

1. *Anchors.*  A ``length``-byte window has ``length - K + 1`` K-byte grams; the leftmost one
   with the least hash is its anchor.  Equal windows have equal anchors at equal places, so
   only windows with the same anchor gram need to meet.  A run of windows with one anchor is
   a *stretch* (about 70 windows, 270 bytes).
2. Anchors whose gram occurs once are dropped by a pre-aggregated count.  Stretches that are
   equal as a whole are settled by their 128-bit key (gram hash and stretch hash): every one
   has a copy, and one of them stands for all in the next step.
3. The distinct stretches of a gram (the ends of repeated passages) are cut from the texts
   and grouped by gram.  A task builds the suffix order of its stretches by prefix doubling
   to depth ``length``, finds the previous and next smaller text positions in it, and from
   these the longest previous factor of every window, cut at ``length``: the longer of the
   prefixes that it shares with either.
4. A gram with more than ``part`` distinct stretches is dealt over several tasks.  The
   first window of each class in each of them is named by 128 bits and the names are joined
   across tasks, so a passage that a third of the corpus shares is no task's burden.

Nothing is sampled or capped; memory in a task is a multiple of one text or one part.

Defined cases: null and empty texts and texts shorter than ``length`` have no spans.  Rows
with the same doc_id and the same text are copies of each other for ``keep="none"``; for
``keep="first"`` they are one document and stay alike.  Rows with the same doc_id and other
text are different documents.  Of repeated rows each task passes on one text and one of each span.  Extra columns are ignored by the finder and kept by
``remove_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm._work import Workspace, arrow_map, slices

GRAM = 64
PART = 4000
AT = B.U((1 << 22) - 1)  # low bits of the packed gram hash: place in a section
SECTION = 1 << 21
NO_ID = (1 << 63) - 1  # a null doc_id comes after all others


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[p : p + w] for every p (block prefix and suffix minima)."""
    n = len(x) - w + 1
    pad = -(-len(x) // w) * w
    y = np.full(pad, np.iinfo(np.uint64).max, B.U)
    y[: len(x)] = x
    y = y.reshape(-1, w)
    pre = np.minimum.accumulate(y, axis=1).ravel()
    suf = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suf[:n], pre[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, off: np.ndarray, length: int, gram: int = GRAM):
    """Stretches of every text: document, first window, windows, place of the anchor in the
    first window, gram hash, stretch hash."""
    w = length - gram + 1
    parts = []
    # sections of whole documents, or of one long document with an overlap of one window run
    lo, n = 0, len(data)
    c = B.prefix(data)
    while n - lo >= length:
        hi = min(n, lo + SECTION)
        at = np.arange(lo, hi - gram + 1)
        h = B.span_hash(c, at, at + gram)
        packed = (h & ~AT) | (at - lo).astype(B.U)
        least = _window_min(packed, w)  # windows lo .. hi - length
        p = lo + np.arange(len(least))
        doc = B.owner(off, p)
        inside = p + length <= off[doc + 1]
        place = (least & AT).astype(np.int64) + lo
        new = np.ones(len(p), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        cut = hi < n
        if cut:  # the last run may go on in the next section
            last = int(np.flatnonzero(new)[-1])
            nxt = lo + last if last else hi - length + 1
            inside[last if last else len(p):] = False
        ok = np.flatnonzero(inside)
        if len(ok):
            fresh = new[ok]
            fresh[0] = True
            first = ok[fresh]
            count = np.diff(np.r_[np.flatnonzero(fresh), len(ok)])
            s, a = p[first], place[first]
            parts.append((doc[first], s - off[doc[first]], count, a - s, h[a - lo], B.span_hash(c, s, s + count - 1 + length)))
        if not cut:
            break
        lo = nxt
    if not parts:
        z = np.empty(0, np.int64)
        return z, z, z, z, z.astype(B.U), z.astype(B.U)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _texts(docs: DataFrame) -> DataFrame:
    """(id, key, text): the identity of a document and its text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("key"), "text"
    )


def _once(texts: DataFrame) -> DataFrame:
    """``texts`` with each (id, key) at most once a task."""

    def run(batches):
        seen: set[tuple[int, int]] = set()  # bounded by the rows of the task
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            new = [i for i, r in enumerate(rows) if not (r in seen or seen.add(r))]
            yield batch if len(new) == len(rows) else batch.take(pa.array(new, pa.int64()))

    return arrow_map(texts, run, "id long, key long, text string")


def _stretches(texts: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, rows, data, off in B.pieces(batch.column(2)):
                doc, s, n, d, gram, whole = anchors(data, off, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (B.signed(gram), B.signed(whole), ids[lo + doc], keys[lo + doc], s.astype(np.int32), n.astype(np.int16))],
                    names=["gram", "whole", "id", "key", "s", "n"],
                )

    return arrow_map(texts, run, "gram long, whole long, id long, key long, s int, n short")


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Adds the bytes of each wanted stretch: rows are (id, key, text, wants)."""
    names = ["gram", "part", "parts", "copies", "id", "key", "s", "n", "bytes"]

    def run(batches):
        for batch in slices(batches):
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, wants = batch.column(2), batch.column(3)
            out = [[] for _ in names]
            for i, want in enumerate(wants.to_pylist()):
                raw = texts[i].as_py().encode()
                for w in want:
                    for col, v in zip(out, (w["gram"], w["part"], w["parts"], w["copies"], ids[i], keys[i], w["s"], w["n"], raw[w["s"] : w["s"] + w["n"] - 1 + length])):
                        col.append(v)
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return arrow_map(rows, run, "gram long, part int, parts int, copies long, id long, key long, s int, n short, bytes binary")


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, the first highest; zeros past the end."""
    raw = np.r_[data, np.zeros(8, np.uint8)]
    words = np.zeros(len(data), B.U)
    for k in range(8):
        words |= raw[k : k + len(data)].astype(B.U) << B.U(56 - 8 * k)
    return words


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every position's suffix cut at ``depth`` bytes (equal prefixes rank equal), by
    prefix doubling from the first eight bytes; the bytes are padded with zeros past the end."""
    have = min(8, depth)
    _, rank = np.unique(eight_bytes(data) >> B.U(64 - 8 * have), return_inverse=True)
    rank = rank.astype(np.int64) + 1
    while have < depth:
        step = min(have, depth - have)  # the last step overlaps
        nxt = np.zeros(len(rank), np.int64)
        nxt[: max(0, len(rank) - step)] = rank[step:]
        pair = rank * (int(rank.max(initial=0)) + 1) + nxt
        _, rank = np.unique(pair, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        have += step
    return rank


def previous_smaller(x: np.ndarray) -> np.ndarray:
    """Place of the nearest smaller value before each, -1 where there is none: jumps of halving
    width over the minima of 1, 2, 4, ... values."""
    least, width = [x], 1
    while width < len(x):
        low = least[-1].copy()
        low[width:] = np.minimum(low[width:], least[-1][:-width])
        least.append(low)
        width *= 2
    at = np.arange(len(x)) - 1
    for low in reversed(least):
        jump = (at >= 0) & (low[at] > x)
        at = np.maximum(np.where(jump, at - width, at), -1)
        width //= 2
    return at


def shared_prefix(a: np.ndarray, b: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and at ``b``, cut at ``depth``;
    ``words`` are the eight bytes from every place on."""
    n = np.zeros(len(a), np.int64)
    go = np.arange(len(a))
    for at in range(0, depth, 8):
        x = words[a[go] + at] ^ words[b[go] + at]
        n[go] += sum((x >> B.U(bits) == 0).astype(np.int64) for bits in range(0, 64, 8))
        go = go[x == 0]
    return np.minimum(n, depth)


def previous_factors(data: np.ndarray, at: np.ndarray, order: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For the suffixes at ``at`` (of ``depth`` bytes or more) with text order ``order``: the
    longest previous factor, cut at ``depth``; and whether any other one shares ``depth``
    bytes.  Of all suffixes before it in the text, the one that shares most with a suffix is
    the nearest on either side in suffix order, the previous or the next smaller position."""
    rank = suffix_ranks(data, depth)[at]
    sa = np.lexsort((order, rank))
    same = rank[sa][1:] == rank[sa][:-1]
    # behind the first of those that share ``depth`` bytes, the previous smaller position does too
    head = sa[np.r_[True, ~same][: len(sa)]]
    text = order[head].astype(np.int32)
    before = previous_smaller(text)
    after = len(head) - 1 - previous_smaller(text[::-1])[::-1]  # len(head) where there is none
    words = eight_bytes(data)
    found = np.zeros(len(head), np.int64)
    for near, has in ((before, before >= 0), (after, after < len(head))):
        k = np.flatnonzero(has)
        found[k] = np.maximum(found[k], shared_prefix(at[head[k]], at[head[near[k]]], words, depth))
    lpf = np.full(len(sa), depth, np.int64)
    lpf[head] = found
    other = np.zeros(len(rank), bool)
    other[sa[1:]] = same
    other[sa[:-1]] |= same
    return lpf, other


def _factor(cols: dict, length: int, keep: str):
    """Matches inside one part: (rows of spans), (rows of names to be joined across parts)."""
    off = np.zeros(len(cols["bytes"]) + 1, np.int64)
    np.cumsum([len(b) for b in cols["bytes"]], out=off[1:])
    data = np.frombuffer(b"".join(cols["bytes"]), np.uint8)
    n = cols["n"].astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = off[row] + within
    # text order of the windows: (id, key, position)
    order = np.empty(len(row), np.int64)
    order[np.lexsort((cols["s"][row] + within, cols["key"][row], cols["id"][row]))] = np.arange(len(row))
    lpf, other = previous_factors(data, at, order, length)
    earlier = lpf >= length
    hit = earlier if keep == "first" else other
    split = (cols["parts"][row] > 1) & ~earlier  # the class's first window in this part
    c = B.prefix(data)
    named = np.flatnonzero(split)
    x, y = B.span_hash(c, at[named], at[named] + length), B.span_hash(c, at[named] + 16, at[named] + length - 16)
    # runs of hit windows become spans
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | ~hit[:-1]
    heads = np.flatnonzero(hit & new)
    ends = np.flatnonzero(hit & np.r_[new[1:] | ~hit[1:], True]) if len(row) else heads
    return row, within, heads, ends, named, x, y


def _match(part: DataFrame, length: int, keep: str) -> DataFrame:
    """Stretches sorted by group -> spans (kind 0) and window names (kind 1)."""
    names = ["kind", "id", "key", "lo", "hi", "x", "y"]

    def run(batches):
        held, size = [], 0

        def work(batch):
            cols = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("id", "key", "s", "n", "parts")}
            cols["bytes"] = batch.column("bytes").to_pylist()
            row, within, heads, ends, named, x, y = _factor(cols, length, keep)
            s = cols["s"].astype(np.int64)
            lo = np.r_[s[row[heads]] + within[heads], s[row[named]] + within[named]]
            hi = np.r_[s[row[ends]] + within[ends], s[row[named]] + within[named]] + length
            r = np.r_[row[heads], row[named]]
            z = np.zeros(len(heads), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (np.r_[z, np.ones(len(named), np.int64)].astype(np.int32), cols["id"][r], cols["key"][r], lo.astype(np.int32), hi.astype(np.int32), np.r_[z, B.signed(x)], np.r_[z, B.signed(y)])],
                names=names,
            )

        for batch in slices(batches, 1 << 19):
            held.append(batch)
            size += batch.nbytes
            if size > (1 << 20):  # whole groups, about a MB at a time
                t = pa.Table.from_batches(held).combine_chunks()
                g = t.column("g").to_numpy()
                last = int(np.searchsorted(g, g[-1]))
                if last:
                    yield work(t.slice(0, last).combine_chunks().to_batches()[0])
                held = t.slice(last).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held) if last else 0
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            if t.num_rows:
                yield work(t.to_batches()[0])

    return arrow_map(part, run, "kind int, id long, key long, lo int, hi int, x long, y long")


def repeated_spans(docs: DataFrame, length: int = 200, keep: str = "first", part: int = PART) -> DataFrame:
    """``(id, key, spans)``: byte spans ``[lo, hi)`` to remove from each document that has any
    (they may overlap); ``id`` is doc_id (the greatest long for null), ``key`` xxhash64(text)."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    if length < GRAM + 32:
        raise ValueError(f"length must be at least {GRAM + 32}")
    work = Workspace(docs.sparkSession, "suffix")
    texts = _texts(docs)
    # written first: the anchors are found once, and a join of two plain scans is one whose hot
    # keys AQE can split
    every = work.save(_stretches(texts, length), "anchors")
    twice = work.save(every.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("gram").alias("g")), "grams")
    found = work.save(every.join(twice, F.col("gram") == F.col("g"), "left_semi"), "stretches")
    work.drop("anchors")
    # equal stretches: one stands for all
    whole = work.save(
        found.groupBy("gram", "whole").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "key", "s", "n")).alias("first")
        ),
        "distinct",
    )
    settled = found.join(whole.filter("copies > 1").select(F.col("gram").alias("g"), F.col("whole").alias("w"), "first"), (F.col("gram") == F.col("g")) & (F.col("whole") == F.col("w")))
    if keep == "first":
        settled = settled.filter(F.struct("id", "key", "s") != F.struct("first.id", "first.key", "first.s"))
    settled = settled.select("id", "key", F.col("s").alias("lo"), (F.col("s") + F.col("n") - 1 + length).cast("int").alias("hi"))
    many = whole.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select(F.col("gram").alias("g"), F.ceil(F.col("kinds") / part).cast("int").alias("parts"))
    many = work.save(many, "many")  # so that the join below can split a hot gram
    wants = (
        whole.join(many, F.col("gram") == F.col("g"))
        .select("first.id", "first.key", F.struct("gram", F.pmod(F.xxhash64("whole"), F.col("parts")).cast("int").alias("part"), "parts", "copies", "first.s", "first.n").alias("want"))
        .groupBy(F.col("id").alias("w_id"), F.col("key").alias("w_key"))
        .agg(F.collect_list("want").alias("wants"))  # bounded by the stretches of one text
    )
    one = _once(texts).join(wants, (F.col("id") == F.col("w_id")) & (F.col("key") == F.col("w_key"))).select("id", "key", "text", "wants")
    one = one.groupBy("id", "key").agg(F.first("text").alias("text"), F.first("wants").alias("wants"))  # a row of each task at most
    grouped = _cut(one, length).withColumn("g", F.xxhash64("gram", "part")).drop("gram", "part")
    found2 = work.save(_match(grouped.repartition("g").sortWithinPartitions("g"), length, keep), "matches")
    spans = found2.filter("kind = 0").select("id", "key", "lo", "hi")
    names = found2.filter("kind = 1")
    by_name = names.groupBy(F.col("x").alias("nx"), F.col("y").alias("ny")).agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "key", "lo")).alias("first")).filter("c > 1")
    across = names.join(by_name, (F.col("x") == F.col("nx")) & (F.col("y") == F.col("ny")))
    if keep == "first":
        across = across.filter(F.struct("id", "key", "lo") != F.col("first"))
    spans = settled.unionByName(spans).unionByName(across.select("id", "key", "lo", "hi"))
    # rows with the same id and text give the same spans: they are reduced before they meet
    return spans.distinct().groupBy("id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined, in order."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    packed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d_id"),
        F.xxhash64("text").alias("d_key"),
    )
    return packed.join(spans, (F.col("d_id") == F.col("id")) & (F.col("d_key") == F.col("key")), "left")


def _pairs(column) -> list:
    return [None if v is None else [(x["lo"], x["hi"]) for x in v] for v in column.to_pylist()]


def span_digest(docs: DataFrame, length: int = 200, keep: str = "none") -> DataFrame:
    """Per document row: n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes."""

    def run(batches):
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column(1), _pairs(batch.column(2))):
                raw = (text.as_py() or "").encode()
                cut = merged(spans or [])
                h, at = hashlib.sha256(), 0
                for s, e in cut:
                    h.update(raw[at:s])
                    at = e
                h.update(raw[at:])
                out.append((len(raw), sum(e - s for s, e in cut), len(cut), h.hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    spans = repeated_spans(docs, length, keep)
    d = docs.select("doc_id", "text")
    rows = _with_spans(d, spans).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"), "spans"
    )
    return arrow_map(rows, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 200, keep: str = "first") -> DataFrame:
    """``docs`` with the repeated spans cut out of the texts; columns and rows stay.  A cut
    that would split a character keeps the whole character."""
    names = docs.columns
    at = [c.lower() for c in names].index("text")

    def run(batches):
        for batch in slices(batches):
            col = batch.column(at)
            texts = col.to_pylist()
            for i, spans in enumerate(_pairs(batch.column(len(names)))):
                if spans:
                    raw, pos, keep_ = texts[i].encode(), 0, []
                    for s, e in merged(spans):
                        while s < e and raw[s] & 0xC0 == 0x80:  # inside a character: it stays
                            s += 1
                        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
                            e -= 1
                        keep_.append(raw[pos:s])
                        pos = e
                    texts[i] = b"".join([*keep_, raw[pos:]]).decode()
            cols = [batch.column(i) for i in range(len(names))]
            cols[at] = pa.array(texts, col.type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    spans = repeated_spans(docs, length, keep)
    joined = _with_spans(docs, spans).select("row.*", F.col("spans").alias("_" * 3 + "spans"))
    return arrow_map(joined, run, docs.schema)
