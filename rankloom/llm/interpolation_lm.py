"""Language-model scores by deleted interpolation of word n-grams.

``score_texts`` learns a bigram model from the training documents and scores every text:

    P(w | u v) = l2[b] c(v w) / c(v)  +  l1[b] c(w) / N  +  l0[b] / (V + 1)

with b the bucket of the context's frequency: the octave of c(v) and that of c(u v), the pair
that leads up to the word (a pair that was seen makes the next one likelier, above all in
passages that occur again).  The weights of every b are learned by expectation-maximisation on
held-out counts: a tenth of the training documents is scored with the counts of the others.  Tokens are words, lower-cased A-Z, then one end token; the context
of the first word is the end token.  Counts cover all training documents.

Plan.  Rows with the same doc_id and text are one row with a number within each batch, and the
rest is dealt by doc_id and text into blocks of about ``BLOCK`` bytes of text.  A block sends each
of its distinct words and pairs once, with its counts, as one packed row for each of ``RANGES``
ranges of hashes, whatever the size of the corpus.  The rows of ``GROUP`` blocks and one range
meet in a task, which adds up their counts.  Where there are more blocks than a group has, each
group asks in turn, with its merged keys and ranges cut ``RANGES`` times finer, until one group
is left: its sums are the totals.  They go back down the same way, to each asker in the order
of its keys, so answers need no keys.  The blocks meet their answers in a cogroup (the texts'
exchange is the same one, reused) and write the counts of every token.  Every shuffle carries
one entry per distinct key and asker, packed as sorted differences: about 5 bytes for a pair
and one or two for an answer, where rows would take 30.  A word that is in every text is one
entry per block, and ranges of hashes are even, so there is no hot key.  A task holds the
distinct keys of one block, or one range of ``GROUP`` askers.  Weights and scores
then come from the written counts without any shuffle; the driver sees N, V and a histogram
of held-out counts on a grid of bounded size.

Keys are 64-bit hashes for words and 56-bit hashes for pairs.

Defined cases: a null or empty text has the end token only; a document without a doc_id is
held out (nothing is learned from it); repeated rows count and are scored each; with no
training document every probability is that of the uniform part; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm._work import Workspace, arrow_map
from rankloom.session import ship_package

BLOCK = 10 << 20
RANGES = 64  # ranges of hashes a block's keys are sent in; each level cuts them as often again
GROUP = 256  # askers whose keys of one range meet in a task
END = B.mix(np.array([0x656E64], B.U))[0]
PAIR = (B.U(0x9FB21C651E98DF25), B.U(0xC2B2AE3D27D4EB4F))
GRID = 4  # cells of the held-out histogram per octave of a probability
OCTAVES = 64
BEFORE = 4  # octaves of the leading pair's count: none, 1, 2 to 3, more
HELD, DEV = 0, 1  # remainders: scored only; held-out counts


def block_tokens(text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a column of texts, the token before each, tokens per text."""
    toks, sizes = [], []
    for _, rows, data, off in B.pieces(text):
        low = B.LOWER[data]
        s, e, doc = B.words(low, off)
        tok = np.full(len(s) + rows, END, B.U)
        tok[np.arange(len(s)) + doc] = B.span_hash(B.prefix(low), s, e)
        toks.append(tok)
        sizes.append(B.per_doc(doc, rows) + 1)
    if not toks:
        return np.empty(0, B.U), np.empty(0, B.U), np.empty(0, np.int64)
    tok = np.concatenate(toks)
    return tok, np.r_[END, tok[:-1]], np.concatenate(sizes)


def pair_keys(prev: np.ndarray, tok: np.ndarray) -> np.ndarray:
    return B.mix(prev * PAIR[0] + tok * PAIR[1]) >> B.U(8)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as byte planes of their differences."""
    step = np.diff(keys, prepend=keys[:1])
    width = max(1, (int(step.max()).bit_length() + 7) // 8)
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return keys[:1].astype("<u8").tobytes() + planes.tobytes()


def unpack_sorted(raw: bytes, n: int) -> np.ndarray:
    first = np.frombuffer(raw, "<u8", 1)[0]
    planes = np.frombuffer(raw, np.uint8, offset=8).reshape(-1, n)
    step = np.zeros((n, 8), np.uint8)
    step[:, : len(planes)] = planes.T
    return np.cumsum(step.view("<u8").ravel()) + first


def pack_counts(x: np.ndarray) -> bytes:
    """Counts as byte planes of the width they need (planes of zeros are left out)."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_counts(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    planes = np.frombuffer(raw, np.uint8).reshape(-1, n)
    out[:, : len(planes)] = planes.T
    return out.view("<i8").ravel()


def _range_bounds(keys: np.ndarray, first: int, parts: int, ranges: int, bits: int) -> np.ndarray:
    """Where sorted ``keys`` of the ranges ``first`` to ``first + parts - 1`` (of ``ranges`` equal
    ones over ``bits`` bits) are cut."""
    edges = [-(-(b << bits) // ranges) for b in range(first + 1, first + parts)]
    return np.r_[0, np.searchsorted(keys, np.array(edges, B.U)), len(keys)].astype(np.int64)


ASKED = "bucket long, unit long, kind int, n int, keys binary, rest binary, dev binary"
ANSWERED = "unit long, bucket long, kind int, n int, rest binary, dev binary"
BITS = (64, 56)  # of the keys of either kind
COUNTED = "doc_id long, split int, times int, n long, words binary, pairs binary, words_rest binary, pairs_rest binary"


def _once(batches):
    """Rows of a batch with the same doc_id and text as one, with their number."""
    for batch in batches:
        rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()))
        first = {r: i for i, r in reversed(list(enumerate(rows)))}
        times = np.bincount([first[r] for r in rows], minlength=len(rows)).astype(np.int32)
        out = batch.append_column("times", pa.array(times))
        yield out if len(first) == len(rows) else out.take(pa.array(np.flatnonzero(times)))


def _requests(unit: int, kind: int, first: int, parts: int, ranges: int, keys, rest, dev) -> list[tuple]:
    """One packed row for each range that has some of the sorted ``keys``."""
    bound = _range_bounds(keys, first, parts, ranges, BITS[kind])
    return [
        (int(first + b), unit, kind, int(j - i), pack_sorted(keys[i:j]), pack_counts(rest[i:j]), pack_counts(dev[i:j]))
        for b, i, j in ((b, bound[b], bound[b + 1]) for b in np.flatnonzero(np.diff(bound)))
    ]


def _asked(rows: list[tuple]) -> pa.Table:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "unit", "kind", "n", "keys", "rest", "dev"]
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, types)], names=names)


def _answered(rows: list[tuple]) -> pa.Table:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["unit", "bucket", "kind", "n", "rest", "dev"]
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, types)], names=names)


def _ask(table: pa.Table) -> pa.Table:
    """A block of texts -> its requests."""
    tok, prev, size = block_tokens(table.column("text"))
    split = np.repeat(table.column("split").to_numpy().astype(np.int8), size)
    times = np.repeat(table.column("times").to_numpy(), size)
    block, rows = table.column("block")[0].as_py(), []
    for kind in range(len(BITS)):
        distinct, at = np.unique(tok if kind == 0 else pair_keys(prev, tok), return_inverse=True)
        rest, dev = (
            np.bincount(at[some], weights=times[some], minlength=len(distinct)).astype(np.int64) for some in (split > DEV, split == DEV)
        )
        rows += _requests(block, kind, 0, RANGES, RANGES, distinct, rest, dev)
    return _asked(rows)


def _of_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pa.array(table.column("kind").to_numpy() == kind))


def _sums(some: pa.Table):
    """Requests of one kind and range -> distinct keys, the place of every asker's keys among
    them, both sums."""
    n = some.column("n").to_pylist()
    keys = np.concatenate([unpack_sorted(k, m) for k, m in zip(some.column("keys").to_pylist(), n)])
    distinct, at = np.unique(keys, return_inverse=True)
    total = []
    for name in ("rest", "dev"):
        x = np.concatenate([unpack_counts(k, m) for k, m in zip(some.column(name).to_pylist(), n)])
        total.append(np.bincount(at, weights=x, minlength=len(distinct)).astype(np.int64))
    return distinct, at, total


def _replies(some: pa.Table, bucket: int, kind: int, at, total) -> list[tuple]:
    """Each asker's totals, in the order of its keys."""
    out, end = [], 0
    for unit, m in zip(some.column("unit").to_pylist(), some.column("n").to_pylist()):
        mine = at[end : end + m]
        end += m
        out.append((unit, bucket, kind, m, pack_counts(total[0][mine]), pack_counts(total[1][mine])))
    return out


def _answer(table: pa.Table) -> pa.Table:
    """All requests of one range -> the replies, and the number of training words in it."""
    bucket, rows = table.column("bucket")[0].as_py(), []
    for kind in range(len(BITS)):
        some = _of_kind(table, kind)
        if some.num_rows:
            _, at, total = _sums(some)
            rows += _replies(some, bucket, kind, at, total)
            if kind == 0:
                rows.append((-1 - bucket, bucket, 2, int(((total[0] + total[1]) > 0).sum()), b"", b""))
    return _answered(rows)


def _merge(ranges: int):
    """Requests of one range and group of askers -> the group's requests, in finer ranges."""

    def run(table: pa.Table) -> pa.Table:
        bucket, group, rows = table.column("bucket")[0].as_py(), table.column("grp")[0].as_py(), []
        for kind in range(len(BITS)):
            some = _of_kind(table, kind)
            if some.num_rows:
                distinct, _, total = _sums(some)
                rows += _requests(group, kind, bucket * RANGES, RANGES, ranges * RANGES, distinct, *total)
        return _asked(rows)

    return run


def _down(asked: pa.Table, replies: pa.Table) -> pa.Table:
    """A group's requests of one range and the replies to its merged ones -> each asker's."""
    rows = []
    for kind in range(len(BITS)):
        some = _of_kind(asked, kind)
        if some.num_rows:
            _, at, _ = _sums(some)
            mine = _of_kind(replies, kind).sort_by("bucket")
            n = mine.column("n").to_pylist()
            total = [np.concatenate([unpack_counts(k, m) for k, m in zip(mine.column(c).to_pylist(), n)]) for c in ("rest", "dev")]
            rows += _replies(some, asked.column("bucket")[0].as_py(), kind, at, total)
    return _answered(rows)


def total_counts(asked: DataFrame, units: int, ranges: int = RANGES, group: int = GROUP) -> DataFrame:
    """Requests of ``units`` askers -> replies with the totals over all of them, by merging
    ``group`` askers at a time until one group is left."""
    if units <= group:
        return asked.groupBy("bucket").applyInArrow(_answer, ANSWERED)
    grouped = asked.withColumn("grp", F.floor(F.col("unit") / group).cast("long"))
    merged = grouped.groupBy("bucket", "grp").applyInArrow(_merge(ranges), ASKED)
    above = total_counts(merged, -(-units // group), ranges * RANGES, group)
    replies = above.filter("kind < 2").select(
        F.floor(F.col("bucket") / RANGES).cast("long").alias("wide"), F.col("unit").alias("grp"), "bucket", "kind", "n", "rest", "dev"
    )
    down = grouped.groupBy("bucket", "grp").cogroup(replies.groupBy("wide", "grp")).applyInArrow(_down, ANSWERED)
    return down.unionByName(above.filter("kind = 2"))


def _packed(values: np.ndarray, size: np.ndarray, wanted: np.ndarray | None = None) -> pa.Array:
    """The counts of each text's tokens, packed; null where they are not wanted."""
    end = np.cumsum(size)
    rows = range(len(size))
    return pa.array(
        [pack_counts(values[end[i] - size[i] : end[i]]) if wanted is None or wanted[i] else None for i in rows], pa.binary()
    )


def _unpacked(column, size: np.ndarray) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(unpack_counts(raw, n) for raw, n in zip(column.to_pylist(), size))])


def _meet(left: pa.Table, right: pa.Table) -> pa.Table:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("split", pa.int32()), ("times", pa.int32()), ("n", pa.int64())]
        + [(c, pa.binary()) for c in ("words", "pairs", "words_rest", "pairs_rest")]
    )
    if not left.num_rows:  # word totals of one range
        n = sum(right.column("n").to_pylist())
        return pa.Table.from_pylist([{"doc_id": None, "split": -1, "times": 1, "n": n}], schema=schema)
    tok, prev, size = block_tokens(left.column("text"))
    split = left.column("split").to_numpy()
    dev = split == DEV
    both, rest_of_dev = [], []
    for kind in (0, 1):
        _, at = np.unique(tok if kind == 0 else pair_keys(prev, tok), return_inverse=True)
        some = right.filter(pa.array(right.column("kind").to_numpy() == kind)).sort_by("bucket")
        n = some.column("n").to_pylist()
        rest, held = (
            np.concatenate([unpack_counts(k, m) for k, m in zip(some.column(name).to_pylist(), n)]) for name in ("rest", "dev")
        )
        both.append(_packed((rest + held)[at], size))
        rest_of_dev.append(_packed(rest[at], size, dev))
    return pa.table([left.column("doc_id"), pa.array(split), left.column("times"), pa.array(size), *both, *rest_of_dev], schema=schema)


def token_counts(docs: DataFrame, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``(doc_id, split, times, n, words, pairs, words_rest, pairs_rest)``: packed, for every token of
    every text, the training counts of the token and of its pair with the one before; the
    same without the held-out part for documents of that part; ``times`` is the number of equal
    rows that one stands for.  Rows with split -1 have the number
    of distinct training words of one hash range in ``n``."""
    ship_package(docs.sparkSession)
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10))
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(part, F.lit(HELD)).cast("int").alias("split"),
        "text",
        F.xxhash64("text").alias("text_key"),
    )
    d = arrow_map(d, _once, "doc_id long, split int, text string, text_key long, times int")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(blocks))).drop("text_key")
    answers = total_counts(d.groupBy("block").applyInArrow(_ask, ASKED), blocks, group=group)
    return d.groupBy("block").cogroup(answers.groupBy("unit")).applyInArrow(_meet, COUNTED)


def octave(count: np.ndarray) -> np.ndarray:
    """0 for no count, else 1 + floor(log2(count))."""
    return np.where(count > 0, np.frexp(count.astype(np.float64))[1], 0)


def context(words: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Count of the token before each: the end token's for the first."""
    prev = np.empty(len(words), np.int64)
    prev[1:] = words[:-1]
    prev[off[:-1]] = words[off[1:] - 1]  # a text's last token is the end token
    return prev


def bucket(words: np.ndarray, pairs: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count of each token's context, and its bucket: the octave of that count and, in steps of
    ``OCTAVES + 1``, that of the count of the pair before (none for a text's first token)."""
    ctx = context(words, off)
    lead = np.zeros(len(pairs), np.int64)
    lead[1:] = pairs[:-1]
    lead[off[:-1]] = 0
    return ctx, octave(ctx) + (OCTAVES + 1) * np.minimum(octave(lead), BEFORE - 1)


def _held_out(total: int, types: int):
    """Histogram of held-out tokens: bucket of the context, grid cells of both estimates."""

    def cell(p):
        with np.errstate(divide="ignore"):
            return np.where(p > 0, np.floor(-np.log2(np.where(p > 0, p, 1)) * GRID), 1023).astype(np.int64)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                size, times = part.column(0).to_numpy(), part.column(3).to_numpy()
                off = np.r_[0, np.cumsum(size)]
                words, pairs = _unpacked(part.column(1), size), _unpacked(part.column(2), size)
                ctx, b = bucket(words, pairs, off)
                p2 = np.where(ctx > 0, pairs / np.maximum(ctx, 1), 0.0)
                code = (b << 20) | (cell(p2) << 10) | cell(words / max(1, total))
                code, at = np.unique(code, return_inverse=True)
                count = np.bincount(at, weights=np.repeat(times, size), minlength=len(code)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["code", "n"])

    return run


def mixture_weights(code: np.ndarray, count: np.ndarray, types: int, rounds: int = 60) -> np.ndarray:
    """EM on held-out counts -> weights (pair, word, uniform) of every bucket."""
    out = np.tile([0.0, 0.9, 0.1], (BEFORE * (OCTAVES + 1), 1))
    buckets, k2, k1 = code >> 20, (code >> 10) & 1023, code & 1023
    value = lambda k: np.where(k < 1023, 2.0 ** (-(k + 0.5) / GRID), 0.0)
    p = np.stack([np.minimum(1, value(k2)), np.minimum(1, value(k1)), np.full(len(code), 1 / (types + 1))], axis=1)
    for lead in range(BEFORE):
        seen = None
        for o in range(OCTAVES + 1):
            b = lead * (OCTAVES + 1) + o
            mine = buckets == b
            if mine.any():
                w, x, c = np.array([1 / 3, 1 / 3, 1 / 3]), p[mine], count[mine].astype(float)
                for _ in range(rounds):
                    share = x * w
                    share /= share.sum(axis=1, keepdims=True)
                    w = (share * c[:, None]).sum(axis=0) / c.sum()
                w = np.maximum(w, [0, 1e-9, 1e-6])
                out[b] = w / w.sum()
                seen = b
            elif seen is not None:  # no held-out token has such a context: the next rarer octave's weights
                out[b] = out[seen]
            elif lead:  # nor a rarer one: those without such a pair before
                out[b] = out[b - OCTAVES - 1]
        none = lead * (OCTAVES + 1)  # no context count, no pair estimate
        out[none] = [0.0, *(out[none][1:] / out[none][1:].sum())]
    return out


def _scores(weights: np.ndarray, total: int, types: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                size = part.column(2).to_numpy()
                off = np.r_[0, np.cumsum(size)]
                words, pairs = _unpacked(part.column(3), size), _unpacked(part.column(4), size)
                ctx, b = bucket(words, pairs, off)
                w = weights[b]
                p = w[:, 0] * pairs / np.maximum(ctx, 1) + w[:, 1] * words / max(1, total) + w[:, 2] / (types + 1)
                base = np.log10((words + 0.1) / (total + 0.1 * (types + 1)))
                doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
                n = len(off) - 1
                out = pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(part.column(1).to_numpy() == HELD), pa.array(size.astype(np.int64)),
                        pa.array(np.bincount(doc[words > 0], minlength=n).astype(np.int64)), pa.array(np.full(n, total, np.int64)),
                        pa.array(np.bincount(doc, weights=base, minlength=n)), pa.array(np.bincount(doc, weights=np.log10(p), minlength=n)),
                    ],
                    names=names,
                )
                row = np.repeat(np.arange(n), part.column(5).to_numpy())
                for at in range(0, len(row), 10_000):
                    yield out.take(pa.array(row[at : at + 10_000])) if len(row) > n else out

    return run


def score_texts(docs: DataFrame, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every
    document row; logarithms to base 10."""
    work = Workspace(docs.sparkSession, "lm")
    counts = work.save(token_counts(docs, block, group), "counts")
    n = F.col("n") * F.col("times")
    sums = counts.agg(
        F.sum(F.when(F.col("split") >= DEV, n)).alias("total"),
        F.sum(F.when(F.col("split") > DEV, n)).alias("rest"),
        F.sum(F.when(F.col("split") == -1, F.col("n"))).alias("types"),
    ).first()
    total, rest, types = (int(x or 0) for x in sums)
    held = arrow_map(
        counts.filter(F.col("split") == DEV).select("n", "words_rest", "pairs_rest", "times"), _held_out(rest, types), "code long, n long"
    )
    cells = held.groupBy("code").agg(F.sum("n").alias("n")).toPandas()  # cells of the grid, whatever the corpus
    weights = mixture_weights(cells["code"].to_numpy(np.int64), cells["n"].to_numpy(np.int64), types)
    rows = counts.filter("split >= 0").select("doc_id", "split", "n", "words", "pairs", "times")
    return arrow_map(
        rows, _scores(weights, total, types),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
