"""Quality rules by cross-document line frequency.

``line_verdicts`` hashes the normalised lines of every text, counts in how many distinct
documents of the same host each line occurs, marks lines above the limits as boilerplate and
rejects documents that keep too little without them, besides the per-document base rules.

* A line is normalised by lower-casing A-Z and joining its words with one space; lines
  without a word are ignored.  The key is 64 bits.
* Documents with the same host and the same text count once, so a group of exact copies
  alone never makes its own lines boilerplate.
* A line is boilerplate where it is in more than ``max_docs`` distinct documents *and* in
  more than ``max_share`` of the host's distinct documents.
* With ``low_docs`` a line of at least ``low_words`` words (where it is least repeated) is also
  boilerplate from ``LOW_LEAST`` documents on if it is in more than ``low_docs`` *or* in more
  than ``low_share`` of the host's, so its limit neither grows without end with the host nor
  keeps small hosts out.  Only documents count whose words are at least half outside such
  lines: a group of near copies shares its lines with nobody else and stays for the
  deduplication.
* ``kept`` is false if a base rule fails, or the words outside boilerplate lines are fewer
  than ``min_words`` or less than ``min_left`` of the text's words.

Plan: one Arrow pass over the texts makes counts and one short list of line keys per
document (written once, a few per cent of the text); everything else is joins and hash
aggregates over those keys.  Lines are pre-aggregated per distinct text, then per (host,
line), so no task gets all rows of a common line or a common host; the joins have unique
keys on their small side, which lets AQE split a hot key on the other.

Defined cases: a null text has no words (``base_failed``); a null host is a host of its own;
empty tables give empty results; repeated rows get the same verdict each; other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm._work import Workspace, arrow_map, free_name

WINDOW = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW_KEYS = B.mix(np.arange(101, 101 + WINDOW, dtype=B.U) * B.U(B.BASE)) | B.U(1)
IN_DOC = B.U(0xA24BAED4963EE407)
LOW_LEAST, LOW_DOCS = 3, 100

STATS = (
    "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, line_keys array<long>, line_words array<int>"
)


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: equal to another entry; equal to an entry before it."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    any_, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def _lines(data, off):
    """Starts and ends of the lines (cut at \\n and at document bounds)."""
    nl = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([off[:-1], nl + 1]))
    starts = starts[starts < len(data)]
    stop = np.append(nl, len(data))[np.searchsorted(nl, starts)]
    return starts, np.minimum(stop, off[B.owner(off, starts) + 1])


def line_keys(data, off):
    """Per line with a word: start, end, key of its normalised words, number of words."""
    low = B.LOWER[data]
    s, e, _ = B.words(data, off)
    starts, ends = _lines(data, off)
    if not len(s):
        z = np.empty(0, np.int64)
        return z, z, z.astype(B.U), z
    h = B.span_hash(B.prefix(low), s, e)
    first = np.searchsorted(s, starts)
    last = np.append(first[1:], len(s))
    has = last > first
    first, last = first[has], last[has]
    power, inverse = B.powers(len(s) + 1)
    c = np.zeros(len(s) + 1, B.U)
    np.cumsum(h * power[: len(s)], out=c[1:])
    key = B.mix((c[last] - c[first]) * inverse[first] + (last - first).astype(B.U) * IN_DOC)
    return starts[has], ends[has], key, last - first


def _stats(data, off):
    n = len(off) - 1
    s, e, doc = B.words(data, off)
    c = B.prefix(data)
    n_words = B.per_doc(doc, n)
    letters = np.flatnonzero(~B.SPACE[data] & ((data & 0xC0) != 0x80))
    symbols = np.flatnonzero(SYMBOLS[data])
    # words inside 8-word windows that occur again in the same text
    repeat = np.zeros(n, np.int64)
    if len(s) >= WINDOW:
        h = B.span_hash(c, s, e)
        m = len(s) - WINDOW + 1
        g = sum((h[j : j + m] * WINDOW_KEYS[j] for j in range(WINDOW)), np.zeros(m, B.U))
        at = np.flatnonzero(doc[:m] == doc[WINDOW - 1 :])
        again, _ = _repeated(B.mix(g[at] + doc[at].astype(B.U) * IN_DOC))
        at = at[again]
        cover = np.bincount(at, minlength=len(s) + 1) - np.bincount(at + WINDOW, minlength=len(s) + 1)
        repeat = B.per_doc(doc[np.cumsum(cover)[:-1] > 0], n)
    ls, le, key, count = line_keys(data, off)
    ldoc = B.owner(off, ls)
    _, later = _repeated(B.mix(B.span_hash(c, ls, le) + ldoc.astype(B.U) * IN_DOC))
    # distinct normalised lines of each document with their words
    order = np.lexsort((key, ldoc))
    k, d = key[order], ldoc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    total = np.bincount(np.cumsum(new) - 1, weights=count[order], minlength=int(new.sum())) if len(k) else np.empty(0)
    return {
        "n_words": n_words,
        "word_chars": B.per_doc(B.owner(off, letters), n),
        "n_symbols": B.per_doc(B.owner(off, symbols), n),
        "n_dup_lines": B.per_doc(ldoc[later], n),
        "n_repeat_words": repeat,
        "line_keys": B.lists(d[new], B.signed(k[new]), n),
        "line_words": B.lists(d[new], total.astype(np.int32), n),
    }


def _stats_batches(batches):
    for batch in batches:
        for lo, rows, data, off in B.pieces(batch.column("text")):
            out = _stats(data, off)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(lo, rows) for i in range(3)] + [v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()],
                names=["doc_id", "host", "text_key", *out],
            )


def document_stats(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts and distinct line keys per document; ``text_key`` is a 64-bit key of the text."""
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.xxhash64("text").alias("text_key"),
        F.col("text"),
    )
    return arrow_map(d, _stats_batches, STATS)


def frequent_lines(stats: DataFrame, max_docs: int, max_share: float) -> tuple[DataFrame, DataFrame]:
    """(distinct texts with their lines, boilerplate lines with their document counts)."""
    texts = stats.groupBy("host", "text_key").agg(
        F.first("line_keys").alias("line_keys"), F.first("line_words").alias("line_words")
    )
    entries = texts.select(
        "host", "text_key", F.explode(F.arrays_zip("line_keys", "line_words")).alias("l")
    ).select("host", "text_key", F.col("l.line_keys").alias("line"), F.col("l.line_words").alias("words"))
    hosts = stats.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    counts = (
        entries.groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > max_docs)
    )
    hosts = hosts.withColumnRenamed("host", "h")
    often = (
        counts.join(hosts, F.col("host").eqNullSafe(F.col("h")))
        .filter(F.col("n_docs") > max_share * F.col("host_docs"))
        .select(F.col("host").alias("f_host"), F.col("line").alias("f_line"), "n_docs")
    )
    return entries, often


def low_lines(stats: DataFrame, entries: DataFrame, low_docs: int, low_share: float, low_words: int, work: Workspace) -> DataFrame:
    """Lines above the low limits, counted over documents that have as much else to say."""
    above = lambda n: (n >= LOW_LEAST) & (n > F.least(F.lit(low_docs), F.lit(low_share) * F.col("host_docs")))
    hosts = stats.select("host", "text_key").distinct().groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("host_docs"))
    some = (
        entries.groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("line_words"))
        .filter((F.col("n") >= LOW_LEAST) & (F.col("line_words") >= low_words))
        .join(hosts, F.col("host").eqNullSafe(F.col("h")))
        .filter(above(F.col("n")))
        .select(F.col("host").alias("f_host"), F.col("line").alias("f_line"), "host_docs")
    )
    # written first: only lines above the limits are in it
    held = work.save(
        entries.join(some, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line"))).drop("f_host", "f_line"),
        "low",
    )
    texts = stats.groupBy(F.col("host").alias("h"), F.col("text_key").alias("k")).agg(F.first("n_words").alias("n_words"))
    same = F.col("host").eqNullSafe(F.col("h")) & (F.col("text_key") == F.col("k"))
    carriers = (
        held.groupBy("host", "text_key")
        .agg(F.sum("words").alias("low"))
        .join(texts, same)
        .filter(2 * F.col("low") <= F.col("n_words"))
        .select("h", "k")
    )
    return (
        held.join(carriers, same)
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.first("host_docs").alias("host_docs"))
        .filter(above(F.col("n_docs")))
        .select(F.col("host").alias("f_host"), F.col("line").alias("f_line"), "n_docs")
    )


def line_verdicts(
    docs: DataFrame,
    host: str = "source",
    max_docs: int = 10,
    max_share: float = 0.1,
    min_words: int = 20,
    min_left: float = 0.3,
    max_repeat_pct: int = 30,
    low_docs: int | None = None,
    low_share: float = 0.02,
    low_words: int = 6,
) -> DataFrame:
    """One row per document row: base counts, boilerplate words, ``base_failed``, ``kept``,
    and ``drop_lines`` (keys of its boilerplate lines; null where it has none)."""
    work = Workspace(docs.sparkSession, "rules")
    stats = work.save(document_stats(docs, host), "stats")
    entries, often = frequent_lines(stats, max_docs, max_share)
    if low_docs is not None:
        entries = work.save(entries, "entries")  # read four times
        often = often.unionByName(low_lines(stats, entries, low_docs, low_share, low_words, work))
        often = often.groupBy("f_host", "f_line").agg(F.max("n_docs").alias("n_docs"))
    removed = (
        entries.join(often, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")))
        .groupBy("host", "text_key")
        .agg(
            F.sum("words").alias("n_line_words"),
            F.count(F.lit(1)).alias("n_frequent_lines"),
            F.collect_list("line").alias("drop_lines"),  # bounded by the lines of one text
        )
        .withColumnRenamed("host", "r_host")
        .withColumnRenamed("text_key", "r_key")
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    left = F.col("n_words") - F.col("n_line_words")
    return (
        stats.drop("line_keys", "line_words")
        .join(removed, F.col("host").eqNullSafe(F.col("r_host")) & (F.col("text_key") == F.col("r_key")), "left")
        .withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)).cast("long"))
        .withColumn("n_frequent_lines", F.coalesce("n_frequent_lines", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= min_words) & (left >= min_left * F.col("n_words")))
        .drop("r_host", "r_key")
    )


def drop_lines(data, off, keys: list) -> list[bytes | None]:
    """The texts without the lines whose key is in the document's list; None where there is
    no list (the text stays as it is)."""
    starts, ends, key, _ = line_keys(data, off)
    key = B.signed(key)
    first = np.searchsorted(starts, off)  # the lines of document i are first[i] .. first[i + 1]
    out: list[bytes | None] = []
    for i, mine in enumerate(keys):
        if not mine:
            out.append(None)
            continue
        lo, hi = first[i], first[i + 1]
        bad = lo + np.flatnonzero(np.isin(key[lo:hi], np.array(mine, np.int64)))
        kept, at = [], int(off[i])
        for s, e in zip(starts[bad].tolist(), ends[bad].tolist()):
            kept.append(data[at:s].tobytes())
            at = min(int(off[i + 1]), e + 1)  # with its \n
        kept.append(data[at : off[i + 1]].tobytes())
        out.append(b"".join(kept))
    return out


def edited_batches(batches, at: int):
    """Batches whose last column lists line keys -> batches without it, whose texts (column
    ``at``) lost those lines; a megabyte of text at a time, whatever the size of a batch."""
    for batch in batches:
        last = batch.num_columns - 1
        keys = batch.column(last)
        if keys.null_count == len(keys):
            yield batch.select(range(last))
            continue
        for lo, rows, data, off in B.pieces(batch.column(at)):
            some = batch.slice(lo, rows).select(range(last))
            mine = keys.slice(lo, rows)
            if mine.null_count < rows:
                col = some.column(at)
                texts = drop_lines(data, off, mine.to_pylist())
                for i, ok in enumerate(col.is_valid().to_pylist()):
                    if texts[i] is None and ok:
                        texts[i] = data[off[i] : off[i + 1]].tobytes()
                new = pa.array(texts, pa.binary()).cast(pa.string()).cast(col.type)
                some = pa.RecordBatch.from_arrays([new if i == at else some.column(i) for i in range(last)], names=some.schema.names)
            yield some


def apply_rules(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """``docs`` without rejected rows; texts lose their boilerplate lines, columns stay."""
    v = line_verdicts(docs, host, **limits)
    # rows that need no change carry nothing: only rejected and edited texts are on this side
    verdicts = (
        v.filter(~F.col("kept") | F.col("drop_lines").isNotNull())
        .groupBy(F.col("doc_id").alias("_v_id"), F.col("host").alias("_v_host"), F.col("text_key").alias("_v_key"))
        .agg(F.first("kept").alias("_v_kept"), F.first("drop_lines").alias("_v_lines"))
    )
    packed = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.col(host).cast("string").alias("_host"),
        F.xxhash64("text").alias("_key"),
    )
    same = F.col("_id").eqNullSafe(F.col("_v_id")) & F.col("_host").eqNullSafe(F.col("_v_host")) & (F.col("_key") == F.col("_v_key"))
    joined = (
        packed.join(verdicts, same, "left")
        .filter(F.coalesce("_v_kept", F.lit(True)))
        .select("row.*", F.col("_v_lines").alias(free_name(docs, "_v_lines")))
    )
    at = [c.lower() for c in docs.columns].index("text")
    return arrow_map(joined, lambda batches: edited_batches(batches, at), docs.schema)
