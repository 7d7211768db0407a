"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous sweeps.

``token_pieces`` tokenises every text, adds the end id and cuts what is longer than
``capacity``; ``pack`` places the pieces, longest first, each into the smallest gap that holds
it.

Pieces of one length, and gaps of one size, are interchangeable, and both are whole numbers
up to ``capacity``.  So the sweeps run on the number of pieces of each length and the
intervals of sequences with each gap - a state bounded by ``capacity``, whatever the number of
documents - and every step moves a whole class: all pieces of a length find the successor
among the gap sizes, the k-th piece (by rank) takes the k-th sequence of that gap, gaps are
updated, and what is left goes to the next successor, or opens sequences where there is
none.  A step fills the gap of an interval as often as the length fits, so the plan has at
most ``most_rows(lengths, capacity)`` rows, 260,096 for a capacity of 2048.  Documents never pass through the driver: Spark range-sorts the pieces by (length,
doc_id, start, row), gives each its rank within its length from per-partition counts, and a
join on (length, rank range) hands out sequence and offset.

The tokenizer is applied per white-space-separated word, with a bounded cache of words per
task; it drops white space, so the ids are those of the whole text.

Defined cases: a null or empty text is one piece that holds only the end id; repeated rows
are packed each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm import _bytes as B
from rankloom.llm._work import Workspace, arrow_map

CACHE_WORDS, CACHE_PARTS = 120_000, 500_000  # at most about 130 MB in a worker
TEXTS = 2 << 20  # bytes of text whose words are looked up together
MARKS = b".,!?;:*#$%&"  # neither letters nor numbers, so the tokenizer splits before them
LETTERS = frozenset(range(97, 123)) | frozenset(range(65, 91))
LATIN = frozenset(range(0x80, 0xC0)) - {0x97, 0xB7}  # behind 0xC3: the letters U+00C0 to U+00FF
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")  # lower-case ASCII and Latin-1 letters only
# the byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes, in
# turn, for the characters from 256 on
_OTHERS = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD)]
ALPHABET = {b: 256 + i for i, b in enumerate(_OTHERS)}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _reduced(word: bytes) -> bytes:
    """``word`` without the marks behind its last letter, which the tokenizer splits off.

    Only behind ASCII letters and U+00C0 to U+00FF, whose lower-case form is one letter: others
    may grow a mark of their own that joins those behind it."""
    core = word.rstrip(MARKS)
    if len(core) == len(word) or not core or b"<|" in word:  # the last may hold a special token
        return word
    last = core[-1]
    return core if last in LETTERS or (last in LATIN and core[-2:-1] == b"\xc3") else word


class WordIds:
    """Words (UTF-8) -> ids as little-endian unsigned 32-bit bytes; either cache is emptied when
    full.

    A-Z are lower-cased for a whole text and marks after a last letter cut off a new word, both
    of which the tokenizer does itself, so that the forms of one word are encoded once."""

    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        self.encode, self.pieces = tokenizer.encode_batch_fast, tokenizer.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        parts, known = self.parts, self.known
        if len(parts) > CACHE_PARTS:
            parts.clear()
        cores = list(map(_reduced, words))
        tails = [w[len(c) :] for w, c in zip(words, cores)]
        other = []
        for p in set(cores).union(tails).difference(parts):
            if PLAIN.fullmatch(p):  # nothing to normalise or split: the model's pieces are the ids
                text = p.decode("latin-1")
                parts[p] = array("I", [t.id for t in self.pieces(text if p.isascii() else text.translate(ALPHABET))]).tobytes()
            else:
                other.append(p)
        for at in range(0, len(other), 20_000):
            some = other[at : at + 20_000]
            for p, e in zip(some, self.encode([p.decode() for p in some], add_special_tokens=False)):
                parts[p] = array("I", e.ids).tobytes()
        for w, core, tail in zip(words, cores, tails):
            known[w] = parts[core] + parts[tail] if tail else parts[core]

    def texts(self, raws: list[bytes]) -> list[bytes]:
        # lower-casing could make a special token of what is none
        words = [(raw if b"<|" in raw else raw.lower()).split() for raw in raws]
        every, known = set(itertools.chain.from_iterable(words)), self.known
        new = every.difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = every
        self._learn(list(new))
        return [b"".join(map(known.__getitem__, ws)) for ws in words]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One cache per Python worker, kept from task to task."""
    return WordIds(path)


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        ids = word_ids(path)
        for batch in batches:
            for lo, n, data, off in B.pieces(batch.column(1), TEXTS):
                raws = [data[off[i] : off[i + 1]].tobytes() for i in range(n)]
                rows = []
                for i, raw in enumerate(ids.texts(raws)):
                    raw += end
                    for p, s in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[s : s + 4 * capacity]
                        rows.append((lo + i, p, s // 4, len(part) // 4, zlib.crc32(part)))
                at, piece, start, length, crc = (np.array(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(piece.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(d, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def most_rows(lengths: int, capacity: int) -> int:
    """Bound on the rows of a plan with so many different lengths.

    A length splits at most one interval of sequences, or opens at most two, so at the end there
    are at most ``2 * lengths`` intervals of sequences with the same contents.  Every row puts a
    length into one of them or more; a length meets an interval in one row, but for one row
    more in the step that ends the length.  A sequence holds at most d different lengths where
    1 + 2 + ... + d <= capacity."""
    d = (math.isqrt(8 * capacity + 1) - 1) // 2
    return lengths * (2 * d + 1)


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Sweeps over length classes -> rows ``(length, rank from, rank to, first sequence, number
    of sequences, offset)``: the pieces of a length with these ranks go to these sequences in
    turn, each round behind the one before."""
    plan, sizes, gaps, opened = [], [], {}, 0  # gaps: size -> intervals [first, count]

    def give(size, first, count):
        if size and count:
            if size not in gaps:
                bisect.insort(sizes, size)
                gaps[size] = []
            gaps[size].append([first, count])

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        rank, left = 0, counts[length]

        def put(pieces, first, count, offset):
            nonlocal rank, left
            if pieces:
                plan.append((length, rank, rank + pieces, first, count, offset))
                rank, left = rank + pieces, left - pieces

        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):  # the successor among the gaps; what remains of it is the next one
                size = sizes[at]
                first, count = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size], sizes[at]
                rounds = min(size // length, left // count)
                put(rounds * count, first, count, capacity - size)
                size -= rounds * length
                more = left if size >= length else 0  # fewer than the sequences
                put(more, first, count, capacity - size)
                give(size, first + more, count - more)
                give(size - length, first, more)
            else:  # none: open sequences, each filled as far as this length goes
                fit = capacity // length
                full, rest = divmod(left, fit)
                put(full * fit, opened, full, 0)
                give(capacity - fit * length, opened, full)
                put(rest, opened + full, 1, 0)
                give(capacity - rest * length, opened + full, 1 if rest else 0)
                opened += full + (rest > 0)
    return plan


def ranged(pieces: DataFrame, work: Workspace) -> DataFrame:
    """``pieces`` written in ranges of (length, doc_id, start, row), with their partition and a
    number that counts up inside it.  The row splits even equal pieces."""
    # the range sort samples its input first, so the pieces are written before it
    pieces = work.save(pieces, "pieces").withColumn("_row", F.monotonically_increasing_id())
    return work.save(
        pieces.repartitionByRange("length", "doc_id", "start", "_row")
        .sortWithinPartitions("length")
        .drop("_row")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )


def pack(pieces: DataFrame, capacity: int, work: Workspace) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``start``, ``length``) plus ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    ranked = ranged(pieces, work)
    cells = ranked.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # a sorted layout has at most (partitions + capacity) cells
    cells = cells.select("_part", "length", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"))
    rank = ranked.join(F.broadcast(cells), ["_part", "length"]).withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    plan = best_fit_plan(counts, capacity)
    rows = spark.createDataFrame(plan, "p_length long, lo long, hi long, first long, n_seq long, offset long")
    nth = F.col("_rank") - F.col("lo")
    return rank.join(
        F.broadcast(rows), (F.col("length") == F.col("p_length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    ).select(*pieces.columns, (F.col("first") + nth % F.col("n_seq")).alias("sequence_id"), (F.col("offset") + F.floor(nth / F.col("n_seq")) * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = 2048, path: str | None = None, end_id: int = 0) -> DataFrame:
    """Every document of ``docs`` tokenised, cut and packed: one row per piece."""
    work = Workspace(docs.sparkSession, "packing")
    pieces = token_pieces(docs, path or vocabulary("word_bpe_49k.json"), capacity, end_id)
    return pack(pieces, capacity, work).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
