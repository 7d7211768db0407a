"""Document fingerprints by winnowing, in DataFrame expressions only.

The grams of a text are its ``k``-byte strings (UTF-8; a shorter text is one gram), hashed to
32 bits at every place.  Of each window of ``w`` grams the least hash is chosen, the rightmost
of equal ones; a chosen gram is kept once, with its place.  So two texts that share
``w + k - 1`` bytes share a fingerprint, and neighbouring places are at most ``w`` apart.

* *Expressions.*  ``winnow`` is one array expression: grams are hashed with ``xxhash64``, a
  hash and its place are packed into one long (the place turned round, so that the least long
  is the rightmost of the least hashes), and the minimum of ``w`` grams comes from minima of 1,
  2, 4, ... of them.  A text is worked on in pieces of ``PIECE`` windows, so an array never has
  more elements than that, however long the text.
* *The next document* comes from one shuffle of the texts (``ordered.next_row``).  The order
  keys alone are written and range-sorted first, in as many ranges as the texts need; each row
  is then shuffled to its range, the first row of a range to the one before it as well.  A hot
  id is split like any rows, as the order ends with the row's number.  ``docs`` is read twice
  and must give the same rows in the same order, as a scan of files does; write other frames
  first.

Defined cases: a null text is empty; an empty text has no fingerprints, and two texts without
any are alike (1.0); a null doc_id comes after all others; rows with the same id come in the
order of their texts' hashes, and equal rows follow each other; the next document of a single
row is itself; an empty table gives no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm._work import Workspace
from rankloom.operators.ordered import next_row
from rankloom.session import partitions_for

GRAM, WINDOW = 24, 64
PIECE = 8192  # windows worked on at once
TOP = (1 << 16) - 1  # places in a piece are packed as TOP - place
HASH = (1 << 32) - 1


# --- expressions ------------------------------------------------------------------------
def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _lower(x: Column, y: Column) -> Column:
    return F.when(y < x, y).otherwise(x)  # a missing y (past the end) is never lower


def _window_min(grams: Column, have: int, w: int) -> Column:
    """Minima of ``w`` neighbours (fewer at the end) from minima of ``have``."""
    if have == w:
        return grams
    step = min(have, w - have)
    return _let(grams, lambda g: _window_min(F.zip_with(g, F.slice(g, F.lit(1 + step), F.size(g)), _lower), have + step, w))


def _piece(data: Column, first: Column, k: int, w: int) -> Column:
    """Chosen grams of a piece whose first window starts at ``first``, as place and hash."""
    n = F.greatest(F.octet_length(data) - (k - 1), F.lit(1))  # grams
    high = lambda j: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.substring(data, F.lit(TOP + 1) - j, F.lit(k))), 32), 16)
    grams = F.transform(F.sequence(F.lit(TOP), F.lit(TOP + 1) - n, F.lit(-1)), lambda j: high(j).bitwiseOR(j.cast("long")))
    least = F.slice(_window_min(grams, 1, w), F.lit(1), F.greatest(n - (w - 1), F.lit(1)))
    return F.transform(
        F.array_distinct(least),
        lambda x: F.shiftleft(first + TOP - x.bitwiseAND(TOP), 32).bitwiseOR(F.shiftrightunsigned(x, 16)),
    )


def winnow(text: Column, k: int = GRAM, w: int = WINDOW, piece: int = PIECE) -> Column:
    """``array<bigint>``: the fingerprints of a text in the order of their places, each as
    ``place << 32 | hash``."""
    if piece + w > TOP:
        raise ValueError(f"piece + w is at most {TOP}")

    def of_bytes(data):
        last = F.floor(F.greatest(F.octet_length(data) - (k + w - 1), F.lit(0)) / piece).cast("int")
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda q: _let(F.substring(data, q * piece + 1, F.lit(piece + w + k - 2)), lambda p: _piece(p, (q * piece).cast("long"), k, w)),
            )
        )

    data = F.coalesce(text.cast("binary"), F.lit("").cast("binary"))
    return F.when(F.octet_length(data) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(_let(data, of_bytes)))


def winnow_edited(text: Column, prints: Column, common: Column, k: int = GRAM, w: int = WINDOW) -> Column:
    """``winnow(text)`` of a text whose first ``common`` bytes are those of a text with the
    fingerprints ``prints``: only windows that reach past them are worked out.

    The windows before ``same`` lie within the common bytes, so the fingerprints at places
    before it, which only they can choose, stay.  What they choose behind it is chosen by the
    last ``w - 1`` of them, which are worked out again."""
    same = F.greatest(common - (w + k - 2), F.lit(0))
    first = F.greatest(same - (w - 1), F.lit(0))
    data = F.coalesce(text, F.lit("")).cast("binary")
    rest = winnow(F.substring(data, first + 1, F.octet_length(data)), k, w)
    kept = F.filter(prints, lambda x: F.shiftright(x, 32) < same)
    moved = F.transform(rest, lambda x: x + F.shiftleft(first.cast("long"), 32))
    return F.array_distinct(F.concat(kept, moved))  # those of both come first, so the order stays


def hashes(prints: Column) -> Column:
    """The distinct hashes of a text's fingerprints."""
    return F.array_distinct(F.transform(prints, lambda x: x.bitwiseAND(HASH)))


def place(prints: Column) -> Column:
    """The places (bytes from the start) of a text's fingerprints."""
    return F.transform(prints, lambda x: F.shiftright(x, 32).cast("int"))


def render(prints: Column) -> Column:
    """Fingerprints as text, ten hexadecimal digits each: two of the distance from the place
    before (from 0 for the first), eight of the hash."""
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice(prints, F.lit(1), F.greatest(F.size(prints) - 1, F.lit(0))))
    gap = lambda x, y: F.shiftleft(F.shiftright(x, 32) - F.shiftright(y, 32), 32).bitwiseOR(x.bitwiseAND(HASH))
    text = F.array_join(F.zip_with(prints, before, lambda x, y: F.lpad(F.hex(gap(x, y)), 10, "0")), "")
    return F.when(F.size(prints) == 0, F.lit("")).otherwise(F.lower(text))


def resemblance(a: Column, b: Column) -> Column:
    """Share of two sets of hashes that both have (their Jaccard index); 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


# --- documents --------------------------------------------------------------------------
def fingerprint_documents(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, prints`` and ``next``, the same of the next
    document in descending doc_id."""
    if not 0 < w < 256:
        raise ValueError("w is 1 to 255: the gap between two places is written with two digits")
    work = Workspace(docs.sparkSession, "winnow")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # ~x falls as x grows
    order = [F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)), F.xxhash64("text"), F.monotonically_increasing_id()]
    keys = work.save(rows.select(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.octet_length("text").alias("size")), "keys")
    total = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    ranges = partitions_for(docs.sparkSession, total["n"], -(-(total["bytes"] or 0) // max(1, total["n"])) + 64)
    rows = rows.withColumn("prints", winnow(F.col("text"), k, w))
    return next_row(rows, order, ["text", "prints"], ranges=ranges, wrap=True, keys=keys.drop("size"))


def edited_likeness(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """How alike each text is to itself with its last third replaced by the start of the next
    document, and to the next document."""
    third = F.floor(F.length("text") / 3).cast("int")
    start = F.substring(F.col("text"), F.lit(1), F.length("text") - third)
    d = fingerprint_documents(docs, k, w)
    d = d.withColumn("start", start)
    d = d.withColumn("edited", F.concat(F.col("start"), F.substring(F.col("next.text"), F.lit(1), third)))
    d = d.withColumn("edited_prints", winnow_edited(F.col("edited"), F.col("prints"), F.octet_length("start"), k, w))
    d = d.withColumn("own", hashes(F.col("prints")))
    return d.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        render(F.col("prints")).alias("fingerprint"),
        render(F.col("edited_prints")).alias("edited_fingerprint"),
        resemblance(F.col("own"), hashes(F.col("edited_prints"))).alias("near_edited"),
        resemblance(F.col("own"), hashes(F.col("next.prints"))).alias("near_next"),
    )
