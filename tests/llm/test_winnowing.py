"""Winnowing: plain Python fingerprints, the match guarantee, the next document, hard tables."""

import hashlib
import math
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from rankloom.llm import winnowing as W
from rankloom.llm.queries import op11_document_fingerprints
from rankloom.llm._work import Workspace

SCHEMA = "doc_id long, text string"


def plain(text, k=W.GRAM, w=W.WINDOW):
    """(place, hash) of the chosen grams."""
    raw = text.encode()
    if not raw:
        return []
    h = [xxhash.xxh64_intdigest(raw[i : i + k], 42) >> 32 for i in range(max(1, len(raw) - k + 1))]
    out = []
    for i in range(max(1, len(h) - w + 1)):
        at = min(range(i, min(i + w, len(h))), key=lambda j: (h[j], -j))
        if not out or out[-1][0] != at:
            out.append((at, h[at]))
    return out


def text_of(prints):
    before, out = 0, ""
    for at, h in prints:
        out += f"{at - before:02x}{h:08x}"
        before = at
    return out


def jaccard(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def made(rng, n):
    return "".join(rng.choice("abcdé 中\U0001f600\n") for _ in range(n))


@pytest.mark.parametrize("k,w,piece", [(24, 64, 8192), (24, 64, 100), (5, 7, 13), (3, 1, 4), (1, 16, 8192)])
def test_fingerprints(spark, k, w, piece):
    rng = random.Random(k * w)
    texts = [None, "", "a", "ab" * 200, "a" * 500, "é" * 99, *(made(rng, rng.randint(0, 900)) for _ in range(40))]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for r in df.select("text", W.winnow(F.col("text"), k, w, piece).alias("p")).collect():
        assert [(x >> 32, x & W.HASH) for x in r.p] == plain(r.text or "", k, w)


@pytest.mark.parametrize("k,w", [(24, 64), (5, 7), (1, 1), (3, 2)])
def test_edited_texts(spark, k, w):
    rng = random.Random(k + w)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 5, 30, 90, 200, 400])))
        cut = rng.randint(0, len(a))
        rows.append((a, a[:cut] + "".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 9, 100]))), cut))
    df = spark.createDataFrame(rows, "a string, b string, cut int").withColumn("p", W.winnow(F.col("a"), k, w))
    got = df.select("b", W.winnow_edited(F.col("b"), F.col("p"), F.col("cut"), k, w).alias("e")).collect()
    for r in got:
        assert [(x >> 32, x & W.HASH) for x in r.e] == plain(r.b, k, w)


def test_every_long_match_shares_a_fingerprint(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        shared = "".join(rng.choice("abc") for _ in range(W.GRAM + W.WINDOW - 1))
        rows.append((made(rng, rng.randint(0, 300)) + shared + made(rng, 50), made(rng, rng.randint(0, 300)) + shared + made(rng, 9)))
    df = spark.createDataFrame(rows, "a string, b string")
    h = lambda c: W.hashes(W.winnow(F.col(c)))
    assert all(r.n for r in df.select(F.size(F.array_intersect(h("a"), h("b"))).alias("n")).collect())


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest((r[1] or "").encode(), 42) ^ (1 << 63)))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, new, nxt = plain(text), plain(edited), plain(after)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(new), jaccard(own, new), jaccard(own, nxt)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_hard_tables(spark):
    rng = random.Random(8)
    rows = [(i * 7 % 50 - 20, made(rng, rng.choice([0, 1, 2, 3, 40, 400]))) for i in range(50)]
    rows += [(3, "other text"), (3, None), (None, "no id"), (None, None), (60, None), (61, "")] + [(5, "the same " * 30)] * 30
    rows += [(70, "the quick brown fox jumps over the lazy dog " * 3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.repartition(6)
    for c in ("prints", "next", "edited", "own", "_to", "_range", "_o0"):
        clash = clash.withColumn(c, F.lit(c))
    path = Workspace(spark, "test").path("clash")
    clash.write.parquet(path)
    assert rows_of(W.edited_likeness(spark.read.parquet(path))) == brute(rows)
    assert rows_of(W.edited_likeness(spark.createDataFrame([(1, "only " * 50)], SCHEMA))) == brute([(1, "only " * 50)])
    assert W.edited_likeness(df.filter("false")).collect() == []


def test_query_over_the_whole_table_and_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = op11_document_fingerprints(spark, "/root/testdata/sf0.001")
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs.collect()])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert got.count() == docs.count() and math.isfinite(got.agg(F.avg("near_edited")).first()[0])
