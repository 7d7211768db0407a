"""Merkle manifest: layout, a plain tree of the same leaves, hard tables."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import merkle_manifest as M
from rankloom.llm.queries import op12_merkle_manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def veb_order(height):
    """(depth, index) in van Emde Boas order, by the recursion itself."""
    if height == 1:
        return [(0, 0)]
    top = height // 2
    out = veb_order(top)
    for i in range(1 << top):
        out += [(top + d, (i << d) + j) for d, j in veb_order(height - top)]
    return out


def test_layout_is_the_recursion():
    for height in range(1, 12):
        order = veb_order(height)
        depth, index = (np.array(x) for x in zip(*order))
        assert M.veb_address(depth, index, height).tolist() == list(range((1 << height) - 1))
    # a path to the root touches few blocks of neighbouring places: height 10 in runs of 32 places
    path = [int(M.layout(10)[d][(777 >> (10 - d)) if d else 0]) for d in range(11)]
    assert len({p // 31 for p in path}) <= 5


def test_blocks_against_plain_levels():
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(64)]
    for height in (0, 1, 3, 5, 6):
        for n in {1, 2, 3, (1 << height) - 1, 1 << height} - {0}:
            if n > 1 << height:
                continue
            block, level = M.build_block(leaves[:n], height), leaves[:n]
            paths = M.sibling_paths(block, height, n)
            for _ in range(height):
                level = [M.node(*level[i : i + 2]) for i in range(0, len(level), 2)]
            assert M.block_root(block) == level[0]
            assert all(M.fold(leaves[i], i, paths[i]) == level[0] for i in range(n))
            assert height == 0 or M.fold(leaves[-1], 0, paths[0]) != level[0]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    out = []
    for c in COLUMNS:
        v = row[c]
        v = v + more if c == "n_chars" and v is not None else v
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def climb(level):
    levels = [level]
    while len(level) > 1:
        level = [sha(*level[i : i + 2]) for i in range(0, len(level), 2)]
        levels.append(level)
    return levels


def up(levels, i, at):
    """(siblings, folded root) of place i."""
    siblings = []
    for level in levels[:-1]:
        run = level[i // 2 * 2 : i // 2 * 2 + 2]
        siblings += run[: i % 2] + run[i % 2 + 1 :]
        run[i % 2] = at
        at, i = sha(*run), i // 2
    return siblings, at


def brute(rows):
    runs = {}
    for r in rows:
        runs.setdefault(r["lang"], []).append(r)
    langs = sorted(runs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        runs[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in runs[g]])
    top = climb([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(runs[g]):
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            proof, sub = up(trees[g], i, leaf(r, int(bad)))
            more, folded = up(top, k, sub)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], sha(*proof, *more), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def tampered():
    return (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, {"n_chars": F.try_add(F.col("n_chars"), F.lit(1))})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("high", [1, 2, 10])
def test_manifest_against_plain_trees(spark, high):
    rows = [(i, "s" + str(i % 3), ["en", "fr", None, "É", "de"][i % 5 if i < 60 else 0], i if i % 4 else None, "téxt " * (i % 7)) for i in range(90)]
    rows += [(7, "s", "en", 1, "other"), (None, None, None, None, None), (91, "a", "lone", 3, ""), (5, "x", "en", 2, None)]
    rows += [(14, "same", "fr", 9, "same")] * 40  # a third of the rows equal
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    df = spark.createDataFrame(rows, schema)
    clash = df
    for c in ("grp", "idx", "n", "block", "digest", "_part", "_row", "extra", "path"):
        clash = clash.withColumn(c, F.lit(c))
    want = brute([dict(zip(COLUMNS, r)) for r in rows])
    assert rows_of(M.manifest(clash, tampered(), high=high)) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)


def test_empty_and_untampered(spark):
    df = spark.createDataFrame([(1, "a", "en", 3, "x")], "doc_id long, source string, lang string, n_chars long, text string")
    assert M.manifest(df.filter("false"), tampered()).collect() == []
    (r,) = M.manifest(df).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op12_merkle_manifest(spark, "/root/testdata/sf0.01")
    assert rows_of(got) == brute([r.asDict() for r in docs.collect()])
