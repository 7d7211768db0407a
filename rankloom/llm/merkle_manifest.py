"""Merkle manifest of a table, its trees stored block by block in the van Emde Boas layout.

Every row is a leaf (the digest of its columns).  The leaves of a group (``lang``), in
``doc_id`` order, are the bottom of a binary tree whose root is the group's *subroot*; the
subroots, in the order of the groups, are the bottom of one more tree, whose root stands for
the whole table.  A node is the digest of its two children, the last node of a level whose
number is odd the digest of its only child.

*Layout.*  A tree over n leaves is cut into aligned blocks: subtrees of ``HEIGHT`` levels
over 2**HEIGHT neighbouring leaves.  The roots of the blocks are the leaves of the blocks
above them, and so on up to one block per group.  Inside a block the nodes lie in van Emde
Boas order: the tree is cut at half its height, the top half comes first, the bottom subtrees
behind it from left to right, each laid out the same way.  ``veb_address`` gives a node's
place from its depth and index by arithmetic alone, for construction and for the siblings.

*Plan.*  Leaves are digested in the JVM; (group, doc_id, digest) rows are range-sorted and
numbered by per-partition counts.  ``(group, block)`` is the key of the only other shuffle, at
most 2**HEIGHT rows each, so a group with a third of the rows is as many blocks as any other
part of the table of that size.  A block is one row: its nodes as one binary value beside its
leaves' ids.  Going up, a table per level holds the blocks over the roots of the last one;
going down, each block's path to the root (at most a few KB) joins its children.  The last
step reads each block once and makes the proofs of its leaves.  Nothing but the number of
blocks of a level comes to the driver.

Defined cases: nulls are ``-`` in a leaf; rows with a null doc_id come first in their group;
equal doc_ids are ordered by leaf, and equal leaves are interchangeable; an empty table gives
no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm._work import Workspace, arrow_map
from rankloom.session import ship_package

HEIGHT = 10
SIZE = 32  # bytes of a digest


# --- layout -----------------------------------------------------------------------------
def veb_address(depth: np.ndarray, index: np.ndarray, height: int) -> np.ndarray:
    """Place of the nodes (``depth`` below the root, ``index`` from the left) of a complete
    tree of ``height`` levels."""
    depth, index = np.array(depth, np.int64), np.array(index, np.int64)
    base, levels = np.zeros(len(depth), np.int64), np.full(len(depth), height, np.int64)
    while True:
        open_ = levels > 1
        if not open_.any():
            return base
        top = levels >> 1  # levels of the top half
        inside = open_ & (depth < top)
        levels = np.where(inside, top, levels)
        below = open_ & ~inside
        down = np.where(below, depth - top, 0)
        bottom = np.where(below, levels - top, 1)
        which = index >> down
        base += np.where(below, (1 << top) - 1 + which * ((1 << bottom) - 1), 0)
        index = np.where(below, index & ((1 << down) - 1), index)
        depth = np.where(below, down, depth)
        levels = np.where(below, bottom, levels)


@functools.lru_cache(maxsize=4)
def layout(height: int) -> list[np.ndarray]:
    """``layout(h)[d]``: the places of the nodes of depth d, from left to right, in a tree of
    ``height`` levels above its leaves (depth ``height``)."""
    return [veb_address(np.full(1 << d, d), np.arange(1 << d), height + 1) for d in range(height + 1)]


# --- one block --------------------------------------------------------------------------
def node(*children: bytes) -> bytes:
    """The digest of a node: over the hexadecimal text of its children."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The block over ``leaves`` (1 to 2**height digests) as one binary value in van Emde
    Boas order; places without a node are zero."""
    out = np.zeros(((2 << height) - 1, SIZE), np.uint8)
    level = leaves
    for d in range(height, -1, -1):
        out[layout(height)[d][: len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, SIZE)
        level = [node(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return out.tobytes()


def block_root(block: bytes) -> bytes:
    return block[:SIZE]


def sibling_paths(block: bytes, height: int, n: int) -> list[list[bytes]]:
    """For each of the block's ``n`` leaves, level by level: the sibling (empty where the
    node is the only one of its run)."""
    nodes = memoryview(block)
    out: list[list[bytes]] = [[] for _ in range(n)]
    count = n
    for up in range(height):
        at = layout(height)[height - up]
        level = [bytes(nodes[a * SIZE : a * SIZE + SIZE]) for a in at[:count].tolist()]
        for i, path in enumerate(out):
            j = (i >> up) ^ 1
            path.append(level[j] if j < count else b"")
        count = (count + 1) >> 1
    return out


def fold(leaf: bytes, index: int, siblings: list[bytes]) -> bytes:
    """The root that ``leaf`` at ``index`` and its siblings lead to."""
    at = leaf
    for i, sibling in enumerate(siblings):
        if not sibling:
            at = node(at)
        elif (index >> i) & 1:
            at = node(sibling, at)
        else:
            at = node(at, sibling)
    return at


# --- leaves -----------------------------------------------------------------------------
def part(c):
    """A value as it enters a digest: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: list):
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def numbered(rows: DataFrame, group: list[str], order: list[str], work: Workspace, name: str) -> DataFrame:
    """``rows`` plus ``idx``, the place (from 0) within ``group`` by ``order``, and ``n``, the
    rows of the group.  Range-sorted and written once; the numbers follow from the counts of
    (partition, group) cells, which are at most partitions + groups."""
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order, "_row"]]  # _row: equal rows can be split
    ranged = work.save(
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_row")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    cells = ranged.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*group)
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("n"),
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return ranged.join(cells, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("idx"), "n")


# --- blocks -----------------------------------------------------------------------------
BLOCK = "grp string, block long, n long, height int, count int, root binary, nodes binary"


def _blocks(leaves: DataFrame, high: int, done: int, extra: str = "") -> DataFrame:
    """Leaves ``(grp, idx, n, digest[, extra])`` -> one row per aligned block, in van Emde
    Boas order; ``extra`` is a column kept as a list beside it, in the order of the leaves."""
    schema = BLOCK + (f", extra array<{extra}>" if extra else "")

    def run(key, table):
        t = table.sort_by("idx")
        leaf = t.column("digest").to_pylist()
        n = t.column("n")[0].as_py()
        height = min(high, (n - 1).bit_length() - done)  # the last block ends at a single node
        nodes = build_block(leaf, height)
        cols = {
            "grp": [t.column("grp")[0].as_py()], "block": [t.column("idx")[0].as_py() >> high], "n": [n],
            "height": [height], "count": [len(leaf)], "root": [block_root(nodes)], "nodes": [nodes],
        }
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        out = pa.table([pa.array(v, ty) for v, ty in zip(cols.values(), types)], names=list(cols))
        if extra:
            col = t.column("extra").combine_chunks()
            out = out.append_column("extra", pa.ListArray.from_arrays(pa.array([0, len(col)], pa.int32()), col))
        return out

    keyed = leaves.withColumn("block", F.shiftright("idx", high))
    return keyed.groupBy("grp", "block").applyInArrow(run, schema)


class Manifest:
    """The written trees of one table.

    ``rows`` holds (grp, idx, digest, extra) of the leaves; ``levels[0]`` the blocks over the
    leaves, ``levels[i + 1]`` those over the roots of ``levels[i]``.  Groups that end earlier
    have no rows further up."""

    def __init__(self, levels: list[DataFrame], high: int, work: Workspace):
        self.levels, self.high, self.work = levels, high, work

    def roots(self) -> DataFrame:
        """``(grp, subroot)``: the digest over each group."""
        tops = [
            lv.filter(F.col("n") <= F.lit(1 << (self.high * (i + 1))) if self.high * (i + 1) < 63 else F.lit(True)).select("grp", F.col("root").alias("subroot"))
            for i, lv in enumerate(self.levels)
        ]
        # a group's top is the level at which it has one block; it is not built further
        return functools.reduce(DataFrame.unionByName, tops)

    def paths(self) -> DataFrame:
        """``(grp, block, path)``: the siblings of each bottom block's root up to its group's
        subroot, level by level.  Each level's paths join the level below on (grp, block)."""
        upper = None
        for i in range(len(self.levels) - 1, 0, -1):
            lv = self.levels[i]
            lv = lv.select("grp", "block", "height", "count", "nodes")
            if upper is not None:
                up = upper.select(F.col("grp").alias("u_grp"), F.col("block").alias("u_block"), "path")
                lv = lv.join(up, F.col("grp").eqNullSafe(F.col("u_grp")) & (F.col("block") == F.col("u_block")), "left").drop("u_grp", "u_block")
            else:
                lv = lv.withColumn("path", F.lit(None).cast("array<binary>"))
            upper = self.work.save(arrow_map(lv, functools.partial(_down, self.high), "grp string, block long, path array<binary>"), f"paths-{i}")
        return upper


def _down(high: int, batches):
    """Blocks with their own path -> the paths of the blocks whose roots are their leaves."""
    for batch in batches:
        for r in batch.to_pylist():
            first = r["block"] << high
            above = r["path"] or []
            paths = sibling_paths(r["nodes"], r["height"], r["count"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["grp"]] * len(paths), pa.string()),
                    pa.array([first + i for i in range(len(paths))], pa.int64()),
                    pa.array([p + above for p in paths], pa.list_(pa.binary())),
                ],
                names=["grp", "block", "path"],
            )


def build(leaves: DataFrame, work: Workspace, name: str = "m", extra: str = "", high: int = HEIGHT) -> Manifest:
    """``leaves(grp, idx, n, digest[, extra])`` -> the written blocks of all levels, ``high``
    levels a block."""
    levels, done, at = [], 0, leaves
    while True:
        lv = work.save(_blocks(at, high, done, extra if not levels else ""), f"{name}-blocks-{len(levels)}")
        levels.append(lv)
        done += high
        at = lv.filter(F.col("n") > F.lit(1 << done) if done < 63 else F.lit(False)).select(
            "grp", F.col("block").alias("idx"), "n", F.col("root").alias("digest")
        )
        if done >= 63 or not at.limit(1).count():
            return Manifest(levels, high, work)


# --- the table --------------------------------------------------------------------------
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest(docs: DataFrame, tampered=None, columns: list[str] | None = None, group: str = "lang", order: str = "doc_id", high: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified``.

    ``proof_sha256`` is the digest of the siblings' hexadecimal text, level by level from the
    leaf to the root.  ``tampered`` is a condition and, in place of the columns it names, the
    values of a tampered row: ``(condition, {column: value})``; ``folded_root`` is folded from
    the tampered leaf where the condition holds, else from the leaf, and ``verified`` says
    whether it is the root."""
    columns = columns or LEAF_COLUMNS
    ship_package(docs.sparkSession)
    work = Workspace(docs.sparkSession, "merkle")
    leaf = leaf_digest([F.col(c) for c in columns])
    bad = F.lit(None).cast("string")
    if tampered is not None:
        condition, values = tampered
        # the text is digested twice only where the row is tampered
        bad = F.when(condition, leaf_digest([values.get(c, F.col(c)) for c in columns]))
    rows = docs.select(
        F.col(group).cast("string").alias("grp"),
        F.col(order).cast("long").alias("doc"),
        F.unhex(leaf).alias("digest"),
        F.unhex(bad).alias("bad"),
    )
    # leaf digests are written before the range sort, which samples its input first
    rows = work.save(rows, "leaves")
    placed = numbered(rows, ["grp"], ["doc", "digest", "bad"], work, "ranged")
    m = build(
        placed.select("grp", "idx", "n", "digest", F.struct("doc", "digest", "bad").alias("extra")),
        work, "rows", "struct<doc: bigint, digest: binary, bad: binary>", high,
    )
    subroots = work.save(m.roots(), "subroots")
    top = numbered(subroots.withColumn("all", F.lit("")), ["all"], ["grp"], work, "groups")
    t = build(top.select(F.col("all").alias("grp"), "idx", "n", F.col("subroot").alias("digest"), F.struct("grp").alias("extra")), work, "top", "struct<grp: string>", high)
    root = next((bytes(r["subroot"]) for r in t.roots().collect()), b"")  # one digest
    group_paths = _group_paths(t, work)
    blocks = m.levels[0].select("grp", "block", "height", "count", "nodes", "extra")
    upper = m.paths()
    if upper is None:
        blocks = blocks.withColumn("path", F.lit(None).cast("array<binary>"))
    else:
        up = upper.select(F.col("grp").alias("u_grp"), F.col("block").alias("u_block"), "path")
        blocks = blocks.join(up, F.col("grp").eqNullSafe(F.col("u_grp")) & (F.col("block") == F.col("u_block")), "left").drop("u_grp", "u_block")
    gp = group_paths.select(F.col("grp").alias("g_grp"), F.col("idx").alias("g_idx"), "subroot", F.col("path").alias("g_path"))
    blocks = blocks.join(gp, F.col("grp").eqNullSafe(F.col("g_grp")))
    out = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return arrow_map(blocks.select("block", "height", "count", "nodes", "extra", "path", "subroot", "g_idx", "g_path"), functools.partial(_proofs, root), out)


def _group_paths(t: Manifest, work: Workspace) -> DataFrame:
    """``(grp, idx, subroot, path)``: each group's siblings up to the root."""
    upper, high = t.paths(), t.high
    lv = t.levels[0].select("grp", "block", "height", "count", "nodes", "extra")
    if upper is None:
        lv = lv.withColumn("path", F.lit(None).cast("array<binary>"))
    else:
        up = upper.select(F.col("block").alias("u_block"), "path")
        lv = lv.join(up, F.col("block") == F.col("u_block"), "left").drop("u_block")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                paths = sibling_paths(r["nodes"], r["height"], r["count"])
                at = layout(r["height"])[r["height"]]
                names = [e["grp"] for e in r["extra"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()),
                        pa.array([(r["block"] << high) + i for i in range(len(paths))], pa.int64()),
                        pa.array([r["nodes"][a * SIZE : a * SIZE + SIZE] for a in at[: len(paths)].tolist()], pa.binary()),
                        pa.array([p + (r["path"] or []) for p in paths], pa.list_(pa.binary())),
                    ],
                    names=["grp", "idx", "subroot", "path"],
                )

    return work.save(arrow_map(lv, run, "grp string, idx long, subroot binary, path array<binary>"), "group-paths")


def _proofs(root: bytes, batches):
    """Blocks with the path above them -> one row per leaf."""
    for batch in batches:
        for k in range(batch.num_rows):
            (r,) = batch.slice(k, 1).to_pylist()
            above = r["path"] or []
            paths = sibling_paths(r["nodes"], r["height"], r["count"])
            subroot, g_path = r["subroot"], r["g_path"] or []
            tail = "".join(s.hex() for s in above + g_path).encode()
            rows = []
            for i, (e, path) in enumerate(zip(r["extra"], paths)):
                proof = hashlib.sha256("".join([s.hex() for s in path]).encode() + tail).hexdigest()
                at = fold(e["bad"] or e["digest"], i, path)
                at = fold(at, r["block"], above)
                at = fold(at, r["g_idx"], g_path)
                rows.append((e["doc"], e["digest"].hex(), subroot.hex(), root.hex(), proof, at.hex(), at == root))
            types = [pa.int64()] + [pa.string()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, ty) for c, ty in zip(zip(*rows), types)],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )
