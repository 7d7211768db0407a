"""Iterative rank recurrences over a link graph, as a driver loop of DataFrame sweeps.

One sweep is:  messages r(u)/d(u) from every node with out-links  ->  equi-join with the
static weighted edge table on the source  ->  partial + final ``sum`` per target  ->
join with the static node table  ->  new vector.  The five recurrences differ only in the
fields of :class:`RankSpec`.

Physical layout, the same at every size:

* The matrix lies in *blocks*.  A source's links are dealt over ``blocks`` target blocks
  (``b = hash(dst) mod blocks``), as many as its links are times the mean load of a bucket:
  one for nearly every source, many for a hub, so that no bucket holds more than about a mean
  load of one source.  The table ``W(src, b, dst, m)`` of distinct links with their
  multiplicity is written once, bucketed on (source, target block).  At most as many sources
  as there are buckets can have more than one block, which bounds the table of them.
* A sweep sends each source's message once to each of its blocks and joins it there; the
  edges are never shuffled.  Only messages (about one per node) and partially summed
  contributions move.
* The node table ``(node, is_page, has_in, deg, blocks)`` is written once, bucketed on
  ``node``, and every rank vector is written the same way at the end of its sweep.  The sums
  land in those buckets, the plan stays one sweep deep, and a lost executor only costs the
  current sweep (the inputs are files in the shared checkpoint folder).
* The bucket count follows the bytes of the links (AQE's coalescing rule, without a cap).  A
  model runs in a session of its own whose shuffle width is that count, so the caller's
  settings stay as they are and other jobs may run beside it.
* What a model writes belongs to its :class:`~rankloom.session.Scratch`: the pairs go once the
  tables are built, each vector when the next is written, the rest when it is closed.
* The dangling mass the next sweep needs is observed (``DataFrame.observe``) while the
  current vector is written: no extra job, and it enters the next sweep as a literal.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rankloom.functions.fixed import (
    DAMPING,
    FIXED_POINT_SCALE,
    LITERAL_FIRST_DELTA,
    SWEEPS_LIST,
    SWEEPS_MATRIX,
    SWEEPS_SPARK,
    TELEPORT,
)
from rankloom.operators.graph import Graph
from rankloom.session import Held, Scratch, adopt, checkpoint_dir, partitions_for, session_beside

SCALES = ("pages", "nodes", "unit")
STARTS = ("pages", "nodes")
EDGE_MODES = ("multiset", "distinct")
UNLINKED = ("teleport", "keep", "inlinks", "reached")
DANGLING = ("none", "exact", "literal")


@dataclass(frozen=True)
class RankSpec:
    """What distinguishes one rank recurrence from another.

    scale     normaliser n of the teleport term and the start value: page count N,
              node count |V|, or none ('unit': teleport 0.15, start 1.0)
    start     nodes holding a start value (others start at 0): pages only, or all of V
    edges     'multiset' (a duplicated link carries weight m/d) or 'distinct' (1/d)
    unlinked  the domain of each new vector, i.e. what happens to nodes without in-links:
              'teleport' every node of V gets the teleport term;
              'keep'     nodes without in-links keep their previous value;
              'inlinks'  only nodes with in-links (a zero sum still counts);
              'reached'  only nodes that received a message this sweep (inner join)
    dangling  mass of nodes without out-links added to every node: 'none', 'exact'
              (sum of their ranks / n) or 'literal' (the list program's fixed-point schedule)
    phantom   pages without links send their whole rank to a NULL node
    """

    scale: str = "nodes"
    start: str = "nodes"
    edges: str = "multiset"
    unlinked: str = "teleport"
    dangling: str = "exact"
    iterations: int = 10
    phantom: bool = False
    damping: float = DAMPING
    teleport: float = TELEPORT

    def __post_init__(self) -> None:
        for value, allowed in (
            (self.scale, SCALES),
            (self.start, STARTS),
            (self.edges, EDGE_MODES),
            (self.unlinked, UNLINKED),
            (self.dangling, DANGLING),
        ):
            if value not in allowed:
                raise ValueError(f"{value!r} not in {allowed}")
        if self.iterations < 0:
            raise ValueError("iterations must be >= 0")

    def with_(self, **kw) -> "RankSpec":
        return replace(self, **kw)


PRESETS: dict[str, RankSpec] = {
    # adjacency-list program: pages start at 1/N, fixed-point dangling schedule, 9 sweeps
    "list": RankSpec("pages", "pages", "multiset", "teleport", "literal", SWEEPS_LIST),
    "list_exact": RankSpec("pages", "pages", "multiset", "teleport", "exact", SWEEPS_LIST),
    # matrix x vector, row-wise (Jacobi form): nodes without in-links keep 1/N
    "matrix_row": RankSpec("pages", "nodes", "multiset", "keep", "none", SWEEPS_MATRIX),
    # matrix x vector, message style: only nodes with in-links are in the result
    "matrix_col": RankSpec("pages", "nodes", "multiset", "inlinks", "none", SWEEPS_MATRIX),
    "matrix_col_once": RankSpec("pages", "nodes", "multiset", "inlinks", "none", 1),
    # RDD program: distinct links, un-normalised, inner-join domain
    "unnormalised": RankSpec("unit", "pages", "distinct", "reached", "none", SWEEPS_SPARK),
    "unnormalised_phantom": RankSpec(
        "unit", "pages", "distinct", "reached", "none", SWEEPS_SPARK, phantom=True
    ),
    # conserving recurrence over V: the ranks always sum to 1
    "total": RankSpec("nodes", "nodes", "multiset", "teleport", "exact", SWEEPS_MATRIX),
}

ROUNDING_GUARD = 1e-11
LINK_ROW_BYTES = 48  # width of one (src, dst, m) row besides the names, to size the bucket count


@dataclass
class RankModel:
    """The static, bucketed frames of one graph + spec, reusable across runs.  Use it as a
    context manager, or call ``close``, to remove what it wrote."""

    spec: RankSpec
    nodes: DataFrame  # node, [name,] is_page, has_in, deg, blocks   (bucketed on node)
    weights: DataFrame  # src, b, dst, m                            (bucketed on src, b)
    norm: float
    buckets: int  # bucket count of every table of this model (and its session's shuffle width)
    scratch: Scratch  # owner of the tables; its session is the model's
    keyed: bool = False  # node columns hold 64-bit keys; the node table maps them to names
    start_dangling: int | None = None  # dangling nodes holding a start value (observed)
    tables: tuple[Held, ...] = ()  # the tables of ``weights`` and ``nodes``
    vector: Held | None = None  # the last vector written

    def close(self) -> None:
        self.scratch.close()

    def __enter__(self) -> "RankModel":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def named(self, df: DataFrame, *cols: str) -> DataFrame:
        """Replace node keys in ``cols`` by node names (identity when not keyed).  The join
        with the bucketed node table is co-partitioned for a vector bucketed on ``node``;
        a NULL key (the phantom node) stays NULL."""
        if not self.keyed:
            return df
        names = self.nodes.select("node", "name")
        for c in cols:
            df = (
                df.join(names.withColumnRenamed("node", c), c, "left")
                .drop(c)
                .withColumnRenamed("name", c)
            )
        return df


def _metrics(observation: Observation, fallback) -> dict:
    """Observed metrics of the last action, or ``fallback()`` (a job computing the same
    aggregates) when there are none - an action over zero partitions reports no row."""
    try:
        return observation.get or fallback()
    except Py4JJavaError:  # no task, no row of metrics
        return fallback()


def _phantom_pairs(g: Graph, pairs: DataFrame) -> DataFrame:
    """``(page, NULL, 1)`` for every page without links (the RDD program's ``[null]`` group)."""
    lonely = g.pages.join(pairs.select(F.col("src").alias("node")).distinct(), "node", "left_anti")
    return lonely.select(
        F.col("node").alias("src"), F.lit(None).cast("string").alias("dst"), F.lit(1).cast("long").alias("m")
    )


def prepare(g: Graph, spec: RankSpec, *, buckets: int | None = None, keys: str = "name") -> RankModel:
    """Build the static frames (weighted edges and the node table) as bucketed tables.

    The raw links are read once: they are aggregated to distinct pairs with their
    multiplicity (partial aggregation, shuffled on the pair, so no single source can
    overload a task) and written; everything else is derived from that.

    ``keys="hash"`` runs the sweeps on 64-bit keys (``xxhash64`` of the name) instead of
    names: the edge table the sweeps scan shrinks to three longs per row and every join
    and aggregation hashes longs.  The node table, one row a name, shows whether the keys are
    collision-free; on any collision the tables are built once more with the names as keys, so
    results are exact either way.  The default here is ``"name"`` at every size, that of
    :func:`scaled_ranks` and :func:`pagerank` is ``"hash"``.
    """
    checkpoint_dir(g.edges.sparkSession)
    own = session_beside(g.edges.sparkSession)
    g = Graph(adopt(own, g.pages), adopt(own, g.edges))
    scratch = Scratch(own)

    counted_pairs = Observation("pairs")
    name_bytes = F.octet_length("src") + F.coalesce(F.octet_length("dst"), F.lit(0))
    pair_stats = [F.count(F.lit(1)).alias("n"), F.sum(name_bytes).alias("bytes")]
    pairs = scratch.written(
        g.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m")).observe(counted_pairs, *pair_stats), "pairs"
    )
    counted = _metrics(counted_pairs, lambda: pairs.df.agg(*pair_stats).first().asDict())
    if buckets is None:
        width = LINK_ROW_BYTES + math.ceil((counted["bytes"] or 0) / max(1, counted["n"]))
        buckets = partitions_for(own, counted["n"], width)
    own.conf.set("spark.sql.shuffle.partitions", str(buckets))
    # the layout is pinned from here on: there is nothing to re-plan between the stages of a
    # sweep, which run as one job
    own.conf.set("spark.sql.adaptive.enabled", "false")
    model = _build(g, spec, pairs.df, counted["n"], buckets, scratch, keys == "hash")
    if model.keyed and not _keys_are_unique(model):
        for held in model.tables:
            scratch.drop(held)
        model = _build(g, spec, pairs.df, counted["n"], buckets, scratch)
    scratch.drop(pairs)
    return model


def _key(c):
    """64-bit key of a node name; NULL stays NULL (the phantom node)."""
    return F.when(c.isNotNull(), F.xxhash64(c))


def _keys_are_unique(model: RankModel) -> bool:
    """The node table has a row a name and lies in buckets of the keys: counted in place."""
    return not model.nodes.groupBy("node").agg(F.count(F.lit(1)).alias("names")).where(F.col("names") > 1).take(1)


def _block_counts(links: DataFrame, total: int, buckets: int) -> DataFrame:
    """``(src, blocks)`` of the sources with more links than a mean bucket of ``total`` links: one
    block for each mean load.  Fewer rows than ``buckets``."""
    widths = links.groupBy("src").agg(F.count(F.lit(1)).alias("width"))
    many = F.ceil(F.col("width") * buckets / max(1, total)).cast("int")
    return widths.where(F.col("width") * buckets > total).select("src", many.alias("blocks"))


def _build(
    g: Graph, spec: RankSpec, pairs: DataFrame, n_pairs: int, buckets: int, scratch: Scratch, keyed: bool = False
) -> RankModel:
    """Edge table and node table in ``buckets`` buckets.

    Counts the sweeps need (pages, nodes, dangling nodes of the start vector) are observed
    at the top of the node-table write, i.e. in its result stage, where every task's
    metrics are counted exactly once even if tasks are retried.
    """
    if spec.edges == "distinct":
        pairs = pairs.withColumn("m", F.lit(1).cast("long"))
    links = pairs
    if spec.phantom:
        links = pairs.unionByName(_phantom_pairs(g, pairs))
        n_pairs = links.count()
    if keyed:
        links = links.select(_key(F.col("src")).alias("src"), _key(F.col("dst")).alias("dst"), "m")

    hubs = F.broadcast(_block_counts(links, n_pairs, buckets))
    block = F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("blocks"))).cast("int")
    dealt = links.join(hubs, "src", "left").select("src", block.alias("b"), "dst", "m")
    links_held = scratch.bucketed(dealt, ["src", "b"], "links", buckets)
    weights = links_held.df

    # a source's messages go to the blocks up to its last one with a link
    deg = weights.groupBy("src").agg(F.sum("m").alias("deg"), (F.max("b") + 1).alias("blocks"))
    flags = g.pages.select(
        "node", F.lit(True).alias("is_page"), F.lit(False).alias("has_in"), F.lit(1).alias("lines")
    ).unionByName(
        pairs.where(F.col("dst").isNotNull()).select(
            F.col("dst").alias("node"),
            F.lit(False).alias("is_page"),
            F.lit(True).alias("has_in"),
            F.lit(0).alias("lines"),
        )
    )
    nodes = flags.groupBy("node").agg(
        F.max("is_page").alias("is_page"), F.max("has_in").alias("has_in"), F.sum("lines").alias("lines")
    )
    if keyed:
        nodes = nodes.select(
            _key(F.col("node")).alias("node"), F.col("node").alias("name"), "is_page", "has_in", "lines"
        )
    nodes = nodes.join(deg, F.col("node") == F.col("src"), "left").drop("src")
    nodes = nodes.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    in_start = F.lit(True) if spec.start == "nodes" else F.col("is_page")
    counted = Observation("nodes")
    node_stats = [
        F.count(F.lit(1)).alias("nodes"),
        F.sum("lines").alias("page_lines"),  # page rows, duplicates included
        F.count(F.when(F.col("deg").isNull() & in_start, F.lit(1))).alias("start_dangling"),
    ]
    nodes_held = scratch.bucketed(nodes.observe(counted, *node_stats).drop("lines"), ["node"], "nodes", buckets)
    stats = _metrics(counted, lambda: nodes.agg(*node_stats).first().asDict())

    if spec.scale == "pages":
        norm = float(stats["page_lines"] or 0)
    elif spec.scale == "nodes":
        norm = float(stats["nodes"])
    else:
        norm = 1.0
    norm = norm or 1.0  # empty graph: nothing to rank, keep the arithmetic defined
    return RankModel(
        spec, nodes_held.df, weights, norm, buckets, scratch, keyed, stats["start_dangling"], (links_held, nodes_held)
    )


def _start_value(model: RankModel) -> float:
    return 1.0 if model.spec.scale == "unit" else 1.0 / model.norm


def initial_ranks(model: RankModel) -> DataFrame:
    """Start vector over V: 1/n (or 1.0 when un-normalised) on the start domain, else 0."""
    spec = model.spec
    value = _start_value(model)
    on = F.lit(True) if spec.start == "nodes" else F.col("is_page")
    return model.nodes.select(
        "node",
        F.when(on, F.lit(value)).otherwise(F.lit(0.0)).alias("rank"),
        "deg",
        "blocks",
    )


def contributions(model: RankModel, state: DataFrame) -> DataFrame:
    """Per link: (src, dst, c = r(src) * m / d(src)).  Sources without a rank send nothing."""
    # build the hash table from the messages (one per node and block); the edges only stream
    # by, so the large side is neither shuffled (bucketed) nor sorted
    msgs = _messages(state).hint("shuffle_hash")
    return model.weights.join(msgs, ["src", "b"]).select("src", "dst", (F.col("msg") * F.col("m")).alias("c"))


def _messages(state: DataFrame) -> DataFrame:
    """``(src, b, msg)``: each sender's message, once for each block of its links."""
    return state.where(F.col("deg").isNotNull()).select(
        F.col("node").alias("src"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
        (F.col("rank") / F.col("deg")).alias("msg"),
    )


def gather(model: RankModel, state: DataFrame) -> DataFrame:
    """Sum of incoming contributions per target: (dst, c).  Partial aggregation runs map-side."""
    return contributions(model, state).groupBy("dst").agg(F.sum("c").alias("c"))


def _dangling_filter():
    return F.col("deg").isNull() & F.col("node").isNotNull()


def dangling_stats_exprs():
    """Aggregates over the dangling nodes of a vector: exact rank total, fixed-point total."""
    d = _dangling_filter()
    return [
        F.coalesce(F.sum(F.when(d, F.col("rank"))), F.lit(0.0)).alias("total"),
        fixed_point_total(F.when(d, F.col("rank"))).alias("fixed"),
    ]


def dangling_stats(state: DataFrame) -> dict:
    """Run the dangling aggregates as a job (used when no observation is at hand)."""
    return state.agg(*dangling_stats_exprs()).first().asDict()


def dangling_mass(model: RankModel, stats: dict | None, sweep_no: int) -> float:
    """Mass added to every node in sweep ``sweep_no`` given the previous vector's stats."""
    spec = model.spec
    if spec.dangling == "none":
        return 0.0
    if spec.dangling == "exact":
        return stats["total"] / model.norm
    # literal schedule: -1 in sweep 1, the fixed-point total of sweep 1 in sweep 2, then 0
    scale = FIXED_POINT_SCALE * model.norm
    if sweep_no == 1:
        return LITERAL_FIRST_DELTA / scale
    if sweep_no == 2:
        return stats["fixed"] / scale
    return 0.0


def _needs_stats(spec: RankSpec, sweep_no: int) -> bool:
    return spec.dangling == "exact" or (spec.dangling == "literal" and sweep_no == 2)


def fixed_point_total(rank):
    """Sum of trunc(rank * 1e5) as a long (rounded to 6 places first against float noise)."""
    return F.coalesce(
        F.sum(F.floor(F.round(rank * FIXED_POINT_SCALE, 6)).cast("long")), F.lit(0).cast("long")
    )


def _sweep_statement(spec: RankSpec) -> str:
    """The sweep as one SQL statement over {state}, {weights} and {nodes}.

    One statement is analysed once (a chain of DataFrame calls is analysed call by call,
    which dominates a sweep's driver time on small inputs); the physical plan is the same.
    """
    msgs = (
        "SELECT node AS src, explode(sequence(0, blocks - 1)) AS b, rank / deg AS msg "
        "FROM {state} WHERE deg IS NOT NULL"
    )
    # messages are the hash-join build side: the edge table is streamed, never sorted
    contrib = (
        f"SELECT /*+ SHUFFLE_HASH(s) */ w.dst, sum(s.msg * w.m) AS c "
        f"FROM {{weights}} w JOIN ({msgs}) s ON w.src = s.src AND w.b = s.b GROUP BY w.dst"
    )
    update = ":base + :damping * ({c} + :mass)"
    # the node table (or vector) and the summed contributions are co-partitioned on the
    # node: a partition-local hash join, no broadcast and no extra job per sweep
    if spec.unlinked in ("teleport", "inlinks"):
        where = "WHERE n.has_in" if spec.unlinked == "inlinks" else ""
        return (
            f"SELECT /*+ SHUFFLE_HASH(c) */ n.node, {update.format(c='coalesce(c.c, 0.0D)')} AS rank, "
            f"n.deg, n.blocks FROM {{nodes}} n LEFT JOIN ({contrib}) c ON c.dst = n.node {where}"
        )
    if spec.unlinked == "keep":
        return (
            f"SELECT /*+ SHUFFLE_HASH(c) */ p.node, "
            f"CASE WHEN c.c IS NULL THEN p.rank ELSE {update.format(c='c.c')} END AS rank, "
            f"p.deg, p.blocks FROM {{state}} p LEFT JOIN ({contrib}) c ON c.dst = p.node"
        )
    # reached: only targets of this sweep's messages (the phantom NULL node included)
    return (
        f"SELECT /*+ SHUFFLE_HASH(n) */ c.dst AS node, {update.format(c='c.c')} AS rank, n.deg, n.blocks "
        f"FROM ({contrib}) c LEFT JOIN {{nodes}} n ON n.node = c.dst"
    )


def sweep(model: RankModel, state: DataFrame, sweep_no: int, mass: float | None = None) -> DataFrame:
    """One application of the recurrence; returns the new (unmaterialised) state.

    ``mass`` is the dangling term of this sweep; when omitted it is computed from ``state``.
    """
    spec = model.spec
    if mass is None:
        stats = dangling_stats(state) if _needs_stats(spec, sweep_no) else None
        mass = dangling_mass(model, stats, sweep_no)
    return model.scratch.spark.sql(
        _sweep_statement(spec),
        args={"base": spec.teleport / model.norm, "damping": spec.damping, "mass": float(mass)},
        state=state.select("node", "rank", "deg", "blocks"),
        weights=model.weights,
        nodes=model.nodes,
    )


def iterate(model: RankModel, state: DataFrame | None = None, iterations: int | None = None) -> DataFrame:
    """Run the sweeps.  Each new vector is written as a bucketed table (lineage stays one
    sweep deep) and the one before it dropped; the dangling totals the next sweep needs are
    observed during that write, so they cost no extra job."""
    spec = model.spec
    n = spec.iterations if iterations is None else iterations
    previous = None
    if state is None and model.start_dangling is not None:
        state = initial_ranks(model)
        stats = {"total": model.start_dangling * _start_value(model), "fixed": None}
    else:
        state = state if state is not None else initial_ranks(model)
        stats = dangling_stats(state) if n and _needs_stats(spec, 1) else None
    for k in range(1, n + 1):
        new = sweep(model, state, k, mass=dangling_mass(model, stats, k))
        observed = None
        if k < n and _needs_stats(spec, k + 1):
            observed = Observation(f"dangling{k}")
            new = new.observe(observed, *dangling_stats_exprs())
        held = model.scratch.bucketed(new, ["node"], f"rank{k}", model.buckets)
        model.scratch.drop(previous)  # no longer needed: free the shared folder
        previous, state, model.vector = held, held.df, held
        stats = _metrics(observed, lambda: dangling_stats(state)) if observed is not None else None
    return state


def _result(model: RankModel, state: DataFrame, caller) -> DataFrame:
    """``(node, rank)`` as a frame of the caller's session, all that is left of a model: its
    last vector's files, or the start vector's, with names."""
    if model.keyed or model.vector is None:
        model.vector = model.scratch.written(ranks(model, state), "ranks")
    path = model.scratch.path(model.vector)
    out = caller.read.schema(model.vector.df.schema).parquet(path).select("node", "rank")
    model.scratch.release(model.vector)
    model.close()
    return out


def pagerank(g: Graph, spec: RankSpec | str = "total", keys: str = "hash", **prepare_kw) -> DataFrame:
    """Rank every node of the graph with the given recurrence: ``(node, rank)``.

    The frame reads the last vector's files, which stay in the checkpoint folder; use
    :func:`prepare` and :func:`iterate` in a ``with`` block to leave nothing behind."""
    return scaled_ranks(g, spec, keys=keys, **prepare_kw).select("node", "rank")


def scaled_ranks(
    g: Graph, spec: RankSpec | str = "total", digits: int = 9, keys: str = "hash", **prepare_kw
) -> DataFrame:
    """``(node, rank, rank_n, n)``: ``n`` is the normaliser and ``rank_n`` the rank in units of
    it, ``round(rank * n, digits)`` (see :func:`in_units`).

    Ranks shrink as 1/n, so a fixed number of decimals means less the larger the graph is;
    ``rank_n`` does not shrink, which makes it the value to compare, order and print."""
    spec = PRESETS[spec] if isinstance(spec, str) else spec
    model = prepare(g, spec, keys=keys, **prepare_kw)
    vector = _result(model, iterate(model), g.edges.sparkSession)
    return _scaled(vector, model.norm, digits)


def _scaled(vector: DataFrame, norm: float, digits: int) -> DataFrame:
    return vector.withColumn("rank_n", in_units(F.col("rank"), norm, digits)).withColumn("n", F.lit(int(norm)).cast("long"))


def scaled(model: RankModel, state: DataFrame, digits: int = 9) -> DataFrame:
    """``(node, rank, rank_n, n)`` of a vector of this model, see :func:`scaled_ranks`."""
    return _scaled(ranks(model, state), model.norm, digits)


def in_units(value, norm: float, digits: int = 9):
    """``value`` in units of the normaliser, rounded.  Ranks of small graphs are often decimals
    that end in a 5 just past the last digit; the guard lets those round up whatever the
    order of the sums, and is far below the last digit."""
    return F.round(value * F.lit(norm) + F.lit(ROUNDING_GUARD), digits)


def ranks(model: RankModel, state: DataFrame) -> DataFrame:
    """``(node, rank)`` with node names, from a vector of this model."""
    return model.named(state.select("node", "rank"), "node")
