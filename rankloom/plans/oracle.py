"""DuckDB SQL oracles for the registered queries (independent re-statements, no Spark).

Rank recurrences are unrolled into one ``AS MATERIALIZED`` CTE per sweep.  What each recurrence
is stands here once more, by hand (``SPECS``): a wrong preset of the Spark side differs from it.
"""

from __future__ import annotations

from typing import NamedTuple

from rankloom.functions.fixed import HREF_PATTERN, LINK_PATTERN, PAGE_NAME_PATTERN, TOP_K
from rankloom.sources.tables import (
    CSV_CYCLE,
    CSV_EMPTY,
    CSV_NO_VALUE,
    CSV_SHORT_EVERY,
    CSV_SILENT_STATION,
    CSV_TEXT_VALUE,
    LINK_ESCAPED_LINE,
    LINK_LINESTATUS,
    LINK_OUTSIDE_LINE,
    LINK_RETURNFLAG,
    MAX_PAGE_SIZE,
    PAGE_BROKEN_EVERY,
    PAGE_SECOND_EVERY,
    PAGE_TILDE_EVERY,
)

DIGITS = 9
GUARD = "CAST(1e-11 AS DOUBLE)"  # decides exact halves alike on both sides


FIXED_POINT = 100000.0  # ranks of the list recurrence's dangling total are cut to five decimals


class Spec(NamedTuple):
    """A rank recurrence: normaliser, nodes with a start value, links counted once or as often
    as they occur, nodes without in-links, dangling mass, sweeps, phantom node."""

    norm: str
    start: str
    edges: str
    unlinked: str
    dangling: str
    sweeps: int
    phantom: bool = False


SPECS = {
    "list": Spec("pages", "pages", "multiset", "teleport", "literal", 9),
    "list_exact": Spec("pages", "pages", "multiset", "teleport", "exact", 9),
    "matrix_row": Spec("pages", "nodes", "multiset", "keep", "none", 10),
    "matrix_col": Spec("pages", "nodes", "multiset", "inlinks", "none", 10),
    "matrix_col_once": Spec("pages", "nodes", "multiset", "inlinks", "none", 1),
    "unnormalised": Spec("one", "pages", "distinct", "reached", "none", 10),
    "unnormalised_phantom": Spec("one", "pages", "distinct", "reached", "none", 10, True),
    "total": Spec("nodes", "nodes", "multiset", "teleport", "exact", 10),
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# what the strict extraction must find in the rendered pages, from the rule that renders them
STRICT_CTES = f"""
s_pages AS (
  SELECT p_partkey AS part, 'P' || CAST(p_partkey AS VARCHAR) AS name FROM part
  WHERE p_partkey % {PAGE_TILDE_EVERY} <> 0 AND p_partkey % {PAGE_BROKEN_EVERY} <> 0
),
s_anchors AS (
  SELECT l_partkey AS part, 0 AS div, l_orderkey AS o, l_linenumber AS n, l_suppkey AS s,
         CASE WHEN l_linenumber = {LINK_ESCAPED_LINE} THEN 'P ' ELSE 'P' END || CAST(l_suppkey AS VARCHAR) AS link
  FROM lineitem WHERE l_linenumber <> {LINK_OUTSIDE_LINE}
  UNION ALL SELECT part, 1, 0, 0, 0, 'Second' FROM s_pages WHERE part % {PAGE_SECOND_EVERY} = 0
),
s_links AS (
  SELECT p.name, CAST(row_number() OVER (PARTITION BY a.part ORDER BY div, o, n, s, link) - 1 AS INTEGER) AS pos, a.link
  FROM s_pages p JOIN s_anchors a ON a.part = p.part
)"""

STRICT_GRAPH = f"""{STRICT_CTES},
g_pages AS (SELECT name AS node FROM s_pages),
g_edges AS (SELECT name AS src, replace(link, ' ', '') AS dst FROM s_links),
g_nodes AS (
  SELECT node, bool_or(is_page) AS is_page, bool_or(has_in) AS has_in FROM (
    SELECT node, true AS is_page, false AS has_in FROM g_pages
    UNION ALL SELECT dst, false, true FROM g_edges
  ) GROUP BY node
),
g_n AS (SELECT count(*) AS n FROM g_pages)"""


def graph_ctes(dense: bool = False) -> str:
    """Graph G, its node table and its link multiplicities (``dense``: no line-item filters)."""
    item_filter = (
        "" if dense
        else f"WHERE l_returnflag = {_q(LINK_RETURNFLAG)} AND l_linestatus = {_q(LINK_LINESTATUS)}"
    )
    return f"""
g_pages AS (
  SELECT CAST(p_partkey AS VARCHAR) AS node FROM part WHERE p_size <= {MAX_PAGE_SIZE}
),
g_raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS src,
         CAST(lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS VARCHAR) AS dst
  FROM lineitem {item_filter}
),
g_edges AS (
  SELECT regexp_replace(src, '\\s', '', 'g') AS src, regexp_replace(dst, '\\s', '', 'g') AS dst
  FROM g_raw
  WHERE dst IS NOT NULL AND src IN (SELECT node FROM g_pages)
    AND regexp_replace(dst, '\\s', '', 'g') <> ''
),
g_nodes AS (
  SELECT node, bool_or(is_page) AS is_page, bool_or(has_in) AS has_in FROM (
    SELECT node, true AS is_page, false AS has_in FROM g_pages
    UNION ALL SELECT dst, false, true FROM g_edges
  ) GROUP BY node
),
g_pairs AS (SELECT src, dst, count(*) AS m FROM g_edges GROUP BY src, dst),
g_n AS (SELECT count(*) AS n FROM g_pages)"""


def with_graph(body: str, extra: str = "", dense: bool = False) -> str:
    ctes = graph_ctes(dense) + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


def _num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def rank_ctes(spec: Spec, norm_sql: str, prefix: str = "r") -> tuple[str, str]:
    """CTEs computing ``spec`` over G; returns (ctes, name of the final vector CTE).

    ``norm_sql`` is a scalar subquery giving the normaliser (N pages or |V| nodes).
    """
    edges = "g_edges"
    if spec.phantom:
        edges = f"{prefix}_edges"
    parts = []
    if spec.phantom:
        parts.append(
            f"""{prefix}_edges AS (
  SELECT src, dst FROM g_edges
  UNION ALL SELECT node, CAST(NULL AS VARCHAR) FROM g_pages WHERE node NOT IN (SELECT src FROM g_edges)
)"""
        )
    m = "count(*)" if spec.edges == "multiset" else "1"
    parts.append(f"{prefix}_w AS (SELECT src, dst, {m} AS m FROM {edges} GROUP BY src, dst)")
    parts.append(f"{prefix}_deg AS (SELECT src, sum(m) AS deg FROM {prefix}_w GROUP BY src)")
    parts.append(
        f"""{prefix}_nodes AS (
  SELECT n.node, n.is_page, n.has_in, d.deg FROM g_nodes n LEFT JOIN {prefix}_deg d ON d.src = n.node
)"""
    )
    if spec.norm == "one":
        norm, start = "CAST(1.0 AS DOUBLE)", "CAST(1.0 AS DOUBLE)"
    else:
        norm = f"CAST(({norm_sql}) AS DOUBLE)"
        start = f"CAST(1.0 AS DOUBLE) / {norm}"
    on = "true" if spec.start == "nodes" else "is_page"
    parts.append(
        f"""{prefix}0 AS MATERIALIZED (
  SELECT node, CASE WHEN {on} THEN {start} ELSE CAST(0.0 AS DOUBLE) END AS rank, deg FROM {prefix}_nodes
)"""
    )
    base = f"({_num(0.15)} / {norm})"
    damp = _num(0.85)
    for t in range(1, spec.sweeps + 1):
        prev, cur = f"{prefix}{t - 1}", f"{prefix}{t}"
        parts.append(
            f"""{cur}_c AS (
  SELECT w.dst, sum(r.rank / r.deg * w.m) AS c
  FROM {prefix}_w w JOIN {prev} r ON r.node = w.src WHERE r.deg IS NOT NULL GROUP BY w.dst
)"""
        )
        dangling = f"FROM {prev} WHERE deg IS NULL AND node IS NOT NULL"
        if spec.dangling == "none":
            mass = "CAST(0.0 AS DOUBLE)"
        elif spec.dangling == "exact":
            mass = f"(SELECT coalesce(sum(rank), 0) / {norm} {dangling})"
        elif t == 1:
            mass = f"({_num(-1.0)} / ({FIXED_POINT} * {norm}))"
        elif t == 2:
            mass = (
                f"(SELECT CAST(coalesce(sum(CAST(floor(round(rank * {FIXED_POINT}, 6)) AS BIGINT)), 0) AS DOUBLE)"
                f" / ({FIXED_POINT} * {norm}) {dangling})"
            )
        else:
            mass = "CAST(0.0 AS DOUBLE)"
        if spec.unlinked in ("teleport", "inlinks"):
            where = "WHERE n.has_in" if spec.unlinked == "inlinks" else ""
            body = f"""SELECT n.node, {base} + {damp} * (coalesce(c.c, 0) + {mass}) AS rank, n.deg
  FROM {prefix}_nodes n LEFT JOIN {cur}_c c ON c.dst = n.node {where}"""
        elif spec.unlinked == "keep":
            body = f"""SELECT p.node,
         CASE WHEN c.c IS NULL THEN p.rank ELSE {base} + {damp} * (c.c + {mass}) END AS rank, p.deg
  FROM {prev} p LEFT JOIN {cur}_c c ON c.dst = p.node"""
        else:
            body = f"""SELECT c.dst AS node, {base} + {damp} * (c.c + {mass}) AS rank, n.deg
  FROM {cur}_c c LEFT JOIN {prefix}_nodes n ON n.node = c.dst"""
        parts.append(f"{cur} AS MATERIALIZED (\n  {body}\n)")
    return ",\n".join(parts), f"{prefix}{spec.sweeps}"


def rank_sql(name: str, select: str | None = None, dense: bool = False, graph: str | None = None) -> str:
    spec = SPECS[name]
    norm = "SELECT n FROM g_n" if spec.norm == "pages" else "SELECT count(*) FROM g_nodes"
    ctes, final = rank_ctes(spec, norm)
    # the reported value: the rank in units of the normaliser
    n = "1" if spec.norm == "one" else f"({norm})"
    ctes += f",\nreported AS (SELECT node, round(rank * CAST({n} AS DOUBLE) + {GUARD}, {DIGITS}) AS rank_n, CAST({n} AS BIGINT) AS n FROM {final})"
    select = select or "SELECT node, rank_n, n FROM reported"
    return f"WITH {graph},\n{ctes}\n{select}" if graph else with_graph(select, ctes, dense=dense)


def _topk(spec: str, k: int = TOP_K, graph: str | None = None) -> str:
    return rank_sql(
        spec, f"SELECT node, rank_n FROM reported ORDER BY rank_n DESC, node ASC NULLS LAST LIMIT {k}", graph=graph
    )


def _topk_distinct(spec: str, k: int = TOP_K) -> str:
    return rank_sql(
        spec,
        f"SELECT max(node) AS node, rank_n FROM reported GROUP BY rank_n ORDER BY rank_n DESC LIMIT {k}",
    )


def _topk_skip_first(spec: str, k: int = TOP_K) -> str:
    return rank_sql(
        spec,
        f"""SELECT node, rank_n FROM (
  SELECT node, rank_n, row_number() OVER (ORDER BY rank_n DESC, node ASC NULLS LAST) AS pos,
         count(*) OVER () AS cnt
  FROM (SELECT node, rank_n FROM reported ORDER BY rank_n DESC, node ASC NULLS LAST LIMIT {k + 1})
) WHERE pos > 1 OR cnt <= {k}""",
    )


READINGS_CTES = """
r_raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS station, strftime(l_shipdate, '%Y%m%d') AS date,
         CASE l_returnflag WHEN 'R' THEN 'TMIN' WHEN 'A' THEN 'TMAX' ELSE 'OTHER' END AS mtype,
         CAST(l_quantity AS VARCHAR) AS value
  FROM lineitem
),
r_meas AS (
  SELECT station, TRY_CAST(substr(date, 1, 4) AS INTEGER) AS year, mtype, TRY_CAST(value AS DOUBLE) AS value
  FROM r_raw WHERE mtype IN ('TMAX', 'TMIN')
),
r_sums AS (
  SELECT station, year,
         sum(CASE WHEN mtype = 'TMIN' AND value IS NOT NULL THEN value END) AS sum_tmin,
         count(CASE WHEN mtype = 'TMIN' AND value IS NOT NULL THEN 1 END) AS n_tmin,
         sum(CASE WHEN mtype = 'TMAX' AND value IS NOT NULL THEN value END) AS sum_tmax,
         count(CASE WHEN mtype = 'TMAX' AND value IS NOT NULL THEN 1 END) AS n_tmax
  FROM r_meas GROUP BY station, year
),
r_means AS (
  SELECT station, year,
         CASE WHEN n_tmin = 0 THEN CAST(-9999.0 AS DOUBLE) ELSE sum_tmin / n_tmin END AS mean_tmin,
         CASE WHEN n_tmin = 0 AND n_tmax = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN n_tmax = 0 THEN CAST(-9999.0 AS DOUBLE) ELSE sum_tmax / n_tmax END AS mean_tmax
  FROM r_sums
)"""


def with_readings(body: str) -> str:
    return f"WITH {READINGS_CTES}\n{body}"


# the readings of the text file, from the rule that writes its lines: which have a measure, and
# which of those a number
CSV_READINGS_CTES = f"""
r_raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS station, strftime(l_shipdate, '%Y%m%d') AS date,
         CASE l_returnflag WHEN 'R' THEN 'TMIN' WHEN 'A' THEN 'TMAX' ELSE 'OTHER' END AS mtype,
         CASE WHEN l_orderkey % {CSV_CYCLE} NOT IN ({CSV_NO_VALUE}, {CSV_TEXT_VALUE}, {CSV_EMPTY})
               AND NOT (l_partkey % {CSV_SILENT_STATION} = 0 AND year(l_shipdate) % 2 = 0)
              THEN CAST(l_quantity AS VARCHAR) END AS value
  FROM lineitem WHERE l_orderkey % {CSV_SHORT_EVERY} <> 0
),
""" + READINGS_CTES[READINGS_CTES.index("r_meas AS"):]


HREFS = f"""SELECT page_id, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos, unnest(hrefs) AS href
  FROM (SELECT page_id, regexp_extract_all(html, {_q(HREF_PATTERN)}, 1) AS hrefs FROM pages)"""

# Java-style decoding: '+' is a space; DuckDB's url_decode keeps broken escapes as they are
DECODE = "url_decode(replace(href, '+', ' '))"


def _alias_sql() -> str:
    return "SELECT node, row_number() OVER (ORDER BY node) AS id FROM g_nodes"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # --- H: pages and hrefs ---------------------------------------------------------
    q["page_name_filter"] = (
        f"SELECT page_id, url FROM pages WHERE regexp_matches(url, {_q(PAGE_NAME_PATTERN)})"
    )
    q["links_lenient"] = HREFS
    q["links_decoded"] = f"SELECT page_id, pos, {DECODE} AS link FROM ({HREFS})"
    q["links_html_capture"] = f"""SELECT page_id, name FROM (
  SELECT page_id, regexp_extract('.' || regexp_extract(url, 'https?://[^/]+(/[^?#]*)', 1), {_q(LINK_PATTERN)}, 1) AS name
  FROM pages
) WHERE name <> ''"""
    q["links_strict"] = f"""WITH {STRICT_CTES}
SELECT p.name, l.pos, l.link FROM s_pages p LEFT JOIN s_links l ON l.name = p.name"""
    # no given page is well-formed XML, so none may be kept
    q["links_strict_raw"] = "SELECT url AS name, CAST(0 AS INTEGER) AS n_links FROM pages WHERE false"
    # --- G: graph tables ------------------------------------------------------------
    q["edges"] = with_graph("SELECT src, dst FROM g_edges")
    q["edges_distinct"] = with_graph("SELECT DISTINCT src, dst FROM g_edges")
    q["page_count"] = with_graph("SELECT n AS n_pages FROM g_n")
    q["node_universe"] = with_graph("SELECT node, is_page, has_in FROM g_nodes")
    q["adjacency_list"] = with_graph(
        """SELECT src AS node, dst AS link, count(*) AS m FROM g_edges GROUP BY src, dst
UNION ALL
SELECT node, CAST(NULL AS VARCHAR), CAST(0 AS BIGINT) FROM g_pages WHERE node NOT IN (SELECT src FROM g_edges)"""
    )
    q["out_degree"] = with_graph("SELECT src AS node, count(*) AS out_degree FROM g_edges GROUP BY src")
    q["out_degree_distinct"] = with_graph(
        "SELECT src AS node, count(DISTINCT dst) AS out_degree FROM g_edges GROUP BY src"
    )
    q["dangling_pages"] = with_graph(
        "SELECT node FROM g_pages WHERE node NOT IN (SELECT src FROM g_edges)"
    )
    q["dangling_nodes"] = with_graph(
        "SELECT node, is_page FROM g_nodes WHERE node NOT IN (SELECT src FROM g_edges)"
    )
    q["transition_matrix"] = with_graph(
        """SELECT p.dst, p.src, p.m / d.deg AS w
FROM g_pairs p JOIN (SELECT src, sum(m) AS deg FROM g_pairs GROUP BY src) d ON d.src = p.src"""
    )
    q["matrix_rows"] = with_graph(
        """SELECT p.dst, p.src, p.m / d.deg AS w, row_number() OVER (ORDER BY p.dst, p.src) AS pos
FROM g_pairs p JOIN (SELECT src, sum(m) AS deg FROM g_pairs GROUP BY src) d ON d.src = p.src"""
    )
    q["matrix_row_summary"] = with_graph(
        """SELECT dst, count(*) AS nnz, round(sum(w), 9) AS in_weight
FROM (SELECT p.dst, p.src, p.m / d.deg AS w
      FROM g_pairs p JOIN (SELECT src, sum(m) AS deg FROM g_pairs GROUP BY src) d ON d.src = p.src)
GROUP BY dst"""
    )
    q["node_alias"] = with_graph(_alias_sql())
    q["edges_by_id"] = with_graph(
        f"""SELECT p.src, p.dst, a.id AS src_id, b.id AS dst_id, p.m
FROM g_pairs p JOIN ({_alias_sql()}) a ON a.node = p.src JOIN ({_alias_sql()}) b ON b.node = p.dst"""
    )
    q["initial_ranks"] = with_graph(
        f"SELECT node, round(CAST(1.0 AS DOUBLE) / (SELECT n FROM g_n) * (SELECT n FROM g_n) + {GUARD}, {DIGITS}) AS rank_n, (SELECT n FROM g_n) AS n FROM g_nodes"
    )
    ctes, final = rank_ctes(SPECS["list_exact"]._replace(sweeps=1), "SELECT n FROM g_n", prefix="x")
    q["dangling_mass"] = with_graph(
        f"SELECT round(coalesce(sum(rank), 0) + {GUARD}, {DIGITS}) AS total FROM {final} WHERE deg IS NULL", ctes
    )
    spec1 = SPECS["list"]._replace(sweeps=1)
    ctes, final = rank_ctes(spec1, "SELECT n FROM g_n", prefix="d")
    q["dangling_mass_fixed"] = with_graph(
        f"""SELECT CAST(coalesce(sum(CAST(floor(round(rank * {FIXED_POINT}, 6)) AS BIGINT)), 0) AS BIGINT) AS delta
FROM {final} WHERE deg IS NULL""",
        ctes,
    )
    ctes, _ = rank_ctes(SPECS["matrix_row"]._replace(sweeps=0), "SELECT n FROM g_n", prefix="c")
    q["contributions"] = with_graph(
        f"""SELECT w.src, w.dst, round(r.rank / r.deg * w.m * (SELECT n FROM g_n) + {GUARD}, 9) AS c_n, (SELECT n FROM g_n) AS n
FROM c_w w JOIN c0 r ON r.node = w.src""",
        ctes,
    )
    q["spmv_step"] = with_graph(
        f"""SELECT w.dst, round(sum(r.rank / r.deg * w.m) * (SELECT n FROM g_n) + {GUARD}, 9) AS c_n, (SELECT n FROM g_n) AS n
FROM c_w w JOIN c0 r ON r.node = w.src GROUP BY w.dst""",
        ctes,
    )
    # --- G: rank recurrences and reports --------------------------------------------
    q["pagerank"] = rank_sql("total")
    q["pagerank_list"] = rank_sql("list")
    q["pagerank_matrix_row"] = rank_sql("matrix_row")
    q["pagerank_matrix_col"] = rank_sql("matrix_col")
    q["pagerank_matrix_col_once"] = rank_sql("matrix_col_once")
    q["pagerank_unnormalised"] = rank_sql("unnormalised")
    q["pagerank_list_exact"] = rank_sql("list_exact")
    q["pagerank_dense"] = rank_sql("total", dense=True)
    q["pagerank_unnormalised_phantom"] = rank_sql("unnormalised_phantom")
    q["topk"] = _topk("total")
    q["rank_from_pages"] = _topk("list", graph=STRICT_GRAPH)
    q["topk_distinct_ranks"] = _topk_distinct("total")
    q["topk_skip_first"] = _topk_skip_first("unnormalised_phantom")
    q["report_file"] = rank_sql(
        "total",
        f"""SELECT row_number() OVER (ORDER BY rank_n DESC, node) - 1 AS pos, node || ' ' || CAST(rank_n AS VARCHAR) AS line
FROM (SELECT node, rank_n FROM reported ORDER BY rank_n DESC, node LIMIT {TOP_K})""",
    )
    q["key_value_file"] = rank_sql(
        "unnormalised_phantom",
        """SELECT row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS pos, coalesce(key, 'null') || chr(9) || CAST(rank_n AS VARCHAR) AS line
FROM (SELECT CASE WHEN node LIKE '%7' THEN '#' || node ELSE node END AS key, rank_n FROM reported)""",
    )
    # --- R: readings ----------------------------------------------------------------
    q["readings_filtered"] = with_readings("SELECT station, year, mtype, value FROM r_meas")
    q["secondary_sorted"] = with_readings(
        """SELECT station, year, mtype, value, row_number() OVER (ORDER BY station, year, mtype, value) AS pos FROM r_meas"""
    )
    q["yearly_means"] = with_readings("SELECT station, year, mean_tmin, mean_tmax FROM r_means")
    q["yearly_means_csv"] = f"WITH {CSV_READINGS_CTES}\nSELECT station, year, mean_tmin, mean_tmax FROM r_means"
    q["year_breaks"] = with_readings(
        """SELECT station, year, lag(year) OVER (PARTITION BY station ORDER BY year) AS prev_year
FROM (SELECT DISTINCT station, year FROM r_meas)"""
    )
    q["station_series"] = with_readings(
        """SELECT station, CAST(row_number() OVER (PARTITION BY station ORDER BY year) - 1 AS INTEGER) AS pos,
       year, mean_tmin, mean_tmax
FROM r_means"""
    )
    q["series_text"] = with_readings(
        """SELECT station || ',[' || string_agg(
         '(' || CAST(year AS VARCHAR) || ',' || CAST(mean_tmin AS VARCHAR) || ',' || CAST(mean_tmax AS VARCHAR) || ')',
         '' ORDER BY year) || ']' AS value
FROM r_means GROUP BY station"""
    )
    return q
