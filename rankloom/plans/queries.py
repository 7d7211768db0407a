"""Named queries over the given tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Inputs (see FIXTURES.md section 4): graph G (part-follow graph from part + lineitem),
pages H (the ``pages`` table) and readings R (derived from lineitem).  Ranks are
reported in units of the normaliser, ``rank_n = round(rank * n, 9)`` (sums run in a
different order on every engine): unlike the ranks these do not shrink with the graph.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import decode_link, link_capture, page_name_ok
from rankloom.operators import graph as G
from rankloom.operators import links as L
from rankloom.operators import rank as R
from rankloom.operators import series as S
from rankloom.operators import topk as T
from rankloom.operators.ordered import dense_index
from rankloom.session import new_folder
from rankloom.sources import sinks
from rankloom.sources.tables import lineitem_readings, page_lines, part_follow_graph, read_table, reading_lines
from rankloom.sources.text import read_lines_in_order, read_page_lines, read_readings, split_page_lines

Query = Callable[[SparkSession, str], DataFrame]


def _ranked(spark: SparkSession, sf_dir: str, preset: str) -> DataFrame:
    return R.scaled_ranks(part_follow_graph(spark, sf_dir), preset).select("node", "rank_n", "n")


def pagerank_dense(spark, sf_dir):
    """The flagship recurrence on the dense part-follow graph: every line item links to the
    next one of its order (no flag filters), i.e. the whole lineitem table."""
    g = part_follow_graph(spark, sf_dir, returnflag=None, linestatus=None)
    return R.scaled_ranks(g, "total").select("node", "rank_n", "n")


def rank_query(preset: str) -> Query:
    return lambda spark, sf_dir: _ranked(spark, sf_dir, preset)


# --- H: pages ---------------------------------------------------------------------------
def page_name_filter(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").where(page_name_ok("url")).select("page_id", "url")


def links_lenient(spark, sf_dir):
    return L.page_hrefs(read_table(spark, sf_dir, "pages"))


def links_decoded(spark, sf_dir):
    return links_lenient(spark, sf_dir).select("page_id", "pos", decode_link("href").alias("link"))


def links_html_capture(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    path = F.concat(F.lit("."), F.regexp_extract("url", r"https?://[^/]+(/[^?#]*)", 1))
    return pages.select("page_id", link_capture(path).alias("name")).where(F.col("name").isNotNull())


def _strict(spark, sf_dir) -> DataFrame:
    """Page lines -> (name, html) -> (name, links), pages that are no XML dropped."""
    return L.extract_links(split_page_lines(page_lines(spark, sf_dir)), "strict")


def links_strict(spark, sf_dir):
    """Strict (well-formed XML, body-div) extraction: every link with its place in the list;
    a page without links has one row (name, NULL, NULL)."""
    return _strict(spark, sf_dir).select("name", F.posexplode_outer("links").alias("pos", "link"))


def links_strict_raw(spark, sf_dir):
    """The same extraction over the given raw pages, none of which is well-formed XML."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("url").alias("name"), "html")
    return L.extract_links(pages, "strict").select("name", F.size("links").alias("n_links"))


def rank_from_pages(spark, sf_dir):
    """Files to report: page lines written as text and read back -> strict links -> graph ->
    list recurrence -> top 100."""
    path = new_folder(spark, "pages")
    sinks.write_lines(page_lines(spark, sf_dir), "value", path)
    pages = split_page_lines(read_page_lines(spark, path))
    g = G.adjacency_to_graph(L.extract_links(pages, "strict"))
    return T.top_k(R.scaled_ranks(g, "list").select("node", "rank_n"), value="rank_n")


# --- G: graph tables ---------------------------------------------------------------------
def _g(spark, sf_dir) -> G.Graph:
    return part_follow_graph(spark, sf_dir)


def edges(spark, sf_dir):
    return _g(spark, sf_dir).edges


def edges_distinct(spark, sf_dir):
    return G.distinct_edges(_g(spark, sf_dir))


def page_count(spark, sf_dir):
    return G.page_count(_g(spark, sf_dir))


def node_universe(spark, sf_dir):
    return G.node_universe(_g(spark, sf_dir))


def adjacency_list(spark, sf_dir):
    """Each page's link list in multiset form: (node, link, m); (node, NULL, 0) if empty."""
    return G.adjacency(_g(spark, sf_dir))


def out_degree(spark, sf_dir):
    return G.out_degree(_g(spark, sf_dir))


def out_degree_distinct(spark, sf_dir):
    return G.out_degree(_g(spark, sf_dir), distinct=True)


def dangling_pages(spark, sf_dir):
    return G.dangling_pages(_g(spark, sf_dir))


def dangling_nodes(spark, sf_dir):
    return G.dangling_nodes(_g(spark, sf_dir))


def transition_matrix(spark, sf_dir):
    return G.transition_matrix(_g(spark, sf_dir))


def matrix_rows(spark, sf_dir):
    """Row view of the matrix: every entry with its position in (dst, src) order."""
    return dense_index(G.transition_matrix(_g(spark, sf_dir)), ["dst", "src"], "pos")


def matrix_row_summary(spark, sf_dir):
    rows = G.matrix_row_summary(_g(spark, sf_dir))
    return rows.select("dst", "nnz", F.round("in_weight", 9).alias("in_weight"))


def node_alias(spark, sf_dir):
    return G.node_alias(G.node_universe(_g(spark, sf_dir)).select("node"))


def edges_by_id(spark, sf_dir):
    return G.edges_by_id(_g(spark, sf_dir))


def _matrix_start(spark, sf_dir) -> tuple[R.RankModel, DataFrame]:
    model = R.prepare(_g(spark, sf_dir), R.PRESETS["matrix_row"])
    return model, R.initial_ranks(model)


def initial_ranks(spark, sf_dir):
    model, state = _matrix_start(spark, sf_dir)
    return R.scaled(model, state).select("node", "rank_n", "n")


def _in_units(model: R.RankModel) -> list:
    """A contribution in units of the normaliser, and the normaliser."""
    return [R.in_units(F.col("c"), model.norm).alias("c_n"), F.lit(int(model.norm)).cast("long").alias("n")]


def contributions(spark, sf_dir):
    model, state = _matrix_start(spark, sf_dir)
    contrib = R.contributions(model, state).select("src", "dst", *_in_units(model))
    return model.named(contrib, "src", "dst")


def spmv_step(spark, sf_dir):
    model, state = _matrix_start(spark, sf_dir)
    return model.named(R.gather(model, state).select("dst", *_in_units(model)), "dst")


def dangling_mass(spark, sf_dir):
    """Rank total of the dangling nodes after one sweep of the exact list recurrence: the
    mass that the next sweep spreads, summed over the vector itself."""
    model = R.prepare(_g(spark, sf_dir), R.PRESETS["list_exact"])
    totals = R.iterate(model, iterations=1).agg(*R.dangling_stats_exprs())
    return totals.select(R.in_units(F.col("total"), 1.0).alias("total"))


def dangling_mass_fixed(spark, sf_dir):
    """Fixed-point dangling total after the first list sweep (the value fed to sweep 2)."""
    model = R.prepare(_g(spark, sf_dir), R.PRESETS["list"])
    state = R.iterate(model, iterations=1)
    return state.where(F.col("deg").isNull()).agg(R.fixed_point_total(F.col("rank")).alias("delta"))


# --- G: reports --------------------------------------------------------------------------
def topk(spark, sf_dir):
    return T.top_k(_ranked(spark, sf_dir, "total").select("node", "rank_n"), value="rank_n")


def topk_distinct_ranks(spark, sf_dir):
    return T.top_k_distinct(_ranked(spark, sf_dir, "total"), value="rank_n")


def topk_skip_first(spark, sf_dir):
    return T.top_k_skip_first(_ranked(spark, sf_dir, "unnormalised_phantom"), value="rank_n")


def report_file(spark, sf_dir):
    """The top-100 report as written: the lines of its one file with their places."""
    path = new_folder(spark, "report")
    sinks.write_report(topk(spark, sf_dir), path, "node", "rank_n")
    return read_lines_in_order(spark, path)


def key_value_file(spark, sf_dir):
    """A whole vector as ``key TAB value`` files, sorted by key: the lines with their places.
    The phantom node's key is NULL and every tenth node's begins with ``#``."""
    path = new_folder(spark, "ranks")
    ranks = _ranked(spark, sf_dir, "unnormalised_phantom")
    key = F.when(F.col("node").endswith("7"), F.concat(F.lit("#"), "node")).otherwise(F.col("node"))
    sinks.write_key_value(ranks.select(key.alias("key"), "rank_n").orderBy("key"), "key", "rank_n", path)
    return read_lines_in_order(spark, path)


# --- R: readings -------------------------------------------------------------------------
def _r(spark, sf_dir):
    return lineitem_readings(spark, sf_dir)


def readings_filtered(spark, sf_dir):
    return S.measure_readings(_r(spark, sf_dir))


def secondary_sorted(spark, sf_dir):
    """Readings in composite-key order, each with its position in it."""
    return S.sorted_positions(S.measure_readings(_r(spark, sf_dir)))


def yearly_means(spark, sf_dir):
    return S.yearly_means(_r(spark, sf_dir))


def yearly_means_csv(spark, sf_dir):
    """The means of readings that come from a text file with missing, empty, padded, extra and
    unparsable fields."""
    path = new_folder(spark, "readings")
    sinks.write_lines(reading_lines(spark, sf_dir), "value", path)
    return S.yearly_means(read_readings(spark, path))


def year_breaks(spark, sf_dir):
    return S.year_breaks(_r(spark, sf_dir))


def station_series(spark, sf_dir):
    return S.flatten_series(S.station_series(_r(spark, sf_dir)))


def series_text(spark, sf_dir):
    """Each station's series as one text line ``station,[(y,tmin,tmax)...]``."""
    return S.render_series(S.station_series(_r(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "page_name_filter": page_name_filter,
    "links_lenient": links_lenient,
    "links_decoded": links_decoded,
    "links_html_capture": links_html_capture,
    "links_strict": links_strict,
    "links_strict_raw": links_strict_raw,
    "rank_from_pages": rank_from_pages,
    "edges": edges,
    "edges_distinct": edges_distinct,
    "page_count": page_count,
    "node_universe": node_universe,
    "adjacency_list": adjacency_list,
    "out_degree": out_degree,
    "out_degree_distinct": out_degree_distinct,
    "dangling_pages": dangling_pages,
    "dangling_nodes": dangling_nodes,
    "transition_matrix": transition_matrix,
    "matrix_rows": matrix_rows,
    "matrix_row_summary": matrix_row_summary,
    "node_alias": node_alias,
    "edges_by_id": edges_by_id,
    "initial_ranks": initial_ranks,
    "dangling_mass": dangling_mass,
    "dangling_mass_fixed": dangling_mass_fixed,
    "contributions": contributions,
    "spmv_step": spmv_step,
    "pagerank": rank_query("total"),
    "pagerank_list": rank_query("list"),
    "pagerank_matrix_row": rank_query("matrix_row"),
    "pagerank_matrix_col": rank_query("matrix_col"),
    "pagerank_matrix_col_once": rank_query("matrix_col_once"),
    "pagerank_unnormalised": rank_query("unnormalised"),
    "pagerank_list_exact": rank_query("list_exact"),
    "pagerank_dense": pagerank_dense,
    "pagerank_unnormalised_phantom": rank_query("unnormalised_phantom"),
    "topk": topk,
    "topk_distinct_ranks": topk_distinct_ranks,
    "topk_skip_first": topk_skip_first,
    "report_file": report_file,
    "key_value_file": key_value_file,
    "readings_filtered": readings_filtered,
    "secondary_sorted": secondary_sorted,
    "yearly_means": yearly_means,
    "yearly_means_csv": yearly_means_csv,
    "year_breaks": year_breaks,
    "station_series": station_series,
    "series_text": series_text,
}
