"""Adapters that derive the workload's inputs from the given parquet tables.

* G - part-follow graph: pages are the parts with ``p_size <= 40``; within an order,
  each returned-and-finished line item links to the next line item's part.
* R - readings: one reading per line item (station = part, date = ship date,
  returned -> TMIN, accepted -> TMAX, others -> OTHER (filtered out later), value = quantity).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.graph import Graph, normalise_edges
from rankloom.operators.ordered import next_in_group

# fixed values of the G and R derivations (shared with the SQL oracle)
MAX_PAGE_SIZE = 40
LINK_RETURNFLAG = "R"
LINK_LINESTATUS = "F"
MEASURE_BY_FLAG = {"R": "TMIN", "A": "TMAX"}
OTHER_MEASURE = "OTHER"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_follow_graph(
    spark: SparkSession,
    sf_dir: str,
    returnflag: str | None = LINK_RETURNFLAG,
    linestatus: str | None = LINK_LINESTATUS,
    ranges: int | None = None,
) -> Graph:
    """Graph G.  ``returnflag``/``linestatus`` = None drops that filter (denser graphs)."""
    part = read_table(spark, sf_dir, "part")
    lineitem = read_table(spark, sf_dir, "lineitem")
    crawled = part.where(F.col("p_size") <= MAX_PAGE_SIZE)
    pages = crawled.select(F.col("p_partkey").cast("string").alias("node"))
    items = lineitem
    if returnflag is not None:
        items = items.where(F.col("l_returnflag") == returnflag)
    if linestatus is not None:
        items = items.where(F.col("l_linestatus") == linestatus)
    # next line item of the same order; an order of very many lines is split over ranges.
    # file and row position: a unique, deterministic tie-breaker for equal (line, part)
    # keys - it cannot change the result (tied rows have the same part) but lets a hot
    # order be split anywhere and keeps recomputed tasks identical
    lines = items.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    followed = next_in_group(
        lines, "l_orderkey", ["l_linenumber", "l_partkey"], "l_partkey",
        out="next_partkey", ranges=ranges, ties=["_file", "_row"],
    )
    # the join on the keys as they are, names are made of what is left
    links = followed.where(F.col("next_partkey").isNotNull())
    links = links.join(crawled.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    links = links.select(F.col("l_partkey").cast("string").alias("src"), F.col("next_partkey").cast("string").alias("dst"))
    return Graph(pages, normalise_edges(links))


# fixed values of the rendered pages (shared with the SQL oracle)
PAGE_TILDE_EVERY = 17  # names of these parts hold a "~"
PAGE_BROKEN_EVERY = 13  # pages of these parts are not well-formed
PAGE_SECOND_EVERY = 5  # pages of these parts have a second body div
LINK_OUTSIDE_LINE = 7  # line items with this number link to another site
LINK_ESCAPED_LINE = 6  # links of these hold an escaped blank


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name:html`` lines: every part as an XHTML page that links, in (order, line, supplier)
    order, to the pages named after its line items' suppliers.

    Every page has an anchor outside its body div; some have a second body div, some are not
    well-formed and some have a name that is no page name.  One page is one row, so its
    list is gathered per part, as a crawler would have stored it.
    """
    part = read_table(spark, sf_dir, "part").select("p_partkey")
    items = read_table(spark, sf_dir, "lineitem")
    supplier = lambda s: s["l_suppkey"].cast("string")
    href = lambda s: (
        F.when(s["l_linenumber"] == LINK_OUTSIDE_LINE, F.concat(F.lit("http://x/P"), supplier(s), F.lit(".html")))
        .when(s["l_linenumber"] == LINK_ESCAPED_LINE, F.concat(F.lit("./s/P%20"), supplier(s), F.lit(".html")))
        .otherwise(F.concat(F.lit("../s/P"), supplier(s), F.lit(".html")))
    )
    anchor = lambda s: F.concat(F.lit('<p><a href="'), href(s), F.lit('">x</a></p>'))
    # the keys alone are gathered and sorted; anchors are made of them in place
    bodies = (
        items.select("l_partkey", F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("s"))
        .groupBy("l_partkey")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("s")), anchor), "").alias("body"))
    )
    every = lambda n: F.col("p_partkey") % n == 0
    second = F.when(every(PAGE_SECOND_EVERY), F.lit('<div id="BODYCONTENT"><a href="./s/Second.html"/></div>')).otherwise(F.lit(""))
    line = F.concat(
        F.lit("P"), F.col("p_partkey").cast("string"), F.when(every(PAGE_TILDE_EVERY), F.lit("~1")).otherwise(F.lit("")),
        F.lit(':<html><body><a href="./s/Out.html">o</a><div id="bodyContent">'), F.coalesce("body", F.lit("")), F.lit("</div>"),
        second, F.when(every(PAGE_BROKEN_EVERY), F.lit("<br>")).otherwise(F.lit("")), F.lit("</body></html>"),
    )
    return part.join(bodies, F.col("p_partkey") == F.col("l_partkey"), "left").select(line.alias("value"))


# fixed values of the readings' text lines (shared with the SQL oracle): by order key
CSV_EXTRA_EVERY = 3  # these lines have fields behind the value
CSV_SHORT_EVERY = 13  # these end behind the date
CSV_CYCLE = 7  # of seven orders: the second has no value field, the third text in it, the
CSV_NO_VALUE, CSV_TEXT_VALUE, CSV_BLANKS, CSV_EMPTY = 1, 2, 3, 4  # fourth blanks around the number, the fifth nothing
CSV_SILENT_STATION = 11  # every such station has no number in even years


def reading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings R as lines of a file kept by hand: fields are missing, empty, padded, followed
    by others, or no numbers."""
    order, year = F.col("l_orderkey"), F.year("l_shipdate")
    flag = F.col("l_returnflag")
    mtype = F.when(flag == "R", F.lit("TMIN")).when(flag == "A", F.lit("TMAX")).otherwise(F.lit(OTHER_MEASURE))
    value = F.col("l_quantity").cast("string")
    cycle = order % CSV_CYCLE
    silent = (F.col("l_partkey") % CSV_SILENT_STATION == 0) & (year % 2 == 0)
    start = F.concat_ws(",", F.col("l_partkey").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"))
    field = (
        F.when(silent | (cycle == CSV_TEXT_VALUE), F.concat(F.lit(",n/a "), value))
        .when(cycle == CSV_NO_VALUE, F.lit(""))
        .when(cycle == CSV_BLANKS, F.concat(F.lit(",  "), value, F.lit(" ")))
        .when(cycle == CSV_EMPTY, F.lit(","))
        .otherwise(F.concat(F.lit(","), value))
    )
    extra = F.when((order % CSV_EXTRA_EVERY == 0) & (cycle != CSV_NO_VALUE), F.lit(",S,0.5,")).otherwise(F.lit(""))
    line = F.when(order % CSV_SHORT_EVERY == 0, start).otherwise(F.concat(start, F.lit(","), mtype, field, extra))
    return read_table(spark, sf_dir, "lineitem").select(line.alias("value"))


def lineitem_readings(spark: SparkSession, sf_dir: str, measures_only: bool = True) -> DataFrame:
    """Readings R as text fields (station, date yyyymmdd, mtype, value); ``measures_only``
    reads only the line items that carry a measure (a predicate on the flag itself, which
    the parquet scan can use; a filter on the derived ``mtype`` could not reach it)."""
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    if measures_only:
        li = li.where(flag.isin(*MEASURE_BY_FLAG))
    mtype = None
    for code, name in MEASURE_BY_FLAG.items():
        branch = flag == code
        mtype = F.when(branch, F.lit(name)) if mtype is None else mtype.when(branch, F.lit(name))
    mtype = mtype.otherwise(F.lit(OTHER_MEASURE))
    return li.select(
        F.col("l_partkey").cast("string").alias("station"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
        mtype.alias("mtype"),
        F.col("l_quantity").cast("string").alias("value"),
    )
