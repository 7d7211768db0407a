"""End-to-end batch jobs, from input files to output files.

    python -m rankloom.jobs rank    <page-lines> <out-dir> [--preset list] [--mode strict] [--k 100]
    python -m rankloom.jobs series  <readings-csv> <out-dir>

``rank`` reads ``name:html`` lines, extracts links, ranks the graph with a preset and
writes the top-k report (``node TAB rank``, one file) plus the full rank vector
(``node TAB rank``, one file per task).  ``series`` reads ``station,yyyymmdd,type,value``
readings and writes one ``station,[(year,mean_tmin,mean_tmax)...]`` line per station.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rankloom.functions.fixed import TOP_K
from rankloom.operators import rank as R
from rankloom.operators import series as S
from rankloom.operators import topk as T
from rankloom.operators.graph import adjacency_to_graph
from rankloom.operators.links import extract_links
from rankloom.session import Scratch
from rankloom.sources import sinks
from rankloom.sources.text import read_page_lines, read_readings, split_page_lines


def rank_pages(
    spark: SparkSession,
    pages_path: str,
    out_dir: str,
    preset: str = "list",
    mode: str = "strict",
    k: int = TOP_K,
    write_ranks: bool = True,
) -> None:
    pages = split_page_lines(read_page_lines(spark, pages_path))
    with Scratch(spark) as scratch:  # the job leaves its outputs and nothing else
        graph = adjacency_to_graph(extract_links(pages, mode, scratch=scratch))
        with R.prepare(graph, R.PRESETS[preset]) as model:
            ranks = R.ranks(model, R.iterate(model))
            if write_ranks:
                sinks.write_key_value(ranks, "node", "rank", f"{out_dir}/ranks")
            top = T.top_k(ranks, k)
            sinks.write_key_value(top.orderBy(top["rank"].desc(), "node").coalesce(1), "node", "rank", f"{out_dir}/top{k}")


def station_series(spark: SparkSession, readings_path: str, out_dir: str) -> None:
    lines = S.render_series(S.station_series(read_readings(spark, readings_path)))
    sinks.write_lines(lines, "value", out_dir)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rankloom.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    rank = sub.add_parser("rank", help="rank the pages of name:html lines")
    rank.add_argument("pages")
    rank.add_argument("out")
    rank.add_argument("--preset", default="list", choices=sorted(R.PRESETS))
    rank.add_argument("--mode", default="strict", choices=["strict", "lenient"])
    rank.add_argument("--k", type=int, default=TOP_K)
    series = sub.add_parser("series", help="yearly TMIN/TMAX means per station")
    series.add_argument("readings")
    series.add_argument("out")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"rankloom-{args.job}").getOrCreate()
    if args.job == "rank":
        rank_pages(spark, args.pages, args.out, args.preset, args.mode, args.k)
    else:
        station_series(spark, args.readings, args.out)


if __name__ == "__main__":
    main()
