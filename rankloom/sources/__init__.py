"""Scans, adapters over the given parquet tables, and text sinks."""

from rankloom.sources.tables import lineitem_readings, part_follow_graph, read_table
from rankloom.sources.text import read_page_lines, read_readings, split_page_lines

__all__ = [
    "lineitem_readings",
    "part_follow_graph",
    "read_page_lines",
    "read_readings",
    "read_table",
    "split_page_lines",
]
