"""rankloom: link-graph ranking and keyed time-series summaries as Spark jobs.

Everything here is DataFrame in / DataFrame out; Catalyst plans it and Spark runs it.
Sub-packages:

* ``sources``   - text-line and CSV scans, page-line splitting, the driver-table adapters, sinks
* ``functions`` - Column-level helpers (regexes, decoding, lenient number parsing, text rendering)
* ``operators`` - link extraction, graph tables, the rank sweep engine, top-k, per-station series
* ``plans``     - the named queries registered in ``__spark_entry__`` and their DuckDB oracles
"""

from rankloom.session import checkpoint_dir, shuffle_partitions

__all__ = ["checkpoint_dir", "shuffle_partitions"]
