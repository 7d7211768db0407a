"""Operators: link extraction, graph tables, rank sweeps, top-k and station series."""
