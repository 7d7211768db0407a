"""Column-level helpers built from ``pyspark.sql.functions`` (JVM-side, codegen-friendly)."""

from rankloom.functions.text import (
    decode_link,
    java_double_text,
    lenient_double,
    link_capture,
    page_name_ok,
    strip_whitespace,
    year_prefix,
)

__all__ = [
    "decode_link",
    "java_double_text",
    "lenient_double",
    "link_capture",
    "page_name_ok",
    "strip_whitespace",
    "year_prefix",
]
