"""Scalar Column helpers.  All built-in expressions: no Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankloom.functions.fixed import LINK_PATTERN, PAGE_NAME_PATTERN


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def page_name_ok(name: Column | str) -> Column:
    """True for a non-empty name without '~'."""
    return _c(name).rlike(PAGE_NAME_PATTERN)


def decode_link(href: Column | str) -> Column:
    """UTF-8 percent-decoding with '+' as space; undecodable input is kept as is."""
    h = _c(href)
    return F.coalesce(F.try_url_decode(h), h)


def link_capture(link: Column | str) -> Column:
    """Name captured from a relative ``.../<name>.html`` link, or NULL when it does not match."""
    name = F.regexp_extract(_c(link), LINK_PATTERN, 1)
    return F.when(name != "", name)


WHITESPACE = " \t\n\x0b\f\r"  # what the regular expression \s stands for


def strip_whitespace(c: Column | str) -> Column:
    """Remove every whitespace character (names are compared without blanks).  Names without any,
    nearly all, are not given to the regular expression."""
    text = _c(c)
    blank = reduce(lambda a, b: a | b, [text.contains(w) for w in WHITESPACE])
    return F.when(blank, F.regexp_replace(text, r"\s", "")).otherwise(text)


def lenient_double(c: Column | str) -> Column:
    """Parse text as a double; unparsable or missing text gives NULL instead of failing."""
    return _c(c).try_cast("double")


def year_prefix(date: Column | str) -> Column:
    """Year from a ``yyyymmdd`` string (its first four characters); NULL if not a number."""
    return F.substring(_c(date), 1, 4).try_cast("int")


def java_double_text(c: Column | str) -> Column:
    """Double rendered the way the JVM prints it (``-9999.0``, ``1.0E-4``, ``NaN``)."""
    return _c(c).cast("string")
