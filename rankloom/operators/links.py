"""Link extraction: page (name, html) -> adjacency (name, links ARRAY<STRING>).

Two modes:

* ``lenient`` - every ``href="..."`` in the page, decoded and filtered by the link
  pattern.  Pure JVM expressions (regex + higher-order functions), codegen'd.
* ``strict`` - the page must be well-formed XML; only anchors inside the
  ``<div id="bodyContent">`` element count.  Needs a real XML parser, so it runs as a
  ``mapInArrow`` over Arrow batches: Spark partitions the pages, each task parses its
  own rows, and malformed pages are dropped (they are not pages at all).
"""

from __future__ import annotations

import re
import urllib.parse
from collections.abc import Iterator
from functools import lru_cache
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.fixed import BODY_DIV_ID, HREF_PATTERN, LINK_PATTERN
from rankloom.functions.text import decode_link, link_capture, page_name_ok, strip_whitespace
from rankloom.session import Scratch, materialise, ship_package

MODES = ("strict", "lenient")

_BODY_ID = BODY_DIV_ID.lower()
_LINK_RE = re.compile(LINK_PATTERN)
_BAD_ESCAPE = re.compile(r"%(?![0-9A-Fa-f]{2})")


def url_decode(link: str) -> str:
    """UTF-8 percent-decoding with '+' as space; input with a broken escape comes back as is."""
    if "%" not in link and "+" not in link:
        return link
    if _BAD_ESCAPE.search(link):
        return link
    return urllib.parse.unquote_plus(link, encoding="utf-8", errors="replace")


def _link(href: str) -> str | None:
    found = _LINK_RE.search(url_decode(href))
    return found.group(1) if found else None


SHORT_HREF = 200  # code points; longer ones are not kept
_link_again = lru_cache(maxsize=1 << 16)(_link)  # most pages link to what other pages link to


def strict_links(html: str) -> list[str] | None:
    """Link names of the anchors that have a body div among their ancestors, or None when the page
    is not well-formed XML.  External entities are never loaded.

    ``inside`` counts the open elements from the outermost body div on (0 outside of one); nested
    and repeated body divs need no special case.
    """
    links: list[str] = []
    inside = 0

    def start(name, attrs):
        nonlocal inside
        if inside:
            inside += 1
            if (name == "a" or name == "A") and "href" in attrs:
                href = attrs["href"]
                link = _link_again(href) if len(href) <= SHORT_HREF else _link(href)
                if link is not None:
                    links.append(link)
        elif name.lower() == "div" and attrs.get("id", "").lower() == _BODY_ID:
            inside = 1

    def end(name):
        nonlocal inside
        if inside:
            inside -= 1

    parser = expat.ParserCreate()
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    # a document type may name an external one: it is passed over, and entities it may declare too
    parser.SetParamEntityParsing(expat.XML_PARAM_ENTITY_PARSING_UNLESS_STANDALONE)
    parser.ExternalEntityRefHandler = lambda context, base, system_id, public_id: 1
    try:
        parser.Parse(html, True)
    except expat.ExpatError:  # not well-formed: not a page
        return None
    return links


def _strict_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parsed = [strict_links(h) if h is not None else None for h in batch.column("html").to_pylist()]
        keep = pa.array([p is not None for p in parsed], pa.bool_())
        out = [batch.column(c).filter(keep) for c in ("name", "h")]
        lists = pa.array([p for p in parsed if p is not None], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*out, lists], names=["name", "h", "links"])


def lenient_links(html):
    """Array of link names from every href of the page (JVM-side expression)."""
    hrefs = F.regexp_extract_all(html, F.lit(HREF_PATTERN), 1)
    names = F.transform(hrefs, lambda h: link_capture(decode_link(h)))
    return F.filter(names, lambda n: n.isNotNull())


def extract_links(pages: DataFrame, mode: str = "strict", dedupe: bool = True, scratch: Scratch | None = None) -> DataFrame:
    """(name, html) -> (name, links).  Names with '~' and malformed pages (strict) are dropped.

    Whitespace is stripped from the names first (a name that becomes empty is no page).  With
    ``dedupe`` a name that occurs on several lines keeps one of its link lists, the one with
    the smallest html hash: the winning hash per name is a hash aggregate over two short
    columns, joined back to the written lists; only names that repeat go through one
    more exchange.  Lines with the same name and html are one page.  The lists belong to
    ``scratch`` where one is given.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    named = (
        pages.where(page_name_ok("name"))
        .select(strip_whitespace("name").alias("name"), "html", F.xxhash64("html").alias("h"))
        .where("name != ''")
    )
    if mode == "lenient":
        adj = named.select("name", "h", lenient_links(F.col("html")).alias("links"))
    else:
        ship_package(pages.sparkSession)
        adj = named.mapInArrow(_strict_batches, "name string, h long, links array<string>")
    if not dedupe:
        return adj.select("name", "links")
    adj = materialise(adj, "adjacency", scratch)  # each page is parsed once, whatever reads the lists
    best = adj.groupBy("name").agg(F.min("h").alias("best"), F.count(F.lit(1)).alias("lines"))
    joined = adj.join(best, "name").where(F.col("h") == F.col("best"))
    once = joined.where(F.col("lines") == 1).select("name", "links")
    again = joined.where(F.col("lines") > 1).dropDuplicates(["name"]).select("name", "links")
    return once.unionByName(again)


def page_hrefs(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, pos, href): every double-quoted href of each page, in page order."""
    return pages.select(
        id_col, F.posexplode(F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1)).alias("pos", "href")
    )
