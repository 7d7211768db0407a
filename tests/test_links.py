"""Page-line parsing and link extraction (FIXTURES.md section 1)."""

import pytest
from pyspark.sql import functions as F

from rankloom.functions.text import decode_link, link_capture
from rankloom.operators import graph as G
from rankloom.operators.links import extract_links, strict_links, url_decode
from rankloom.sources.text import read_page_lines, split_page_lines

LINES = [
    'A:<html><body><div id="bodyContent"><a href="./x/B.html">b</a><a href="../y/C.html">c</a></div>'
    '<a href="./x/Z.html">out</a></body></html>',
    "User~1:<html/>",
    "D:<html><br></html>",
    'F:<html><div id="BODYCONTENT"><p><a href="./a/G%20H.html"/><a href="http://x/I.html"/>'
    '<a href="./a/J~k.html"/><a/></p></div></html>',
    "K:<html></html>",
    "no colon here",
]


@pytest.fixture(scope="module")
def page_lines(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pages") / "pages.txt"
    path.write_text("\n".join(LINES) + "\n")
    return split_page_lines(read_page_lines(spark, str(path)))


def test_split_at_first_colon_and_drop_lines_without_one(page_lines):
    names = [r["name"] for r in page_lines.collect()]
    assert names == ["A", "User~1", "D", "F", "K"]
    html = {r["name"]: r["html"] for r in page_lines.collect()}
    assert html["User~1"] == "<html/>"


def test_strict_extraction(page_lines):
    adj = {r["name"]: list(r["links"]) for r in extract_links(page_lines, "strict").collect()}
    assert adj == {"A": ["B", "C"], "F": ["G H"], "K": []}


def test_strict_graph_and_page_count(page_lines):
    g = G.adjacency_to_graph(extract_links(page_lines, "strict"))
    assert G.n_pages(g) == 3
    assert sorted(tuple(r) for r in g.edges.collect()) == [("A", "B"), ("A", "C"), ("F", "GH")]
    assert sorted(r["node"] for r in G.dangling_pages(g).collect()) == ["K"]
    dn = {r["node"]: r["is_page"] for r in G.dangling_nodes(g).collect()}
    assert dn == {"K": True, "B": False, "C": False, "GH": False}


def test_lenient_extraction_reads_every_href(page_lines):
    adj = {r["name"]: list(r["links"]) for r in extract_links(page_lines, "lenient").collect()}
    assert adj == {"A": ["B", "C", "Z"], "D": [], "F": ["G H"], "K": []}


def test_duplicate_names_keep_one_list(spark):
    pages = spark.createDataFrame(
        [("A", '<div id="bodyContent"><a href="./x/B.html"/></div>'),
         ("A", '<div id="bodyContent"><a href="./x/C.html"/></div>')],
        "name string, html string",
    )
    first = extract_links(pages, "strict").collect()
    assert len(first) == 1 and list(first[0]["links"]) in (["B"], ["C"])
    assert extract_links(pages, "strict").collect() == first  # deterministic


@pytest.mark.parametrize(
    "link,name",
    [("../a/b/Foo.html", "Foo"), ("http://x/Foo.html", None), ("./a/Us~er.html", None), ("./a/.html", "a/")],
)
def test_link_pattern_jvm_and_python_agree(spark, link, name):
    got = spark.range(1).select(link_capture(F.lit(link)).alias("n")).first()["n"]
    assert got == name
    html = f'<div id="bodyContent"><a href="{link}"/></div>'
    assert strict_links(html) == ([name] if name else [])


@pytest.mark.parametrize("raw,decoded", [("a%20b+c", "a b c"), ("100%zz", "100%zz"), ("%C3%A9", "é")])
def test_decode(spark, raw, decoded):
    assert spark.range(1).select(decode_link(F.lit(raw)).alias("d")).first()["d"] == decoded
    assert url_decode(raw) == decoded


def test_strict_depth_counting():
    # a second body div after the first closes counts too; anchors after the div do not
    html = (
        '<r><div id="bodycontent"><p><a href="./x/A.html"/></p></div><a href="./x/N.html"/>'
        '<DIV id="bodyContent"><a href="./x/B.html"/></DIV></r>'
    )
    assert strict_links(html) == ["A", "B"]
    assert strict_links("<r><div id='bodyContent'>") is None  # not well-formed


def test_entities_with_and_without_external_dtd():
    body = '<html><body><div id="bodyContent">a&nbsp;b<a href="./x/Q.html"/></div></body></html>'
    doctype = (
        '<!DOCTYPE html PUBLIC "-//W3C//DTD XHTML 1.0 Strict//EN" '
        '"http://www.w3.org/TR/xhtml1/DTD/xhtml1-strict.dtd">'
    )
    assert strict_links(body) is None  # undefined entity, no DTD: not well-formed
    assert strict_links(doctype + body) == ["Q"]  # external DTD named (never loaded): skipped


def test_names_are_stripped_before_they_are_compared(spark):
    html = '<html><div id="bodyContent"><a href="./x/%s.html"/></div></html>'
    pages = spark.createDataFrame([("G H", html % "B"), ("GH", html % "C"), ("GH", html % "C"), (" ", html % "D")], "name string, html string")
    for mode in ("strict", "lenient"):
        got = extract_links(pages, mode).collect()
        assert [r["name"] for r in got] == ["GH"] and list(got[0]["links"]) in (["B"], ["C"])


def test_each_page_is_parsed_once(spark, tmp_path, monkeypatch):
    """The written lists, not the parser, feed the graph and all its readers."""
    from rankloom.operators import rank as R

    html = '<html><div id="bodyContent"><a href="./x/P1.html"/></div></html>'
    pages = spark.createDataFrame([(f"P{i}", html) for i in range(20)], "name string, html string")
    g = G.adjacency_to_graph(extract_links(pages, "strict"))
    for df in (g.pages, g.edges):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" not in plan and all("/tables/rankloom_adjacency_" in f for f in df.inputFiles())
    assert R.pagerank(g, "list").count() == 20


def test_repeated_and_nested_body_divs(spark):
    page = (
        '<html><a href="./x/O.html"/><div id="bodyContent"><div><a href="./x/A.html"/><div id="BodyContent"><a href="./x/B.html"/></div>'
        '<a href="./x/C.html"/></div></div><a href="./x/O.html"/><DIV id="bodycontent"><A href="./x/D.html"/></DIV></html>'
    )
    assert strict_links(page) == ["A", "B", "C", "D"]
