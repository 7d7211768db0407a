"""Pages of the larger tables: page lines gather keys only, pages are parsed as Arrow batches."""

from rankloom.operators import graph as G
from rankloom.operators import links as L
from rankloom.sources.tables import page_lines
from tests.test_link_building import _plan, follow_tables


def test_page_lines_gather_keys_only(spark, tmp_path):
    follow_tables(spark, tmp_path, [(2, 1, 1, 9), (1, 7, 1, 4), (1, 6, 1, 3), (1, 6, 1, 3), (3, None, 1, 2), (3, 2, 1, None), (None, 1, 1, 8), (1, 1, None, 1)])
    df = page_lines(spark, str(tmp_path))
    got = {r["value"].split(":")[0]: r["value"] for r in df.collect()}
    a = '<p><a href="{}">x</a></p>'.format
    body = "".join(map(a, ["../s/P8.html", "./s/P%203.html", "./s/P%203.html", "http://x/P4.html", "../s/P9.html", "../s/P2.html"]))
    assert got["P1"] == f'P1:<html><body><a href="./s/Out.html">o</a><div id="bodyContent">{body}</div></body></html>'
    assert len(got) == 100
    gathered = _plan(df).split("partial_collect_list(")[1].split("]")[0]
    assert "href" not in gathered and "http" not in gathered


def test_pages_are_parsed_as_arrow_batches(spark):
    pages = spark.createDataFrame([("A", "<r/>"), ("B", None), ("C", "<r>"), ("D", "")], "name string, html string")
    got = L.extract_links(pages, "strict", dedupe=False)
    assert "MapInArrow" in _plan(got) and [tuple(r) for r in got.collect()] == [("A", [])]


def test_hrefs_seen_again_and_long_ones():
    long = "./x/" + "L" * 500 + ".html"
    page = '<r><div id="bodyContent"><a href="./x/A%20B.html"/><a href="./x/A%20B.html"/><a href="{}"/><a href="./x/C+D.html"/></div></r>'
    for _ in range(2):
        assert L.strict_links(page.format(long)) == ["A B", "A B", "L" * 500, "C D"]


def test_graph_of_parsed_pages(spark):
    html = '<r><div id="bodyContent"><a href="./x/G%20H.html"/></div></r>'
    g = G.adjacency_to_graph(L.extract_links(spark.createDataFrame([("A", html)], "name string, html string")))
    assert [tuple(r) for r in g.edges.collect()] == [("A", "GH")]
