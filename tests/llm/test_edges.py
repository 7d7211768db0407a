"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from rankloom.llm import (
    interpolation_lm,
    packing,
    quality_qda,
    quality_rules,
    simhash_cover,
    spaced_seeds,
    suffix_dedup,
    toxicity_nnpu,
    url_filter,
    wordpiece_counts,
)

SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards box quietly under a pale moon tonight "
LONG = SENTENCE * 3000
# names that the operators use themselves
CLASH = ("row", "key", "id", "gram", "spans", "fp", "node", "root", "_key", "kept", "host", "text_key", "_v_lines", "item_id", "length")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "Alpha beta gamma delta. " * 12, "a"),
        (2, None, "a"),
        (3, "", None),
        (4, LONG, "b"),
        (5, "one two", "b"),
        (5, "one two", "b"),  # repeated row
        (6, "é̀ \U0001f600 中文 text \x00 \x0b tab\tand\r\nline\n\n", "b"),
        (None, SENTENCE * 5, None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in CLASH:
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 7)] + [(None, 1, 1), (99, 1, 0), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_rules(docs, none):
    got = quality_rules.line_verdicts(docs).collect()
    assert len(got) == 9
    by = {r.doc_id: r for r in got if r.doc_id}
    assert by[2].n_words == 0 and by[2].base_failed and not by[2].kept
    assert by[3].n_words == 0 and by[4].n_repeat_words == by[4].n_words and not by[4].kept
    kept = quality_rules.apply_rules(docs)
    assert kept.columns == docs.columns
    assert quality_rules.line_verdicts(none).count() == 0 and quality_rules.apply_rules(none).count() == 0


def test_simhash(docs, none):
    got = simhash_cover.near_groups(docs).collect()
    assert len(got) == 9
    zero = [r for r in got if r.doc_id in (2, 3)]
    assert {r.fp for r in zero} == {0} and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in got if r.doc_id == 5} == {5}
    one = simhash_cover.keep_one(docs)
    assert one.columns == docs.columns
    ids = [r.doc_id for r in one.collect()]
    assert sorted(i for i in ids if i) == sorted({min(r.component_id, r.doc_id) for r in got if r.doc_id and r.component_id == r.doc_id})
    assert ids.count(5) == 1
    assert simhash_cover.near_groups(none).count() == 0 and simhash_cover.keep_one(none).count() == 0


def test_suffix_dedup(docs, none):
    got = suffix_dedup.span_digest(docs).collect()
    assert len(got) == 9
    by = {r.doc_id: r for r in got if r.doc_id}
    assert (by[2].n_bytes, by[2].n_removed, by[2].n_spans) == (0, 0, 0)
    assert by[4].n_removed == by[4].n_bytes  # periodic: every string starts elsewhere
    kept = suffix_dedup.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == 9
    texts = {r.doc_id: r.text for r in kept.filter("doc_id = 4 or text is not null").collect()}
    assert texts[4] == SENTENCE and texts[None] == ""  # one period of the first document stays
    assert suffix_dedup.span_digest(none).count() == 0 and suffix_dedup.remove_repeats(none).count() == 0


def test_spaced_seeds(spark, docs, none):
    bench = spark.createDataFrame([(1, SENTENCE), (2, None), (3, ""), (None, "short item"), (4, SENTENCE)], "item_id long, text string")
    got = spaced_seeds.contaminated_pairs(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(4, 1), (4, 4), (None, 1), (None, 4)}
    clean = spaced_seeds.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 7
    assert spaced_seeds.contaminated_pairs(none, bench).count() == 0
    assert spaced_seeds.contaminated_pairs(docs, bench.filter("false")).count() == 0
    assert spaced_seeds.drop_contaminated(docs, bench.filter("false")).count() == 9


def test_packing(docs, none):
    rows = packing.pack_documents(docs).collect()
    assert sum(r.doc_id == 5 for r in rows) == 2
    assert all(r.length == 1 for r in rows if r.doc_id in (2, 3))
    assert sum(r.length for r in rows if r.doc_id == 4) > 2048 and all(r.length <= 2048 for r in rows)
    assert packing.pack_documents(none).count() == 0


def test_token_counts(docs, none):
    path = packing.vocabulary("word_bpe_49k.json")
    got = {r.doc_id: r for r in wordpiece_counts.count_pieces(docs, path).collect() if r.doc_id}
    assert (got[2].n_words, got[2].n_pieces, got[3].n_pieces) == (0, 0, 0)
    assert got[5].n_words == 2 and got[4].n_unknown == 0
    assert wordpiece_counts.count_pieces(none, path).count() == 0


def test_language_model(docs, none):
    got = interpolation_lm.score_texts(docs).collect()
    assert len(got) == 9 and all(r.n_tokens >= 1 and r.score <= 0 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {True}
    assert interpolation_lm.score_texts(none).count() == 0


def test_classifiers(docs, none, labels):
    for run, label in ((quality_qda.classify, "quality"), (toxicity_nnpu.classify, "toxic")):
        got = run(docs, labels, label).collect()
        assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
        assert run(none, labels, label).count() == 0
        assert run(docs, labels.filter("false"), label).count() == 9


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://Sub.Example.ORG/es/x?y#z"), (5, "http://a.com/de/"),
            (5, "http://a.com/de/"), (6, "http://org"), (7, "http://casino-pills.net/a"), (8, "x" * 50_000), (None, "http://b.fr/?://c.com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("f", F.lit(2))
    got = url_filter.judge(pages, url_filter.labelled_table(pages)).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 10 and (by[1].host, by[1].path, by[1].rule) == ("", "", None) and by[2].host == by[3].host == ""
    assert (by[4].host, by[4].path, by[4].rule, by[4].verdict) == ("sub.example.org", "/es/x", "example.org/es/", "block")
    assert (by[5].rule, by[5].verdict, by[6].rule, by[7].verdict) == ("com/de/", "block", None, "block")
    assert (by[None].host, by[None].path) == ("b.fr", "/")
    assert url_filter.judge(pages.filter("false"), url_filter.labelled_table(pages)).count() == 0
