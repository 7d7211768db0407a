"""Operators against plain brute-force versions on the smallest tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm import interpolation_lm, packing, queries, quality_rules, simhash_cover, spaced_seeds, suffix_dedup, wordpiece_counts
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, SF_SMALL).collect()


def test_op2_counts_and_verdicts(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op2_quality_rules")}
    for i, t in docs:
        ws, r = WORD.findall(t), got[i]
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
        n, cover = collections.Counter(windows), set()
        for k, w in enumerate(windows):
            if n[w] > 1:
                cover.update(range(k, k + 8))
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(ws), sum(map(len, ws)), dup, len(cover))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t))
        assert r.base_failed == (len(ws) < 20 or 100 * len(cover) > 30 * len(ws))


def test_op2_frequent_lines(spark):
    menu = "home about contact login register help imprint"
    body = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(40)]
    rows = [(i, f"{body[i]}\n{menu.upper()}  ", "a") for i in range(30)]
    rows += [(100 + i, "\n".join([menu] * 1) + "\n" + " ".join(body[i].split()[:3]), "a") for i in range(5)]  # little besides the menu
    rows += [(200, f"{menu}\n{body[0]}", "b")]  # the line is rare on this host
    rows += [(300 + i, body[39] + "\n" + body[38], "c") for i in range(50)]  # exact copies only
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.line_verdicts(df).collect()}
    assert all(got[i].kept and got[i].n_line_words == 7 for i in range(30))
    assert not any(got[100 + i].kept for i in range(5))
    assert got[200].n_line_words == 0 and got[200].kept and all(got[300 + i].kept for i in range(50))
    kept = {r.doc_id: r.text for r in quality_rules.apply_rules(df).collect()}
    assert set(kept) == {*range(30), 200, *range(300, 350)} and kept[3] == body[3] + "\n" and kept[200] == f"{menu}\n{body[0]}"


def test_op2_low_limits(spark):
    """One line in a tenth of the documents of small, middling and big hosts."""
    menu, body = "home about contact login register help", "concat_ws(' ', transform(sequence(1, 40), j -> concat('w', id, 'x', j)))"
    rate = lambda host, n: spark.range(n).selectExpr(
        "id AS doc_id", f"concat({body}, if(id % 10 = 0, '\n{menu}', if(id % 10 = 1, '\nread more', ''))) AS text", f"'{host}' AS source"
    )
    big = rate("small", 30).union(rate("middle", 500)).union(rate("big", 100_000))
    only = spark.range(5).selectExpr("id + 200000 AS doc_id", f"concat('{menu}\\n', {body.replace('40', '14')}) AS text", "'big' AS source")
    # each of a group of near copies has the same three lines and one of its own
    near = "\n".join(" ".join(f"n{i}y{j}" for j in range(20)) for i in range(3))
    copies = spark.range(300).selectExpr("id + 300000 AS doc_id", f"concat('{near}\nown line ', id) AS text", "'big' AS source")
    docs = big.union(only).union(copies)
    rows = quality_rules.line_verdicts(docs, low_docs=100).groupBy("host", "n_line_words", "kept").count().collect()
    got = {(r.host, r.n_line_words, r.kept): r["count"] for r in rows}
    assert got == {
        ("small", 6, True): 3, ("small", 0, True): 27,
        ("middle", 6, True): 50, ("middle", 0, True): 450,
        ("big", 6, True): 10_000, ("big", 0, True): 90_300, ("big", 6, False): 5,
    }
    assert not quality_rules.line_verdicts(docs).filter("n_line_words > 0").count()


def test_pipeline_marks_lines_of_big_hosts(spark):
    menu, body = "home about contact login register help", "concat_ws(' ', transform(sequence(1, 40), j -> concat('w', id, 'x', j)))"
    docs = spark.range(2000).selectExpr("id AS doc_id", f"concat({body}, if(id % 20 = 0, '\n{menu}', '')) AS text", "'a' AS source")
    out = corpus_pipeline.drop_poor(spark, docs, SF_SMALL)
    assert out.count() == 2000 and not out.filter(F.col("text").contains(menu)).count()


def brute_spans(texts, length):
    raw = [t.encode() for t in texts]
    n = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    seen, out = set(), []
    for b in raw:
        both = {"none": [], "first": []}
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if n[s] > 1:
                both["none"].append((i, i + length))
            if s in seen:
                both["first"].append((i, i + length))
            seen.add(s)
        out.append({k: suffix_dedup.merged(v) for k, v in both.items()})
    return out


def test_op7_digest(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op7_suffix_dedup")}
    for (i, t), spans in zip(docs, brute_spans([t for _, t in docs], 200)):
        b, at, keep = t.encode(), 0, []
        for s, e in spans["none"]:
            keep.append(b[at:s])
            at = e
        keep.append(b[at:])
        want = (len(b), sum(e - s for s, e in spans["none"]), len(spans["none"]), hashlib.sha256(b"".join(keep)).hexdigest())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("part", [4000, 3])
def test_op7_shared_passages(spark, keep, part):
    rng = np.random.default_rng(7)
    word = lambda n: "".join(rng.choice(list("abcd ef"), n))
    passage = word(300)
    texts = [word(150) + passage[rng.integers(0, 60) : 300 - rng.integers(0, 60)] + word(150) for _ in range(40)]
    texts += ["x" * 450, "ab" * 300, texts[0], passage, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: suffix_dedup.merged([(s.lo, s.hi) for s in r.spans]) for r in suffix_dedup.repeated_spans(df, 200, keep, part=part).collect()}
    order = [(i, s[keep]) for i, s in enumerate(brute_spans(texts, 200))]
    assert {i: s for i, s in order if s} == got


@pytest.mark.parametrize("keep", ["first", "none"])
def test_op7_repeated_rows(spark, keep, monkeypatch):
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("abcd ef"), n))
    text, passage = word(900), word(350)
    rows = [(1, text)] * 300 + [(None, passage + text[:400])] * 200 + [(2, word(300) + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cut, seen = suffix_dedup._cut, []
    monkeypatch.setattr(suffix_dedup, "_cut", lambda rows, length: seen.append(rows.count()) or cut(rows, length))
    got = suffix_dedup.repeated_spans(df, 200, keep).collect()
    assert seen[0] <= 3  # one text of each
    brute = brute_spans([text] * (keep == "none") + [text, *[passage + text[:400]] * (1 + (keep == "none")), rows[-1][1]], 200)
    by = {r.id: r.spans for r in got}
    for i, spans in ((1, brute[0]), (suffix_dedup.NO_ID, brute[-2 - (keep == "none")]), (2, brute[-1])):
        if keep == "none" or i == 1:
            assert suffix_dedup.merged([(s.lo, s.hi) for s in by.get(i, [])]) == spans[keep]
    assert all(len(s) == len(set(s)) for s in by.values())


@pytest.mark.parametrize("depth", [1, 7, 8, 20])
def test_op7_longest_previous_factors(depth):
    rng = np.random.default_rng(depth)
    for n in (0, 1, 40, 300):
        data = np.r_[rng.integers(0, 2, n), rng.integers(0, 3, depth)].astype(np.uint8)
        raw, at = bytes(data), np.arange(n + 1 if n else 0)
        order = rng.permutation(len(at))
        share = lambda a, b: next((k for k in range(depth) if raw[a + k] != raw[b + k]), depth)
        lpf, other = suffix_dedup.previous_factors(data, at, order, depth)
        for i in at:
            assert lpf[i] == max((share(i, j) for j in at if order[j] < order[i]), default=0)
            assert other[i] == any(share(i, j) == depth for j in at if j != i)
    x = rng.permutation(50)
    assert [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(50)] == list(suffix_dedup.previous_smaller(x))


def test_op8_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by, seqs, total = collections.defaultdict(list), collections.defaultdict(list), 0
    for r in run(spark, "op8_best_fit_packing"):
        by[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        seqs[r.sequence_id].append((r.offset, r.length))
    for i, t in docs:
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        total += len(ids)
        want = [(k, s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
        assert sorted(by[i]) == want
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) <= -(-total // 2048) + 1


def sweeps(counts, capacity):
    """(length, rank) -> (sequence, offset), one sweep at a time: pieces of a length go to the
    sequences of one interval with the smallest gap that holds them, one to each, or fill new
    sequences one by one."""
    out, held, opened = {}, collections.defaultdict(list), 0  # gap -> lists of sequences
    for length in sorted(counts, reverse=True):
        ranks = list(range(counts[length]))
        while ranks and (size := min((g for g in held if g >= length and held[g]), default=0)):
            seqs = held[size].pop()
            now, later = seqs[: len(ranks)], seqs[len(ranks) :]
            out |= {(length, k): (x, capacity - size) for k, x in zip(ranks, now)}
            ranks = ranks[len(now) :]
            held[size] += [later] if later else []
            held[size - length].append(now)
        fit = capacity // length
        full, rest = divmod(len(ranks), fit)
        for k, rank in enumerate(ranks):
            new, slot = (k % full, k // full) if k < full * fit else (full, k - full * fit)
            out[length, rank] = opened + new, slot * length
        if full:
            held[capacity - fit * length].append(list(range(opened, opened + full)))
        if rest:
            held[capacity - rest * length].append([opened + full])
        opened += full + (rest > 0)
    return out


def test_op8_plan():
    rng = np.random.default_rng(11)
    some = [({33 - i: 3 for i in range(1, 33)}, 32), ({32: 2, 5: 1}, 32), ({}, 32), ({7: 1000}, 32)]
    for _ in range(60):
        capacity = int(rng.integers(1, 60))
        lengths = rng.choice(capacity, rng.integers(1, capacity + 1), replace=False) + 1
        some.append(({int(x): int(rng.integers(0, rng.choice([2, 30]))) for x in lengths}, capacity))
    for counts, capacity in some:
        plan, got = packing.best_fit_plan(counts, capacity), {}
        for length, lo, hi, first, count, offset in plan:
            got |= {(length, lo + k): (first + k % count, offset + k // count * length) for k in range(hi - lo)}
        assert got == sweeps(counts, capacity) and sum(r[2] - r[1] for r in plan) == len(got)
        assert len(plan) <= packing.most_rows(len(counts), capacity)
    # every gap from 1 to 255, and pieces of length 1 for all of them
    counts = {x: 1 for x in range(257, 512)} | {1: 255 * 256 // 2}
    assert len(packing.best_fit_plan(counts, 512)) <= packing.most_rows(256, 512) == 256 * 63
    assert packing.most_rows(2048, 2048) == 260_096


def test_op9_components(spark, docs):
    rows = run(spark, "op9_simhash_near_dedup")
    fps = np.array([int(r.fingerprint, 16) for r in rows], np.uint64)
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r.doc_id), r.doc_id)
    assert all(least[root(i)] == r.component_id for i, r in enumerate(rows))


def test_op9_covering_masks_and_blocks(spark):
    masks = simhash_cover.covering_masks(4)
    rng = np.random.default_rng(3)
    for _ in range(300):  # any 4 bits are left out by some mask
        flip = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(flip & m == 0 for m in masks)
    base = int(rng.integers(0, 2**63))
    near = {base ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(20, 40)}  # 400 in one ball
    far = {int(x) for x in rng.integers(0, 2**63, 200)}
    df = spark.createDataFrame([(x,) for x in near | far], "fp long")
    for block in (2048, 16):
        links = simhash_cover.near_links(df, 4, block).collect()
        assert all(((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 12 for r in links)
        group, queue = set(), [next(iter(near))]
        edges = collections.defaultdict(set)
        for r in links:
            edges[r.u].add(r.v)
            edges[r.v].add(r.u)
        while queue:
            x = queue.pop()
            if x not in group:
                group.add(x)
                queue += edges[x]
        assert group == near


def test_op9_big_buckets_grow_in_proportion(spark):
    """Fingerprints that agree in all bits of one mask: as many rows each, however many they are."""
    rng = np.random.default_rng(8)
    dropped = [i for i in range(64) if not simhash_cover.covering_masks(4)[0] >> i & 1]
    parts = simhash_cover.dropped_parts(simhash_cover.covering_masks(4)[0], 4)
    assert sum(parts) == sum(1 << i for i in dropped) and len(parts) == 5
    rows, most = {}, {}
    for n in (4000, 16_000):
        bits = rng.integers(0, 2, (n, len(dropped)))
        fp = (bits << np.array(dropped, np.uint64).astype(np.int64)).sum(axis=1)
        df = spark.createDataFrame([(int(x),) for x in np.unique(fp)], "fp long")
        g = simhash_cover.candidate_groups(df, 4, 256).groupBy("g").count()
        rows[n], most[n] = g.agg(F.sum("count"), F.max("count")).first()
    assert rows[16_000] < 8 * rows[4000] and max(most.values()) <= 600  # 16 times with pairs of blocks alone


def test_op3_exact_and_substituted(spark, docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    tok = lambda t: lower(" ".join(re.findall(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", t))).split(" ")
    grams = collections.defaultdict(set)
    for i, t in bench:
        w = tok(t)
        for k in range(len(w) - 12):
            grams[tuple(w[k : k + 13])].add(i)
    exact = {(d, i) for d, t in docs for w in [tok(t)] for k in range(len(w) - 12) for i in grams.get(tuple(w[k : k + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in run(spark, "op3_benchmark_decontamination")}
    assert exact <= got
    rng = np.random.default_rng(5)
    made, clean = [], []
    for k, (i, t) in enumerate(bench):
        w = t.split()
        for at in range(3, len(w), 8):  # every eighth word replaced
            w[at] = f"replaced{at}"
        made.append((1000 + k, "before it all " + " ".join(w) + " and after"))
        clean.append((2000 + k, " ".join(rng.permutation(t.split()))))
    df = spark.createDataFrame(made + clean, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    pairs = {(r.doc_id, r.item_id) for r in spaced_seeds.contaminated_pairs(df, items).collect()}
    assert {(1000 + k, i) for k, (i, _) in enumerate(bench)} <= pairs
    assert not any(d >= 2000 for d, _ in pairs)


def test_op3_short_items(spark):
    """Every copy of a short item with as many tokens replaced as the share allows."""
    items = [(n, " ".join(f"t{n}x{j}" for j in range(n))) for n in range(1, 14)]
    texts, want = [], set()
    for n, t in items:
        r = n - math.ceil(0.8 * n)
        for k in range(r + 2):  # the last ones have one replaced token too many
            for out in itertools.combinations(range(n), k):
                w = ["other" if j in out else x for j, x in enumerate(t.split())]
                at = len(texts)
                texts.append((at, " ".join(["before", *w, "after"] if at % 2 else w)))
                if k == 0 or n >= 8 and k <= r:
                    want.add((at, n))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(90, ""), (91, None)], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in spaced_seeds.contaminated_pairs(df, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_op5_greedy(spark, docs):
    import public_tokenizers

    pieces = set(wordpiece_counts.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    memo = {}

    def greedy(word):
        s, n, i = (*word, wordpiece_counts.END), 0, 0
        while i < len(s):
            i = next((j for j in range(len(s), i, -1) if s[i:j] in pieces), 0)
            if not i:
                return 0
            n += 1
        return n

    got = {r.doc_id: r for r in run(spark, "op5_token_counts")}
    for i, t in docs:
        ws = wordpiece_counts.WORD.findall(t.encode().lower())
        for w in ws:
            if w not in memo:
                memo[w] = greedy(w)
        assert (got[i].n_words, got[i].n_pieces) == (len(ws), sum(memo[w] or 1 for w in ws))


def test_op5_automaton_small():
    a = wordpiece_counts.Automaton([tuple(p) for p in (b"a", b"abcd", b"b", b"bc", b"z")] + [(*p, 256) for p in (b"a", b"b", b"bc", b"abcdx")])
    assert [a.count(w) for w in (b"a", b"abcdz", b"abcdx", b"abc", b"abca", b"q", b"abcdq")] == [1, 0, 1, 2, 3, 0, 0]


def test_op6_base_and_probabilities(spark, docs):
    rows = {r.doc_id: r for r in run(spark, "op6_lm_scoring")}
    part = lambda i: zlib.crc32(str(i).encode()) % 10
    text = {i: WORD.findall(lower(t)) + [None] for i, t in docs}
    c = collections.Counter(w for i, ws in text.items() if part(i) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in text.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (part(i) == 0, len(ws), sum(w in c for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op6_repeated_rows(spark):
    rng = np.random.default_rng(4)
    text = lambda: " ".join(rng.choice(list("abcdefgh"), 30))
    rows = [(i, text()) for i in range(60)] + [(7, text()) for _ in range(40)] + [(100, "a b c a b")] * 400 + [(None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert interpolation_lm.token_counts(df).filter("doc_id = 100").count() <= 3  # one row of each batch
    part = lambda i: zlib.crc32(str(i).encode()) % 10 if i is not None else 0
    c = collections.Counter(w for i, t in rows if part(i) for w in [*(t or "").split(), None])
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t in rows:
        ws = [*(t or "").split(), None]
        want[i, part(i) == 0, len(ws), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)] += 1
    got = interpolation_lm.score_texts(df).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    # as many copies with ids of the same part, which are not reduced, score the same
    alike = [j for j in range(1000, 9000) if part(j) == part(100)][:400]
    apart = [(alike.pop() if i == 100 else i, t) for i, t in rows]
    other = interpolation_lm.score_texts(spark.createDataFrame(apart, "doc_id long, text string")).collect()
    assert np.allclose(sorted(r.score for r in other), sorted(r.score for r in got))


def test_op10_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in run(spark, "op10_url_filter"):
        m = re.match(r"([^/?#]*)([^?#]*)", pages[r.page_id].split("://", 1)[1], re.S)
        host, path = lower(m[1]), m[2]
        fit = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fit, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best[0] + best[1])
        assert r.verdict == best[2] if best else r.verdict in ("allow", "block")


def test_op2_agrees_with_its_oracle(spark):
    import duckdb

    from rankloom.llm.oracle import ORACLE_SQL

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    rel = con.sql(ORACLE_SQL["op2_quality_rules"])
    df = queries.QUERIES["op2_quality_rules"](spark, SF_SMALL)
    assert df.columns == rel.columns
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_line_removal_by_hand_and_its_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from rankloom.llm import _bytes as B
    from rankloom.llm import quality_rules as Q

    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "é", "delta"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) for _ in range(30)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, ""]

    def norm(line):
        return " ".join("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in line.split())

    bad = {norm(x) for x in lines[::3] if norm(x)}
    keys = [int(B.signed(Q.line_keys(*B.column_bytes(pa.array([x])))[2])[0]) for x in sorted(bad)]
    has = [i % 4 != 0 and t is not None for i, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(texts), pa.array([keys if h else None for h in has], pa.list_(pa.int64()))], names=["i", "text", "k"]
    )
    got = pa.Table.from_batches(Q.edited_batches([batch], 1)).column("text").to_pylist()
    for t, h, g in zip(texts, has, got):
        assert g == ("".join(x + "\n" for x in t.split("\n") if norm(x) not in bad)[: None if norm(t.split("\n")[-1]) in bad else -1] if h else t)

    # one Arrow batch of 64 MB, every row with the line: the peak stays a small multiple of a piece
    text = lines[0] + "\n" + "some longer line of text that goes on and on\n" * 140
    big = pa.RecordBatch.from_arrays(
        [pa.array([text] * 10_000), pa.array([keys[:1]] * 10_000, pa.list_(pa.int64()))], names=["text", "k"]
    )
    assert big.nbytes > 60 << 20
    B.powers(1)
    tracemalloc.start()
    for out in Q.edited_batches([big], 0):
        assert isinstance(out, pa.RecordBatch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20, peak
    assert np.int64(B.KEPT) * 16 <= 64 << 20


def test_op8_word_ids_are_those_of_the_whole_text():
    """Word by word, with marks cut off, the ids are those of the text as a whole."""
    from rankloom.llm import packing

    rng = random.Random(12)
    bits = [*"abzABZ019.,!?;:*#$%&'\"-_<|>/()", "İ", "ı", "Σ", "ς", "ß", "É", "é", "×", "÷", "ÿ", "Ñ", "ñ", "中", "̇", "́", "ͅ", " ", "\u0085", " ",
            "‍", "\x1c", "\x1f", "\x00", "\U0001f600", "Ⅷ", "²", "½", "ﬁ", "Å", "K", "'s", "'LL", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "the", "İ.", "İ!"]
    gaps = ["", "", "", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c"]
    texts = ["".join(rng.choice(bits) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZéèàüößñçøÿÉÀÑ"
    texts += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) + rng.choice(["", ".", "s,"]) for _ in range(30)) for _ in range(500)]
    ids = packing.WordIds(packing.vocabulary("word_bpe_49k.json"))
    tok = packing._tokenizer(packing.vocabulary("word_bpe_49k.json"))
    got = ids.texts([t.encode() for t in texts])
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t
    packing.CACHE_WORDS, kept = 50, packing.CACHE_WORDS
    try:  # emptied caches give the same
        again = [ids.texts([t.encode()])[0] for t in texts[:300]]
    finally:
        packing.CACHE_WORDS = kept
    assert again == got[:300]


def test_op3_a_document_of_many_items_ships_in_proportion(spark):
    rng = random.Random(21)
    items = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([5, 11, 40, 300])))) for i in range(400)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    shipped = {}
    for n in (100, 200, 400):
        docs = spark.createDataFrame([(1, " ".join(t for _, t in items[:n])), (None, "some other words here " * 9)], "doc_id long, text string")
        hits = spaced_seeds.aligned(docs, bench)
        shipped[n] = hits.agg(F.sum(F.size("tokens") + F.size("item"))).first()[0]
        pairs = spaced_seeds.contaminated_pairs(docs, bench).collect()
        assert {(r.doc_id, r.item_id) for r in pairs} == {(1, i) for i in range(n)}
        assert all(r.matched == r.length == min(13, len(items[r.item_id][1].split())) for r in pairs)
        assert spaced_seeds.drop_contaminated(docs, bench).count() == 1
    words = sum(len(t.split()) for _, t in items)
    assert shipped[400] < 2.5 * shipped[200] < 6 * shipped[100] and shipped[400] < 60 * words


def lm_by_hand(rows, grid=4):
    """Deleted interpolation in plain Python -> score of each text."""
    part = lambda i: zlib.crc32(str(i).encode()) % 10 if i is not None else 0
    tokens = [(part(i), [*WORD.findall(lower(t or "")), None]) for i, t in rows]
    pairs = lambda ws: list(zip([None, *ws[:-1]], ws))
    one, two = ([collections.Counter() for _ in range(2)] for _ in range(2))  # all training tokens; without the held-out tenth
    for p, ws in tokens:
        for k in range(2):
            if p > k:
                one[k].update(ws)
                two[k].update(pairs(ws))
    n, rest, v = sum(one[0].values()), sum(one[1].values()), len(one[0])
    octave = lambda c: c.bit_length()
    cell = lambda x: math.floor(-math.log2(x) * grid) if x > 0 else None

    def steps(ws, k):
        """(context, word, bucket) of each token by the counts of ``k``."""
        lead = 0
        for a, b in pairs(ws):
            yield a, b, (min(3, octave(lead)), octave(one[k][a]))
            lead = two[k][a, b]

    held = collections.Counter()
    for p, ws in tokens:
        if p == 1:
            for a, b, at in steps(ws, 1):
                c = one[1][a]
                held[at, cell(two[1][a, b] / c if c else 0), cell(one[1][b] / max(1, rest))] += 1
    weights = {}
    for lead in range(4):
        seen = None
        for o in range(65):
            mine = [([min(1, 2.0 ** (-(x + 0.5) / grid)) if x is not None else 0.0 for x in k[1:]] + [1 / (v + 1)], c) for k, c in held.items() if k[0] == (lead, o)]
            w = weights[seen] if seen else weights.get((lead - 1, o), [0.0, 0.9, 0.1])
            if mine:
                w = [1 / 3] * 3
                for _ in range(60):
                    new = [0.0] * 3
                    for p, c in mine:
                        s = sum(x * y for x, y in zip(p, w))
                        new = [a + c * x * y / s for a, x, y in zip(new, p, w)]
                    w = [a / sum(c for _, c in mine) for a in new]
                w = [max(a, b) for a, b in zip(w, [0, 1e-9, 1e-6])]
                w, seen = [a / sum(w) for a in w], (lead, o)
            weights[lead, o] = w
        weights[lead, 0] = [0.0, *(a / sum(weights[lead, 0][1:]) for a in weights[lead, 0][1:])]
    out = []
    for (i, _), (_, ws) in zip(rows, tokens):
        s = 0.0
        for a, b, at in steps(ws, 0):
            w = weights[at]
            s += math.log10(w[0] * two[0][a, b] / max(1, one[0][a]) + w[1] * one[0][b] / max(1, n) + w[2] / (v + 1))
        out.append((str(i), s))
    return sorted(out)


def test_op6_scores_by_hand(spark, docs):
    want = lm_by_hand(docs)
    got = sorted((str(r.doc_id), r.score) for r in run(spark, "op6_lm_scoring"))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-9)


def test_op6_many_blocks_and_levels(spark, docs):
    """Small blocks, few to a group: requests are merged over several levels, the scores stay."""
    some = [*docs[:60], (None, "a b"), (None, None), (7, ""), *[(9, "again and again")] * 20]
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
    size = sum(len((t or "").encode()) for _, t in some)
    block = size // 40
    assert 40 / 3 / 3 > 3  # groups of three: four levels
    want = lm_by_hand(some)
    for group in (3, 1000):
        got = sorted((str(r.doc_id), r.score) for r in interpolation_lm.score_texts(df, block, group).collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        assert np.allclose(sorted(s for _, s in got), sorted(s for _, s in want), rtol=1e-9)


def test_op6_a_block_sends_as_many_rows_at_every_size():
    import pyarrow as pa

    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40_000))
    def rows(block):  # the number of blocks is no input of it
        t = pa.table({"block": pa.array([block], pa.int64()), "text": [text], "split": pa.array([5], pa.int32()), "times": pa.array([1], pa.int32())})
        return interpolation_lm._ask(t)
    small, large = rows(3), rows(8_000_000)  # of 36 MB and of 100 TB
    assert small.num_rows == large.num_rows == 2 * interpolation_lm.RANGES
    assert sum(small.column("n").to_pylist()) == sum(large.column("n").to_pylist())
    merged = interpolation_lm._merge(interpolation_lm.RANGES)(
        small.filter(pa.array([b == 5 for b in small.column("bucket").to_pylist()])).append_column("grp", pa.array([0] * 2, pa.int64()))
    )
    assert merged.num_rows <= 2 * interpolation_lm.RANGES and set(merged.column("bucket").to_pylist()) <= set(range(320, 384))
