"""Scores, fingerprints and the pipeline's stages against plain Python versions."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from rankloom.llm import _bytes as B
from rankloom.llm import packing, quality_qda, queries, spaced_seeds, toxicity_nnpu, url_filter
from tests.conftest import SF_SMALL
from tests.llm.test_exact import WORD, brute_spans, lower

ODD = [None, "", "one", "é̀ \U0001f600 中文 \x00 tab\tand\r\nline\n\n", "A! B? C| #1 -x_y\n\nA! B? C| #1 -x_y", "same words " * 40]


def read(spark, table):
    return spark.read.parquet(f"{SF_SMALL}/{table}.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in read(spark, "documents").collect()]


# --- op1 --------------------------------------------------------------------------------
def features(text):
    ws, raw = WORD.findall(text), text.encode()
    some, chars, lines = max(1, len(ws)), max(1, len(text)), text.count("\n") + 1
    logit = lambda s: math.log((s + 0.002) / (1.002 - min(s, 1)))
    share = lambda chs: logit(sum(c in chs for c in text) / chars)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
    n = collections.Counter(windows)
    cover = {j for k, w in enumerate(windows) if n[w] > 1 for j in range(k, k + 8)}
    size = [len(w.encode()) for w in ws]
    p = [c / len(raw) for c in collections.Counter(raw).values()]
    return [
        math.log1p(len(ws)), math.log1p(len(text)), math.log1p(sum(map(len, ws)) / some),
        share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("0123456789"), share(".,;:"), share("!"), share("?"), share("|"), share("#*$%&<>"), share("-_/@=+~^"),
        logit(sum(ord(c) > 127 for c in text) / chars), share("\n"), math.log1p(len(ws) / lines), logit(dup / lines), logit(len(cover) / some),
        len({lower(w) for w in ws}) / some * math.log1p(len(ws)),
        logit(sum(x <= 3 for x in size) / some), logit(sum(x >= 12 for x in size) / some), logit(sum(w[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for w in ws) / some),
        -sum(x * math.log2(x) for x in p),
    ]


def test_op1_features_and_scores(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    x = {i: np.array(features(t or "")) for i, t in rows}
    got = {r.doc_id: r.x for r in quality_qda.document_features(df).collect()}
    assert all(np.allclose(got[i], x[i], atol=1e-9) for i, _ in rows)
    labels = read(spark, "labels")
    y = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    mean, cov, n = [], [], []
    for k in (0, 1):
        mine = np.array([x[i] for i in y if y[i] == k and i in x])
        mean.append(mine.mean(0)), cov.append(np.cov(mine.T, bias=True)), n.append(len(mine))
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    grand, spread = (n[0] * mean[0] + n[1] * mean[1]) / sum(n), np.sqrt(np.diag(pooled)) + 1e-6

    def density(k, z):
        c = 0.95 * (0.7 * cov[k] + 0.3 * pooled) + 0.05 * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(z))
        d = z - mean[k]
        return math.log(n[k] / sum(n)) - 0.5 * d @ np.linalg.solve(c, d) - 0.5 * np.linalg.slogdet(c)[1]

    for r in quality_qda.classify(df, labels).collect():
        z = np.clip(x[r.doc_id], grand - 10 * spread, grand + 10 * spread)
        want = 1 / (1 + math.exp(max(-500, min(500, density(0, z) - density(1, z)))))
        assert math.isclose(r.score, want, abs_tol=1e-6) and r.predicted == (r.score >= 0.3)


# --- op4 --------------------------------------------------------------------------------
def test_op4_scores_from_given_weights(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashes, w, b, _ = toxicity_nnpu.fit(df, read(spark, "labels"))
    weight = dict(zip(np.sort(hashes.view(B.U)).tolist(), w))

    def key(word, more=0):
        c = B.prefix(np.frombuffer(word, np.uint8))
        return int((B.span_hash(c, np.array([0]), np.array([len(word)])) + B.U(more))[0])

    used = 0
    for r in toxicity_nnpu.classify(df, read(spark, "labels")).collect():
        text = lower(dict(rows)[r.doc_id] or "").encode()
        found = set()
        for word in re.findall(rb"[0-9a-zA-Z\x80-\xff]+", text):
            found |= {key(word), *(key(word[:k], k) for k in (5, 6, 7, 8) if len(word) > k)}
        used += len(found & weight.keys())
        z = b + sum(weight.get(h, 0.0) for h in found)
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), abs_tol=1e-6) and r.predicted == (r.score >= 0.5)
    assert used > 50


# --- op9 --------------------------------------------------------------------------------
def simhash(text, k=4):
    ws = WORD.findall(lower(text))
    shingles = [" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))] if ws else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op9_fingerprints(spark, docs):
    text = {r["doc_id"]: r["text"] or "" for r in docs}
    for r in queries.QUERIES["op9_simhash_near_dedup"](spark, SF_SMALL).collect():
        assert r.fingerprint == f"{simhash(text[r.doc_id]):016x}"


# --- op10 -------------------------------------------------------------------------------
def url_features(url, width):
    m = re.match(r"[^:]*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    host = re.sub(r"[.][^.]*$", "", host)
    path = re.sub("[0-9]+", "0", path)
    out = set()
    for text, tag, sizes in ((host, "h", (3, 4, 5)), (path, "p", (3,))):
        text = f"^{text}$"
        for n in sizes:
            seed = xxhash.xxh64_intdigest(f"{tag}{n}".encode(), 42)
            for i in range(len(text) - n + 1):
                h = xxhash.xxh64_intdigest(text[i : i + n].encode(), seed)
                out.add((h - (1 << 64) if h >> 63 else h) % width)
    return out


def test_op10_verdicts_from_given_weights(spark):
    rng = np.random.default_rng(6)
    weights, bias = rng.normal(0, 0.4, 1 << 10).tolist(), -0.3
    pages = read(spark, "pages").select("page_id", "url")
    odd = [(10**6 + i, u) for i, u in enumerate([None, "", "no scheme", "http://", "HTTPS://A.B.example/É/12?x#y", "http://x"])]
    pages = pages.union(spark.createDataFrame(odd, pages.schema))
    url = {r.page_id: r.url for r in pages.collect()}
    got = url_filter.judge(pages, None, width=1 << 10, model=(weights, bias)).collect()
    assert len(got) == len(url)
    for r in got:
        z = bias + sum(weights[f] for f in url_features(url[r.page_id], 1 << 10))
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)
        if r.rule is None:
            assert r.verdict == ("block" if r.score >= 0.5 else "allow")
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_op10_learns_names_it_has_not_seen(spark):
    """Made names that hold a blocked word against general ones, in forms the table does not have."""
    bad = "mega-casino casinoroyal pokerstar24 bet-win cheapviagra pornsite adult-chat freemoney spamlist payday-now".split()
    good = "townhall riverside cooking-school oldmaps stargazer birdwatch bakery workshop choir lighthouse".split()
    rows = [(i, f"https://{n}.test/{i}/page") for i, n in enumerate(bad + good)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = url_filter.labelled_table(read(spark, "pages"))
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, table).collect()}
    right = sum(got[i] == ("block" if i < len(bad) else "allow") for i in got)
    assert right >= 0.85 * len(rows)


# --- the pipeline -----------------------------------------------------------------------
def quality_rules_by_hand(docs):
    line_of = lambda line: " ".join(WORD.findall(lower(line)))
    texts = {}  # (host, text) -> normalised line -> words
    for r in docs:
        held = collections.Counter()
        for line in (r["text"] or "").split("\n"):
            held[line_of(line)] += len(WORD.findall(line))
        held.pop("", None)
        texts[r["source"], r["text"] or ""] = held
    hosts = collections.Counter(h for h, _ in texts)
    count, least = collections.Counter(), {}
    for (h, _), held in texts.items():
        for line, n in held.items():
            count[h, line] += 1
            least[h, line] = min(n, least.get((h, line), n))
    above = lambda n, h: n >= 3 and n > min(100, 0.02 * hosts[h])
    often = {(h, x) for (h, x), n in count.items() if n > 10 and n > 0.1 * hosts[h]}
    some = {(h, x) for (h, x), n in count.items() if above(n, h) and least[h, x] >= 6}
    again = collections.Counter()
    for (h, t), held in texts.items():
        mine = [x for x in held if (h, x) in some]
        if mine and 2 * sum(held[x] for x in mine) <= len(WORD.findall(t)):
            again.update((h, x) for x in mine)
    often |= {(h, x) for (h, x), n in again.items() if above(n, h)}
    out = []
    for r in docs:
        t, h = r["text"] or "", r["source"]
        ws = WORD.findall(t)
        windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
        n = collections.Counter(windows)
        cover = {j for k, w in enumerate(windows) if n[w] > 1 for j in range(k, k + 8)}
        left = len(ws) - sum(c for x, c in texts[h, t].items() if (h, x) in often)
        if len(ws) >= 20 and 100 * len(cover) <= 30 * len(ws) and left >= 20 and left >= 0.3 * len(ws):
            lines = [(x, x + "\n") for x in t.split("\n")]
            lines[-1] = (lines[-1][0], lines[-1][0])
            text = "".join(whole for x, whole in lines if (h, line_of(x)) not in often)
            out.append({**r, "text": text, "n_chars": len(text)})
    return out


def near_copies_by_hand(docs):
    fp = {r["doc_id"]: simhash(r["text"]) for r in docs}
    group = {i: i for i in fp}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in itertools.combinations(sorted(fp), 2):
        if (fp[a] ^ fp[b]).bit_count() <= 4:
            a, b = sorted((root(a), root(b)))
            group[b] = a
    return [r for r in docs if root(r["doc_id"]) == r["doc_id"]]


def repeats_by_hand(docs):
    docs = sorted(docs, key=lambda r: r["doc_id"])
    out = []
    for r, spans in zip(docs, brute_spans([r["text"] for r in docs], 200)):
        raw, at, kept = r["text"].encode(), 0, []
        for s, e in spans["first"]:
            while s < e and raw[s] & 0xC0 == 0x80:
                s += 1
            while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
                e -= 1
            kept.append(raw[at:s])
            at = e
        text = b"".join([*kept, raw[at:]]).decode()
        out.append({**r, "text": text, "n_chars": len(text)})
    return out


def leaks_by_hand(docs, items):
    tokens = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", lower(t).encode())
    seeds = lambda t, m: ((i, tuple(t[i + j] for j, bit in enumerate(m) if bit == "1")) for i in range(len(t) - len(m) + 1))
    of_seed = collections.defaultdict(list)
    items = [tokens(t) for t in items]
    for n, t in enumerate(items):
        for m in spaced_seeds.short_masks(len(t)) or spaced_seeds.MASKS:
            for i, s in seeds(t, m):
                of_seed[m, s].append((n, i))
    masks = {m for m, _ in of_seed}
    out = []
    for r in docs:
        t, bad = tokens(r["text"]), False
        for n, shift in {(n, at - i) for m in masks for at, s in seeds(t, m) for n, i in of_seed.get((m, s), ())}:
            item = items[n]
            w = min(13, len(item))
            lo, hi = max(0, -shift), min(len(item), len(t) - shift)
            same = [item[i] == t[i + shift] for i in range(lo, hi)]
            bad |= any(sum(same[k : k + w]) >= math.ceil(0.8 * w) for k in range(len(same) - w + 1))
        if not bad:
            out.append(r)
    return out


def test_pipeline_stages_by_hand(spark, docs):
    items = [r.text for r in read(spark, "benchmark").collect()]
    by_hand = [quality_rules_by_hand, near_copies_by_hand, repeats_by_hand, lambda d: leaks_by_hand(d, items)]
    frame, want = read(spark, "documents"), docs
    schema = frame.schema
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], by_hand):
        want = sorted(plain(want), key=lambda r: r["doc_id"])
        got = sorted((r.asDict() for r in stage(spark, frame, SF_SMALL).collect()), key=lambda r: r["doc_id"])
        assert [r["doc_id"] for r in got] == [r["doc_id"] for r in want], name
        assert got == want, name
        frame = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in got], schema)
    tok = packing._tokenizer(packing.vocabulary("word_bpe_49k.json"))
    pieces, total = set(), 0
    for r in want:
        ids = tok.encode(r["text"], add_special_tokens=False).ids + [0]
        total += len(ids)
        pieces |= {(r["doc_id"], k, s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 2048))}
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == pieces and len(rows) == len(pieces)
    full = collections.defaultdict(list)
    for r in rows:
        full[r.sequence_id].append((r.offset, r.length))
    for places in full.values():
        assert [o for o, _ in sorted(places)] == [0, *itertools.accumulate(n for _, n in sorted(places))][:-1]
        assert sum(n for _, n in places) <= 2048
    assert len(full) <= -(-total // 2048) + 1
