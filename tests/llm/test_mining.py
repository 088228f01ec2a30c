"""Phrase mining, URL rules and periodic runs against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from meterlake.llm import periodic_runs, phrases, queries, url_rules
from meterlake.llm.text import mixed
from tests.llm.fixtures import LOW, documents, prose, texts


def phrases_by_hand(rows, first, least, most=5):
    """(lang, rank, phrase, a, l, r, n, score) from (lang, text) rows."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for size in range(1, most + 1):
                f.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        inner = {}
        for p in found:
            for i, j in itertools.combinations(range(len(p) + 1), 2):
                if 1 < j - i < len(p):
                    inner[p[i:j]] = max(inner.get(p[i:j], 0), f[p])
        scored = []
        for p in found:
            if inner.get(p, 0) >= f[p]:
                continue
            cuts = [(1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def mined(docs, **kw):
    found = phrases.collocations(docs, **kw)
    return sorted((r["lang"], r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


def test_phrases(spark):
    rows = [(k, t) for k, (_, t) in enumerate(texts())]
    rows += [(k, "a b c d e f, a b c d. Ünï ünï; a b a b a b a b\tc  d\x0be" + " x" * (k % 5) * 40) for k in range(20, 40)]
    rows += [(k, prose(k % 3, 200, 12)) for k in range(40, 60)]
    docs = documents(spark, rows)
    plain = [(r["lang"], r["text"]) for r in docs.collect()]
    for first, least in ((1000, 3), (4, 6)):
        assert mined(docs, first=first, least=least) == phrases_by_hand(plain, first, least)
    assert mined(docs.where("false")) == []
    assert mined(documents(spark, [(1, None), (2, " .,; \n")])) == []
    with pytest.raises(ValueError):
        phrases.collocations(docs, most=6)


def test_each_occurrence_is_in_one_chunk(spark):
    """Long stretches without an end, and words that end a chunk everywhere."""
    rows = [(1, "same " * 500), (2, " ".join(f"w{i}" for i in range(700))), (3, "ab cd " * 300), (4, prose(4, 900, 30))]
    docs = documents(spark, rows)
    plain = [(r["lang"], r["text"]) for r in docs.collect()]
    assert mined(docs, least=1, first=100_000) == phrases_by_hand(plain, 100_000, 1)


def runs_by_hand(x, least=12):
    n, out = len(x), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j - i >= max(least - q, q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def test_find_runs():
    rng = random.Random(5)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 5)):
            n = rng.choice([0, 1, 11, 40, 150, 400])
            x = [rng.randrange(rng.choice([1, 2, 3, 12, 900])) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n else 0):
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // rng.choice([2, 3, 9])))
                x[a:] = [x[a + (i - a) % p] for i in range(a, n)]
            docs.append(x)
        least = rng.choice([12, 12, 2, 7])
        hashes = mixed(np.array([v for d in docs for v in d], np.uint64) + np.uint64(1))
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = sorted(zip(*(v.tolist() for v in periodic_runs.find_runs(hashes, bounds, least))))
        want = sorted(
            (int(bounds[i]) + s, int(bounds[i]) + s + k, q) for i, d in enumerate(docs) for s, k, q in runs_by_hand(d, least)
        )
        assert got == want


def test_long_texts_of_few_words_are_quick():
    for words in (np.ones(200_000), np.arange(200_000) % 1001, np.arange(200_000) % 500 > 0):
        found = periodic_runs.find_runs(mixed(words.astype(np.uint64) + np.uint64(1)), np.array([0, 200_000]))
        assert len(found[0]) >= 1 and found[1].max() == 200_000


def collapsed_by_hand(words, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_collapse_runs(spark):
    rows = texts() + [(40, "A b\tc " * 9 + "end A b c"), (41, "x " * 5000), (42, "pre " + "P q r s t u " * 2 + "p")]
    docs = documents(spark, rows)
    got = periodic_runs.collapse_runs(docs)
    assert got.columns == ["rest", "n_words", "runs", "text"]
    found = [(r.rest.doc_id, r.rest.text, r.n_words, [tuple(x) for x in r.runs], r.text) for r in got.collect()]
    want = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = runs_by_hand(words)
        want.append((i, text, len(words), runs, collapsed_by_hand(words, runs)))
    assert sorted(found, key=str) == sorted(want, key=str)
    assert any(r[3] for r in want)
    assert periodic_runs.collapse_runs(docs.where("false")).count() == 0


def test_op13(spark, tmp_path):
    rows = [(i, t) for i, t in texts() if i is not None]
    rows += [(i, None if i % 50 == 0 else prose(i, i % 90, 25)) for i in range(100, 260)]
    rows += [(i, prose(1, 10)) for i in (7, 33, 62)]
    documents(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
        runs = runs_by_hand(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        text = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (text, collapsed_by_hand(w, runs))]
        want.append((i, len(runs), *tail, *digests))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(1 for r in want if r[1]) > 5


RULES = [
    url_rules.Rule("allow", "org/"),
    url_rules.Rule("block", "example.org/es/"),
    url_rules.Rule("block", "example.org/en/1"),
]
URLS = [
    (1, "https://A.Example.ORG/es/5?x=1", "a.example.org", "/es/5", "example.org/es/", "block"),
    (2, "http://example.org/en/17#y", "example.org", "/en/17", "example.org/en/1", "block"),
    (3, "http://badexample.org/es/5", "badexample.org", "/es/5", "org/", "allow"),
    (4, "http://example.org/ES/5", "example.org", "/ES/5", "org/", "allow"),
    (5, "http://example.org", "example.org", "", None, "allow"),
    (6, "http://example.org?/es/", "example.org", "", None, "allow"),
    (7, "example.org/es/5", "", "", None, "allow"),
    (8, None, "", "", None, "allow"),
    (9, "", "", "", None, "allow"),
    (10, "x://", "", "", None, "allow"),
    (11, "a://b://c/d", "b:", "//c/d", None, "allow"),
    (12, "http://org/a\nb?c", "org", "/a\nb", "org/", "allow"),
    (12, "http://org:80/a", "org:80", "/a", None, "allow"),
    (None, "http://ÜÄ.example.org/é", "ÜÄ.example.org", "/é", "org/", "allow"),
]


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u, *_ in URLS], "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, True), (None, True), (5, None)], "page_id long, blocked boolean")
    got = url_rules.filter_urls(pages, labels, RULES).select("rest.page_id", "rest.url", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(URLS, key=str)
    assert url_rules.filter_urls(pages.where("false"), labels, RULES).count() == 0
    assert url_rules.filter_urls(pages, labels.where("false"), []).where("verdict = 'block'").count() == 0


def rules_by_hand(rows, support, confidence, least):
    """Sure sets of tokens by counting every set of every URL."""
    all_sets, blocked_sets = Counter(), Counter()
    for tokens, blocked in rows:
        for size in range(1, len(tokens) + 1):
            for s in itertools.combinations(sorted(tokens), size):
                all_sets[s] += 1
                blocked_sets[s] += blocked
    sure = {
        s: n / all_sets[s] for s, n in blocked_sets.items()
        if n >= max(least, support * len(rows)) and n / all_sets[s] >= confidence
    }
    kept = {}
    for s, c in sure.items():
        parts = (p for size in range(1, len(s)) for p in itertools.combinations(s, size))
        if not any(sure.get(p, 0) >= c for p in parts):
            kept[s] = c
    return kept


def test_mined_rules(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        tokens = [f"{k}{rng.randrange(n)}" for k, n in (("a", 2), ("b", 3), ("c", 4), ("d", 9))]
        bad = {"a0", "b1"} <= set(tokens) or "d3" in tokens
        rows.append((tokens, rng.random() < (0.95 if bad else 0.1)))
    rows.append(([], True))
    labelled = spark.createDataFrame(rows, "tokens array<string>, blocked boolean")
    for support, confidence, least in ((0.01, 0.8, 5), (0.05, 0.6, 1)):
        got = {tuple(sorted(r.tokens)): r.confidence for r in url_rules.mined_rules(labelled, support, confidence, least).collect()}
        want = rules_by_hand(rows, support, confidence, least)
        assert got == pytest.approx(want) and want


def test_mined_rules_block_other_pages(spark):
    pages = [(i, f"http://{'casino' if i % 3 == 0 else 'site%d' % (i % 7)}.example.net/en/{i}.html?a={i}") for i in range(90)]
    pages = spark.createDataFrame(pages, "page_id int, url string")
    labels = pages.where("page_id < 60").selectExpr("page_id", "page_id % 3 = 0 AS blocked")
    got = {r.page_id: (r.verdict, r.confidence) for r in url_rules.filter_urls(pages, labels, RULES).select("rest.page_id", "verdict", "confidence").collect()}
    assert got == {i: ("block", 1.0) if i % 3 == 0 else ("allow", None) for i in range(90)}


def test_a_url_has_few_tokens(spark):
    long = "http://" + "a.b." * 50 + "example.net/" + "x1/" * 90 + "f.html?" + "&".join(f"k{i}=1" for i in range(90)) + "#z"
    page = spark.createDataFrame([(1, long)], "page_id int, url string")
    tokens = url_rules.judged_pages(page, []).first().tokens
    assert len(tokens) <= 14 and len(set(tokens)) == len(tokens)
    assert {"scheme:http", "host:net", "host:example.net", "path1:x#", "ending:html", "fragment"} <= set(tokens)
