"""HTML extraction, packing, decontamination, words and filters against plain Python."""

import itertools
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import decontaminate, packing
from meterlake.llm.bits import bit_filter, has
from meterlake.llm.html_text import extract, main_text
from meterlake.llm.text import BLANK, SYMBOL, minima, text_array, words
from tests.llm.fixtures import SCHEMA, blank_words, documents, plain_words, prose, texts

LONG = "A sentence that is long enough to be the text of a page, with some more words."


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        (f"<article><h1>T</h1><p>{LONG}</p><p>a</p></article>", f"T\n{LONG}\na"),
        (f"<nav><a>x</a></nav><article><p><b>{LONG}<br><p>b &amp;&nbsp;c\n d</article><footer>f</footer>", f"{LONG}\nb & c d"),
        (f"<main><p>{LONG}</p><div class='ad box'>buy</div><p>end</p><section id=comments>no</section></main>", f"{LONG}\nend"),
        (f"<p>{LONG}</p><script>var t='</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>b</p>", f"{LONG}\nb"),
        (f"<div class=sidebar>{LONG}</div><div><h2>H</h2><p>{LONG}</p></div><form>f</form>", f"H\n{LONG}"),
        (f"<ul><li><a href=a>one</a><li><a href=b>two</a></ul><div><p>{LONG}</p></div>", LONG),
        (f"<article><p>{LONG}</p>", LONG),
        ("<nav>only a menu</nav>", ""),
        ("<p>&lt;b&gt; &#233; &unknown;</p>", "<b> é &unknown;"),
        ("<article><ul><li>one<li>two</ul></article>", "one\ntwo"),
        ("<a b='>'>x</a> < 3 <", "x < 3 <"),
    ],
)
def test_main_text(page, want):
    assert main_text(page) == want


PROSE = " ".join([LONG] * 5)
REMARK = " ".join(["A reader wrote this remark, which is long enough to look like a text of its own."] * 5)


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article><p>{PROSE}</p><div class='comment-list'><p>{REMARK}</p></div></article>", PROSE),
        (f"<article><p>{PROSE}</p></article><div class='comments-section'><p>{REMARK}</p></div>", PROSE),
        (f"<div class=x><p>{PROSE}</p></div><div class='comment-item'><p>{REMARK}</p></div>", PROSE),
        (f"<article><p>{PROSE}</p></article><article class='user-comment'><p>{' '.join([REMARK] * 9)}</p></article>", PROSE),
        (f"<div><p>{PROSE}</p></div><div class='newsletter-signup-box'>{REMARK}</div>", PROSE),
        (f"<div><p>{PROSE}</p></div><div class='related-posts'>{REMARK}</div>", PROSE),
        (f"<div class='cookie-notice-bar'>{REMARK}</div><div><p>{PROSE}</p></div>", PROSE),
        (f"<div><p>{PROSE}</p></div><div class='main-footer-area'>{REMARK}</div>", PROSE),
        (f"<div class=a>{PROSE}</div><div class=ad>buy</div><div class=b>{PROSE}</div>", f"{PROSE}\n{PROSE}"),
        (f"<div id=w><div class=a>{PROSE}</div><div class=ad>buy</div><div class=b>{PROSE}</div></div>", f"{PROSE}\n{PROSE}"),
        (f"<div class='content has-comments'><p>{PROSE}</p></div>", PROSE),
        (f"<div class='content has-sidebar'><p>{PROSE}</p></div>", PROSE),
        (f"<p>{PROSE} <a href=\"x>y\" title='it's'>z</a> &amp; <b class=\"open>{LONG}</b></p>", f"{PROSE} z & {LONG}"),
        (f"<p>{PROSE}<br>a<span class='share-buttons'>tell others</span> <wbr>b</p></i></div>", f"{PROSE} a b"),
    ],
)
def test_containers(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("unit", ["<span>x", "<div>x", "<div class=my-ad>x", "<div class=my-comment>x", "<article>x", "<a \"", "<a ", "<b>x</i>"])
def test_nested_and_unclosed_tags_are_linear(unit):
    """Four times the text takes about four times the time and memory, on one deep page."""
    tracemalloc.start()
    times = []
    for size in (100_000, 400_000):
        page = unit * (size // len(unit))
        start = time.process_time()
        main_text(page)
        times.append(time.process_time() - start)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert times[1] < 9 * times[0] + 0.3
    assert most < 200_000_000


def test_extract(spark):
    pages = spark.createDataFrame(
        [(1, "u", f"<p>{LONG}é"), (None, None, None), (1, "u", "")], "page_id int, url string, html string"
    ).selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, len(LONG) + 1]
    assert extract(pages.where("false")).count() == 0


def test_extract_long_page_quickly(spark):
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert main_text(page).count("\n") == 19_999


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= x) - x for x in lengths)


@pytest.mark.parametrize("buckets", [1, 2, 3, 9])
def test_boundaries_are_optimal(buckets):
    random = np.random.default_rng(buckets)
    lengths = random.integers(0, 40, 60)
    values, counts = np.unique(lengths, return_counts=True)
    ends = packing.boundaries(values, counts, buckets)
    k = min(buckets, 3) if buckets < 9 else 9
    if buckets <= 3:
        best = min(
            padding(lengths, [*some, values[-1]]) for some in itertools.combinations(values[:-1].tolist(), k - 1)
        )
        assert padding(lengths, ends) == best
    assert ends[-1] == values[-1] and len(ends) <= buckets


def test_pack(spark):
    rows = texts() + [(100 + i, "w " * (i % 37)) for i in range(300)]
    docs = documents(spark, rows)
    got = packing.pack(docs, buckets=4, budget=100).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(i), len(blank_words(t))) for i, t in rows)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.padded_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), members in batches.items():
        capacity = max(1, 100 // max(1, members[0].padded_length))
        assert sorted(m.place for m in members) == list(range(len(members)))
        full = (bucket, batch + 1) not in batches or len(members) == capacity
        assert len(members) <= capacity and full
    assert len({r.bucket for r in got}) <= 4


def test_pack_numbers_over_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 10)
    got = packing.pack(documents(spark, [(i, "w " * (i % 5)) for i in range(200)]), buckets=2, budget=12).collect()
    assert len({(r.bucket, r.batch, r.place) for r in got}) == 200
    for bucket in {r.bucket for r in got}:
        numbers = sorted(r.batch for r in got if r.bucket == bucket)
        assert set(numbers) == set(range(max(numbers) + 1))


def test_long_buckets_end_at_a_document(spark):
    lengths = [1025, 1030, 1500, 2051, 2060, 3007, 5003, 9001]
    got = packing.pack(documents(spark, [(i, "w " * n) for i, n in enumerate(lengths)]), buckets=3).collect()
    for r in got:
        assert r.padded_length == max(x.n_tokens for x in got if x.bucket == r.bucket)


def test_grid_has_few_points(spark):
    lengths = spark.range(0, 300_000, 7).selectExpr("id AS n")
    grid = [r[0] for r in lengths.select(packing.on_grid(lengths.n).alias("g")).distinct().collect()]
    assert len(grid) < packing.EXACT + packing.STEPS * 10
    worst = lengths.select((packing.on_grid(lengths.n) - lengths.n).alias("d"), "n").where("d < 0 OR d > 1 + n / 64")
    assert worst.count() == 0


def hits_by_hand(text, items):
    w = plain_words(text)
    hit, names = set(), set()
    for item, t in items:
        v = plain_words(t)
        size = min(13, len(v))
        wins = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if v and tuple(w[i : i + size]) in wins:
                hit.update(range(i, i + size))
                names.add("" if item is None else str(item))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("bits", [16, 23], ids=["full filter", "usual filter"])
def test_contamination(spark, bits):
    p = prose(50, 40).split()
    items = [(1, " ".join(p)), (2, "Only, THREE words"), (None, prose(3, 70)), (4, None), (5, "..."), (1, " ".join(p)), (12, "again " * 6)]
    rows = texts() + [
        (20, prose(60, 30) + " " + " ".join(p[5:18]) + " " + prose(61, 300)),
        (21, " ".join(p[5:17]) + " stop " + " ".join(p[17:30])),
        (22, " ".join(p).upper().replace(" ", "-") + "."),
        (23, "but only three words here"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS hash")
    got = decontaminate.contamination(documents(spark, rows), bench, bits).collect()
    want = sorted((str(i), *hits_by_hand(t, items)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == want
    for r in got:
        assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
        assert len({x for s in r.spans for x in range(s.start, s.stop)}) == r.n_hit
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(spark), none).where("contaminated").count() == 0
    assert decontaminate.contamination(spark.createDataFrame([], SCHEMA), bench).count() == 0


@pytest.mark.parametrize("separator, by_hand", [(BLANK, blank_words), (SYMBOL, plain_words)], ids=["blank", "symbol"])
def test_words(separator, by_hand):
    some = [t for _, t in texts()] + ["", " a", "a ", "É é\tB\x0bb", "\x1c\x85　x"]
    found = words(text_array(pa.array(some, pa.string()).slice(1)), separator)
    seen = {}
    for k, t in enumerate(some[1:]):
        w = by_hand(t)
        a, b = found.bounds[k], found.bounds[k + 1]
        assert b - a == len(w)
        for h, word, s, e in zip(found.hashes[a:b], w, found.starts[a:b], found.ends[a:b], strict=True):
            assert found.data[s:e].tobytes().decode() == word
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_winnowing_keeps_the_least_of_every_window():
    random = np.random.default_rng(4)
    hashes = random.integers(0, 2**62, 300, dtype=np.uint64)
    bounds = np.array([0, 5, 12, 25, 25, 300])
    at, _ = minima(hashes, bounds, 5, 9)
    from meterlake.llm.text import runs

    grams = runs(hashes, 5)
    want = set()
    for a, b in itertools.pairwise(bounds.tolist()):
        for s in range(a, b - 13 + 1):
            want.add(s + int(np.argmin(grams[s : s + 9])))
    assert set(at.tolist()) == want


def test_bit_filter(spark):
    df = spark.createDataFrame([(5 << 45,), (-3,), (None,), (2**62,)], "h long")
    bits = bit_filter(df, "h", 20)
    assert len(bits) == (1 << 20) // 8
    probe = np.array([5 << 45, -3, 2**62, 1 << 61], np.int64).view(np.uint64)
    assert has(bits, probe).tolist() == [True, True, True, False]


@pytest.mark.parametrize("opening", ["<div class='content has-sidebar'>", "<div class='layout no-sidebar'>", "<div id=page-with-nav>"])
def test_a_part_of_a_name_does_not_hide_an_article(opening):
    sentence = "A sentence of the article that says quite a lot. " * 5
    page = f"<html><body>{opening}<p>{sentence}</p><p>{sentence}</p></div></body></html>"
    assert main_text(page) == "\n".join([sentence.strip()] * 2)


@pytest.mark.parametrize(
    "block",
    ["<ul><li>{}</li></ul>", "<ol><li>{}</li></ol>", "<blockquote>{}</blockquote>", "<section><p>{}</p></section>",
     "<table><tr><td>{}</td></tr></table>", "<div><p>{}</p></div>"],
)
def test_blocks_after_an_advert_belong_to_the_article(block):
    sentence = "A sentence of the article that says quite a lot. " * 5
    page = (
        f"<body><div class=content><p>{sentence}</p><p>{sentence}</p><div class=ad-slot>Buy now</div>"
        f"{block.format('after the advert')}</div><div class=site-sidebar><a href=x>more links</a></div></body>"
    )
    assert main_text(page) == "\n".join([*[sentence.strip()] * 2, "after the advert"])


def test_one_id_on_many_rows_is_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 10)
    packed = packing.pack(documents(spark, [(7, "w w")] * 150 + [(i, "w w") for i in range(100, 150)]), buckets=2, budget=12)
    got = packed.collect()
    assert len({(r.bucket, r.batch, r.place) for r in got}) == 200
    # In order of shards, the id stands in runs with others in between.
    order = [r.doc_id == 7 for r in sorted(got, key=lambda r: (r.batch, r.place))]
    assert sum(a and not b for a, b in zip(order, order[1:])) > 3
