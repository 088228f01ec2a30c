"""Exact, line, near and substring de-duplication against plain Python."""

import hashlib
import pathlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import exact_dedup, jaccard_join, line_dedup, substring_dedup
from meterlake.llm.components import components
from meterlake.llm.shared import shared_folder
from meterlake.llm.text import text_array
from pyspark.sql import functions as F
from tests.llm.fixtures import BLANKS, LOW, SCHEMA, blank_words, documents, prose, shingles, texts

LAST = 2**63 - 1


def exact_by_hand(data):
    groups = {}
    for i, t in data:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for i, t in data:
        norm = (t or "").translate(LOW)
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.length(c) % 2], ids=["sha256", "weak"])
def test_exact(spark, digest):
    got = exact_dedup.exact_duplicates(documents(spark), salts=3, digest=digest)
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == exact_by_hand(texts())


def lines_by_hand(data, shortest=10):
    def key(line):
        return line.strip(BLANKS).translate(LOW)

    owner = {}
    for i, t in data:
        for line in (t or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), LAST), LAST if i is None else i)
    out = []
    for i, t in data:
        all_lines = (t or "").split("\n")
        me = LAST if i is None else i
        kept = [x for x in all_lines if len(key(x)) < shortest or owner[key(x)] == me]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def lines_got(df):
    return sorted(((r.rest.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=str)


def test_lines(spark):
    assert lines_got(line_dedup.without_repeated_lines(documents(spark))) == lines_by_hand(texts())


def test_lines_of_a_hot_key_span_partitions(spark):
    data = [(i, f"the very common line\nown line number {i}\nthe very common line") for i in range(400)]
    data += [(i, "two common lines here\n\nthe very common line") for i in range(1000, 1100)]
    docs = documents(spark, data).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 17)
    try:
        assert lines_got(line_dedup.without_repeated_lines(docs)) == lines_by_hand(data)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bitmaps_are_compressed_flags(spark):
    found = line_dedup.keep_bitmaps(documents(spark)).where("_row_id = 5").first()
    bits = np.unpackbits(np.frombuffer(zlib.decompress(found.keep), np.uint8), bitorder="little")
    lost = set(np.flatnonzero(bits == 0).tolist())
    assert lost == {1, 2}


def near_by_hand(data):
    sets = [shingles(t) for _, t in data]
    label = list(range(len(data)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    ids = [LAST if i is None else i for i, _ in data]
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), LAST), i)
    return sorted(
        ((i, len(sets[k]), None if least[find(k)] == LAST else least[find(k)]) for k, (i, _) in enumerate(data)), key=str
    )


def near_got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def chained():
    """Near copies of near copies: ends of a chain link only through the middle; and pairs just below 0.75."""
    base = prose(20, 200).split()
    data = []
    for k in range(12):
        words = list(base)
        for j in range(k):
            words[10 + 14 * j] = f"edit{j}"
        data.append((100 + k, " ".join(words)))
    for k in range(8):
        words = prose(30, 100).split()
        for j in range(5):
            words[(7 + 13 * j + 5 * k) % 100] = f"own{k}x{j}"
        data.append((200 + k, " ".join(words)))
    return data


@pytest.mark.parametrize("data", [texts(), chained()], ids=["hard cases", "chains"])
def test_near(spark, data):
    assert near_got(jaccard_join.jaccard_components(documents(spark, data))) == near_by_hand(data)


def test_near_in_dealt_out_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    assert near_got(jaccard_join.jaccard_components(documents(spark, chained()))) == near_by_hand(chained())


def test_near_search_finds_what_the_bound_allows():
    random = np.random.default_rng(1)
    sets = [np.unique(random.integers(0, 2**62, 80, dtype=np.uint64)) for _ in range(60)]
    sets += [np.unique(np.append(s[5:], random.integers(0, 2**62, 4, dtype=np.uint64))) for s in sets]
    point = [np.bincount((s & np.uint64(255)).astype(int), minlength=256) for s in sets]
    points = np.minimum(np.array(point), jaccard_join.FULL).astype(np.uint8)
    of = np.arange(len(sets), dtype=np.int64)
    n = np.array([len(s) for s in sets])
    found = jaccard_join._search(of, n, of.copy(), np.zeros(len(of), int), points)
    got = {p for a, b in found for p in zip(a.tolist(), b.tolist(), strict=True)}
    links = set()
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (n[a] + n[b] - both):
                links.add((b, a))
    assert links and links <= got
    assert len(got) < 5 * len(links)


def test_representatives(spark):
    kept = jaccard_join.representatives(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect() if r.text)
    near = {i: c for i, _, c in near_by_hand(texts())}
    assert {i for i, _ in ids if i != 8} <= {i for i, c in near.items() if i == c}
    assert [i for i, _ in ids].count(11) == 1  # repeated rows
    assert kept.where("doc_id IN (6, 7, 8)").count() == 3  # no words, linked with nothing


def test_components_of_long_chains(spark):
    random = np.random.default_rng(0)
    names = random.integers(-(2**62), 2**62, 200).tolist()
    links = [(a, b) for a, b in zip(names[:150], names[1:150], strict=False)] + [(names[160], names[161])]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[x] for x in names[:150]}) == 1
    assert got[names[160]] == got[names[161]] != got[names[0]]


def windows_by_hand(h, text, bounds):
    out = set()
    for c in range(len(h)):
        left = c
        while left > bounds[text[c]] and h[left - 1] > h[c]:
            left -= 1
        right = c + 1
        while right < bounds[text[c] + 1] and h[right] >= h[c]:
            right += 1
        if right - left >= substring_dedup.STRETCH:
            out.add((c, left, right))
    return out


def test_compact_windows():
    random = np.random.default_rng(3)
    h = random.integers(1, 60, 700, dtype=np.uint64)
    bounds = np.array([0, 20, 300, 300, 346, 700])
    text = np.repeat(np.arange(5), np.diff(bounds))
    got = set(zip(*(x.tolist() for x in substring_dedup.compact_windows(h, text, bounds)), strict=True))
    assert got == windows_by_hand(h, text, bounds)


def test_shared_passages(spark):
    got = substring_dedup.shared_passages(documents(spark)).collect()
    by_text = {i: blank_words(t) for i, t in texts() if i is not None}
    for r in got:
        if r.doc_id is not None and r.first_doc_id is not None:
            a, b = by_text[r.doc_id][r.start : r.stop], by_text[r.first_doc_id][r.first_start : r.first_stop]
            x, y = shingles(" ".join(a)), shingles(" ".join(b))
            assert min(len(a), len(b)) >= 50
            assert r.similarity == pytest.approx(len(x & y) / len(x | y))
            assert r.similarity >= 0.75
    pairs = {frozenset((r.doc_id, r.first_doc_id)) for r in got}
    assert frozenset((4, 5)) in pairs
    group = {x for p in pairs for x in p if x in (1, 2, 3, None)}
    assert group == {1, 2, 3, None}
    assert not any(x in (9, 10, 11, 13, 14, 15) for p in pairs for x in p)


def test_passages_cover_equal_stretches():
    random = np.random.default_rng(5)
    shared = random.integers(0, 2**62, 60, dtype=np.uint64)
    x = np.concatenate([random.integers(0, 2**62, 33, dtype=np.uint64), shared, shared[:10]])
    y = np.concatenate([shared[5:9], random.integers(0, 2**62, 11, dtype=np.uint64), shared])
    found = substring_dedup.passages(x, y)
    assert any(a <= 33 and 93 <= b and c <= 15 and 75 <= d for a, b, c, d, _ in found)


def stretches_by_hand(words, size=50):
    return {tuple(words[i : i + size]): i for i in range(len(words) - size + 1)}


def test_stretches_beside_partial_quotes(spark):
    """Documents that hold only a part of a passage stand among its holders; each stretch still has a first."""
    rows = []
    for n in range(12):
        passage = prose(1000 + n, 58).split()
        for holder in range(3):
            rows.append((len(rows), " ".join([prose(2000 + len(rows), 40), *passage, prose(3000 + len(rows), 40)])))
        for size in (28, 34, 40, 46):
            for a in (0, 58 - size):
                quote = " ".join(passage[a : a + size])
                rows.append((len(rows), f"{prose(4000 + len(rows), 40)} {quote} {prose(5000 + len(rows), 40)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {}
    for i, text in rows:
        for stretch, at in stretches_by_hand(text.split()).items():
            held.setdefault(stretch, []).append((i, at))
    found = {}
    for r in substring_dedup.shared_passages(docs).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.stop))
    shared = {s: places for s, places in held.items() if len(places) > 1}
    assert len(shared) == 12 * 9
    for places in shared.values():
        listed = [any(a <= at and at + 50 <= b for a, b in found.get(i, [])) for i, at in places]
        assert listed.count(False) <= 1


def edited(random, words):
    """A copy with one edit in 50 words."""
    out = list(words)
    for at in random.choice(np.arange(1, len(words) - 1), len(words) // 50, replace=False):
        out[at] = ["changed", "two words", ""][random.integers(3)]
    return " ".join(out)


def test_recall_of_similar_passages(spark):
    """Planted passages of 50 to 100 words with edits, against the comparison of each pair."""
    random, pairs = np.random.default_rng(11), {}

    def some(n):
        return [f"w{x}" for x in random.integers(0, 10**9, n)]

    rows = []
    for n in range(400):
        passage = some(50 + n % 51)
        copies = [" ".join([*some(60), t, *some(60)]) for t in (" ".join(passage), edited(random, passage))]
        pairs[frozenset((2 * n, 2 * n + 1))] = copies
        rows += [(2 * n, copies[0]), (2 * n + 1, copies[1])]

    def hashes(text):
        return substring_dedup._shingles(text_array(pa.array([text])))[0]

    alike = {p for p, (a, b) in pairs.items() if substring_dedup.passages(hashes(a), hashes(b))}
    assert len(alike) > 250
    got = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {frozenset((r.doc_id, r.first_doc_id)) for r in got}
    assert found <= alike
    assert len(found & alike) >= 0.99 * len(alike)


@pytest.mark.parametrize(
    "operator",
    [
        exact_dedup.exact_duplicates,
        line_dedup.without_repeated_lines,
        jaccard_join.jaccard_components,
        jaccard_join.representatives,
        substring_dedup.shared_passages,
    ],
)
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("quotes", [0, 10, 40])
def test_edited_passages_among_documents_that_quote_parts(spark, quotes):
    """60 words with one changed, in two documents each, while others quote 28 to 45 words of them."""
    rng = random.Random(quotes + 1)
    rows, want = [], []

    def fill(k):
        return [f"f{rng.randrange(10**9)}" for _ in range(k)]

    for _ in range(40):
        passage = [f"p{rng.randrange(10**9)}" for _ in range(60)]
        edited = [*passage[:30], f"e{rng.randrange(10**9)}", *passage[31:]]
        docs = [fill(rng.randrange(5, 40)) + p + fill(rng.randrange(5, 40)) for p in (passage, edited)]
        for _ in range(quotes):
            size = rng.randint(28, 45)
            at = rng.randrange(60 - size + 1)
            docs.append(fill(rng.randrange(30, 60)) + passage[at : at + size] + fill(rng.randrange(30, 60)))
        ids = list(range(len(rows), len(rows) + len(docs)))
        rng.shuffle(ids)
        want.append(frozenset(ids[:2]))
        rows += [(i, " ".join(d)) for i, d in zip(ids, docs)]
    found = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {frozenset((r.doc_id, r.first_doc_id)) for r in found}
    assert sum(w in pairs for w in want) >= 38
    assert pairs <= set(want)


def edited_once(rng, words, at):
    """``words`` with one of them changed, left out or put in at a place."""
    return [*words[:at], *rng.choice([["changed"], [], ["put", words[at]]]), *words[at + 1 :]]


def test_each_edited_passage_among_those_that_begin_alike(spark):
    """Seven pairs begin their passages with the same words, too few for a passage; each pair is found."""
    rng = random.Random(8)
    rows, want = [], set()

    def fill(k):
        return [f"f{rng.randrange(10**9)}" for _ in range(k)]

    for _ in range(12):
        begin = fill(28)
        for _ in range(7):
            passage = begin + fill(23)
            for p in (passage, edited_once(rng, passage, 39)):
                rows.append((len(rows), " ".join(fill(rng.randrange(5, 40)) + p + fill(rng.randrange(5, 40)))))
            want.add(frozenset((len(rows) - 2, len(rows) - 1)))
    rng.shuffle(rows)
    found = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {frozenset((r.doc_id, r.first_doc_id)) for r in found} == want


def test_second_passage_that_the_first_document_quotes_in_part(spark):
    """Three documents share a passage; two of them a second one, of which the third has too little."""
    rng = random.Random(21)
    rows, want = [], set()

    def fill(k):
        return [f"f{rng.randrange(10**9)}" for _ in range(k)]

    for _ in range(12):
        shared, passage = fill(60), fill(52)
        for p in (passage[:44], passage, [*passage[:45], "changed", *passage[46:]]):
            rows.append((len(rows), " ".join([*shared, *fill(40), *p, *fill(20)])))
        want.add(frozenset((len(rows) - 2, len(rows) - 1)))
    found = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {frozenset((r.doc_id, r.first_doc_id)) for r in found if r.start >= 60} == want


def test_similar_passages_share_a_node():
    """Whatever the edits, if only no words repeat beside them."""
    rng = random.Random(3)

    def hashes(words):
        return substring_dedup._shingles(text_array(pa.array([" ".join(words)])))[0]

    def keys(words):
        return set(substring_dedup._node_keys(text_array(pa.array([" ".join(words)])))[0].tolist())

    similar = 0
    for _ in range(3000):
        x = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(50, 160))]
        y = list(x)
        for at in sorted(rng.sample(range(5, len(x) - 5), rng.randint(1, 1 + len(x) // 30)), reverse=True):
            y = edited_once(rng, y, at)
        x, y = ([f"{c}{i}" for i in range(9)] + w + [f"{c}{i}" for i in range(9)] for c, w in (("a", x), ("b", y)))
        if substring_dedup.passages(hashes(x), hashes(y)):
            similar += 1
            assert keys(x) & keys(y)
    assert similar > 1000


@pytest.mark.parametrize("ties", [True, False])
def test_nearest_smaller_values(ties):
    """Against a plain search to the left, with many ties and long descents."""
    rng = np.random.default_rng(4)
    for values in [*(rng.integers(0, top, 300) for top in (3, 40, 10**6)), np.arange(300)[::-1], np.ones(300, int)]:
        values = np.append(0, values).astype(np.uint64)
        expected = [0]
        for i in range(1, len(values)):
            smaller = [j for j in range(i) if values[j] < values[i] or ties and values[j] == values[i]]
            expected.append(max(smaller, default=0))
        assert substring_dedup._nearest(values, ties).tolist() == expected


def test_passages_of_copies_and_repeated_tokens():
    tokens = np.tile(np.arange(20, dtype=np.uint64), 5)
    end = len(tokens) + substring_dedup.SHINGLE - 1
    assert substring_dedup.passages(tokens, tokens.copy()) == [(0, end, 0, end, 1.0)]
    short = tokens[: substring_dedup.STRETCH - 1]
    assert substring_dedup.passages(short, short.copy()) == []
    moved = np.concatenate([np.arange(100, 110, dtype=np.uint64), tokens])
    assert substring_dedup.passages(tokens, moved) == [(0, end, 10, 10 + end, 1.0)]


def test_representatives_of_many_rows_without_words_or_id(spark):
    rows = [(None, "")] * 30 + [(None, None)] * 10 + [(5, " \t")] * 3 + [(6, "a b c d e f")] * 4 + [(None, "a b c d e f")]
    kept = jaccard_join.representatives(documents(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(str, kept)) == sorted(f"Row(doc_id={i!r}, text={t!r})" for i, t in [*rows[:43], rows[43]])


def test_repeated_rows_lose_their_lines_once_each(spark):
    text = "a line that repeats\nother words stay"
    rows = [(1, "a line that repeats")] + [(2, text)] * 20
    got = [r for r in line_dedup.keep_bitmaps(documents(spark, rows)).collect()]
    assert [r._row_id for r in got] == [2]
    kept = line_dedup.without_repeated_lines(documents(spark, rows)).select("text", "n_dropped").collect()
    assert sorted((r.text, r.n_dropped) for r in kept) == [("a line that repeats", 0)] + [("other words stay", 1)] * 20


def test_near_leaves_only_what_its_result_reads(spark):
    """Tables of candidates and sets are removed when the links are found."""
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("llm-*"))
    got = jaccard_join.jaccard_components(documents(spark, chained()))
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("llm-*")) - before}
    assert "llm-points" in left
    assert not left & {"llm-members", "llm-tiles", "llm-stars", "llm-star-pairs", "llm-star-sets", "llm-tree-sets"}
    assert near_got(got) == near_by_hand(chained())


def test_passages_hold_few_texts_at_a_time(monkeypatch):
    """Each step over texts works on small parts, whatever the batch, and finds the same in them."""
    sizes, read = [], substring_dedup._shingles

    def noted(part):
        sizes.append(part.nbytes)
        return read(part)

    monkeypatch.setattr(substring_dedup, "_shingles", noted)

    class Full:
        value = np.full(1 << 10, 255, np.uint8)

    data = [prose(40, 700)] + [prose(i, 700) for i in range(40, 840)]
    docs = pa.array(range(len(data)), pa.int64())
    batch = pa.RecordBatch.from_arrays([docs, docs, pa.array(data)], ["doc", "doc_id", "text"])
    keys = sum(b.num_rows for b in substring_dedup._keys(iter([batch])))
    assert keys == sum(len(substring_dedup._node_keys(text_array(pa.array([t])))[0]) for t in data)
    list(substring_dedup._equal_zones(Full)(iter([batch])))
    list(substring_dedup._whole_stretches(Full, Full)(iter([batch])))
    compared = batch.set_column(0, "doc", pa.array([None, *range(1, len(data))], pa.int64()))
    compared = compared.append_column("first", pa.array([7] * len(data), pa.int64()))
    found = pa.Table.from_batches(list(substring_dedup._verified(iter([compared]))))
    assert found.column("doc_id").to_pylist() == [1] and found.column("first_doc_id").to_pylist() == [0]
    assert max(sizes) < 600_000
