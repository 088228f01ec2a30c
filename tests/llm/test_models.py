"""Language model, quality classifier and toxicity: arithmetic against plain Python, and held-out accuracy."""

import zlib

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import lm_scoring, quality, toxicity
from meterlake.llm.text import text_array
from tests.llm.fixtures import SCHEMA, blank_words, documents, prose, texts

FOLDER = "/root/testdata/sf0.01"


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def test_base_score(spark):
    counts = Counter()
    for i, t in texts():
        if fold(i) != 1:
            counts.update([*blank_words(t), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in texts():
        tokens = [*blank_words(t), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want.append((str(i), fold(i) == 1, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6)))
    got = lm_scoring.score(documents(spark)).collect()
    assert sorted(want) == sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    )
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_words_beyond_the_heavy_are_joined(spark, monkeypatch):
    whole = {(str(r.doc_id), r.n_tokens): r for r in lm_scoring.score(documents(spark)).collect()}
    monkeypatch.setattr(lm_scoring, "HEAVY", 20)
    for r in lm_scoring.score(documents(spark)).collect():
        same = whole[(str(r.doc_id), r.n_tokens)]
        assert r.score == pytest.approx(same.score) and r.base_score == pytest.approx(same.base_score)
        assert r.n_known == same.n_known


def test_all_training_documents_reach_the_model(spark, monkeypatch):
    seen, trained = [], lm_scoring.trained

    def watched(rows, counts, unigram, n_tokens):
        seen.extend(r.text for r in rows.select("text").collect())
        assert n_tokens == sum(len(blank_words(t)) + 1 for t in seen)
        return trained(rows, counts, unigram, n_tokens)

    monkeypatch.setattr(lm_scoring, "trained", watched)
    lm_scoring.score(documents(spark)).collect()
    assert sorted(seen, key=str) == sorted((t for i, t in texts() if fold(i) != 1), key=str)


def test_probabilities_are_normalised():
    random = np.random.default_rng(0)
    model = lm_scoring.start(np.full(lm_scoring.CLASSES, 1 / lm_scoring.CLASSES))
    model = model._replace(outputs=random.normal(0, 1, model.outputs.shape).astype(np.float32))
    target = np.arange(lm_scoring.CLASSES)
    norms = np.full((lm_scoring.CLASSES + 1) ** 2, np.nan, np.float32)
    for one, two in ((3, 4), (lm_scoring.START, lm_scoring.START)):
        found = lm_scoring.log_probabilities(model, np.full(len(target), one), np.full(len(target), two), target, norms)
        assert (10.0**found).sum() == pytest.approx(1, abs=1e-4)


def test_training_beats_unigrams_where_words_follow_each_other():
    random = np.random.default_rng(0)
    n = 40_000
    target = np.zeros(n, np.int64)
    for i in range(1, n):
        target[i] = (target[i - 1] + 1) % 5 if random.random() < 0.8 else random.integers(5)
    unigram = np.full(lm_scoring.CLASSES, 1e-6)
    unigram[:5] = 0.2
    unigram /= unigram.sum()
    one, two = lm_scoring._contexts(target, np.array([0, n]))
    first = lm_scoring.start(unigram)
    last, _ = lm_scoring.train_copy(first, lm_scoring.step_sizes(first), unigram, one, two, target, 0)
    means = []
    for model in (first, last):
        norms = np.full((lm_scoring.CLASSES + 1) ** 2, np.nan, np.float32)
        means.append(lm_scoring.log_probabilities(model, one, two, target, norms).mean())
    assert means[1] > means[0] + 0.2


def test_model_beats_base_on_held_out_texts(spark):
    got = lm_scoring.score(spark.read.parquet(f"{FOLDER}/documents.parquet")).where("held_out").toPandas()
    assert got.score.sum() > got.base_score.sum() + 0.1 * got.n_tokens.sum()


@pytest.mark.parametrize("shard", [lm_scoring.SHARD, 30_000])
def test_scores_do_not_depend_on_files_or_tasks(spark, monkeypatch, shard):
    """The same rows in 1, 8 and 64 partitions and another order, in one shard and in several."""
    monkeypatch.setattr(lm_scoring, "SHARD", shard)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = []
    for parts in (1, 8, 64):
        rows = docs.repartition(parts, "text")
        got = {r.doc_id: (r.score, r.n_tokens, r.held_out) for r in lm_scoring.score(rows).collect()}
        found.append(got)
    for got in found[1:]:
        for i, (score, n, _) in got.items():
            assert abs(score - found[0][i][0]) < 0.005 * n
    held = [v for v in found[0].values() if v[2]]
    assert sum(v[0] for v in held) / sum(v[1] for v in held) > -4.02


def test_score_by_hand(spark, monkeypatch):
    """Each token's class from the vectors before it, and a rarer word by its share of its kind."""
    kept = {}
    trained = lm_scoring.trained

    def keeps(rows, counts, unigram, n_tokens):
        kept["model"], kept["counts"] = trained(rows, counts, unigram, n_tokens), counts.value
        return kept["model"]

    monkeypatch.setattr(lm_scoring, "trained", keeps)
    monkeypatch.setattr(lm_scoring, "WORDS", 3)
    monkeypatch.setattr(lm_scoring, "CLASSES", 3 + lm_scoring.KINDS + 1)
    monkeypatch.setattr(lm_scoring, "END_CLASS", 3 + lm_scoring.KINDS)
    monkeypatch.setattr(lm_scoring, "START", 3 + lm_scoring.KINDS + 1)
    rows = [(k, "the cat and the dog and the bird see a cat " * (k % 4 + 1) + f"odd{k}") for k in range(40)] + [(50, None), (51, "new words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(docs).collect()}
    m, counts, end = kept["model"], Counter(), lm_scoring.END_CLASS
    for i, t in rows:
        if fold(i) != 1:
            counts.update([*blank_words(t), None])
    n, v = sum(counts.values()), len(counts)
    denominator = n + 0.5 * (v + 1)
    order = sorted((w for w in counts if w), key=lambda w: -counts[w])[:3]
    assert counts[order[2]] > max(c for w, c in counts.items() if w and w not in order)
    vocabulary = {int(h): int(c) for h, c in zip(kept["counts"].vocabulary, kept["counts"].classes)}
    hashes = {w: int(lm_scoring.tokens(text_array(pa.array([w])))[0][0]) for w in order}
    kinds = {w: w.encode()[-1] % lm_scoring.KINDS for w in {w for _, t in rows for w in blank_words(t)}}
    mass = Counter({k: 0.5 for k in range(lm_scoring.KINDS)})
    for w, c in counts.items():
        if w and w not in order:
            mass[kinds[w]] += c + 0.5

    def class_of(w):
        return end if w is None else vocabulary[hashes[w]] if w in order else 3 + kinds[w]

    for i, t in rows:
        words = [*blank_words(t), None]
        before, total = [lm_scoring.START, lm_scoring.START], 0.0
        for w in words:
            p = m.inputs[before[0]] @ m.turns[0] + m.inputs[before[1]] @ m.turns[1]
            e = np.exp((p @ m.outputs.T + m.bias).astype(np.float64))
            total += math.log10(e[class_of(w)] / e.sum())
            if w is not None and w not in order:
                total += math.log10((counts[w] + 0.5) / mass[kinds[w]])
            before = [class_of(w), before[0]]
        assert got[i] == pytest.approx(total, abs=1e-3 * len(words))


def symbols_by_hand(text):
    """The symbols of a text as a list, by its words and characters."""
    out, last, end = [], None, 0
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        word = m[0]
        if word == last:
            out.append(quality.REPEAT)
            end = m.end()
            continue
        out += [ord(c) for c in text[end : m.start()]]
        before = ""
        for c in word:
            small = c.lower() if len(c.lower()) == 1 and ord(c) < 1 << 16 else c
            letter = small != c or c in "abcdefghijklmnopqrstuvwxyz" or ord(c) >= 0xAA
            inside = before
            before = letter
            if c in "0123456789":
                out.append(quality.DIGIT)
            elif small != c:
                out.append(quality.CAPITAL if inside else ord(small))
            else:
                out.append(ord(c))
        last, end = word, m.end()
    return out + [ord(c) for c in text[end:]]


SYMBOLS = ["ab ab  ab c", "", "ab", None, "Ünï ÜNÏ 12 x9 HTML Ab-Cd\nAb", "日本 日本語 \U0001f600\U0001f600 a", " x x", "x x ", "Straße straße İ ǅ"]


def test_symbols():
    s, edges = quality.symbols(text_array(pa.array(SYMBOLS)))
    got = [s[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]
    assert got == [symbols_by_hand(t or "") for t in SYMBOLS]


def kneser_ney_by_hand(train, texts):
    """Perplexities by an interpolated modified Kneser-Ney model written from its definition."""
    pad = [quality.BEGIN] * (quality.ORDER - 1)
    longest = Counter()
    for t in train:
        s = pad + symbols_by_hand(t)
        longest.update(tuple(s[i : i + quality.ORDER]) for i in range(len(s) - quality.ORDER + 1))
    counts = {quality.ORDER: longest}
    for n in range(quality.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    alphabet = len(counts[1]) + 1
    discount, total, left = {}, {}, {}
    for n, level in counts.items():
        discount[n] = quality._discounts([sum(c == i for c in level.values()) for i in (1, 2, 3, 4)])
        total[n], left[n] = Counter(), Counter()
        for g, c in level.items():
            total[n][g[:-1]] += c
            left[n][g[:-1]] += discount[n][min(c, 3) - 1]

    def probability(g):
        n = len(g)
        if not n:
            return 1 / alphabet
        lower = probability(g[1:])
        if g[:-1] not in total[n]:
            return lower
        c = counts[n][g]
        own = max(c - discount[n][min(c, 3) - 1], 0) if c else 0
        return (own + left[n][g[:-1]] * lower) / total[n][g[:-1]]

    for context in list(total[quality.ORDER])[:5]:
        known = [g for (g,) in counts[1]]
        assert abs(sum(probability((*context, c)) for c in known) + probability((*context, -1)) - 1) < 1e-9
    usual = sum(c * math.log10(probability(g)) for g, c in longest.items()) / sum(longest.values())
    out = []
    for t in texts:
        s = pad + symbols_by_hand(t or "")
        logs = [math.log10(probability(tuple(s[i : i + quality.ORDER]))) for i in range(len(s) - quality.ORDER + 1)]
        out.append(10 ** -((sum(logs) + quality.PRIOR * usual) / (len(logs) + quality.PRIOR)))
    return out


@pytest.mark.parametrize("table_rows, batch", [(1 << 22, 1 << 24), (10, 3000), (10, 1 << 24)])
def test_perplexity_by_hand(spark, table_rows, batch):
    train = [t for _, t in texts()[:6] if t] + ["ab ab c", "Ünï cödé 日本 12"]
    other = [t for _, t in texts()] + SYMBOLS + ["zzz qqq", "ab"]
    model = quality.train(spark.createDataFrame([(t,) for t in train], "text string"))
    rows = spark.createDataFrame([(k, t or "") for k, t in enumerate(other)], "k int, text string").repartition(3)
    got = [r.perplexity for r in quality.perplexities(rows, model, table_rows, batch).orderBy("k").collect()]
    assert got == pytest.approx(kneser_ney_by_hand(train, other), rel=1e-9)


RUSSIAN = "это простой текст о том как люди живут и работают в большом городе у реки где летом тепло а зимой холодно"
FRENCH = "où êtes déjà allés les élèves français après le dîner à la forêt près du château où naît la rivière fraîche"


def shuffled(text, seed):
    letters = [c for c in text if c != " "]
    random.Random(seed).shuffle(letters)
    rest = iter(letters)
    return "".join(c if c == " " else next(rest) for c in text)


@pytest.mark.parametrize("prose", [RUSSIAN, FRENCH])
def test_noise_of_real_letters_is_rejected(spark, prose):
    words, rng = prose.split(), random.Random(1)
    good = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(300)]
    bad = [shuffled(t, k) for k, t in enumerate(good[:40])]
    rows = [(i, t, "x") for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = labelled(spark, [(i, 1, 0, None) for i in range(250)])
    kept = {r.doc_id for r in quality.judge(docs, labels).where("keep").collect()}
    assert len(kept & set(range(250, 300))) >= 48 and not kept & set(range(300, 340))


def labelled(spark, values):
    return spark.createDataFrame(values, "doc_id long, quality int, toxic int, extra string")


def test_quality_hard_cases(spark):
    labels = [(i, 1, 0, None) for i in (1, 2, 3, 4, 5)] + [(None, 1, 0, None), (9, None, 0, None), (2, 1, 0, "again")]
    got = quality.judge(documents(spark), labelled(spark, labels)).collect()
    assert len(got) == len(texts())
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].keep for i in (1, 6, 7))
    assert by_id[1].perplexity < by_id[11].perplexity
    assert set(got[0].rest.asDict()) == set(documents(spark).columns)
    untrained = quality.judge(documents(spark), labelled(spark, [(1, 0, 0, None)])).collect()
    assert all(r.keep and r.perplexity is None for r in untrained)


def test_quality_learns_from_all_trusted_rows(spark, monkeypatch):
    learnt, measured = [], []
    train, perplexities = quality.train, quality.perplexities

    def counted_train(texts):
        learnt.append(texts.count())
        return train(texts)

    def counted_perplexities(rows, model):
        measured.append(rows.count())
        return perplexities(rows, model)

    monkeypatch.setattr(quality, "train", counted_train)
    monkeypatch.setattr(quality, "perplexities", counted_perplexities)
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'x' AS lang")
    labels = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    got = quality.judge(docs, labels)
    assert learnt[0] > 20_000 and learnt[0] + measured[0] == 30_000
    assert got.count() == 30_000


def test_quality_of_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    train, rest = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").toPandas()
    got = quality.judge(docs, train).select("doc_id", "keep").toPandas().merge(rest, on="doc_id")
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.keep.mean() >= 0.97
    assert bad.keep.mean() <= 0.1


def test_toxicity_of_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = toxicity.toxicity(docs, labels).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [fold(i) == 0 for i in got.doc_id]).all()
    out = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    rank, toxic = out.score.rank(), out.toxic == 1
    pairs = toxic.sum() * (~toxic).sum()
    assert (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / pairs >= 0.9


def test_toxicity_hard_cases(spark):
    one_class = labelled(spark, [(i, 1, 0, None) for i in range(1, 6)])
    assert {r.score for r in toxicity.toxicity(documents(spark), one_class).collect()} == {0.0}
    rows = [(i, f"you are a b4dword fool {prose(i, 20)}" if i % 2 else prose(i, 25)) for i in range(300, 500)]
    labels = labelled(spark, [(i, 1, i % 2, None) for i in range(300, 500)] + [(None, 1, 1, None), (3, 1, None, None)])
    docs = documents(spark, [*rows, *texts(), (901, f"you are a BADWORD fool {prose(400, 20)}"), (902, None)])
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert got[901] > 0.5 > got[902]


def test_repeated_rows_keep_the_bound(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 30)
    monkeypatch.setattr(toxicity, "CLEAN_ROWS", 40)
    fitted, grow = [], toxicity.grow

    def watched(x, y, weight):
        fitted.append((len(y), y.sum()))
        return grow(x, y, weight)

    monkeypatch.setattr(toxicity, "grow", watched)
    rows = [(i, f"you are a b4dword fool {prose(i, 20)}" if i % 2 else prose(i, 25)) for i in range(300, 400)]
    rows += [rows[1]] * 150 + [(304, prose(n, 25)) for n in range(500, 650)]
    labels = labelled(spark, [(i, 1, i % 2, None) for i in range(300, 400)])
    toxicity.train(documents(spark, rows), labels)
    assert fitted[0] == (70, 30)


def test_features_undo_obfuscation():
    part = text_array(pa.array(["an id1ot here", "", "an idiot here"]))
    plain, between, _ = toxicity._unmasked(part)
    assert plain.to_pylist() == ["an idiot here", "", "an idiot here"]
    assert between.sum() == 1
    assert not toxicity.features(part, np.zeros(0, np.uint64), np.zeros(0))[1].any()


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]), np.ones(4))
    assert x.tolist() == [1, 2.5, 4] and y.tolist() == [0, 0.5, 1]


@pytest.mark.parametrize("operator", ["lm", "quality", "toxicity"])
def test_empty_tables(spark, operator):
    docs, labels = spark.createDataFrame([], SCHEMA), labelled(spark, [])
    run = {
        "lm": lambda: lm_scoring.score(docs),
        "quality": lambda: quality.judge(docs, labels),
        "toxicity": lambda: toxicity.toxicity(docs, labels),
    }[operator]
    assert run().count() == 0


def test_contexts_are_normalised_once_in_a_worker(monkeypatch):
    """A second task of a worker goes on with the norms of the first one; another model begins anew."""
    monkeypatch.setattr(lm_scoring, "_KEPT", [None, None])
    model, other = (lm_scoring.start(np.full(lm_scoring.CLASSES, 1 / lm_scoring.CLASSES)) for _ in range(2))
    one, two, target = (np.random.default_rng(i).integers(0, lm_scoring.CLASSES, 700) for i in range(3))
    norms = lm_scoring._norms_of(model)
    first = lm_scoring.log_probabilities(model, one, two, target, norms)
    assert lm_scoring._norms_of(model) is norms and not np.isnan(norms[one * (lm_scoring.CLASSES + 1) + two]).any()
    assert (lm_scoring.log_probabilities(model, one, two, target, norms) == first).all()
    assert np.isnan(lm_scoring._norms_of(other)).all()


def test_quality_holds_the_runs_of_few_texts_at_a_time(monkeypatch):
    """The runs of a part take more than a hundred times its bytes, so parts are small, whatever the batch."""
    seen, symbols = [], quality.symbols

    def noted(part):
        seen.append(part.nbytes)
        return symbols(part)

    monkeypatch.setattr(quality, "symbols", noted)
    random_ = random.Random(3)
    data = ["".join(random_.choices("abcdefgh ", k=20_000)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"text": data, "doc_id": pa.array(range(60), pa.int64())})
    counted = sum(sum(b.column("n").to_pylist()) for b in quality._counted(iter([batch])))
    assert counted == sum(len(symbols(text_array(pa.array([t])))[0]) for t in data)

    class Sent:
        value = np.zeros(0, np.uint64), np.zeros(0)

    list(quality._by_table(Sent, -1.0, -7.0, ["doc_id"])(iter([batch])))
    assert max(seen) <= 600_000 and len(seen) > 3
