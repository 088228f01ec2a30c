"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text are densities of a lexicon (words and word beginnings that are much more frequent in
toxic labelled texts), how near second-person words stand to its entries, shares of capitals and of kinds
of punctuation, and rates of obfuscation (digits and signs between letters, which are also undone before
the lexicon is looked up). The lexicon, the trees and the calibration are fitted on a bounded sample of
labelled rows; every text is then scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import _table, chunks, mixed, text_array, words

#: The model is fitted on at most so many labelled rows of each class, those with the least hash of their id.
TOXIC_ROWS, CLEAN_ROWS = 6_000, 10_000
#: The lexicon has at most so many entries, each in at least LEAST_TEXTS toxic texts.
LEXICON, LEAST_TEXTS, LEAST_LOG_ODDS = 4_000, 3, 2.0
TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 48
NEAR = 5
#: crc32 of the id as text, modulo FOLDS; rows with 0 are never learnt from.
FOLDS = 5

# Second-person words.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer sie ihnen tu te toi ton ta tes "
    "vous votre vos tú ti tuyo usted ustedes vosotros vuestro su"
).split()
# Signs that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
NOT_LETTER = _table(np.flatnonzero(~LETTER).tolist())
UNLEET = np.arange(256, dtype=np.uint8)
for _sign, _letter in LEET.items():
    UNLEET[ord(_sign)] = ord(_letter)
#: Kinds of bytes that are counted in a text.
KINDS = ["!", "?", ".,", "*#%&$@^~", "0123456789", "|<>{}[]\\_=+", "\n"]
BEGINNINGS = (4, 5, 6)


class Model(NamedTuple):
    lexicon: np.ndarray  # sorted hashes
    weights: np.ndarray
    trees: list
    base: float
    x: np.ndarray
    y: np.ndarray


def _pronouns() -> np.ndarray:
    return np.sort(words(text_array(pa.array(SECOND_PERSON)), NOT_LETTER).hashes)


def _unmasked(part: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The texts with signs between letters read as letters; where those signs were; the bytes."""
    offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
    raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    letter = LETTER[raw]
    between = np.zeros(len(raw), bool)
    between[1:-1] = ~letter[1:-1] & letter[:-2] & letter[2:] & (raw[1:-1] > 32)
    plain = np.where(between, UNLEET[raw], raw)
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(plain.tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(part), buffers), between, raw


def _terms(w) -> list[np.ndarray]:
    """Hashes of the words and of their beginnings (0 where a word is shorter)."""
    out = [w.hashes]
    length, h = w.ends - w.starts, np.zeros(len(w.starts), np.uint64)
    for i in range(max(BEGINNINGS)):
        byte = w.data[np.minimum(w.starts + i, max(len(w.data) - 1, 0))].astype(np.uint64)
        h = mixed(h * np.uint64(257) + byte + np.uint64(1 + (i << 9)))
        if i + 1 in BEGINNINGS:
            out.append(np.where(length > i + 1, h, 0))
    return out


def _found(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def features(part: pa.Array, lexicon: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of features for each text of ``part``; an empty text has zeros."""
    plain, between, raw = _unmasked(part)
    w = words(plain, NOT_LETTER)
    n = np.diff(w.bounds)
    text = np.repeat(np.arange(len(part)), n)
    edges = np.frombuffer(plain.buffers()[1], np.int64)

    def per_text(flags, upto):
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
        return total[upto[1:]] - total[upto[:-1]]

    weight = np.zeros(len(w.hashes))
    kinds = []
    for terms in _terms(w):
        hit, at = _found(terms, lexicon)
        value = np.where(hit, weights[at] if len(weights) else 0.0, 0.0)
        kinds.append(per_text(hit, w.bounds))
        weight = np.maximum(weight, value)
    hit = weight > 0
    you, _ = _found(w.hashes, _pronouns())
    # Lexicon entries with a second-person word of the same text at most NEAR words away.
    places = np.flatnonzero(you)
    near = np.zeros(len(hit))
    if len(places):
        at = np.flatnonzero(hit)
        right = np.minimum(np.searchsorted(places, at), len(places) - 1)
        for p in (places[right], places[np.maximum(right - 1, 0)]):
            close = (np.abs(p - at) <= NEAR) & (text[p] == text[at])
            near[at[close]] = 1
    most = np.zeros(len(part))
    np.maximum.at(most, text[hit], weight[hit])
    size, count = np.maximum(np.diff(edges), 1), np.maximum(n, 1)
    hits = per_text(hit, w.bounds)
    letters = np.maximum(per_text(LETTER[raw], edges), 1)
    twice = np.zeros(len(raw), bool)
    twice[1:] = (raw[1:] == raw[:-1]) & ~LETTER[raw[1:]] & (raw[1:] > 32)
    columns = [
        np.log1p(n),
        hits / count,
        np.minimum(hits, 10),
        per_text(weight, w.bounds) / count,
        np.minimum(per_text(weight, w.bounds), 60),
        most,
        *(k / count for k in kinds),
        per_text(near, w.bounds) / count,
        per_text(you, w.bounds) / count,
        per_text((raw >= 65) & (raw <= 90), edges) / letters,
        per_text(raw >= 128, edges) / size,
        per_text(between, edges) / count,
        per_text(twice, edges) / size,
    ]
    for kind in KINDS:
        columns.append(per_text(_table(kind.encode())[raw], edges) / size)
    return np.column_stack(columns).astype(np.float32)


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list, float]:
    """Trees of the logistic loss over binned features: (feature, cut) a level-ordered node, values at the leaves."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    share = (weight * y).sum() / weight.sum()
    base = float(np.log(share / (1 - share)))
    raw, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = weight * (y - p), weight * p * (1 - p)
        node, nodes = np.zeros(len(y), np.int64), []
        for level in range(DEPTH):
            width = 1 << level
            best = np.full(width, 1e-6)
            split = [(0, np.inf, BINS + 1)] * width
            for f in range(x.shape[1]):
                key = node * (BINS + 1) + binned[:, f]
                shape = (width, BINS + 1)
                g = np.bincount(key, gradient, width * (BINS + 1)).reshape(shape).cumsum(1)
                h = np.bincount(key, hessian, width * (BINS + 1)).reshape(shape).cumsum(1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[:, len(cuts[f]) :] = 0
                at = gain.argmax(1)
                for k in range(width):
                    if gain[k, at[k]] > best[k]:
                        best[k], split[k] = gain[k, at[k]], (f, float(cuts[f][at[k]]), int(at[k]))
            nodes += [(f, cut) for f, cut, _ in split]
            bins = np.array([b for _, _, b in split])
            which = np.array([f for f, _, _ in split])
            node = 2 * node + (binned[np.arange(len(y)), which[node]] > bins[node])
        leaves = 1 << DEPTH
        value = RATE * np.bincount(node, gradient, leaves) / (np.bincount(node, hessian, leaves) + 1)
        raw = raw + value[node]
        trees.append((np.array([f for f, _ in nodes]), np.array([c for _, c in nodes]), value))
    return trees, base


def raw_scores(x: np.ndarray, trees: list, base: float) -> np.ndarray:
    out, rows = np.full(len(x), base), np.arange(len(x))
    for which, cut, value in trees:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, which[node]] > cut[node])
        out += value[node - (1 << DEPTH) + 1]
    return out


def isotonic(scores: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points between whose centres scores are interpolated."""
    blocks: list[list[float]] = []
    for s, t, w in sorted(zip(scores.tolist(), y.tolist(), weight.tolist(), strict=True)):
        blocks.append([s * w, t * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, half, texts of each class that have it), added up for a batch."""
    for batch in batches:
        toxic, half = batch.column("toxic").to_numpy(), batch.column("half").to_numpy()
        found = []
        for first, part in chunks(text_array(batch.column("text"))):
            w = words(_unmasked(part)[0], NOT_LETTER)
            for a, b, i in zip(w.bounds[:-1], w.bounds[1:], range(first, first + len(part)), strict=True):
                one = w._replace(hashes=w.hashes[a:b], starts=w.starts[a:b], ends=w.ends[a:b])
                terms = np.unique(np.concatenate(_terms(one)))
                found.append((terms, np.full(len(terms), 2 * half[i] + toxic[i], np.uint64)))
        if not found:
            continue
        terms, kind = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((kind, terms))
        terms, kind = terms[order], kind[order]
        new = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (kind[1:] != kind[:-1])))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(terms[new].view(np.int64)),
                pa.array(kind[new].astype(np.int32)),
                pa.array(np.diff(np.append(new, len(terms)))),
            ],
            ["term", "kind", "texts"],
        )


def _lexicon(table, halves: tuple[int, ...], sizes: dict) -> tuple[np.ndarray, np.ndarray]:
    toxic = sum(table[f"k{2 * h + 1}"] for h in halves)
    clean = sum(table[f"k{2 * h}"] for h in halves)
    n_toxic, n_clean = (sum(sizes.get((h, t), 0) for h in halves) for t in (1, 0))
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    good = np.flatnonzero((toxic >= LEAST_TEXTS) & (odds >= LEAST_LOG_ODDS) & (table["term"] != 0))
    good = good[np.argsort(-(toxic * odds)[good], kind="stable")[:LEXICON]]
    terms = table["term"][good].view(np.uint64)
    order = np.argsort(terms)
    return terms[order], odds[good][order]


def _feature_rows(lexicons):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = batch.column("half").to_numpy()
            for first, part in chunks(text_array(batch.column("text"))):
                # Each half is seen with the lexicon of the other, as a new text is.
                both = [features(part, *lexicons.value[1 - h]) for h in (0, 1)]
                h = half[first : first + len(part)]
                x = np.where((h == 0)[:, None], both[0], both[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, len(part)) for c in ("toxic", "half")),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                    ],
                    ["toxic", "half", "x"],
                )

    return rows


def crc_fold(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model, or the constant score if the labels have one class or none."""
    spark = docs.sparkSession
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(crc_fold(F.col("doc_id")) != 0)
    )
    by_hash = F.xxhash64("doc_id")
    chosen = usable.where("toxic = 1").orderBy(by_hash, "doc_id").limit(TOXIC_ROWS)
    chosen = chosen.union(usable.where("toxic = 0").orderBy(by_hash, "doc_id").limit(CLEAN_ROWS))
    # An id can have many rows: equal ones count once, and the bounds hold for rows as well.
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.col("text").cast("string")).alias("hash")
    )
    distinct = keyed.select("doc_id", "hash").join(F.broadcast(chosen), "doc_id").distinct()
    some = distinct.where("toxic = 1").orderBy(by_hash, "doc_id", "hash").limit(TOXIC_ROWS)
    some = some.union(distinct.where("toxic = 0").orderBy(by_hash, "doc_id", "hash").limit(CLEAN_ROWS))
    texts = (
        keyed.join(F.broadcast(some), ["doc_id", "hash"])  # TOXIC_ROWS + CLEAN_ROWS rows at most
        .dropDuplicates(["doc_id", "hash"])
        .withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
        .select("text", "toxic", "half")
    )
    kinds = [F.sum(F.when(F.col("kind") == k, F.col("texts")).otherwise(0)).alias(f"k{k}") for k in range(4)]
    terms = texts.mapInArrow(_term_rows, "term long, kind int, texts long").groupBy("term").agg(*kinds)
    # Sorted by what the lexicon is chosen by, so that the driver sees a bounded part of the terms.
    top = terms.where(f"k1 + k3 >= {LEAST_TEXTS} AND k1 + k3 > k0 + k2")
    top = top.orderBy(F.desc(F.expr("k1 + k3")), "term").limit(10 * LEXICON).toArrow()
    table = {c: top.column(c).to_numpy() for c in top.column_names}
    sizes = {(r.half, r.toxic): r.n for r in texts.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    whole = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    in_sample = {t: sum(n for (_, k), n in sizes.items() if k == t) for t in (0, 1)}
    if not in_sample[0] or not in_sample[1]:
        return float(bool(in_sample[1]))
    lexicons = spark.sparkContext.broadcast([_lexicon(table, (h,), sizes) for h in (0, 1)])
    rows = texts.mapInArrow(_feature_rows(lexicons), "toxic int, half int, x binary").toArrow()
    y, half = (rows.column(c).to_numpy() for c in ("toxic", "half"))
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(len(y), -1)
    order = np.lexsort((*x.T, half, y))  # the fit depends on the rows alone, not on the tasks
    x, y, half = x[order], y[order].astype(np.float64), half[order]
    weight = np.where(y == 1, whole[1] / in_sample[1], whole[0] / in_sample[0])
    trees, base = grow(x, y, weight)
    # Calibrated on scores of trees that did not see the rows.
    outside = np.zeros(len(y))
    folds = np.arange(len(y)) % 3
    for fold in range(3):
        seen = folds != fold
        if 0 < y[seen].sum() < seen.sum():
            outside[~seen] = raw_scores(x[~seen], *grow(x[seen], y[seen], weight[seen]))
    points = isotonic(outside, y, weight)
    return Model(*_lexicon(table, (0, 1), sizes), trees, base, *points)


def _scored(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            out = [np.zeros(0)]
            for _, part in chunks(text_array(batch.column("text"))):
                raw = raw_scores(features(part, m.lexicon, m.weights), m.trees, m.base)
                # A thousandth of the plain probability keeps an order inside the flat parts.
                out.append(0.999 * np.interp(raw, m.x, m.y) + 0.001 / (1 + np.exp(-raw)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(out))], ["doc_id", "score"])

    return rows


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from a score of 0.5).

    Labels are learnt from rows whose crc32(doc_id as text) mod 5 is not 0; a document labelled twice is
    toxic if one label says so, other label values and rows without id are left out. A null text is an
    empty one, and gets a score too. Without both classes among the labels every score is 0, or 1 if all
    are toxic. Repeated rows score alike; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(rows, labels)
    if isinstance(model, float):
        scored = rows.select("doc_id", F.lit(model).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        scored = rows.mapInArrow(_scored(shared), "doc_id long, score double")
    return scored.select(
        "doc_id",
        (crc_fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
