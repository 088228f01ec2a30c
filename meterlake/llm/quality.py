"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, as perplexity thresholds.

Texts are read as symbols: code points, but for digits (all alike), a capital that begins a word (as the small
letter), capitals inside words (all alike), and a word that repeats the word before it (a symbol of its own).
The model is over runs of four symbols of the trusted texts. Its counts, continuation counts, contexts and
probabilities are tables that Spark groups and joins by the hash of the run, so they grow with the trusted text.

A run that the model lacks backs off to the shorter one, at the weight of its context. Up to a proven size the
model is sent to the tasks. Beyond it documents are dealt into batches, whose runs, each once, are joined with the
model; the answers go back to the batch, which adds up its documents. A document stays if its perplexity is at
most a high quantile of the trusted documents of its language, with a margin.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.bits import bit_filter, has
from meterlake.llm.shared import discard, stored
from meterlake.llm.text import BLANK, SAME, chunks, mixed, text_array, words

ORDER = 4
#: One trusted document in so many is never learnt from: the thresholds are from all of these. The model learns from
#: all others.
SPARE = 5
#: The threshold is MARGIN times this quantile of the perplexities of the trusted documents of a
#: language that were not learnt from.
QUANTILE, MARGIN = 0.995, 1.05
#: A document's mean counts as if PRIOR more symbols had the mean of the trusted text, so that a few words
#: are not taken for noise.
PRIOR = 40
#: A language with fewer trusted documents takes the threshold of all languages.
LEAST_TRUSTED = 50
#: Rows of a model that is sent to tasks whole (64 MB); a larger one is joined with batches of documents.
TABLE_ROWS = 4_000_000
#: Bytes of text in such a batch, about.
BATCH = 1 << 24
#: Bytes of text whose runs a task holds at a time; a byte takes more than a hundred there.
PART = 1 << 19

BEGIN, REPEAT, CAPITAL, DIGIT = 0x02, 0xF8FF, ord("A"), ord("0")


def _small() -> np.ndarray:
    """The small letter of each code point below 2**16, itself if there is none or more than one."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        low = chr(i).lower()
        if len(low) == 1 and not 0xD800 <= i < 0xE000:
            table[i] = ord(low)
    return table


SMALL = _small()
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CONTEXT = np.uint64(0x5851F42D4C957F2D)


def symbols(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first symbol of each text and the end) of texts from ``text_array``."""
    w = words(part, BLANK, SAME)
    edges = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
    raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    keep = np.ones(len(raw), bool)
    again = np.zeros(len(w.hashes), bool)
    if len(w.hashes) > 1:
        again[1:] = w.hashes[1:] == w.hashes[:-1]
        again[w.bounds[:-1][w.bounds[:-1] < len(again)]] = False
    if again.any():
        # The blanks before the word and all but its first byte go.
        change = np.zeros(len(raw) + 1, np.int32)
        np.add.at(change, w.ends[np.flatnonzero(again) - 1], 1)
        np.subtract.at(change, w.starts[again], 1)
        np.add.at(change, w.starts[again] + 1, 1)
        np.subtract.at(change, w.ends[again], 1)
        keep = np.cumsum(change[:-1]) == 0
    # A code point for each byte that begins one.
    begins = (raw & 0xC0) != 0x80
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    place = np.cumsum(begins) - 1
    first_of_again = place[w.starts[again]] if again.any() else np.zeros(0, np.int64)
    whole = points < len(SMALL)
    small = points.copy()
    small[whole] = SMALL[points[whole]]
    capital = small != points
    letter = capital | (small >= 0xAA) | ((small >= 97) & (small <= 122))
    inside = np.zeros(len(points), bool)
    inside[1:] = letter[:-1]
    starts = np.cumsum(np.concatenate([[0], begins]))[edges]  # first code point of each text
    inside[starts[:-1][starts[:-1] < len(points)]] = False
    out = np.where(capital & inside, CAPITAL, small)
    out[(points >= 48) & (points <= 57)] = DIGIT
    out[first_of_again] = REPEAT
    stays = keep[begins]
    return out[stays], np.concatenate([[0], np.cumsum(stays)])[starts]


def _grams(s: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """For each order from 1, the hash of the run of symbols that ends at each symbol; BEGIN stands before a text."""
    since = np.arange(len(s)) - np.repeat(edges[:-1], np.diff(edges))
    total = s.astype(np.uint64) + np.uint64(1)
    out = [mixed(total ^ np.uint64(1))]
    for back in range(1, ORDER):
        before = np.concatenate([np.full(min(back, len(s)), BEGIN, np.uint32), s[:-back]])[: len(s)]
        before = np.where(since >= back, before, BEGIN).astype(np.uint64) + np.uint64(1)
        total = total + before * (_ODD ** np.uint64(back))
        out.append(mixed(total ^ np.uint64(back + 1)))
    return out


def _contexts(s: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """For each order from 2, the hash of the symbols before each symbol."""
    since = np.arange(len(s)) - np.repeat(edges[:-1], np.diff(edges))
    total, out = np.zeros(len(s), np.uint64), []
    for back in range(1, ORDER):
        before = np.concatenate([np.full(min(back, len(s)), BEGIN, np.uint32), s[:-back]])[: len(s)]
        before = np.where(since >= back, before, BEGIN).astype(np.uint64) + np.uint64(1)
        total = total + before * (_ODD ** np.uint64(back))
        out.append(mixed(mixed(total) ^ _CONTEXT ^ np.uint64(back)))
    return out


_KEYS = [f"g{n}" for n in range(1, ORDER + 1)] + [f"c{n}" for n in range(2, ORDER + 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of the texts, with the shorter ones at their ends and their contexts, and how often they occur."""
    for batch in batches:
        for _, part in chunks(text_array(batch.column("text")), PART):
            s, edges = symbols(part)
            if not len(s):
                continue
            keys = [*_grams(s, edges), *_contexts(s, edges)]
            _, first, n = np.unique(keys[ORDER - 1], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k[first].view(np.int64)) for k in keys), pa.array(n.astype(np.int64))], [*_KEYS, "n"]
            )


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts of an order, from the numbers of runs with counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
    steps = [1 - 2 * y * n[1] / n[0] if n[0] else 0.5, 2 - 3 * y * n[2] / n[1] if n[1] else 1.0]
    steps.append(3 - 4 * y * n[3] / n[2] if n[2] else 1.5)
    return tuple(min(max(d, 0.05), i + 0.9) for i, d in enumerate(steps))


class Model(NamedTuple):
    """(key, value): log10 probabilities of runs and weights of contexts; the mean of the trusted text; that of an
    unknown symbol."""

    table: DataFrame
    rows: int
    usual: float
    unknown: float


def train(texts: DataFrame) -> Model | None:
    """The model of a column ``text``, or None without any symbol. Everything but a few sums stays in tables."""
    counts = texts.mapInArrow(_counted, ", ".join(f"{k} long" for k in _KEYS) + ", n long")
    others = [k for k in _KEYS if k != f"g{ORDER}"]
    longest = counts.groupBy(f"g{ORDER}").agg(F.sum("n").alias("n"), *(F.first(k).alias(k) for k in others))
    levels = {ORDER: stored(longest, "runs")}
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: in how many longer runs a run stands last.
        keep = [k for k in _KEYS if k != f"g{order}" and int(k[1]) < order + (k[0] == "c")]
        rows = levels[order + 1].groupBy(f"g{order}")
        levels[order] = stored(rows.agg(F.count(F.lit(1)).alias("n"), *(F.first(k).alias(k) for k in keep)), "runs")
    tables, below = [], None
    for order in range(1, ORDER + 1):
        rows = levels[order]
        tells = [F.count(F.when(F.col("n") == i, 1)) for i in (1, 2, 3, 4)]
        found = rows.agg(*(t.alias(f"n{i}") for i, t in enumerate(tells)), F.count(F.lit(1)).alias("all")).first()
        if not found["all"]:
            return None
        d1, d2, d3 = _discounts(list(found)[:4])
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        context: Column = F.col(f"c{order}") if order > 1 else F.lit(0).cast("long")
        sums = rows.select(context.alias("context"), "n", discount.alias("d")).groupBy("context").agg(
            F.sum("n").alias("total"), F.sum("d").alias("left")
        )
        contexts = sums.select("context", "total", (F.col("left") / F.col("total")).alias("weight"))
        held = rows.withColumn("context", context).join(contexts, "context")
        if order == 1:
            lower = F.lit(1.0 / (found["all"] + 1))
        else:
            held = held.join(below.select(F.col("key").alias(f"g{order - 1}"), F.col("p").alias("lower")), f"g{order - 1}")
            lower = F.col("lower")
        seen = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")
        below = stored(
            held.select(F.col(f"g{order}").alias("key"), (seen + F.col("weight") * lower).alias("p"), "n"), "probabilities"
        )
        tables.append(below.select("key", F.log10("p").alias("value")))
        if order > 1:
            tables.append(contexts.select(F.col("context").alias("key"), F.log10("weight").alias("value")))
        else:
            unknown = float(np.log10(contexts.first()["weight"] / (found["all"] + 1)))
    usual = below.agg((F.sum(F.col("n") * F.log10("p")) / F.sum("n")).alias("mean")).first()["mean"]
    table = tables[0]
    for other in tables[1:]:
        table = table.unionByName(other)
    table = stored(table, "model")
    model = Model(table, table.count(), float(usual), unknown)
    discard(*levels.values())
    return model


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, key): the runs and contexts of the texts of each batch, about once each."""
    held: dict[int, list[np.ndarray]] = {}

    def out(of: int) -> pa.RecordBatch:
        keys = np.unique(np.concatenate(held.pop(of)))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), of)), pa.array(keys.view(np.int64))], ["batch", "key"])

    for batch in batches:
        of = batch.column("batch").to_numpy()
        texts = text_array(batch.column("text"))
        for number in np.unique(of).tolist():
            here = texts.filter(pa.array(of == number))
            for _, part in chunks(here, PART):
                s, edges = symbols(part)
                if not len(s):
                    continue
                keys = [*_grams(s, edges), *_contexts(s, edges)]
                # What belongs to each longest run, once for each of these.
                _, first = np.unique(keys[ORDER - 1], return_index=True)
                parts = held.setdefault(number, [])
                parts.append(np.unique(np.concatenate([k[first] for k in keys])))
                if sum(map(len, parts)) > 1 << 21:
                    held[number] = [np.unique(np.concatenate(parts))]
    for number in list(held):
        yield out(number)


def _perplexity(part: pa.Array, keys: np.ndarray, values: np.ndarray, usual: float, unknown: float) -> np.ndarray:
    """The perplexities of some texts; ``keys`` are in order."""

    def find(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, values[at]

    s, edges = symbols(part)
    if not len(s):
        return np.full(len(part), 10.0**-usual)
    grams, contexts = _grams(s, edges), _contexts(s, edges)
    _, first, back = np.unique(grams[ORDER - 1], return_index=True, return_inverse=True)
    total, left = np.zeros(len(first)), np.arange(len(first))
    for order in range(ORDER, 0, -1):
        known, value = find(grams[order - 1][first[left]])
        total[left[known]] += value[known]
        left = left[~known]
        if order > 1 and len(left):
            some, weight = find(contexts[order - 2][first[left]])
            total[left[some]] += weight[some]
    total[left] += unknown
    sums = np.concatenate([[0.0], np.cumsum(total[back])])
    length = np.diff(edges)
    return 10.0 ** -((sums[edges[1:]] - sums[edges[:-1]] + PRIOR * usual) / (length + PRIOR))


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys.view(np.uint64))
    return keys.view(np.uint64)[order], values[order]


def _by_table(model, usual: float, unknown: float, names: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = model.value
        for batch in batches:
            parts = chunks(text_array(batch.column("text")), PART)
            found = [_perplexity(part, keys, values, usual, unknown) for _, part in parts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(np.concatenate([np.zeros(0), *found]))], [*names, "perplexity"]
            )

    return work


def _by_answers(usual: float, unknown: float):
    def work(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys, values = _sorted(answers.column("key").to_numpy(), answers.column("value").to_numpy())
        parts = chunks(text_array(texts.column("text")), PART)
        found = [_perplexity(part, keys, values, usual, unknown) for _, part in parts]
        return pa.table([texts.column("h1"), texts.column("h2"), pa.array(np.concatenate([np.zeros(0), *found]))],
                        names=["h1", "h2", "perplexity"])

    return work


def perplexities(rows: DataFrame, model: Model, table_rows: int = TABLE_ROWS, batch: int = BATCH) -> DataFrame:
    """``rows`` without ``text`` and with its ``perplexity`` under the model.

    A model of up to ``table_rows`` rows (which bounds its bytes) is sent to the tasks. A larger one is joined: texts are reduced to
    distinct ones and dealt into batches of about ``batch`` bytes; each asks for its runs and contexts, each once, and
    adds up its texts from the answers, which then meet their rows again.
    """
    spark, names = rows.sparkSession, [c for c in rows.columns if c != "text"]
    if model.rows <= table_rows:
        table = model.table.toPandas()
        sent = spark.sparkContext.broadcast(_sorted(table["key"].to_numpy(), table["value"].to_numpy()))
        schema = rows.select(*names).schema.add("perplexity", "double")
        return rows.mapInArrow(_by_table(sent, model.usual, model.unknown, names), schema)
    marks = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")}
    texts = stored(rows.select("text").withColumns(marks).groupBy("h1", "h2").agg(F.first("text").alias("text")), "texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = texts.withColumn("batch", F.pmod("h1", F.lit(max(1, -(-size // batch))))).repartition("batch")
    wanted = dealt.select("batch", "text").mapInArrow(_wanted, "batch long, key long").distinct()
    answers = wanted.join(model.table, "key").select("batch", "key", "value")
    found = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _by_answers(model.usual, model.unknown), "h1 long, h2 long, perplexity double"
    )
    return rows.withColumns(marks).join(found, ["h1", "h2"]).select(*names, "perplexity")


def _trusted(labels: DataFrame) -> DataFrame:
    """(doc_id, spare): ids whose labels all say quality 1; spare ones are kept from training."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality"))
    whole = ids.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    return whole.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(SPARE)) == 0).alias("spare"))


def _maybe_trusted(known):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(has(known.value, batch.column("hash").to_numpy())))

    return rows


def _trusted_texts(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """(lang, text, spare) of all rows with trusted ids. Few others are shuffled, at any number of ids."""
    hashed = F.xxhash64("doc_id").alias("hash")
    known = rows.sparkSession.sparkContext.broadcast(bit_filter(trusted.select(hashed), "hash"))
    some = rows.select("doc_id", "lang", "text", hashed).mapInArrow(
        _maybe_trusted(known), "doc_id long, lang string, text string, hash long"
    )
    return some.join(trusted.hint("merge"), "doc_id").select("lang", "text", "spare")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, perplexity, threshold, keep, and ``rest``, all columns as a struct.

    A null or empty text has the mean perplexity of trusted text and stays. A null language is a language of its
    own. Trusted documents are those whose labels all say quality 1; rows without doc_id are never trusted. Without
    trusted text perplexities are null and all rows stay. Repeated rows are judged alike; extra columns
    only travel in ``rest``.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"),
    )
    texts = stored(_trusted_texts(rows, _trusted(labels)), "trusted")
    model = train(texts.where("NOT spare").select("text"))
    if model is None:
        discard(texts)
        null = F.lit(None).cast("double")
        return rows.select("doc_id", "lang", null.alias("perplexity"), null.alias("threshold"), F.lit(True).alias("keep"), "rest")
    # Texts that were learnt from look too good; they count only where there are no others.
    for some in ("spare", "NOT spare"):
        measured = stored(perplexities(texts.where(some).select("lang", "text"), model), "perplexities")
        over_all = measured.agg(F.percentile_approx("perplexity", QUANTILE, 10_000) * MARGIN).first()[0]
        if over_all is not None:
            break
    discard(texts)
    limits = (
        measured.groupBy("lang")
        .agg((F.percentile_approx("perplexity", QUANTILE, 10_000) * MARGIN).alias("own"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= LEAST_TRUSTED)
        .select(F.col("lang").alias("of"), "own")
    )
    threshold = F.coalesce("own", F.lit(over_all))
    return (
        perplexities(rows, model)
        .join(limits, F.col("lang").eqNullSafe(F.col("of")), "left")
        .select(
            "doc_id",
            "lang",
            "perplexity",
            threshold.alias("threshold"),
            (threshold.isNull() | (F.col("perplexity") <= threshold)).alias("keep"),
            "rest",
        )
    )
