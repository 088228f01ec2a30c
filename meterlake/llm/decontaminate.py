"""Benchmark decontamination by winnowing.

Of every window of nine 5-word runs the least hash is a fingerprint, so that any 13 shared words share
one. Documents and benchmark items are joined on fingerprints; a filter of fixed size keeps the rest of
the documents' fingerprints out of the shuffle. Each hit fixes a diagonal (position in the document less
position in the item), along which words are compared: a stretch of 13 equal words is an occurrence. An
item of fewer words is one fingerprint, and occurs as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.bits import BITS, bit_filter, has
from meterlake.llm.shared import stored
from meterlake.llm.text import SYMBOL, chunks, minima, runs, text_array, words

SPAN, GRAM = 13, 5
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _fingerprints(column, short: list[int], whole: bool):
    """Per chunk: first row, words per text, and (text, position, hash) of the fingerprints.

    ``short`` are lengths below SPAN of which each run counts; with ``whole``, only the runs that are the
    whole text.
    """
    for first, part in chunks(text_array(column)):
        w = words(part, SYMBOL)
        counts = np.diff(w.bounds)
        text = np.repeat(np.arange(len(part)), counts)
        found = [minima(w.hashes, w.bounds, GRAM, SPAN - GRAM + 1)]
        for size in short:
            grams = runs(w.hashes, size)
            at = np.arange(len(grams))
            inside = at + size <= w.bounds[text[: len(grams)] + 1]
            if whole:
                inside &= counts[text[: len(grams)]] == size
            found.append((at[inside], grams[inside]))
        at = np.concatenate([a for a, _ in found])
        yield first, counts, text[at], at - w.bounds[text[at]], np.concatenate([h for _, h in found])


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, _, text, at, hashes in _fingerprints(batch.column("text"), list(range(1, SPAN)), True):
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(first + text)), pa.array(hashes.view(np.int64)), pa.array(at)],
                ["item", "hash", "at"],
            )


def _document_rows(present, short):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = present.value
        for batch in batches:
            for first, counts, text, at, hashes in _fingerprints(batch.column("text"), short, False):
                hit = has(seen, hashes)
                text, at, hashes = text[hit], at[hit], hashes[hit]
                order = np.argsort(text, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(counts)))])
                pairs = pa.StructArray.from_arrays(
                    [pa.array(hashes[order].view(np.int64)), pa.array(at[order])], ["hash", "at"]
                )
                # Only documents with hits carry their text on.
                rows_hit = pa.array(first + np.arange(len(counts)), mask=np.diff(ends) == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(counts)),
                        batch.column("row_text").slice(first, len(counts)),
                        batch.column("text").take(rows_hit),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                    ],
                    ["doc_id", "row_text", "text", "n_words", "hits"],
                )

    return rows


def _spans(document: np.ndarray, item: np.ndarray, diagonals) -> list[tuple[int, int]]:
    need, found = min(SPAN, len(item)), []
    for d in diagonals:
        low, high = max(0, d), min(len(document), d + len(item))
        if high - low < need:
            continue
        same = np.concatenate([[0], document[low:high] == item[low - d : high - d], [0]]).astype(np.int8)
        edges = np.diff(same)
        for a, b in zip(np.flatnonzero(edges > 0), np.flatnonzero(edges < 0), strict=True):
            if b - a >= need:
                found.append((low + int(a), low + int(b)))
    return found


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact occurrences from the diagonals: hit words, items and spans of each document."""
    for batch in batches:
        hit, names, spans = [], [], []
        for row in batch.select(["text", "candidates"]).to_pylist():
            codes: dict[str, int] = {}

            def coded(text, codes=codes):
                found = _WORD.findall(text.translate(_LOWER))
                return np.array([codes.setdefault(w, len(codes)) for w in found], np.int64)

            document, mask, items, where = coded(row["text"]), None, set(), set()
            mask = np.zeros(len(document), bool)
            for c in row["candidates"]:
                if got := _spans(document, coded(c["item_text"]), c["diagonals"]):
                    items.add(c["item"])
                    where.update(got)
            for a, b in where:
                mask[a:b] = True
            hit.append(int(mask.sum()))
            names.append(sorted(items))
            spans.append([{"start": a, "stop": b} for a, b in sorted(where)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(hit, pa.int64()),
                pa.array(names, pa.list_(pa.string())),
                pa.array(spans, span),
            ],
            ["row", "n_hit", "items", "spans"],
        )


def contamination(docs: DataFrame, benchmark: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, row_text, n_words, n_hit, items (ids with an occurrence, sorted), spans, contaminated.

    Words are runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z; a null text has
    none. Spans are half-open word positions; ``row_text`` is a hash of the text. A benchmark item without words occurs nowhere, one without
    id counts as the empty id, and repeated items count once. Rows that repeat a doc_id are judged one by
    one. Other columns of either table are not read; empty tables give no rows or no hits.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    marks = items.select(F.sha2("text", 256).alias("item_key"), "item", "text")
    prints = stored(
        marks.select(F.concat_ws(":", "item_key", "item").alias("item"), "text").mapInArrow(
            _item_rows, "item string, hash long, at long"
        ),
        "item-fingerprints",
    )
    spark = docs.sparkSession
    present = spark.sparkContext.broadcast(bit_filter(prints, "hash", bits))
    words_of_short = F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")))
    lengths = items.select(words_of_short.alias("n")).where(f"n BETWEEN 1 AND {SPAN - 1}").distinct()
    short = sorted(r.n for r in lengths.collect())  # twelve at most
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row_text"),
            F.col("text").cast("string").alias("text"),
        )
        .mapInArrow(
            _document_rows(present, short),
            "doc_id long, row_text long, text string, n_words long, hits array<struct<hash: long, at: long>>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "document-fingerprints",
    )
    diagonals = (
        rows.where(F.size("hits") > 0)
        .select("row", F.inline("hits"))
        .withColumnRenamed("at", "document_at")
        .join(prints, "hash")
        .groupBy("row", "item")
        .agg(F.collect_set(F.col("document_at") - F.col("at")).alias("diagonals"))
    )
    texts = marks.select(
        F.concat_ws(":", "item_key", "item").alias("key"), F.col("item"), F.col("text").alias("item_text")
    )
    candidates = (
        diagonals.withColumnRenamed("item", "key")
        .join(texts, "key")
        .groupBy("row")
        .agg(F.collect_list(F.struct("item", "item_text", "diagonals")).alias("candidates"))
    )
    judged = candidates.join(rows.select("row", "text"), "row").mapInArrow(
        _extended,
        "row long, n_hit long, items array<string>, spans array<struct<start: long, stop: long>>",
    )
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (
        rows.select("row", "doc_id", "row_text", "n_words")
        .join(judged, "row", "left")
        .select(
            "doc_id",
            "row_text",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start: bigint, stop: bigint>>")).alias("spans"),
            ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
        )
    )
