"""Phrase mining by prefix-free parsing.

Texts are cut into pieces at punctuation, and pieces into overlapping chunks: a window of OVERLAP words
whose hash says so (the content alone decides) ends one chunk and begins the next. Equal chunks meet in a
dictionary with the number of their occurrences, and phrases are counted inside the distinct chunks, each
weighted by that number. A phrase of at most OVERLAP + 1 words that begins in a chunk before its last window
lies wholly in it, and what begins in that window belongs to the next chunk, so every occurrence is counted
once. A stretch of LONGEST words without such a window is cut there.

Phrases are counted by length: one of n words is only counted where both its parts of n - 1 words are
frequent, by a filter of fixed size that lets no frequent part fail. All sums, joins and ranks are Spark's; a
hot phrase is summed in each task before it is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.bits import bit_filter, has
from meterlake.llm.shared import stored
from meterlake.llm.text import BASE, chunks, gathered, mixed, pieces_of, runs, strings, text_array, words

#: Pieces end at ``[.,;:!?\x0A-\x0D]``; words are ``[^\x20\x09]+`` inside them.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09]] = True
NO_LANGUAGE = "und"
WORDS, LEAST, FIRST = 5, 100, 2000
OVERLAP = WORDS - 1
#: One window of OVERLAP words in this many ends a chunk.
ONE_IN = 16
#: Words of a chunk, without its overlap, at most.
LONGEST = 64
#: Bits of the filters (8 MB).
FILTER_BITS = 26


def _cuts(hashes: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """First words of the chunks, in order."""
    n = len(hashes)
    starts = np.ones(n, bool)
    starts[1:] = piece[1:] != piece[:-1]
    windows = runs(hashes, OVERLAP)
    inside = piece[: len(windows)] == piece[n - len(windows) :]
    starts[: len(windows)] |= inside & (windows % np.uint64(ONE_IN) == 0)
    first = np.flatnonzero(starts)
    more = (np.diff(np.append(first, n)) - 1) // LONGEST
    nth = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
    return np.sort(np.concatenate([first, np.repeat(first, more) + (nth + 1) * LONGEST]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, own, chunk): its words joined by one space; phrases are counted from the first ``own`` of them."""
    for batch in batches:
        langs = batch.column("lang")
        for row, part in chunks(text_array(batch.column("text"))):
            w = words(part, BLANKS | ENDS)
            n = len(w.hashes)
            if not n:
                continue
            text = np.repeat(np.arange(len(part)), np.diff(w.bounds))
            ends = np.cumsum(ENDS[w.data])[w.starts]
            new = np.ones(n, bool)
            new[1:] = (text[1:] != text[:-1]) | (ends[1:] != ends[:-1])
            piece = np.cumsum(new)
            first = _cuts(w.hashes, piece)
            piece_end = np.append(np.flatnonzero(new)[1:], n)[piece[first] - 1]
            following = np.append(first[1:], n)
            last = np.where(following < piece_end, np.minimum(following + OVERLAP, piece_end), piece_end)
            own = np.minimum(following, piece_end) - first
            # All words once, each with one space behind it; then the chunks out of them.
            lengths = w.ends - w.starts
            body, edges = pieces_of(w.data, w.starts, lengths)
            spaced = np.full(len(body) + n, 0x20, np.uint8)
            spaced[np.arange(len(body)) + np.repeat(np.arange(n), lengths)] = body
            begin = edges + np.arange(n + 1)
            found = strings(*pieces_of(spaced, begin[first], begin[last] - 1 - begin[first]))
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(text[first] + row)), pa.array(own.astype(np.int32)), found], ["lang", "own", "chunk"]
            )


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, own, chunk, n) of the distinct chunks of all texts, stored. A missing language is ``und``."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    rows = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))
    parsed = rows.mapInArrow(_parse, "lang string, own int, chunk string")
    return stored(parsed.groupBy("lang", "own", "chunk").agg(F.count(F.lit(1)).alias("n")), "phrase-chunks")


def _language(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _counter(size: int, frequent: np.ndarray | None):
    """Phrases of ``size`` words with their weight in a batch, where the filter has both their parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            langs = batch.column("lang").dictionary_encode()
            seeds = np.array([_language(x) for x in langs.dictionary.to_pylist()], np.uint64)
            codes = langs.indices.to_numpy().astype(np.int64)
            own, weights = batch.column("own").to_numpy(), batch.column("n").to_numpy()
            for row, part in chunks(text_array(batch.column("chunk"))):
                w = words(part, BLANKS)
                chunk = np.repeat(np.arange(len(part)), np.diff(w.bounds))
                nth = np.arange(len(w.hashes)) - w.bounds[chunk]
                at = np.flatnonzero(
                    (nth < own[chunk + row]) & (np.arange(len(w.hashes)) + size <= w.bounds[chunk + 1])
                )
                seed = seeds[codes[chunk[at] + row]]
                if frequent is not None:
                    parts = runs(w.hashes, size - 1)
                    good = has(frequent, mixed(parts[at] + seed)) & has(frequent, mixed(parts[at + 1] + seed))
                    at, seed = at[good], seed[good]
                if not len(at):
                    continue
                key = mixed(runs(w.hashes, size)[at] + seed)
                order = np.argsort(key, kind="stable")
                new = np.append(True, key[order][1:] != key[order][:-1])
                total = np.add.reduceat(weights[chunk[at[order]] + row], np.flatnonzero(new))
                one = at[order[new]]
                lengths = w.ends[one + size - 1] - w.starts[one]
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(codes[chunk[one] + row])),
                        pa.array(key[order[new]].view(np.int64)),
                        strings(*pieces_of(w.data, w.starts[one], lengths)),
                        pa.array(total),
                    ],
                    ["lang", "key", "phrase", "a"],
                )

    return work


def frequent_phrases(chunk_table: DataFrame, most: int = WORDS, least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, a): phrases of 1 to ``most`` words (WORDS at most) that occur ``least`` times or more."""
    spark, levels, known = chunk_table.sparkSession, [], None
    for size in range(1, most + 1):
        counted = chunk_table.mapInArrow(_counter(size, known), "lang string, key long, phrase string, a long")
        level = counted.groupBy("lang", "key", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
        level = stored(level.withColumn("size", F.lit(size)), f"phrases-{size}")
        levels.append(level.select("lang", "phrase", "size", "a"))
        if size < most:
            known = bit_filter(level, "key", FILTER_BITS)
            if not known.any():
                break
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _cut_scores(candidates: DataFrame, frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut: (lang, phrase, size, a, n, l, r, score)."""
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "size", "a", k).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    first = frequent.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = frequent.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    parts = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    # Products of up to 38 digits, divided exactly.
    exact = {c: f"CAST({c} AS DECIMAL(19,0))" for c in "anlr"}
    score = F.expr(f"(CAST(1000 AS DECIMAL(19,0)) * {exact['a']} * {exact['n']}) div ({exact['l']} * {exact['r']})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return parts.groupBy("lang", "phrase", "size", "a", "n").agg(lowest).select(
        "lang", "phrase", "size", "a", "n", "cut.l", "cut.r", "cut.score"
    )


def _covered(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, a) that lie in a candidate as frequent: one word longer is enough to look at, as a phrase
    in between is as frequent as both."""
    longer = candidates.where("size > 2")
    head = F.expr("substring_index(phrase, ' ', size - 1)")
    tail = F.expr("substring_index(phrase, ' ', 1 - size)")
    return longer.select("lang", "a", F.explode(F.array(head, tail)).alias("phrase"))


def collocations(docs: DataFrame, first: int = FIRST, least: int = LEAST, most: int = WORDS) -> DataFrame:
    """Each language's best phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts in lower case (A-Z only) are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
    ``[^\\x20\\x09]+``. ``n`` counts all words of the language (null: ``und``), ``a`` all occurrences of the phrase
    inside pieces, overlaps included. Candidates have 2 to ``most`` words and ``a >= least``; the cut into ``l``
    and ``r`` occurrences with the smallest floor(1000 a n / (l r)) counts, of equal ones the earliest. A candidate
    that lies in a longer one as frequent is dropped. Order: score and ``a`` descending, phrase ascending by
    bytes. Null and empty texts have no words; repeated rows count each time; an empty table gives no rows.
    """
    if not 2 <= most <= WORDS:
        raise ValueError(f"phrases of 2 to {WORDS} words are counted")
    table = dictionary(docs)
    totals = table.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
    frequent = frequent_phrases(table, most, least)
    candidates = frequent.where("size > 1")
    scored = _cut_scores(candidates, frequent, totals).join(_covered(candidates), ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
