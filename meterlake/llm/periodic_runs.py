"""Periodic runs of words, found by recursive frequency splitting and lag scans.

A run is a stretch of words with smallest period q (words q apart are the same), of at least ``least``
words and two periods, that no neighbour extends. Its words from q before the end on have been met q
words earlier, so at least half of ``least`` neighbours in a row occur again at distance q, and every
word of the run is in such a row. The search works on all texts of a batch at once:

* Splitting: a word none of whose rows of that many words occurs twice in its segment is too rare to
  join a run, and splits the segment. The parts are counted anew, each for itself, until they are stable.
* Lags below 16: each surviving segment is compared with itself, moved by the lag.
* Lags from Q to 2Q: a match of Q words holds a whole aligned block of Q/2 words. The block's other
  places come from the sorted names of all stretches of Q/2 words (equal stretches have equal names,
  made by doubling), and both are extended to the left and right by names of halving length. So the work
  is about n log n for each doubling of the lag, also for a text that is one word repeated.

Each text is handled where its row is: there is no shuffle, and a lost executor repeats its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from meterlake.llm.text import BASE, BLANK, SAME, chunks, mixed, pieces_of, runs, strings, text_array, words

LEAST = 12
#: Lags below this are scanned one by one.
DIRECT = 16
#: Bytes of text worked on at a time.
AT_ONCE = 1 << 20
RUNS = ArrayType(StructType().add("start", "long").add("length", "long").add("period", "long"))


def _split(hashes: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, segment numbers) of the words that may be in runs, in order.

    The rounds end when one takes away less than a hundredth of the words: what is left is scanned.
    """
    size = (least + 1) // 2
    at = np.arange(len(hashes))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    grams = runs(hashes, size)
    while len(at) >= least:
        first = np.flatnonzero(segment[: 1 - size] == segment[size - 1 :]) if size > 1 else np.arange(len(at))
        key = mixed(grams[at[first]] + segment[first].astype(np.uint64) * BASE)
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(first), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        marks = np.zeros(len(at) + 1, np.int64)
        marks[first[twice]] += 1
        np.subtract.at(marks, first[twice] + size, 1)
        stays = np.cumsum(marks[:-1]) > 0
        before = len(at)
        at, segment = at[stays], segment[stays]
        if not len(at):
            break
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(segment) != 0)
        segment = np.cumsum(new) - 1
        long = np.bincount(segment)[segment] >= least
        at, segment = at[long], segment[long]
        if before - len(at) < max(1, before // 100):
            break
    return (at, segment) if len(at) >= least else (at[:0], segment[:0])


def _direct(x: np.ndarray, segment: np.ndarray, least: int) -> Iterator[tuple]:
    """(starts, ends, periods) of the stretches with a period below DIRECT."""
    for lag in range(1, min(DIRECT, len(x))):
        same = np.zeros(len(x) - lag + 2, bool)
        same[1:-1] = (x[lag:] == x[:-lag]) & (segment[lag:] == segment[:-lag])
        edges = np.flatnonzero(same[1:] != same[:-1])
        begin, end = edges[::2], edges[1::2]
        enough = end - begin >= max(least - lag, lag)
        yield begin[enough], end[enough] + lag, np.full(int(enough.sum()), lag)


class _Names:
    """Names of all stretches of 1, 2, 4, ... words inside segments; a stretch that leaves its segment has its own."""

    def __init__(self, x: np.ndarray, segment: np.ndarray):
        self.n = n = len(x)
        self.segment = segment
        self.begin = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        ends = np.append(self.begin[1:], n)
        self.end = np.repeat(ends, ends - self.begin)
        self.first = np.repeat(self.begin, ends - self.begin)
        self.alone = (-1 - np.arange(n)).astype(np.int64)
        self.levels = [np.unique(x, return_inverse=True)[1].astype(np.int64)]
        longest = int((ends - self.begin).max())
        while 2 << len(self.levels) <= 2 * longest and 1 << len(self.levels) <= longest:
            half, old = 1 << (len(self.levels) - 1), self.levels[-1]
            inside = np.flatnonzero(np.arange(n) + 2 * half <= self.end)
            names = self.alone.copy()
            names[inside] = np.unique(old[inside] * n + old[inside + half], return_inverse=True)[1]
            self.levels.append(names)

    def extend(self, anchor: np.ndarray, at: np.ndarray, lag: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``at`` on (or before it) are the same as ``lag`` words later, in the anchor's segment."""
        reach = np.zeros(len(at), np.int64)
        first, last = self.first[anchor], self.end[anchor] - lag
        for level in reversed(range(len(self.levels))):
            size, names = 1 << level, self.levels[level]
            here = at + reach if forward else at - reach - size
            fits = here + size <= last if forward else here >= first
            low = np.where(fits, here, 0)
            reach += np.where(fits & (names[low] == names[np.where(fits, here + lag, 0)]), size, 0)
        return reach


def _smallest(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each stretch once, with its smallest period (the others are multiples), by start and end."""
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return begin[new], end[new], period[new]


def _doubling(x: np.ndarray, segment: np.ndarray, known: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """``known`` and the stretches with a period of DIRECT or more; (starts, ends, periods).

    A block that has two periods of a known run inside occurs in that run only at multiples of its period,
    which give the run once more; so its other places are looked for behind the run.
    """
    names, least_lag = _Names(x, segment), DIRECT
    n, place = names.n, np.arange(names.n)
    while 2 * least_lag <= int((names.end - names.first).max()):
        block = least_lag // 2
        level = names.levels[block.bit_length() - 1]
        inside = np.flatnonzero(place + block <= names.end)
        keys = np.sort(level[inside] * n + inside)
        anchors = inside[
            ((inside - names.first[inside]) % block == 0) & (names.end - names.first >= 2 * least_lag)[inside]
        ]
        begin, end, period = known
        fine = (2 * period <= block) & (end - begin >= block)
        begin, end = begin[fine], end[fine]
        low = anchors + least_lag
        if len(begin):
            run = np.maximum(np.searchsorted(begin, anchors, "right") - 1, 0)
            in_run = (begin[run] <= anchors) & (anchors + block <= end[run])
            low = np.where(in_run, np.maximum(low, end[run] - block + 1), low)
        top = np.minimum(anchors + 2 * least_lag, names.end[anchors])
        low = np.searchsorted(keys, level[anchors] * n + np.minimum(low, top))
        counts = np.searchsorted(keys, level[anchors] * n + top) - low
        here = np.repeat(anchors, counts)
        nth = np.arange(len(here)) - np.repeat(np.cumsum(counts) - counts, counts)
        lag = keys[np.repeat(low, counts) + nth] % n - here
        begin = here - names.extend(here, here, lag, False)
        end = here + block + names.extend(here, here + block, lag, True)
        enough = end - begin >= lag
        found = begin[enough], end[enough] + lag[enough], lag[enough]
        known = _smallest(*(np.concatenate(pair) for pair in zip(known, found, strict=True)))
        least_lag *= 2
    return known


def find_runs(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(starts, ends, periods) of all runs in the texts ``bounds[d]:bounds[d + 1]``, by start and period."""
    at, segment = _split(hashes, bounds, least)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none
    x = hashes[at]
    short = [*_direct(x, segment, least)]
    found = _smallest(*(np.concatenate([f[i] for f in short]) for i in range(3)))
    long = np.flatnonzero(np.bincount(segment)[segment] >= 2 * DIRECT)
    if len(long):
        # The words of long segments alone; a run lies in one segment, whose words are neighbours.
        new = np.searchsorted(long, found[0])
        here = (new < len(long)) & (long[np.minimum(new, len(long) - 1)] == found[0])
        other = [f[~here] for f in found]
        begin, end, period = (f[here] for f in found)
        begin, end, period = _doubling(x[long], segment[long], (new[here], new[here] + end - begin, period))
        found = [np.concatenate([o, f]) for o, f in zip(other, (long[begin], long[begin] + end - begin, period), strict=True)]
    begin, length, period = at[found[0]], found[1] - found[0], found[2]
    order = np.lexsort((period, begin))
    return begin[order], begin[order] + length[order], period[order]


def _collapse(texts: pa.Array, least: int) -> list[pa.Array]:
    """n_words, runs and collapsed texts of some texts."""
    w = words(texts, BLANK, SAME)
    begin, end, period = find_runs(w.hashes, w.bounds, least)
    n = len(w.hashes)
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, np.minimum(begin + period, end), 1)
    np.subtract.at(marks, end, 1)
    kept = np.flatnonzero(np.cumsum(marks[:-1]) == 0)
    owner = np.searchsorted(w.bounds, kept, "right") - 1
    body, edges = pieces_of(w.data, w.starts[kept], w.ends[kept] - w.starts[kept])
    # One space after each kept word but the last of its text.
    more = np.ones(len(kept), np.int64)
    more[-1:] = 0
    more[:-1] = owner[1:] == owner[:-1]
    lengths = np.diff(edges)
    before = np.cumsum(more) - more
    out = np.full(len(body) + int(more.sum()), 0x20, np.uint8)
    out[np.arange(len(body)) + np.repeat(before, lengths)] = body
    sizes = np.bincount(owner, lengths + more, len(texts)).astype(np.int64)
    collapsed = strings(out, np.concatenate([[0], np.cumsum(sizes)]))

    text_of = np.searchsorted(w.bounds, begin, "right") - 1
    offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
    values = [begin - w.bounds[text_of], end - begin, period]
    structs = pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in values], ["start", "length", "period"])
    return [pa.array(np.diff(w.bounds).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), structs), collapsed]


def _collapsed_batches(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(text_array(batch.column("text")), AT_ONCE):
                rest = batch.column("rest").slice(first, len(part))
                yield pa.RecordBatch.from_arrays([rest, *_collapse(part, least)], ["rest", "n_words", "runs", "text"])

    return work


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """rest (all columns as a struct), n_words, runs, and the text without the repetitions.

    ``runs`` is by start, then period; start is a word number from 0. Words are ``[^\\x20\\x09-\\x0D]+`` as
    written. A word that some run contains after that run's first period is left out; the other words are
    joined by one space. A null or empty text has no words, no runs and the empty text. Every row is
    answered for itself, repeated rows and ids too; an empty table gives an empty one.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"), F.col("text").cast("string").alias("text"))
    schema = rows.select("rest").schema.add("n_words", "long").add("runs", RUNS).add("text", "string")
    return rows.mapInArrow(_collapsed_batches(least), schema)
