"""Words of many texts at once, as 64-bit hashes: numpy over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time; a longer text is worked on alone.
CHUNK = 1 << 21


def _table(separators) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


#: Words are ``[^\x20\x09-\x0D]+``.
BLANK = _table([0x20, *range(0x09, 0x0E)])
#: Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
SYMBOL = _table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Instead of LOWER, for words as they are written.
SAME = np.arange(256, dtype=np.uint8)
BASE = np.uint64(0x9E3779B97F4A7C15)
#: The number that undoes BASE, modulo 2**64.
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Words(NamedTuple):
    """Text ``d`` has the words ``bounds[d]:bounds[d + 1]``; ``starts`` and ``ends`` are byte positions in ``data``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    data: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """A finishing mix, so that all bits of a hash depend on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_array(column) -> pa.Array:
    """A column of texts with 64-bit offsets and nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(texts: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) with at most ``most`` bytes in each slice, or one text."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def words(texts: pa.Array, separator: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """The words of ``texts`` (from ``text_array``), A-Z in lower case or as ``fold`` maps the bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    body = texts.buffers()[2]
    data = fold[np.frombuffer(body, np.uint8)[first:last]] if last > first else np.zeros(0, np.uint8)
    edges = offsets - first
    inside = ~separator[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(texts) + 1, np.int64), data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = edges[:-1][edges[:-1] < len(data)]
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    # A word reaches to the next one or to the next separator.
    total = np.cumsum(inside)
    lengths = np.diff(np.append(total[starts] - 1, total[-1]))
    ends = starts + lengths
    where = np.cumsum(lengths) - lengths
    at = np.arange(total[-1]) - np.repeat(where, lengths)
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[at]
    hashes = mixed(np.add.reduceat(values, where))
    return Words(hashes, starts, ends, np.searchsorted(starts, edges), data)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbours; the caller leaves out the runs that cross a text's end."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        out *= BASE
        out += hashes[i : len(out) + i]
    return mixed(out)


def sliding(x: np.ndarray, size: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over each run of ``size`` neighbours, by doubling."""
    width = 1
    while width < size:
        step = min(width, size - width)
        x = best(x[: len(x) - step], x[step:])
        width += step
    return x


def minima(hashes: np.ndarray, bounds: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the runs of ``size`` words that are least in a window of ``window`` runs of one text.

    All of equal minima are kept. Any ``size + window - 1`` words that two texts share make both keep the
    same run among them.
    """
    grams = runs(hashes, size)
    if len(grams) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = sliding(grams, window, np.minimum)
    text_end = np.repeat(bounds[1:], np.diff(bounds))[: len(least)]
    least = np.where(np.arange(len(least)) + size + window - 1 <= text_end, least, 0)
    edge = np.zeros(window - 1, np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), window, np.maximum)
    at = np.flatnonzero(most == grams)
    return at, grams[at]


def pieces_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the slices of ``data`` that begin at ``starts``, one after the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return data[at], offsets


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of UTF-8 ``data`` between neighbouring ``offsets``."""
    array = pa.Array.from_buffers(
        pa.large_string(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )
    return array.cast(pa.string()) if len(data) < 1 << 31 else array


def gathered(batches: Iterator[pa.RecordBatch], most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes or more."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    rest = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
    yield from rest
