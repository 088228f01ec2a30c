"""A filter of fixed size over 64-bit hashes: what it lets through is joined exactly afterwards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The filter has 2**BITS bits (1 MB), whatever the number of hashes. A full filter lets all pass.
BITS = 23
#: Bits of a piece, which one row holds.
PIECE = 16


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        for piece in np.unique(bucket >> PIECE).tolist():
            here = bucket[bucket >> PIECE == piece] & ((1 << PIECE) - 1)
            found.setdefault(piece, np.zeros(1 << PIECE, bool))[here] = True
    for piece, flags in found.items():
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([piece], pa.int32()), "bits": [np.packbits(flags, bitorder="little").tobytes()]}
        )


def bit_filter(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A bit for each leading ``bits`` bits of a column of longs. Tasks make the pieces of the filter."""
    bucket = F.shiftrightunsigned(F.col(column), 64 - bits).cast("int").alias("bucket")
    buckets = hashes.where(F.col(column).isNotNull()).select(bucket).distinct()
    pieces = buckets.repartition(F.shiftright("bucket", PIECE)).mapInArrow(_pieces, "piece int, bits binary")
    out = np.zeros((1 << (bits - PIECE), (1 << PIECE) // 8), np.uint8)
    for row in pieces.collect():  # 2**bits bits in all
        out[row.piece] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def has(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Booleans: which hashes the filter lets through."""
    at = buckets(hashes, int(len(filter_bits) * 8).bit_length() - 1)
    return (filter_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
