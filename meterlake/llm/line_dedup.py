"""Line de-duplication: range-partitioned hashes, streamed in order, answered with keep bitmaps.

Lines become (128-bit hash of the key, document, position). They are range-partitioned by hash and
document and sorted, so that one pass meets the first document of each hash first. A hash may span
partitions, however many documents hold it: each partition only claims the head of its first and last
hash, and the smallest claim wins. Texts never take part; each document that loses lines gets a
compressed bitmap, which is applied to its text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import BLANKS, keyed_rows, lower_ascii, stored

SHORTEST_KEY = 10
ROW = "_row_id long, _row_text long"


def _first_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines outside the first document of their hash, and the claimed heads of the border hashes."""
    names = ["h1", "h2", "_row_id", "_row_text", "pos"]
    run, owner, heads, first_run = None, None, [], True

    def out(columns, claimed):
        claims = pa.array(np.full(len(columns[0]), claimed))
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), claims], [*names, "claim"])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1, h2, ids, texts, pos = cols = [batch.column(c).to_numpy() for c in names]
        new = np.ones(n, bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = run != (h1[0], h2[0])
        begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        owners = np.where(begin < 0, ids[0] if owner is None else owner, ids[np.maximum(begin, 0)])
        head = ids == owners
        if not head.all():
            yield out([c[~head] for c in cols], False)
        border = np.flatnonzero(new)
        if len(border) and run is not None:
            old = head & (begin < 0)
            heads.append([c[old] for c in cols])
            if first_run:
                yield from (out(x, True) for x in heads)
            first_run, heads = False, []
        if len(border):
            if run is None and len(border) > 1:
                rows = head & (begin == border[0])
                yield out([c[rows] for c in cols], True)
                first_run = False
            rows = head & (begin == border[-1])
        else:
            rows = head
        heads.append([c[rows] for c in cols])
        run, owner = (h1[-1], h2[-1]), owners[-1]
    yield from (out(x, True) for x in heads)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for positions in batch.column("positions"):
            dropped = positions.values.to_numpy()
            keep = np.ones((int(dropped.max()) // 8 + 1) * 8, np.uint8)
            keep[dropped] = 0
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
        kept = [batch.column("_row_id"), batch.column("_row_text")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(maps, pa.binary())], ["_row_id", "_row_text", "keep"]
        )


def keep_bitmaps(docs: DataFrame, shortest_key: int = SHORTEST_KEY) -> DataFrame:
    """(_row_id, _row_text, keep) of the documents that lose lines.

    ``keep`` is a zlib-compressed bitmap, lowest bit first, with 0 for each line that goes; lines beyond
    its end stay. A line's key is the line without white space at its ends, A-Z in lower case; shorter
    keys than ``shortest_key`` code points never match. A key found in two documents or more stays in the
    smallest doc_id alone, on all its lines there. Rows with one doc_id are one document; a row without
    doc_id counts as the largest id.
    """
    lines = keyed_rows(docs.select("doc_id", "text")).select(
        "_row_id",
        "_row_text",
        F.posexplode(F.split(lower_ascii(F.col("rest.text")), "\n", -1)).alias("pos", "line"),
    )
    key = F.btrim("line", F.lit(BLANKS))
    hashed = (
        lines.select("_row_id", "_row_text", "pos", key.alias("key"))
        .where(F.length("key") >= shortest_key)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("line"), "key").alias("h2"),
            "_row_id",
            "_row_text",
            "pos",
        )
    )
    ordered = hashed.repartitionByRange("h1", "h2", "_row_id").sortWithinPartitions(
        "h1", "h2", "_row_id", "_row_text", "pos"
    )
    found = stored(
        ordered.mapInArrow(
            _first_documents, f"h1 long, h2 long, {ROW}, pos int, claim boolean"
        ),
        "line-claims",
    )
    claims = found.where("claim")
    owners = claims.groupBy("h1", "h2").agg(F.min("_row_id").alias("owner"))
    lost = claims.join(owners, ["h1", "h2"]).where("_row_id > owner")
    parts = ["_row_id", "_row_text", "pos"]
    dropped = found.where("NOT claim").select(parts).union(lost.select(parts))
    return (
        dropped.groupBy("_row_id", "_row_text")
        .agg(F.collect_set("pos").alias("positions"))  # once, however often the row is repeated
        .mapInArrow(_bitmaps, f"{ROW}, keep binary")
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, dropped = [], [], []
        for text, keep in zip(
            batch.column("text").to_pylist(), batch.column("keep").to_pylist(), strict=True
        ):
            rows = (text or "").split("\n")
            gone = np.zeros(0, np.int64)
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
                gone = np.flatnonzero(bits[: len(rows)] == 0)
            left = set(gone.tolist())
            texts.append("\n".join(r for i, r in enumerate(rows) if i not in left) if left else text)
            lines.append(len(rows))
            dropped.append(len(gone))
        rest = [n for n in batch.schema.names if n not in ("text", "keep")]
        columns = [batch.column(n) for n in rest]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            [*rest, "text", "n_lines", "n_dropped"],
        )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rest`` (all columns as a struct), text without the dropped lines, n_lines (before), n_dropped.

    A null text has one empty line and stays null; lines are those between newline characters.
    """
    joined = keyed_rows(docs).join(bitmaps, ["_row_id", "_row_text"], "left")
    rows = joined.select("rest", F.col("rest.text").cast("string").alias("text"), "keep")
    schema = rows.select("rest", "text").schema.add("n_lines", "long").add("n_dropped", "long")
    return rows.mapInArrow(_apply, schema)


def without_repeated_lines(docs: DataFrame, shortest_key: int = SHORTEST_KEY) -> DataFrame:
    """``apply_bitmaps`` of ``keep_bitmaps``. An empty table gives an empty one."""
    return apply_bitmaps(docs, keep_bitmaps(docs, shortest_key))
