"""Packing into optimal length buckets.

The histogram of lengths over all documents goes to a dynamic programme that chooses the bucket
boundaries of least padding. Inside a bucket, documents are numbered and cut into batches of at most
``budget`` padded tokens. Numbers come from shards of a bucket plus the sizes of the shards before, so
that no bucket has to meet in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.shared import stored

BUCKETS, BUDGET = 16, 65_536
#: Lengths up to EXACT are boundaries themselves; above, each doubling has STEPS of them.
EXACT, STEPS = 1024, 128
#: Rows that are numbered in one group, at most about.
SHARD = 20_000


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper ends of at most ``buckets`` buckets over sorted ``lengths``, with the least sum of padding."""
    if not len(lengths):
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    best = np.concatenate([[0.0], np.full(len(lengths), np.inf)])
    cuts = []
    for _ in range(min(buckets, len(lengths))):
        following, cut = np.full(len(best), np.inf), np.zeros(len(best), np.int64)
        for j in range(1, len(best)):
            # The padded size of a bucket that ends at length j - 1 and begins after the i-th length.
            sizes = best[:j] + lengths[j - 1] * (total[j] - total[:j])
            cut[j] = np.argmin(sizes)
            following[j] = sizes[cut[j]]
        cuts.append(cut)
        best = np.minimum(following, np.inf)
    ends, j = [], len(lengths)
    for cut in reversed(cuts):
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return ends[::-1]


def on_grid(length):
    """The length rounded up to the grid of boundaries, which has a fixed number of points a doubling."""
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)))))) / STEPS
    return F.when(length <= EXACT, length).otherwise((F.ceil(length / step) * step).cast("long"))


def n_words(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, bucket, padded_length, batch, place.

    Tokens are words without white space. Buckets count from 0 in order of length; batches count from 0
    inside their bucket, and places inside their batch. A batch holds ``budget // padded_length`` documents,
    one at least: a longer document is a batch of its own, whole. A null or empty text has no tokens and
    is packed with the shortest. Order in a bucket: by shard (a hash of the id and of the row's place in the
    table, so that one id on many rows is spread), then by id; repeated rows have a place each. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), n_words(F.col("text").cast("string")).alias("n_tokens")
        ).withColumn("row", F.monotonically_increasing_id()),
        "lengths",
    )
    histogram = (
        rows.groupBy(on_grid(F.col("n_tokens")))
        .agg(F.max("n_tokens").alias("length"), F.count(F.lit(1)).alias("n"))
        .orderBy("length")
    ).collect()  # as many rows as the grid has points: EXACT, and STEPS for each doubling
    lengths = np.array([r.length for r in histogram], np.int64)
    counts = np.array([r.n for r in histogram], np.int64)
    ends = boundaries(lengths, counts, buckets) or [0]
    bucket = F.array_position(F.transform(F.array(*map(F.lit, ends)), lambda e: e >= F.col("n_tokens")), True) - 1
    shards = max(1, -(-int(counts.sum()) // SHARD))
    spread = F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).alias("shard")
    placed = rows.select("doc_id", "row", "n_tokens", bucket.cast("int").alias("bucket"), spread)
    sizes = placed.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("bucket", "shard").orderBy("doc_id", "n_tokens", "row")
    number = F.row_number().over(order) - 1 + F.col("offset")
    padded = F.element_at(F.array(*map(F.lit, ends)), F.col("bucket") + 1).cast("long")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(padded, F.lit(1)))).cast("long")
    return placed.join(offsets, ["bucket", "shard"]).select(
        "doc_id",
        "n_tokens",
        "bucket",
        padded.alias("padded_length"),
        F.floor(number / capacity).cast("long").alias("batch"),
        F.pmod(number, capacity).cast("long").alias("place"),
    )
