"""Exact de-duplication by skew-safe combining, with DataFrame functions alone.

Equal texts are combined inside each map task first, then by (digest, salt), then the winners of the
salts by digest. A group of copies therefore reaches a task as one row per map task, and the last
combining as one row per salt, however large it is. Every stage groups by the full text beside the
digest, so that two texts with one digest stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import lower_ascii

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_duplicates(docs: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. The row with the
    largest doc_id stays. Rows that repeat id and text count in the group and all say the same. A row
    without doc_id stays only in a group where none has one. An empty table gives no rows; other columns
    are not read. ``digest`` finds the groups; a weak one costs time, not correctness.
    """
    text = lower_ascii(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("norm")).select(
        "doc_id",
        "norm",
        digest(F.col("norm")).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    salted = rows.groupBy("digest", "salt", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    winners = salted.groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
    )
    # The way back from group to rows: the texts were compared above, so a key of three parts will do.
    key = ["digest", F.xxhash64("norm").alias("content"), F.length("norm").alias("size")]
    groups = winners.select(*key, "keep_id", "group_size")
    members = rows.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), *key)
    return members.join(groups, ["digest", "content", "size"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
