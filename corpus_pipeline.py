"""The corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, decontamination, packing.

Each stage takes what its predecessor kept, whole, and all but the last return the columns of
``documents``. A classifier and an optimal partition have no SQL, so the pipeline is tested against
plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from meterlake.llm.shared import id_or_last, keyed_rows, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.judge(docs, table(spark, sf_dir, "labels")).where("keep").select("rest.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; ``n_chars`` follows the text."""
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        size = F.coalesce(F.length("text"), F.col("rest.n_chars"))
        new["n_chars"] = F.when(F.col("n_dropped") > 0, size).otherwise(F.col("rest.n_chars"))
    columns = [
        (new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns
    ]
    return line_dedup.without_repeated_lines(docs).select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold passages of the benchmark."""
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = judged.where("contaminated").select(id_or_last(F.col("doc_id")).alias("_row_id"), F.col("row_text").alias("_row_text"))
    return keyed_rows(docs).join(gone, ["_row_id", "_row_text"], "left_anti").select("rest.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batches of the documents that are left."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; what a stage keeps is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
