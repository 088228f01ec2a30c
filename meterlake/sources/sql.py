"""SQL texts over temporary views, with named parameters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(df: DataFrame, view: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return df


def drop(spark: SparkSession, view: str) -> bool:
    return spark.catalog.dropTempView(view)


def read_sql(spark: SparkSession, path: str) -> str:
    """Text of a SQL file, from any file system that the session can read."""
    row = spark.read.text(path, wholetext=True).agg(F.first("value").alias("text")).first()
    text = (row["text"] or "").strip().rstrip(";")
    if not text:
        raise ValueError(f"no SQL text in {path}")
    return text


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run one statement. ``args`` fill the ``:name`` markers as typed literals."""
    return spark.sql(text, args=dict(args)) if args else spark.sql(text)
