"""Helpers of the operators: normal texts, ids without nulls, tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = 2**63 - 1
#: The white space that the contracts name: space, tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case, null as the empty text."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def id_or_last(column: Column) -> Column:
    """A document id as a long; a missing one counts as the largest."""
    return F.coalesce(column.cast("long"), F.lit(LAST_ID))


def id_or_null(column: Column) -> Column:
    return F.when(column != LAST_ID, column)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only where it is unset, as in tests, a local folder is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Paths of the stored tables that are still referred to.
_PATHS: WeakKeyDictionary = WeakKeyDictionary()
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` through a table in the shared folder: it is computed once and outlives lost executors.

    The shuffles that it took are removed when it is written, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove stored tables. Only for those that nothing reads any more: what was made of them is stored itself."""
    for table in tables:
        spark, path = table.sparkSession, _PATHS.pop(table)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(_row_id, _row_text, rest): what a row is known by, its id and a hash of its text, and all its columns.

    Repeated ids with other texts stay apart, and columns of any name travel inside ``rest``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        id_or_last(F.col("doc_id")).alias("_row_id"),
        F.xxhash64(text).alias("_row_text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"),
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
