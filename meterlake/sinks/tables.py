"""Write semantics of the marts. Executors write their own files; no rows pass the driver.

Every write runs its plan once and returns the rows it wrote, counted while they were written.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import DATE
from meterlake.session import exists

#: A slice of the reads mart is one feed and one interval type.
SLICE = ("feed", "read_interval_type")
#: Order inside each file of the reads mart, so that files can be skipped by meter and time.
READS_ORDER = ("headend_meter_id", "reading_datetime", "register")
#: Rows of a file at most; about a quarter of a gigabyte of readings.
FILE_ROWS = 4_000_000


@dataclass(frozen=True)
class Target:
    """A parquet table: its folders, the order of rows over files and inside them, and how it is replaced.

    ``dated`` names the timestamp whose day is a partition. A ``versioned`` table keeps every version in a folder
    of its own; a row in its log of pointers, written last, makes a version the current one. ``schema`` is for
    tables that may have been written without any row.
    """

    path: str
    partitions: Sequence[str] = ()
    order: Sequence[str] = ()
    dated: str | None = None
    versioned: bool = False
    schema: str | None = None

    @classmethod
    def reads(cls, path: str) -> "Target":
        return cls(path, (*SLICE, DATE), READS_ORDER, dated="reading_datetime")

    @classmethod
    def published(cls, path: str, order: Sequence[str] = ()) -> "Target":
        return cls(path, order=order, versioned=True)


def _laid_out(df: DataFrame, target: Target) -> DataFrame:
    """Rows as they go to files: near ones together, in ranges of the folders and the order's first column.

    The ranges are found from a sample of the rows after their last shuffle, so the work before it is not repeated.
    """
    rows = df.withColumn(DATE, F.to_date(target.dated)) if target.dated else df
    if not target.order:
        return rows
    ranges = [*target.partitions, *target.order[:2]]
    return rows.repartitionByRange(*ranges).sortWithinPartitions(*target.partitions, *target.order)


def _write(df: DataFrame, target: Target, mode: str, path: str | None = None, **options: str) -> int:
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    rows = _laid_out(df, target).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).options(**options)
    writer.partitionBy(*target.partitions).parquet(path or target.path)
    return seen.get["rows"]


def append(df: DataFrame, target: Target) -> int:
    """Add rows. A repeated run adds them again."""
    return _write(df, target, "append")


def replace_slice(df: DataFrame, target: Target) -> int:
    """Replace only the partitions that ``df`` has rows for, in a dated table the days.

    A repeated run leaves one copy, an empty ``df`` changes nothing.
    """
    if not target.partitions:
        raise ValueError("a slice is replaced in a partitioned target only")
    return _write(df, target, "overwrite", partitionOverwriteMode="dynamic")


def replace_kind(df: DataFrame, target: Target, **kind: str) -> int:
    """Replace all days of one slice, whose columns have the values ``kind``; nothing if ``df`` is empty."""
    if tuple(kind) != tuple(target.partitions[: len(kind)]):
        raise ValueError(f"the slice must be given by {target.partitions}")
    inner = Target(
        "/".join([target.path.rstrip("/"), *(f"{k}={v}" for k, v in kind.items())]),
        target.partitions[len(kind) :],
        target.order,
        target.dated,
    )
    # A slice is counted before it goes, from a version written aside; the files then replace the old ones.
    aside = Target(f"{target.path.rstrip('/')}.aside/{uuid.uuid4().hex}", dated=target.dated)
    rows = df.drop(*kind)
    if not _write(rows, aside, "errorifexists"):
        return 0
    ready = df.sparkSession.read.parquet(aside.path).drop(DATE) if target.dated else df.sparkSession.read.parquet(aside.path)
    return _write(ready, inner, "overwrite", partitionOverwriteMode="static")


_POINTER = "seq long, version string, label string, rows long"


def _pointers(spark: SparkSession, target: Target) -> DataFrame | None:
    log = f"{target.path.rstrip('/')}/pointers"
    return spark.read.schema(_POINTER).json(log) if exists(spark, log) else None


def _version_path(target: Target, version: str) -> str:
    return f"{target.path.rstrip('/')}/versions/{version}"


def publish(df: DataFrame, target: Target, *, label: str = "", if_any: bool = False) -> int:
    """Write a new version and make it the current one of its ``label`` (a table may hold several).

    Readers see the old version until the new one is whole: a write that fails leaves a folder without a
    pointer. With ``if_any`` a version without rows does not become current. One writer at a time.
    """
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    rows = _write(df, target, "errorifexists", _version_path(target, version))
    if rows or not if_any:
        pointers = _pointers(spark, target)
        last = pointers.agg(F.max("seq")).first()[0] if pointers is not None else None
        pointer = spark.createDataFrame([((last or 0) + 1, version, label, rows)], _POINTER)
        pointer.coalesce(1).write.mode("append").json(f"{target.path.rstrip('/')}/pointers")
    return rows


def labels(spark: SparkSession, target: Target) -> dict[str, str]:
    """The path of the current version of each label."""
    pointers = _pointers(spark, target)
    if pointers is None:
        return {}
    newest = pointers.groupBy("label").agg(F.max_by("version", F.struct("seq", "version")).alias("version"))
    return {r["label"]: _version_path(target, r["version"]) for r in newest.collect()}


def read(spark: SparkSession, target: Target, label: str = "") -> DataFrame:
    """The rows of a table, of a versioned one the current version."""
    if not target.versioned:
        reader = spark.read.schema(target.schema) if target.schema else spark.read
        return reader.parquet(target.path)
    path = labels(spark, target).get(label)
    if path is None:
        raise FileNotFoundError(f"no version of {target.path}" + (f" labelled {label}" if label else ""))
    return spark.read.parquet(path)


def replace_all(df: DataFrame, target: Target) -> int:
    """Replace everything, also by nothing."""
    if target.versioned:
        return publish(df, target)
    return _write(df, target, "overwrite", partitionOverwriteMode="static")


def overwrite_if_any(df: DataFrame, target: Target) -> bool:
    """Replace everything unless ``df`` is empty; one run of its plan."""
    if not target.versioned:
        raise ValueError("only a versioned target can be replaced on condition")
    return publish(df, target, if_any=True) > 0


def csv_names(columns: Sequence[str]) -> list[str]:
    """Column names without their table prefix; a repeated name gets a number."""
    names: list[str] = []
    for column in columns:
        base = name = column.split(".", 1)[1] if column.find(".") > 0 else column
        number = 1
        while name.lower() in (n.lower() for n in names):
            number += 1
            name = f"{base}_{number}"
        names.append(name)
    return names


def export_csv(df: DataFrame, new_dir: str) -> None:
    """Rows as CSV files with a header, every value quoted, in a folder that must not exist yet.

    A missing value is written as ``null``, and timestamps with all their digits.
    """
    names = csv_names(df.columns)
    untyped = [n for n, f in zip(names, df.schema.fields) if f.dataType.typeName() == "void"]
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    options = {
        "header": True,
        "quoteAll": True,
        "nullValue": "null",
        "timestampFormat": micros,
        "timestampNTZFormat": micros,
    }
    rows = df.toDF(*names).withColumns({n: F.col(f"`{n}`").cast("string") for n in untyped})
    rows.write.mode("errorifexists").options(**options).csv(new_dir)


def jdbc_write_options(
    url: str, table: str, props: Mapping[str, str] | None = None, batch: int = 10_000
) -> dict[str, str]:
    return {"batchsize": str(batch), **(props or {}), "url": url, "dbtable": table}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    props: Mapping[str, str] | None = None,
    *,
    mode: str = "append",
    connections: int = 16,
) -> None:
    """Write to a JDBC table over ``connections`` connections; the plan before keeps its own tasks."""
    rows = df.repartition(connections)
    rows.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, props)).save()
