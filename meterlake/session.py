"""Session with the settings the plans are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: AQE splits skewed joins, sizes shuffles and broadcasts by bytes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
}


def session(app: str = "meterlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder of ``spark.checkpoint.dir``; a local session without it gets one of its machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.startswith("local"):
        base = tempfile.mkdtemp(prefix="meterlake-")
    return base or None


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    base = shared_folder(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _inside(base, name)


def _inside(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
