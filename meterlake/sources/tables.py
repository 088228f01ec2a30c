"""Where a logical table comes from: a parquet folder, the catalog, or a JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from meterlake.sources import schemas as declared_schemas


def load_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    props: Mapping[str, str] | None = None,
    *,
    split: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """Rows of a query on a JDBC source.

    ``split`` = (column, lowest, highest, parts) reads in parallel; without it one task reads all,
    which suits small tables only. Credentials belong in ``props``, given by the caller at run time.
    """
    return spark.read.format("jdbc").options(**jdbc_read_options(url, query, props, split)).load()


def jdbc_read_options(
    url: str,
    query: str,
    props: Mapping[str, str] | None = None,
    split: tuple[str, object, object, int] | None = None,
) -> dict[str, str]:
    table = query.strip().rstrip(";")
    is_query = table.lower().startswith(("select", "with")) and " " in table
    options = {
        "fetchsize": "10000",
        **(props or {}),
        "url": url,
        "dbtable": f"({table}) source_rows" if is_query else table,
    }
    if split:
        column, low, high, parts = split
        options.update(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    return options


@dataclass(frozen=True)
class Tables:
    """Resolves logical names.

    ``root`` is a folder of parquet tables; without it names are looked up in the catalog.
    ``schemas`` gives the schema of a table, with ``""`` as the default for the others; ``names``
    gives the physical name where it is not the logical one. ``frames`` holds tables that come from
    elsewhere, such as ``load_jdbc``. ``checked`` holds every source table to its declared schema: rows that do
    not fit are left out of ``load``, and found in ``rejected``.
    """

    spark: SparkSession
    root: str | None = None
    schemas: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    frames: Mapping[str, DataFrame] = field(default_factory=dict)
    checked: bool = False

    def resolve(self, table: str) -> str:
        name = self.names.get(table, table)
        schema = self.schemas.get(table, self.schemas.get("", ""))
        if self.root is None:
            return f"{schema}.{name}" if schema else name
        parts = [self.root.rstrip("/"), schema, name]
        return "/".join(p for p in parts if p)

    def _source(self, table: str) -> DataFrame:
        if table in self.frames:
            return self.frames[table]
        name = self.resolve(table)
        return self.spark.table(name) if self.root is None else self.spark.read.parquet(name)

    def load(self, table: str) -> DataFrame:
        rows = self._source(table)
        if self.checked and table in declared_schemas.SCHEMAS:
            return declared_schemas.conforming(rows, table)
        return rows

    def rejected(self, table: str) -> DataFrame:
        """Rows of a source table that do not fit its declared schema: table, reason, row."""
        return declared_schemas.rejected(self._source(table), table)
