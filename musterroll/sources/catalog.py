"""Input tables by name: parquet folders, catalog tables and views, remote tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.schemas import FLAG, KIND_TYPES, SOURCE_COLUMNS
from musterroll.sources.ranges import planned

# A remote copy of each of these may be given; "local" as its source says that the local
# table is to be used for it.
REMOTE_COPIES = {
    "member_provider_remote": "member_provider",
    "provider_dim_remote": "provider_dim",
}
JDBC_REQUIRED = ("url", "dbtable")
LOCAL = "local"
JDBC_BOUNDS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
JDBC_PLANNED = ("splitColumn", "parts")


class SourceError(ValueError):
    """A source is missing, or lacks a column, or has a column of the wrong type."""


def check_source(df: DataFrame, name: str) -> DataFrame:
    """The columns the roster reads from ``name``, after a check of their types."""
    wanted = SOURCE_COLUMNS[name]
    types = {field.name: field.dataType for field in df.schema}
    missing = [column for column in wanted if column not in types]
    if missing:
        raise SourceError(f"source {name} lacks columns {missing}")
    for column, kind in wanted.items():
        found = types[column]
        if not isinstance(found, KIND_TYPES[kind]):
            raise SourceError(
                f"source {name}, column {column}: {found.simpleString()} is not a {kind}"
            )
        if kind == FLAG and isinstance(found, T.BooleanType):
            df = df.withColumn(column, F.col(column).cast("int"))
    return df if list(types) == list(wanted) else df.select(*wanted)


def jdbc_options(spec: Mapping[str, Any]) -> dict[str, str]:
    """Reader options of a remote table.

    A table is read in ranges planned from the values of ``splitColumn``, about ``parts``
    of them, or in even ones with all four bounds given, or says ``single_task: true`` if
    it is small enough to be read by one task.
    """
    lacking = [key for key in JDBC_REQUIRED if not spec.get(key)]
    if lacking:
        raise SourceError(f"remote source lacks {lacking}")
    given = [key for key in JDBC_BOUNDS if key in spec]
    by_plan = [key for key in JDBC_PLANNED if key in spec]
    if by_plan and (len(by_plan) < len(JDBC_PLANNED) or given or "single_task" in spec):
        raise SourceError(f"ranges are planned by {list(JDBC_PLANNED)} and nothing else")
    if given and len(given) != len(JDBC_BOUNDS):
        raise SourceError(f"a parallel remote read needs all of {list(JDBC_BOUNDS)}")
    if not given and not by_plan and spec.get("single_task") is not True:
        raise SourceError(
            f"a remote table needs {list(JDBC_PLANNED)}, {list(JDBC_BOUNDS)} or single_task: true"
        )
    own = ("single_task", *JDBC_PLANNED)
    options = {key: str(value) for key, value in spec.items() if key not in own}
    options.setdefault("fetchsize", "10000")
    return options


def read_remote(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """A table over JDBC, by ranges of its key that are planned when it is read."""
    options = jdbc_options(spec)
    if "splitColumn" not in spec:
        return spark.read.format("jdbc").options(**options).load()
    table, url = options.pop("dbtable"), options.pop("url")

    def ask(query: str):
        return spark.read.format("jdbc").options(url=url, query=query, **options).load().collect()

    ranges = planned(ask, table, str(spec["splitColumn"]), int(spec["parts"]))
    return spark.read.jdbc(url, table, predicates=ranges, properties=options)


def read_source(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """One of ``{"parquet": path}``, ``{"table": name}``, ``{"jdbc": {...}}``."""
    if len(spec) != 1:
        raise SourceError("a source is one of parquet, table or jdbc")
    kind, value = next(iter(spec.items()))
    if kind == "parquet":
        return spark.read.parquet(*([value] if isinstance(value, str) else value))
    if kind == "table":
        return spark.table(value)
    if kind == "jdbc":
        return read_remote(spark, value)
    raise SourceError(f"unknown kind of source: {kind}")


class RosterSources:
    """The checked input tables, by attribute or by name.

    A table may be given as a DataFrame or as a function that reads it; a function
    is called, and the table checked, when the table is first used.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame] | str],
        periods: DataFrame | None = None,
    ):
        """``periods`` may give the ``yearmo`` values of member_month without its rows."""
        tables = dict(tables)
        for copy, original in REMOTE_COPIES.items():
            if isinstance(tables.get(copy), str):
                if tables[copy] != LOCAL:
                    raise SourceError(f"{copy} is a table or {LOCAL!r}")
                if original in tables:
                    tables[copy] = tables[original]
        self._periods = periods
        absent = [name for name in SOURCE_COLUMNS if name not in tables]
        if absent:
            raise SourceError(f"sources not given: {absent}")
        unknown = [name for name in tables if name not in SOURCE_COLUMNS]
        if unknown:
            raise SourceError(f"unknown sources: {unknown}")
        self._tables = tables
        self._checked: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        original = REMOTE_COPIES.get(name)
        if original and self._tables[name] is self._tables[original]:
            return self[original]
        if name not in self._checked:
            table = self._tables[name]
            self._checked[name] = check_source(table() if callable(table) else table, name)
        return self._checked[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCE_COLUMNS:
            raise AttributeError(name)
        return self[name]

    @property
    def periods(self) -> DataFrame:
        """A table with all values of ``yearmo``: a partition list, or the months."""
        return self.member_month if self._periods is None else self._periods

    def newest_period(self) -> int | None:
        """The highest ``yearmo`` that has a row; NULL if there are no months.

        A partition list tells what was registered, not what has rows, so its values are
        tried from the highest downwards until one partition has a row. Each try reads
        one row of one partition at most; without a list the months themselves are read.
        """
        if self._periods is None:
            return self.member_month.agg(F.max("yearmo")).first()[0]
        # As many values as there are partitions, from the catalog.
        listed = self._periods.where("yearmo is not null").distinct().orderBy(F.desc("yearmo"))
        for row in listed.collect():
            if not self.member_month.where(F.col("yearmo") == row.yearmo).isEmpty():
                return row.yearmo
        return None

    def check(self) -> RosterSources:
        """Check all tables now, so that a job fails before it writes anything."""
        for name in SOURCE_COLUMNS:
            self[name]
        return self


def partition_values(spark: SparkSession, table: str, column: str) -> DataFrame | None:
    """The values of a catalog table's partition column, from the catalog alone."""
    found = [c for c in spark.catalog.listColumns(table) if c.name == column and c.isPartition]
    if not found:
        return None
    value = F.regexp_extract("partition", f"(?:^|/){re.escape(column)}=([^/]*)", 1)
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        value.try_cast(found[0].dataType).alias(column)
    )


def load_sources(
    spark: SparkSession, specs: Mapping[str, Mapping[str, Any] | str]
) -> RosterSources:
    tables = {
        name: spec if isinstance(spec, str) else read_source(spark, spec)
        for name, spec in specs.items()
    }
    months = specs.get("member_month")
    months = months.get("table") if isinstance(months, Mapping) else None
    periods = partition_values(spark, months, "yearmo") if months else None
    return RosterSources(tables, periods).check()
