"""Catalog tables over the output folders, for readers that go by table name."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from musterroll.schemas import ROSTER_COLUMNS, RUN_LOG_SCHEMA, STAGE_SCHEMA
from musterroll.sinks.writers import archive_parts, current_path

if TYPE_CHECKING:
    from musterroll.plans.roster import RosterPaths

SNAPSHOT_SCHEMA = T.StructType([STAGE_SCHEMA[name] for name in ROSTER_COLUMNS])
ARCHIVE_SCHEMA = T.StructType(
    [
        *SNAPSHOT_SCHEMA.fields,
        T.StructField("subscriber_id", T.VarcharType(50), True),
        T.StructField("sent_at", T.TimestampNTZType(), True),
    ]
)
SNAPSHOT_TABLES = ("roster_current", "roster_missing_id", "roster_review")


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)


def _create(spark: SparkSession, table: str, schema: T.StructType, path: str, by: str = "") -> None:
    quoted = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(schema)}) USING parquet {by} "
        f"LOCATION '{quoted}'"
    )


def register_outputs(spark: SparkSession, paths: RosterPaths, database: str) -> None:
    """Make the outputs readable as ``database.<name>`` and up to date.

    Only the catalog changes: the tables are external, so dropping one leaves its
    folder. A snapshot's table is moved to its current version, and so is each run's
    partition of the archive.
    """
    for name in SNAPSHOT_TABLES:
        current = current_path(spark, paths.root, name)
        _create(spark, f"{database}.{name}", SNAPSHOT_SCHEMA, current)
        quoted = current.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(f"{database}.{name}")
    _create(spark, f"{database}.run_log", RUN_LOG_SCHEMA, paths["run_log"])
    spark.catalog.refreshTable(f"{database}.run_log")
    by_run = T.StructType([*ARCHIVE_SCHEMA.fields, T.StructField("run_id", T.StringType(), True)])
    archive = f"{database}.roster_archive"
    _create(spark, archive, by_run, paths["roster_archive"], "PARTITIONED BY (run_id)")
    for run_id, part in archive_parts(spark, paths["roster_archive"]).items():
        one, place = f"PARTITION (run_id = '{run_id}')", part.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {archive} ADD IF NOT EXISTS {one} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {archive} {one} SET LOCATION '{place}'")
    spark.catalog.refreshTable(archive)
