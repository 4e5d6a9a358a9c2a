"""Versioned snapshots, the archive and tab-separated reports."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.sinks.files import Files

# What the reader puts for an empty text until it is turned back; control characters
# keep it apart from real values.
EMPTY_MARK = "\x01empty\x01"
RUN_ID_PATTERN = re.compile(r"[A-Za-z0-9_.-]+")


VERSIONS = "name string, version string, published bigint"


def check_run_id(run_id: str) -> str:
    """``run_id``, which becomes part of paths."""
    if not RUN_ID_PATTERN.fullmatch(run_id):
        raise ValueError("run_id may hold letters, digits, '_', '.' and '-' only")
    return run_id


def _run_path(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_id={check_run_id(run_id)}"


def version_path(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/version={version}"


def write_version(df: DataFrame, path: str, version: str) -> None:
    """A new version of a snapshot, beside the one that readers see."""
    df.write.mode("errorifexists").parquet(version_path(path, version))


def _point(spark: SparkSession, path: str, versions: Mapping[str, str]) -> None:
    now = time.time_ns()
    rows = [(name, version, now) for name, version in versions.items()]
    spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(path)


def _pointers(spark: SparkSession, path: str) -> dict[str, list[tuple[str, int]]]:
    """Versions and times of publishing of each name, the newest first; a row a run."""
    if not Files(spark).exists(path):
        return {}
    rows = spark.read.schema(VERSIONS).parquet(path).orderBy(F.desc("published")).collect()
    found: dict[str, list[tuple[str, int]]] = {}
    for row in rows:
        known = found.setdefault(row.name, [])
        if row.version not in (version for version, _ in known):
            known.append((row.version, row.published))
    return found


def publish(spark: SparkSession, root: str, versions: Mapping[str, str]) -> None:
    """Make new versions of snapshots below ``root`` the current ones, all at once.

    One small file is added to ``versions``; until it is there, readers see the former
    versions, which stay until ``remove_old_versions`` takes them.
    """
    _point(spark, f"{root.rstrip('/')}/versions", versions)


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder of the snapshot's current version."""
    pointers = spark.read.schema(VERSIONS).parquet(f"{root.rstrip('/')}/versions")
    version = pointers.where(F.col("name") == name).agg(F.max_by("version", "published")).first()[0]
    if version is None:
        raise LookupError(f"{name} has no version yet")
    return version_path(f"{root.rstrip('/')}/{name}", version)


def read_snapshot(
    spark: SparkSession, root: str, name: str, hold: timedelta | None = None
) -> DataFrame:
    """The current version. ``hold`` keeps it from being removed for that long, also when
    newer ones are published meanwhile."""
    path = current_path(spark, root, name)
    if hold is not None:
        version = path.rpartition("version=")[2]
        until = time.time_ns() // 1_000_000 + int(hold.total_seconds() * 1000)
        note = f"{root.rstrip('/')}/readers/{name}/{version}/{until}-{uuid.uuid4().hex}"
        Files(spark).write_text(note, "")
    return spark.read.parquet(path)


def _held(files: Files, readers: str, now_ms: int) -> bool:
    """Whether a reader still holds what ``readers`` belongs to; past notes are removed."""
    notes = files.entries(readers)
    past = [note for note in notes if int(note.name.partition("-")[0]) <= now_ms]
    for note in past:
        files.remove(note.path)
    return len(past) < len(notes)


def remove_old_versions(
    spark: SparkSession, root: str, keep: int = 2, grace: timedelta = timedelta(days=1)
) -> list[str]:
    """Remove versions of the snapshots below ``root`` that nobody needs; their folders.

    The ``keep`` newest of each name stay. An older one goes when another one has taken
    its place for longer than ``grace``, the time in which a reader that found it may
    still read, and no reader holds it. Versions that were never published, of runs that
    failed, go when they are older than ``grace``.
    """
    root, now_ms = root.rstrip("/"), time.time_ns() // 1_000_000
    files = Files(spark)
    return [
        path
        for name, published in _pointers(spark, f"{root}/versions").items()
        for path in _remove_unneeded(
            files, f"{root}/{name}", "version=", published, max(1, keep), grace, now_ms,
            f"{root}/readers/{name}",
        )
    ]


def _remove_unneeded(
    files: Files,
    folder: str,
    prefix: str,
    published: list[tuple[str, int]],
    keep: int,
    grace: timedelta,
    now_ms: int,
    readers: str | None = None,
) -> list[str]:
    """Remove the versions in ``folder`` that are not needed; ``published`` is newest first."""
    before = now_ms - int(grace.total_seconds() * 1000)
    replaced = {v: published[k - 1][1] // 1_000_000 for k, (v, _) in enumerate(published) if k}
    needed = {version for version, _ in published[:keep]}
    removed = []
    for entry in files.entries(folder):
        version = entry.name.removeprefix(prefix)
        if not entry.name.startswith(prefix) or version in needed:
            continue
        if replaced.get(version, entry.modified_ms) > before:
            continue
        if readers is not None and _held(files, f"{readers}/{version}", now_ms):
            continue
        files.remove(entry.path)
        removed.append(f"{folder}/{entry.name}")
    return removed


def _attempts_path(path: str) -> str:
    return f"{path.rstrip('/')}_attempts"


def append_archive(df: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of one run.

    Each run owns one partition. An attempt to write it is a folder of its own, which
    counts when a pointer to it is added, so a repeated or resumed run leaves the archive
    as one run would, also when it now holds no rows, and an attempt that fails leaves
    what was sent before. ``remove_old_attempts`` takes attempts that nobody needs.
    """
    attempt = uuid.uuid4().hex
    df.write.mode("errorifexists").parquet(f"{_run_path(path, run_id)}/attempt={attempt}")
    _point(df.sparkSession, _attempts_path(path), {run_id: attempt})


def archive_parts(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of the rows that count of each run in the archive."""
    return {
        run_id: f"{_run_path(path, run_id)}/attempt={published[0][0]}"
        for run_id, published in sorted(_pointers(spark, _attempts_path(path)).items())
    }


def read_archive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The archive with its run_id, which is text even if it looks like a number."""
    fields = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType)
        for f in schema.fields
    ]
    places = [T.StructField(name, T.StringType(), True) for name in ("run_id", "attempt")]
    with_run = T.StructType([*fields, *places])
    parts = archive_parts(spark, path)
    if not parts:
        return spark.createDataFrame([], with_run).drop("attempt")
    reader = spark.read.schema(with_run).option("basePath", path)
    return reader.parquet(*parts.values()).drop("attempt")


def remove_old_attempts(
    spark: SparkSession, path: str, grace: timedelta = timedelta(days=1)
) -> list[str]:
    """Remove attempts of archived runs that were replaced, or failed, before ``grace``."""
    now_ms = time.time_ns() // 1_000_000
    files = Files(spark)
    published = _pointers(spark, _attempts_path(path))
    return [
        removed
        for entry in files.entries(path)
        if entry.name.startswith("run_id=")
        for removed in _remove_unneeded(
            files, f"{path.rstrip('/')}/{entry.name}", "attempt=",
            published.get(entry.name.removeprefix("run_id="), []), 1, grace, now_ms,
        )
    ]


def write_of_run(df: DataFrame, path: str, run_id: str) -> None:
    """What belongs to one run only, in its partition; a repeated run replaces it."""
    df.write.mode("overwrite").parquet(_run_path(path, run_id))


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as strings; those ``df`` lacks are NULL."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast("string").alias(name)
            for name in columns
        ]
    )


def header_union(
    df: DataFrame, columns: Sequence[str], headings: Sequence[str] | None = None
) -> DataFrame:
    """One row of headings and the rows of ``df`` as text.

    A union promises no order; to get the headings first in a file use
    ``write_report``.
    """
    headings = list(headings or columns)
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in columns])
    header = df.sparkSession.createDataFrame([tuple(headings)], schema)
    return header.unionByName(as_text(df, columns))


def write_report(
    df: DataFrame, path: str, columns: Sequence[str] | Mapping[str, str], heading: bool = True
) -> None:
    """Tab-separated text with a heading line in each part file, unless told otherwise.

    Values are written as they are, without padding; one that holds a tab, a quote
    or a line break is quoted. NULL is nothing and an empty text is a pair of
    quotes, so the two stay apart. A mapping renames columns (heading -> column).
    """
    names = dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}
    text = as_text(df, list(dict.fromkeys(names.values())))
    (
        text.select(*[F.col(column).alias(heading) for heading, column in names.items()])
        .write.mode("overwrite")
        .option("sep", "\t")
        .option("header", heading)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report_file(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | Mapping[str, str],
    order: Sequence[str] = (),
) -> None:
    """One tab-separated file at ``path`` with one heading line, rows by ``order``.

    Many tasks write parts beside it, which the file system joins behind the heading, so
    neither a task nor the driver holds the rows. ``path`` appears when it is whole: a
    file of that name is replaced only then. Where files cannot be joined, ``path`` is a
    folder: the heading is a file that comes first, and its other files have none.
    """
    files, parts = Files(df.sparkSession), f"{path}.parts-{uuid.uuid4().hex}"
    try:
        write_report(df.orderBy(*order) if order else df, f"{parts}/rows", columns, heading=False)
        made = [e.path for e in files.entries(f"{parts}/rows") if e.name.startswith("part-")]
        line = "\t".join(columns) + "\n"
        whole = f"{parts}/whole"
        files.write_text(whole, line)
        try:
            files.join(whole, made)
        except OSError:
            files.move(whole, f"{parts}/rows/part-!heading.csv")
            whole = f"{parts}/rows"
        files.remove(path)
        files.move(whole, path)
    finally:
        files.remove(parts)


def read_report(spark: SparkSession, path: str, headings: Sequence[str]) -> DataFrame:
    """A written report as text columns, with NULL and empty text told apart."""
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in headings])
    rows = spark.read.csv(
        path, schema=schema, sep="\t", header=True, escape='"', emptyValue=EMPTY_MARK
    )
    return rows.select(
        *[
            F.when(F.col(f"`{name}`") == EMPTY_MARK, "").otherwise(F.col(f"`{name}`")).alias(name)
            for name in headings
        ]
    )
