"""The step log, row counts taken while writing, and the quality gates."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from musterroll.schemas import RUN_LOG_SCHEMA
from musterroll.sinks.files import Files

START, FINISH, ERROR = "START", "FINISH", "ERROR"


class Step:
    """One running step; ``count`` attaches a row count to the data it writes."""

    def __init__(self, message: str):
        self.message = message
        self._observation: Observation | None = None
        self.row_count: int | None = None
        self._tests: dict[str, Column] = {}
        self.more_counts: dict[str, int] = {}

    def count(self, df: DataFrame, nulls_of: tuple[str, ...] = (), **also: Column) -> DataFrame:
        """``also`` names further conditions whose rows are counted."""
        self._observation = Observation()
        tests = {f"{self.message}: rows without {name}": F.col(name).isNull() for name in nulls_of}
        self._tests = tests | also
        counts = [F.count_if(test).alias(f"n{i}") for i, test in enumerate(self._tests.values())]
        return df.observe(self._observation, F.count(F.lit(1)).alias("row_count"), *counts)

    def collect(self) -> None:
        if self._observation is not None:
            found = self._observation.get
            self.row_count = found["row_count"]
            self.more_counts = {name: found[f"n{i}"] for i, name in enumerate(self._tests)}


class StepLog:
    """START, FINISH and ERROR rows of one run: messages and counts, never values.

    With ``path`` each row is a small file the moment it is logged, without a Spark job,
    so that the log tells how far a run came whose driver is gone. ``close`` makes one
    file of them, which takes their place at once: ``read_log`` does not look at the rows
    of a run that has its file.
    """

    def __init__(
        self,
        spark: SparkSession,
        procedure_name: str,
        run_id: str,
        clock: Callable[[], datetime] = datetime.now,
        path: str | None = None,
    ):
        self._spark = spark
        self._procedure_name = procedure_name
        self._run_id = run_id
        self._clock = clock
        self._path = path
        self._name = f"{run_id}-{uuid.uuid4().hex}"
        self.rows: list[tuple] = []

    @property
    def _rows_path(self) -> str:
        return f"{open_log(self._path)}/{self._name}"

    def log_step(self, check_point: str, message: str, row_count: int | None = None) -> None:
        now = self._clock().replace(tzinfo=None)
        row = (self._run_id, self._procedure_name, check_point, now, message, row_count)
        self.rows.append(row)
        if self._path is not None:
            write_row(self._spark, f"{self._rows_path}/{len(self.rows):06d}.json", row)

    def close(self) -> None:
        """Make the run's rows one file of the log; to be called when the run is over."""
        if self._path is None or not self.rows:
            return
        files, made = Files(self._spark), f"{self._rows_path}/_file"
        self.frame().write.mode("overwrite").parquet(made)
        [part] = [e.path for e in files.entries(made) if e.name.startswith("part-")]
        files.make_folder(self._path)
        files.move(part, f"{self._path}/{self._name}.parquet")
        files.remove(self._rows_path)

    @contextmanager
    def step(self, message: str) -> Iterator[Step]:
        self.log_step(START, message)
        step = Step(message)
        try:
            yield step
        except Exception as problem:
            try:
                self.log_step(ERROR, f"{message}: {type(problem).__name__}")
            finally:
                raise problem  # also if it cannot be logged
        step.collect()
        self.log_step(FINISH, message, step.row_count)
        for what, number in step.more_counts.items():
            self.log_step(FINISH, what, number)

    def _frame(self, rows: list[tuple]) -> DataFrame:
        return self._spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1)

    def frame(self) -> DataFrame:
        """All rows so far."""
        return self._frame(self.rows)


def open_log(path: str) -> str:
    """Where the rows of runs that are not over lie; readers of ``path`` pass it over."""
    return f"{path}/_open"


def write_row(spark: SparkSession, name: str, row: tuple) -> None:
    values = (v.isoformat() if isinstance(v, datetime) else v for v in row)
    Files(spark).write_text(name, json.dumps(dict(zip(RUN_LOG_SCHEMA.names, values))) + "\n")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log: the files of runs that are over, and the rows so far of the
    others, those whose driver is gone included."""
    files = Files(spark)
    over = {entry.name for entry in files.entries(path)}
    parts = [f"{path}/{name}" for name in sorted(over) if name.endswith(".parquet")]
    still = [e.path for e in files.entries(open_log(path)) if f"{e.name}.parquet" not in over]
    found = spark.createDataFrame([], RUN_LOG_SCHEMA)
    if parts:
        found = found.union(spark.read.schema(RUN_LOG_SCHEMA).parquet(*parts))
    if still:
        found = found.union(spark.read.schema(RUN_LOG_SCHEMA).json(still))
    return found


# Fixed order and texts of the two gates.
GATE_MESSAGES = {
    "missing_id": "There are rows without a payer id in the roster.",
    "review": "There are rows whose record number needs a review.",
}


def gates(counts: DataFrame, threshold: int = 1) -> DataFrame:
    """One row per gate: its count and whether it passed the threshold.

    ``counts`` is one row with a column for each gate.
    """
    found = F.array(
        *[F.struct(F.lit(name).alias("gate"), F.col(name).alias("n")) for name in GATE_MESSAGES]
    )
    return counts.select(F.inline(found)).select(
        "gate",
        "n",
        F.lit(threshold).alias("threshold"),
        (F.col("n") > threshold).alias("fired"),
    )
