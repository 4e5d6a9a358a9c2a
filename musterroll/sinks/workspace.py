"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints.

    Only a single-machine session without that setting gets a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="musterroll-")
    return _local_folders[context.applicationId]


class Workspace:
    """A folder of its own for one job's step tables.

    A written table outlives lost executors, and its size is known to the
    optimizer when the next step decides between broadcast and shuffle.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/musterroll/{label}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        target = f"{self.path}/{name}"
        df.write.mode("errorifexists").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def _folder(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def drop(self) -> None:
        """Remove this job's step tables; they hold personal data."""
        files, folder = self._folder()
        files.delete(folder, True)

    def drop_at_end(self) -> Workspace:
        """Remove the folder when the session's JVM ends, for results read back lazily."""
        files, folder = self._folder()
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        return self
