"""What the corpus operators share: tables, words, stored steps."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.sinks.files import Files
from musterroll.sinks.workspace import shared_folder

# A word is a run of characters other than blank and \x09-\x0D; the bytes of any
# other character never include these, so bytes.split() finds the same words.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for NULL."""
    return text.encode().split() if text else []


def small_batches(
    batches: Iterable[pa.RecordBatch], column: str | int, most: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``most`` bytes of ``column``.

    What a task makes of a batch is many times its text, so memory follows the size of
    these; a longer value is a batch by itself.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def without(df: DataFrame, keys: DataFrame, on: str, most: int = 100_000) -> DataFrame:
    """Rows of ``df`` whose ``on`` is not in ``keys`` (distinct, stored, no NULL).

    Keys are broadcast if there are at most ``most``, and ``df`` is then not shuffled.
    Otherwise each key is repeated for a number of shares among which the rows of ``df``
    are dealt, so that a heavy key is many tasks' work.
    """
    if keys.count() <= most:
        return df.join(F.broadcast(keys.select(on)), on, "left_anti")
    shares = 64
    share = F.pmod(F.monotonically_increasing_id(), F.lit(shares)).cast("int").alias("_share")
    every = keys.select(on, F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"))
    return df.select("*", share).join(every, [on, "_share"], "left_anti").drop("_share")


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no helper column has, and each column's name there."""
    names = [f"column{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``docs`` has."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_removed_at_end: set[str] = set()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, cut from its lineage.

    Lost executors do not lose it. The session's ``spark.checkpoint.dir`` is used;
    only a single-machine session without that setting gets a folder of its own. What a
    session has stored, texts among it, is removed when the session's JVM ends.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    folder = context.getCheckpointDir()  # of this session alone
    if folder not in _removed_at_end:
        files = Files(df.sparkSession)
        files.system(folder).deleteOnExit(files.path(folder))
        _removed_at_end.add(folder)
    return df.checkpoint()
