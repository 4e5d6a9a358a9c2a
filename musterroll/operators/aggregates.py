"""Grouped text concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def string_agg(
    df: DataFrame, keys: Sequence[str], column: str, sep: str = "~", name: str | None = None
) -> DataFrame:
    """All values of each group joined by ``sep`` in value order, NULLs left out.

    Equal values are counted before the groups are put together, so a heavy group
    travels as one row per different value and is spelled out only at the end.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).cast("string").alias("_value"))
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("_value", "_times")))
    spelled = F.flatten(
        F.transform(ordered, lambda item: F.array_repeat(item["_value"], item["_times"]))
    )
    return counted.groupBy(*keys).agg(F.array_join(spelled, sep).alias(name or column))
