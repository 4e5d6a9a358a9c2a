"""Numbering rows inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_rows(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column],
    name: str = "row_rank",
    top: int | None = None,
) -> DataFrame:
    """Number the rows of each group; with ``top`` keep the first ones only.

    The bound is a filter on row_number, which Spark turns into a group limit on
    both sides of the shuffle: a map task sends at most ``top`` rows of any group,
    however large the group is.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window))
    return ranked if top is None else ranked.where(F.col(name) <= top)


def rank_first(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]
) -> DataFrame:
    """The best row of each group."""
    return rank_rows(df, keys, order, name="_rank", top=1).drop("_rank")
