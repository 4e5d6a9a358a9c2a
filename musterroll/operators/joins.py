"""Key restriction, overlays and null-aware suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def only_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``; never multiplies rows.

    A semi join cannot split a heavy key on its right side, so the keys are made
    distinct first, most of it before they are shuffled.
    """
    return df.join(keys.select(on).distinct(), on, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` that have no partner in ``keys``."""
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def restrict_around(df: DataFrame, keys: DataFrame | None, on: str, reduce) -> DataFrame:
    """``reduce(df)`` limited to ``keys``, where ``reduce`` works per value of ``on``.

    Always the reduction first: it shrinks a heavy key inside the map tasks, and the
    semi join then meets few rows of each key. Where the keys are few enough to be
    broadcast, the optimizer itself moves the semi join below the reduction.
    """
    return reduce(df) if keys is None else only_keys(reduce(df), keys, on)


def overlay(
    df: DataFrame, fixes: DataFrame, key: str, column: str, fix_column: str
) -> DataFrame:
    """Replace ``column`` where ``fixes`` lists the key, also by NULL.

    Several fixes for one key count once, the smallest non-null value winning, so
    the row count of ``df`` never changes. Keys that match nothing keep their value.
    """
    chosen = (
        fixes.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_fix_key"))
        .agg(F.min(fix_column).alias("_fix_value"))
        .withColumn("_fix_hit", F.lit(True))
    )
    updated = F.when(F.col("_fix_hit"), F.col("_fix_value")).otherwise(F.col(column))
    return (
        df.join(chosen, df[key] == chosen["_fix_key"], "left")
        .withColumn(column, updated)
        .select(*df.columns)
    )


def suppress(
    df: DataFrame,
    predicate: Column,
    key: str,
    listed: DataFrame,
    listed_key: str | None = None,
    written: bool = False,
) -> DataFrame:
    """Delete rows where ``predicate AND key NOT IN listed`` is true.

    Rows for which the condition is unknown stay. NOT IN is true for an empty
    list, unknown for a NULL key, false on a match, and otherwise unknown if the
    list holds a NULL. Both list counts come from one aggregate, as a scalar
    subquery. Only rows with a key for which the predicate is true can meet one of the
    distinct listed keys; ``df`` is evaluated once, as it may be a long plan.

    With ``written`` ``df`` is a table, cheap to read again: rows that cannot meet a
    listed key then pass the join by and are not shuffled. The others go through a semi
    join, which Spark may precede by a Bloom filter of the listed keys.
    """
    keys = listed.select(F.col(listed_key or key).alias("_listed"))
    size = keys.agg(
        F.struct(F.count(F.lit(1)).alias("n_rows"), F.count("_listed").alias("n_keys"))
    ).scalar()
    n_rows, n_keys = size["n_rows"], size["n_keys"]
    candidate = F.coalesce(predicate, F.lit(False))
    keyed = candidate & F.col(key).isNotNull()
    hits = (
        keys.where(F.col("_listed").isNotNull())
        .distinct()
        .select("_listed", F.lit(0).cast("bigint").alias("_listed_spread"), F.lit(True).alias("_hit"))
    )
    if written:
        passed = df.where(~keyed & ~(candidate & (n_rows == 0)))
        unknown = df.where(keyed & (n_rows > n_keys))
        met = df.where(keyed & (n_rows == n_keys)).join(
            hits.select("_listed"), F.col(key) == F.col("_listed"), "left_semi"
        )
        return passed.unionByName(unknown).unionByName(met)
    # Rows that are not to be joined have no key; the hash of the whole row spreads them.
    marked = df.withColumns(
        {
            "_keyed": keyed,
            "_key": F.when(keyed, F.col(key)),
            "_spread": F.when(keyed, F.lit(0)).otherwise(F.xxhash64(*df.columns)).cast("bigint"),
            "_gone": candidate & (n_rows == 0),
        }
    )
    stays = F.coalesce("_hit", F.lit(False)) | (n_rows > n_keys)
    on = (F.col("_key") == F.col("_listed")) & (F.col("_spread") == F.col("_listed_spread"))
    kept = F.when(F.col("_keyed"), stays).otherwise(~F.col("_gone"))
    return marked.join(hits, on, "left").where(kept).select(*df.columns)
