"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (a, b): root is the component's least node.

    Each round points every node's larger neighbours, then its smaller ones, at its
    least neighbour, until nothing changes: a logarithmic number of rounds. A node
    with many neighbours is a join key, not a group, and its join can be split. Only
    a count and a checksum reach the driver. Edges with a NULL end or equal ends are
    ignored; repeated edges count once.
    """
    edges = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")))
        large = stored(
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")))
        edges = stored(
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least)
            .distinct()
        )
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
