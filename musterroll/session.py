"""Session settings for running the roster by itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle partitions up to the advisory size, and splits
# them in skewed joins only, so the number to start with must suit the data: about the
# bytes shuffled over the advisory size. 8192 do for a terabyte a shuffle.
SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # Column expressions are built by plain code; no need to record each call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def roster_session(app_name: str = "member_roster", **settings: str) -> SparkSession:
    """A session with the roster's settings; ``settings`` are added or win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
