"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the threads, BENCH_RUNS (default 5) how often each query is timed after
one warm-up. With ``--oracle`` the same SQL is timed in DuckDB as well, with ``--job``
the job that writes everything.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.compare import oracle_connection
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES, written
from musterroll.session import roster_session

HEADLINE = [
    "roster_flagship",
    "roster_assemble",
    "cohort_build",
    "employed_providers",
    "attribution_max",
    "payer_ids",
    "rank_first",
    "correction_overlay",
    "historical_id",
    "suppress_unreviewed",
    "normalize_code",
    "other_codes",
    "string_agg",
    "latest_period",
    "distinct_project",
]


def seconds(action) -> float:
    begun = time.perf_counter()
    action()
    return time.perf_counter() - begun


def median(action, runs: int) -> float:
    action()
    return round(statistics.median(seconds(action) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    spark = roster_session(
        "roster_bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(cpus),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def whole(name):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def planned(name):
        return lambda: QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan()

    queries = {name: median(whole(name), runs) for name in names}
    result = {
        "metric": "roster_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        # Parts of the times above that go into making the plans.
        "plans": {name: round(seconds(planned(name)), 3) for name in names},
    }
    if "--job" in sys.argv:
        # The job that writes its steps and outputs, after one warm-up.
        result["job"] = {"run": median(lambda: written(spark, sf_dir), 1)}
    if "--oracle" in sys.argv:
        connection = oracle_connection(sf_dir)
        connection.execute(f"SET threads = {cpus}")
        result["oracle"] = {
            name: median(lambda sql=ORACLE_SQL[name]: connection.execute(sql).to_arrow_table(), runs)
            for name in names
        }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
