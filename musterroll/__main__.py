"""``python -m musterroll job.json [--run-id ID] [--as-of 2024-01-31T00:00:00]``

The job file holds ``config`` (roster settings), ``sources`` (table name -> where
it is), ``root`` (the folder of the outputs) and, if the outputs are to be catalog
tables as well, ``database``.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime

from musterroll.config import RosterConfig
from musterroll.plans.roster import run
from musterroll.session import roster_session
from musterroll.sources.catalog import load_sources


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="musterroll", description="Build a member roster.")
    parser.add_argument("job", help="JSON file with config, sources and root")
    parser.add_argument("--run-id", help="default: the time of the run")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="default: now")
    args = parser.parse_args(argv)
    with open(args.job, encoding="utf-8") as handle:
        job = json.load(handle)
    as_of = args.as_of or datetime.now()
    run_id = args.run_id or as_of.strftime("%Y%m%dT%H%M%S")
    spark = roster_session()
    result = run(
        spark,
        load_sources(spark, job["sources"]),
        RosterConfig.from_dict(job["config"]),
        as_of,
        run_id,
        job["root"],
        database=job.get("database"),
    )
    print(json.dumps({"period": result.period, "counts": result.counts, "fired": result.fired}))


if __name__ == "__main__":
    main()
