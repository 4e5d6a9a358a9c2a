"""The whole job: outputs, archive, gates, log and failure."""

from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from musterroll import audit, run
from musterroll.audit import GATE_MESSAGES, StepLog, gates, read_log
from musterroll.plans import roster
from musterroll.schemas import REPORT_COLUMNS, ROSTER_COLUMNS
from musterroll.sinks import workspace
from musterroll.sinks.tables import ARCHIVE_SCHEMA
from musterroll.sinks.writers import read_archive, read_report, read_snapshot
from tests.fixtures import (
    AS_OF,
    CONFIG,
    DEFAULT_ROWS,
    LOCAL_COPIES,
    SCHEMAS,
    frame,
    local_frame,
    month,
    person,
    relation,
    sources,
    values,
)


def population(spark, n_missing, n_review, **rows):
    """Three good members, some without a payer id, some with a name to review."""
    good = [1, 2, 3]
    missing = list(range(11, 11 + n_missing))
    review = list(range(21, 21 + n_review))
    everyone = good + missing + review
    return sources(
        spark,
        member=[person(i, "77Oak" if i in review else "Oak") for i in everyone],
        member_month=[month(i, payer_id=None if i in missing else f"PRE{i}") for i in everyone],
        member_provider=[relation(i) for i in everyone],
        **rows,
    )


def at_noon():
    return datetime(2024, 3, 15, 12)


def log_of(spark, result):
    return [
        (row["check_point"], row["message"], row["row_count"])
        for row in read_log(spark, result.paths.run_log).collect()
    ]


@pytest.mark.parametrize(
    "n_missing,n_review,fired",
    [(1, 1, ()), (0, 2, ("review",)), (2, 1, ("missing_id",)), (2, 2, ("missing_id", "review"))],
)
def test_one_archive_append_in_every_branch(spark, tmp_path, n_missing, n_review, fired):
    data = population(spark, n_missing, n_review)
    result = run(spark, data, CONFIG, AS_OF, "run-1", str(tmp_path), at_noon)
    assert result.fired == fired
    assert result.period == 202402
    assert result.counts["roster_current"] == result.counts["roster_archive"] == 3
    assert result.counts["roster_missing_id"] == n_missing
    assert result.counts["roster_review"] == n_review
    archive = read_archive(spark, result.paths.roster_archive, ARCHIVE_SCHEMA)
    assert values(archive, "patient_id", "subscriber_id", "run_id", "sent_at") == [
        (i, None, "run-1", at_noon()) for i in (1, 2, 3)
    ]
    alerts = spark.read.parquet(result.paths.alerts)
    assert sorted(row["gate"] for row in alerts.collect()) == sorted(fired)
    report = read_report(spark, f"{result.paths.report_review}/run_id=run-1", REPORT_COLUMNS)
    assert report.count() == (n_review if "review" in fired else 0)
    assert not os.path.exists(result.paths.report_missing_id)
    messages = log_of(spark, result)
    assert {m for c, m, _ in messages if c == "ERROR"} == {GATE_MESSAGES[g] for g in fired}


def test_runs_outputs_and_log(spark, tmp_path):
    root = str(tmp_path)
    cfg = replace(CONFIG, report_missing=True, environment="TEST")
    first = run(spark, population(spark, 2, 2), cfg, AS_OF, "run-1", root, at_noon)
    again = run(spark, population(spark, 2, 2), cfg, AS_OF, "run-1", root, at_noon)
    assert again.counts == first.counts
    archive = read_archive(spark, first.paths.roster_archive, ARCHIVE_SCHEMA)
    assert archive.count() == 3
    log = log_of(spark, first)
    steps = [m for c, m, _ in log if c == "START"]
    assert len(steps) == 2 * len(set(steps))
    assert {m: n for c, m, n in log if c == "FINISH"} == {
        "cohort": 7,
        "payer_id": 7,
        "payer_id: rows without payer_patient_id": 2,
        "crosswalk": 1,
        "codes cut to their last characters": 0,
        "attribution": 7,
        "stage": 7,
        "stage: rows without person_id": 2,
        "stage: rows without record_number": 6,
        "stage: rows without provider_npi": 0,
        "roster_current": 3,
        "roster_missing_id": 2,
        "roster_review": 2,
        "roster_archive": 3,
        "roster_file": None,
        "roster": None,
    }
    assert os.path.exists(f"{first.paths.report_missing_id}/run_id=run-1")
    assert values(spark.read.parquet(first.paths.alerts), "environment", "n") == [("TEST", 2)] * 2
    report = spark.read.csv(f"{first.paths.report_review}/run_id=run-1", sep="\t", header=True)
    assert report.columns[:4] == ["record_number", "patient_id", "person_id", "historical_person_id"]
    assert values(report, "patient_id", "person_id") == [("21", "21"), ("22", "22")]
    file = f"{first.paths.roster_file}/{AS_OF:%Y%m%d}/run-1.txt"
    assert os.path.isfile(file) and sum("Person ID" in line for line in open(file)) == 1
    sent = spark.read.csv(file, sep="\t", header=True)
    assert sent.count() == 3 and sent.columns[0] == "Person ID"
    third = run(spark, population(spark, 0, 0), cfg, AS_OF, "run-2", root, at_noon)
    archive = read_archive(spark, third.paths.roster_archive, ARCHIVE_SCHEMA)
    assert values(archive.groupBy("run_id").count(), "run_id", "count") == [("run-1", 3), ("run-2", 3)]
    assert read_snapshot(spark, root, "roster_missing_id").count() == 0
    # No alert of this run, and the former run's are still to be found under its id.
    alerts = spark.read.parquet(third.paths.alerts).groupBy("run_id").count()
    assert values(alerts, "run_id", "count") == [("run-1", 2)]
    again = spark.read.csv(f"{first.paths.report_review}/run_id=run-2", sep="\t", header=True)
    assert again.count() == 0


def test_a_bad_run_id_touches_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="run_id"):
        run(spark, population(spark, 0, 0), CONFIG, AS_OF, "2024/03", str(tmp_path), at_noon)
    assert os.listdir(tmp_path) == []


def test_a_failed_run_leaves_the_snapshots_readable(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    run(spark, population(spark, 0, 0), CONFIG, AS_OF, "run-1", root, at_noon)

    def fails(*_):
        raise OSError("disk")

    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path / "work"))
    monkeypatch.setattr(roster, "append_archive", fails)
    with pytest.raises(OSError, match="disk"):
        run(spark, population(spark, 2, 0), CONFIG, AS_OF, "run-2", root, at_noon)
    assert read_snapshot(spark, root, "roster_current").count() == 3
    assert read_snapshot(spark, root, "roster_missing_id").count() == 0
    assert os.listdir(tmp_path / "work" / "musterroll") == []
    log = read_log(spark, f"{root}/run_log").where("run_id = 'run-2'")
    assert ("roster_archive: OSError",) in values(log.where("check_point = 'ERROR'"), "message")


def test_a_broken_log_does_not_hide_the_error_or_keep_the_step_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path / "work"))

    def broken(spark, name, row):
        if row[2] == "ERROR":
            raise OSError("log")

    monkeypatch.setattr(audit, "write_row", broken)
    monkeypatch.setattr(roster, "assemble", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, population(spark, 0, 0), CONFIG, AS_OF, "r", str(tmp_path / "out"), at_noon)
    assert os.listdir(tmp_path / "work" / "musterroll") == []


def test_outputs_as_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS roster_test LOCATION '{tmp_path}/db'")
    try:
        for run_id, n_missing in (("007", 2), ("008", 0)):
            run(spark, population(spark, n_missing, 0), CONFIG, AS_OF, run_id, str(tmp_path), at_noon,
                database="roster_test")
            assert spark.table("roster_test.roster_missing_id").count() == n_missing
        archive = spark.table("roster_test.roster_archive").groupBy("run_id").count()
        assert values(archive, "run_id", "count") == [("007", 3), ("008", 3)]
        assert spark.table("roster_test.roster_current").columns == ROSTER_COLUMNS
        assert set(r["run_id"] for r in spark.table("roster_test.run_log").collect()) == {"007", "008"}
    finally:
        spark.sql("DROP DATABASE IF EXISTS roster_test CASCADE")
    assert read_snapshot(spark, str(tmp_path), "roster_current").count() == 3


def test_a_repeat_that_fails_keeps_what_was_sent(spark, tmp_path, monkeypatch):
    """The archive is written in one step: an attempt that dies in it changes nothing."""
    root = str(tmp_path)
    first = run(spark, population(spark, 0, 0), CONFIG, AS_OF, "run-1", root, at_noon)
    before = values(read_archive(spark, first.paths.roster_archive, ARCHIVE_SCHEMA), "patient_id")
    rows = roster.sent_rows
    monkeypatch.setattr(
        roster, "sent_rows", lambda df: rows(df).where(F.raise_error(F.lit("executor lost")).isNull())
    )
    with pytest.raises(PySparkException, match="executor lost"):
        run(spark, population(spark, 2, 0), CONFIG, AS_OF, "run-1", root, at_noon)
    archive = read_archive(spark, first.paths.roster_archive, ARCHIVE_SCHEMA)
    assert values(archive, "patient_id") == before == [(1,), (2,), (3,)]


def test_old_versions_go_when_told(spark, tmp_path):
    cfg = replace(CONFIG, keep_versions=1, grace_hours=0)
    for run_id in ("a", "b", "b"):
        result = run(spark, population(spark, 0, 0), cfg, AS_OF, run_id, str(tmp_path), at_noon)
    assert len(os.listdir(result.paths.roster_current)) == 1
    assert read_snapshot(spark, str(tmp_path), "roster_current").count() == 3
    archive = read_archive(spark, result.paths.roster_archive, ARCHIVE_SCHEMA)
    assert values(archive.groupBy("run_id").count(), "run_id", "count") == [("a", 3), ("b", 3)]
    assert len(os.listdir(f"{result.paths.roster_archive}/run_id=b")) == 1
    files = [name for name in os.listdir(result.paths.run_log) if name.endswith(".parquet")]
    assert len(files) == 3 and os.listdir(f"{result.paths.run_log}/_open") == []


def test_no_months_at_all(spark, tmp_path):
    result = run(spark, sources(spark, member_month=[]), CONFIG, AS_OF, "r", str(tmp_path), at_noon)
    assert result.period is None
    assert result.counts["roster_current"] == result.counts["roster_archive"] == 0
    assert read_snapshot(spark, result.paths.root, "roster_current").columns == ROSTER_COLUMNS


def test_overflow_fails_before_any_output_or_goes_to_quarantine(spark, tmp_path):
    members = {"member": [person(1, state="ZZZ")]}
    root = str(tmp_path / "raise")
    with pytest.raises(PySparkException, match="state is longer than 2"):
        run(spark, sources(spark, **members), CONFIG, AS_OF, "r", root, at_noon)
    assert os.listdir(root) == ["run_log"]
    log = read_log(spark, f"{root}/run_log").collect()
    assert [row["message"] for row in log if row["check_point"] == "ERROR"][0].startswith("stage: ")
    cfg = replace(CONFIG, on_overflow="quarantine")
    result = run(spark, sources(spark, **members), cfg, AS_OF, "r", str(tmp_path / "q"), at_noon)
    assert result.counts["roster_overflow"] == 1
    assert result.counts["roster_current"] == 0


def test_step_tables_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(tmp_path / "work"))
    run(spark, sources(spark), CONFIG, AS_OF, "r", str(tmp_path / "out"), at_noon)
    assert os.listdir(tmp_path / "work" / "musterroll") == []


@pytest.mark.parametrize("n,fires", [(0, False), (1, False), (2, True)])
def test_gates(spark, n, fires):
    df = spark.range(1).select(F.lit(n).alias("missing_id"), F.lit(n).alias("review"))
    got = gates(df)
    assert values(got, "gate", "n", "threshold", "fired") == [
        ("missing_id", n, 1, fires), ("review", n, 1, fires),
    ]
    assert values(gates(df, threshold=0), "fired") == [(n > 0,)] * 2


def test_a_failed_step_is_logged_without_its_text(spark):
    log = StepLog(spark, "p", "r", at_noon)
    with pytest.raises(KeyError), log.step("s"):
        raise KeyError("private")
    assert values(log.frame(), "check_point", "message") == [("ERROR", "s: KeyError"), ("START", "s")]


def test_command_line(spark, tmp_path, capsys):
    from musterroll.__main__ import main

    specs = dict(LOCAL_COPIES)
    for name in SCHEMAS:
        path = str(tmp_path / "in" / name)
        frame(spark, name, DEFAULT_ROWS[name]).write.parquet(path)
        specs[name] = {"parquet": path}
    config = {
        "contract_names": ["North Plan"], "plan_prefix": "open", "data_sys_prefix": "north",
        "id_prefix": "PRE", "code_types": ["CHART"], "review_prefix": "77",
    }
    job = tmp_path / "job.json"
    job.write_text(json.dumps({"config": config, "sources": specs, "root": str(tmp_path / "out")}))
    main([str(job), "--run-id", "r1", "--as-of", "2024-03-15T00:00:00"])
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed["period"] == 202402
    assert printed["counts"]["roster_current"] == 1


def test_local_frames_hold_what_they_are_given(spark):
    assert local_frame(spark, [], "a int").count() == 0
