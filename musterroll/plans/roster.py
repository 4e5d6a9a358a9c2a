"""The whole roster: as one lazy plan, and as a job that writes its outputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.audit import ERROR, GATE_MESSAGES, StepLog
from musterroll.config import RosterConfig
from musterroll.operators.conform import conform, split_overflow
from musterroll.plans.cohort import build_cohort
from musterroll.plans.identifiers import crosswalk, override_codes, payer_ids
from musterroll.plans.providers import attribute, employed_providers
from musterroll.plans.stage import assemble, route, sent_rows, suppress_unreviewed
from musterroll.schemas import REPORT_COLUMNS, ROSTER_FILE_COLUMNS, STAGE_SCHEMA
from musterroll.sinks.tables import register_outputs
from musterroll.sinks.workspace import Workspace
from musterroll.sinks.writers import (
    append_archive,
    check_run_id,
    publish,
    remove_old_attempts,
    remove_old_versions,
    version_path,
    write_of_run,
    write_report,
    write_report_file,
    write_version,
)
from musterroll.sources.catalog import RosterSources


ALERT_COLUMNS = "environment string, gate string, n bigint, message string"


def cohort_of(
    sources: RosterSources, cfg: RosterConfig, period: int | Column | None = None
) -> DataFrame:
    employed = employed_providers(
        sources.provider, sources.provider_plan, sources.provider_practice, cfg
    )
    return build_cohort(
        sources.member,
        sources.member_month,
        sources.contract_dim,
        sources.member_provider_remote,
        sources.provider_dim_remote,
        employed,
        cfg,
        period,
    )


def roster_stage(
    sources: RosterSources,
    cfg: RosterConfig,
    as_of: datetime,
    period: int | Column | None = None,
) -> DataFrame:
    """The stage as one plan over the sources, nothing written in between.

    The left joins to the cohort restrict every branch to its members, so the
    branches are not restricted beforehand and the cohort is computed once.
    """
    ids = payer_ids(sources.member_month, sources.contract_dim, cfg, period)
    codes = override_codes(
        crosswalk(sources.id_crosswalk, cfg), sources.id_blank, sources.id_correction, cfg.code_width
    )
    providers = attribute(sources.member_provider, sources.provider_dim, as_of, cfg)
    return assemble(cohort_of(sources, cfg, period), codes, ids, providers)


@dataclass(frozen=True)
class RosterPaths:
    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class RosterRun:
    period: int | None
    counts: dict[str, int]
    fired: tuple[str, ...]
    paths: RosterPaths


def run(
    spark: SparkSession,
    sources: RosterSources,
    cfg: RosterConfig,
    as_of: datetime,
    run_id: str,
    root: str,
    clock: Callable[[], datetime] = datetime.now,
    database: str | None = None,
) -> RosterRun:
    """Build the roster and write every output below ``root``.

    ``roster_current``, ``roster_missing_id`` and ``roster_review`` get a new version
    each (``read_snapshot`` finds the current one; the three change together at the
    end), ``roster_archive`` holds the sent rows of each run once, with the time of
    sending, ``roster_file/<day>/<run_id>.txt`` is the sendable file, in order of members,
    ``run_log`` grows row by row and has one file for each run that is over. With
    ``cfg.keep_versions`` older versions are removed at the end, when nobody needs them. ``alerts`` and ``report_*`` describe the gates that fired, and
    ``roster_overflow`` (in quarantine mode) the rows held back, each by run. With
    ``database`` the roster, archive and log folders are also catalog tables.

    The cohort, the ranked payer ids and the stage are used several times and are
    written to the shared folder in between; no output is touched before the
    stage is complete.
    """
    check_run_id(run_id)
    sources.check()
    paths = RosterPaths(root)
    log = StepLog(spark, cfg.procedure_name, run_id, clock, paths.run_log)
    work = Workspace(spark, run_id)
    version = f"{run_id}-{uuid.uuid4().hex[:12]}"
    versions: dict[str, str] = {}
    counts: dict[str, int] = {}

    def keep(
        name: str, df: DataFrame, nulls_of: tuple[str, ...] = (), **also: Column
    ) -> DataFrame:
        with log.step(name) as step:
            kept = work.keep(step.count(df, nulls_of, **also), name)
        counts[name] = step.row_count
        return kept

    def replace(name: str, df: DataFrame) -> DataFrame:
        with log.step(name) as step:
            write_version(step.count(df), paths[name], version)
        counts[name], versions[name] = step.row_count, version
        return spark.read.schema(df.schema).parquet(version_path(paths[name], version))

    try:
        log.log_step("START", "roster")
        # One value: known up front it prunes the fact's partitions in every step.
        period = sources.newest_period()
        wanted = F.lit(None).cast("int") if period is None else period

        cohort = keep("cohort", cohort_of(sources, cfg, wanted))
        ids = keep(
            "payer_id",
            payer_ids(sources.member_month, sources.contract_dim, cfg, wanted, cohort),
            ("payer_patient_id",),
        )
        codes = keep(
            "crosswalk",
            crosswalk(sources.id_crosswalk, cfg, cohort),
            **{"codes cut to their last characters": F.col("code_length") > cfg.code_width},
        )
        attribution = keep(
            "attribution",
            attribute(sources.member_provider, sources.provider_dim, as_of, cfg, cohort),
        )
        member_code = override_codes(
            codes, sources.id_blank, sources.id_correction, cfg.code_width, written=True
        )
        stage = conform(
            assemble(cohort, member_code, ids, attribution), STAGE_SCHEMA, cfg.on_overflow
        )
        stage = keep("stage", stage, ("person_id", "record_number", "provider_npi"))
        if cfg.on_overflow == "quarantine":
            stage, overflow = split_overflow(stage)
            with log.step("roster_overflow") as step:
                write_of_run(step.count(overflow), paths.roster_overflow, run_id)
            counts["roster_overflow"] = step.row_count

        routed = route(stage, cfg, sources.id_correction)
        current = replace(
            "roster_current",
            suppress_unreviewed(routed.current, sources.id_correction, cfg, written=True),
        )
        missing = replace("roster_missing_id", routed.missing)
        review = replace("roster_review", routed.review)

        # The counts were taken while the tables were written.
        found = {"missing_id": counts["roster_missing_id"], "review": counts["roster_review"]}
        fired = tuple(gate for gate, n in found.items() if n > cfg.gate_threshold)
        alerts = [
            (cfg.environment, gate, found[gate], GATE_MESSAGES[gate]) for gate in fired
        ]
        write_of_run(spark.createDataFrame(alerts, ALERT_COLUMNS), paths.alerts, run_id)
        for gate in fired:
            log.log_step(ERROR, GATE_MESSAGES[gate])
        write_report(
            review.where(F.lit("review" in fired)),
            f"{paths.report_review}/run_id={run_id}",
            REPORT_COLUMNS,
        )
        if cfg.report_missing:
            write_report(
                missing.where(F.lit("missing_id" in fired)),
                f"{paths.report_missing_id}/run_id={run_id}",
                REPORT_COLUMNS,
            )

        with log.step("roster_archive") as step:
            sent = sent_rows(current).withColumn(
                "sent_at", F.lit(clock().replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
            )
            append_archive(step.count(sent), paths.roster_archive, run_id)
        counts["roster_archive"] = step.row_count
        with log.step("roster_file"):
            file = f"{paths.roster_file}/{as_of:%Y%m%d}/{run_id}.txt"
            write_report_file(current, file, ROSTER_FILE_COLUMNS, ["patient_id", "person_id"])
        publish(spark, root, versions)
        log.log_step("FINISH", "roster")
    finally:
        try:
            work.drop()
        finally:
            log.close()
    if cfg.keep_versions:
        grace = timedelta(hours=cfg.grace_hours)
        remove_old_versions(spark, root, cfg.keep_versions, grace)
        remove_old_attempts(spark, paths.roster_archive, grace)
    if database is not None:
        register_outputs(spark, paths, database)
    return RosterRun(period, counts, fired, paths)
