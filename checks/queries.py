"""The registered queries: each runs one roster operator over whole tables."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import AS_OF, CONFIG, sources, table
from musterroll.audit import gates, read_log
from musterroll.functions.text import (
    ci_eq,
    ci_in,
    ci_prefix,
    day_text,
    joined_name,
    normalize_code,
    pad_code,
    recode,
    strip_prefix,
)
from musterroll.operators.aggregates import string_agg
from musterroll.operators.conform import OVERFLOW_COLUMN, conform
from musterroll.operators.joins import only_keys, suppress, without_keys
from musterroll.plans.cohort import in_period
from musterroll.plans.identifiers import (
    active_codes,
    blank_codes,
    crosswalk,
    historical_id,
    other_codes,
    override_codes,
    payer_ids,
)
from musterroll.plans.providers import (
    attribute,
    current_rows,
    employed_providers,
    employee_flag,
    primary_practices,
)
from musterroll.plans.roster import ALERT_COLUMNS, RosterPaths, cohort_of, roster_stage, run
from musterroll.plans.stage import gate_counts, has_review_name, route, suppress_unreviewed
from musterroll.schemas import REPORT_COLUMNS, ROSTER_FILE_COLUMNS
from musterroll.sinks.tables import ARCHIVE_SCHEMA
from musterroll.sinks.workspace import Workspace
from musterroll.sinks.writers import (
    append_archive,
    current_path,
    header_union,
    publish,
    read_archive,
    read_report,
    read_snapshot,
    write_report,
    write_version,
)
from musterroll.sources.catalog import check_source, read_source


def latest_period_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_period(sources(spark, sf_dir).member_month)


def cohort_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort_of(sources(spark, sf_dir), CONFIG)


def contract_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).contract_dim.where(
        ci_in("contract_name", CONFIG.contract_names) & (F.col("is_contracted") == 1)
    )


def current_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(sources(spark, sf_dir).member_provider)


def recode_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).member.select(
        "patient_id",
        recode("gender", CONFIG.sex_codes, CONFIG.sex_other).alias("legal_sex"),
        day_text("birthdate").alias("date_of_birth"),
        F.col("postal_code").alias("zip_code"),
    )


def distinct_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").distinct()


def ci_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sources(spark, sf_dir)
        .member.where(ci_eq("patient_status", "Active"))
        .select("patient_id", "patient_status")
    )


def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sources(spark, sf_dir)
        .member_month.where(
            ci_prefix("data_sys", CONFIG.data_sys_prefix)
            & ~ci_prefix("payer_patient_id", CONFIG.id_prefix)
        )
        .select("patient_id", "yearmo", "payer_patient_id", "data_sys")
    )


def left_on_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return (
        data.provider.select("contact_id", "last_name")
        .join(primary_practices(data.provider_practice, CONFIG), "contact_id", "left")
        .select(
            "contact_id",
            "last_name",
            "group_practice_name",
            employee_flag(CONFIG).alias("employee"),
        )
    )


def employed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return employed_providers(data.provider, data.provider_plan, data.provider_practice, CONFIG)


def semi_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return only_keys(data.member, in_period(data.member_month), "patient_id").select(
        "patient_id", "last_name"
    )


def anti_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return without_keys(data.member, in_period(data.member_month), ["patient_id"]).select(
        "patient_id", "last_name"
    )


def attribution_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return attribute(
        data.member_provider, data.provider_dim, AS_OF, CONFIG, cohort_of(data, CONFIG)
    )


def rank_first_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosswalk(sources(spark, sf_dir).id_crosswalk, CONFIG)


def ranked_payer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return payer_ids(
        data.member_month, data.contract_dim, CONFIG, cohort=cohort_of(data, CONFIG)
    )


def historical_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    members = data.member.select(
        "patient_id", F.lit(None).cast("string").alias("historical_person_id")
    )
    return historical_id(members, payer_ids(data.member_month, data.contract_dim, CONFIG, top=2))


def strip_prefix_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).member_month.select(
        "patient_id",
        "yearmo",
        "payer_patient_id",
        strip_prefix("payer_patient_id", CONFIG.id_prefix).alias("stripped_id"),
        F.concat("payer_subscriber", "payer_relation").alias("subscriber_id"),
    )


def normalized_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).id_crosswalk.select(
        "individual_id",
        "external_code",
        pad_code("external_code").alias("padded_code"),
        normalize_code("external_code").alias("code"),
    )


def active_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_codes(sources(spark, sf_dir).id_crosswalk, CONFIG)


def blank_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return blank_codes(crosswalk(data.id_crosswalk, CONFIG), data.id_blank)


def correction_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return override_codes(
        crosswalk(data.id_crosswalk, CONFIG), data.id_blank, data.id_correction
    )


def other_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return other_codes(data.id_crosswalk, crosswalk(data.id_crosswalk, CONFIG), CONFIG)


def concat_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources(spark, sf_dir).provider_dim.select(
        "provider_key",
        F.upper(joined_name("last_name", "first_name", sep=",")).alias("provider_name"),
        joined_name("first_name", "middle_name", "last_name").alias("provider_full_name"),
    )


def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster_stage(sources(spark, sf_dir), CONFIG, AS_OF)


def route_null_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each output of ``route``."""
    routed = route(stage_rows(spark, sf_dir), CONFIG)
    outputs = {"current": routed.current, "missing": routed.missing}
    return _tagged(
        {name: df.select("patient_id", "person_id", "lob") for name, df in outputs.items()}
    )


def _tagged(outputs: dict[str, DataFrame]) -> DataFrame:
    combined = None
    for name, df in outputs.items():
        tagged = df.withColumn("output", F.lit(name))
        combined = (
            tagged
            if combined is None
            else combined.unionByName(tagged, allowMissingColumns=True)
        )
    return combined


def review_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(stage_rows(spark, sf_dir), CONFIG).review


def suppression_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members held back by an empty list, a full one, and one with a NULL key."""
    data = sources(spark, sf_dir)
    members = data.member.select(
        F.nullif("patient_id", F.lit(3)).alias("patient_id"),
        F.nullif("last_name", F.lit("HOUSEHOLD 5")).alias("last_name"),
    )
    corrections = data.id_correction
    lists = {
        "empty": corrections.where(F.lit(False)),
        "keys": corrections,
        "null_key": corrections.select(F.nullif("patient_id", F.lit(5)).alias("patient_id")),
    }
    result = None
    for name, listed in lists.items():
        kept = suppress(members, has_review_name(CONFIG), "patient_id", listed, written=True)
        kept = kept.select(F.lit(name).alias("list"), "patient_id", "last_name")
        result = kept if result is None else result.unionByName(kept)
    return result


def gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates(gate_counts(stage_rows(spark, sf_dir), CONFIG), CONFIG.gate_threshold)


def written(spark: SparkSession, sf_dir: str, runs: int = 1) -> tuple[str, RosterPaths]:
    """The job run ``runs`` times with one run id, below a folder that goes with the session."""
    root = Workspace(spark, "roster").drop_at_end().path
    for _ in range(runs):
        result = run(
            spark, sources(spark, sf_dir), CONFIG, AS_OF, "run-1", root, lambda: AS_OF
        )
    return root, result.paths


def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that the job itself writes."""
    _, paths = written(spark, sf_dir)
    return read_log(spark, paths.run_log)


NARROW_MEMBER = T.StructType(
    [
        T.StructField("patient_id", T.IntegerType()),
        T.StructField("last_name", T.VarcharType(12)),
        T.StructField("city", T.VarcharType(9)),
        T.StructField("patient_status", T.VarcharType(6)),
    ]
)


def varchar_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(sources(spark, sf_dir).member, NARROW_MEMBER, "quarantine")
    return rows.withColumn(OVERFLOW_COLUMN, F.array_join(OVERFLOW_COLUMN, ","))


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_union(
        sources(spark, sf_dir).member, ["patient_id", "last_name", "middle_name"]
    )


def joined_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    return string_agg(
        payer_ids(data.member_month, data.contract_dim, CONFIG, top=None),
        ["patient_id"],
        "payer_patient_id",
        name="payer_patient_ids",
    )


def current_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = sources(spark, sf_dir)
    current = route(roster_stage(data, CONFIG, AS_OF), CONFIG).current
    return suppress_unreviewed(current, data.id_correction, CONFIG)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published twice, and a third version not published: the second is current."""
    members = sources(spark, sf_dir).member
    root = Workspace(spark, "snapshot").drop_at_end().path
    for version, rows in (("1", members.where(F.lit(False))), ("2", members)):
        write_version(rows, f"{root}/members", version)
        publish(spark, root, {"members": version})
    write_version(members.where(F.lit(False)), f"{root}/members", "3")
    return spark.read.schema(members.schema).parquet(current_path(spark, root, "members"))


def archive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run archived twice and a second run once."""
    members = sources(spark, sf_dir).member.select("patient_id", "last_name")
    path = f"{Workspace(spark, 'archive').drop_at_end().path}/sent"
    for run_id in ("2001", "2001", "2002"):
        append_archive(members, path, run_id)
    return read_archive(spark, path, members.schema)


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    review = review_extract(spark, sf_dir)
    path = f"{Workspace(spark, 'report').drop_at_end().path}/review"
    write_report(review, path, REPORT_COLUMNS)
    return read_report(spark, path, REPORT_COLUMNS)


def roster_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written job: everything it leaves after two runs with one run id."""
    root, paths = written(spark, sf_dir, runs=2)
    snapshots = {
        name: read_snapshot(spark, root, f"roster_{name}")
        for name in ("current", "missing_id", "review")
    }
    archive = read_archive(spark, paths.roster_archive, ARCHIVE_SCHEMA)
    alerts = spark.read.schema(f"{ALERT_COLUMNS}, run_id string").parquet(paths.alerts)
    log = read_log(spark, paths.run_log)
    sent = read_report(
        spark, f"{paths.roster_file}/{AS_OF:%Y%m%d}/run-1.txt", list(ROSTER_FILE_COLUMNS)
    )
    report = read_report(spark, f"{paths.report_review}/run_id=run-1", REPORT_COLUMNS)
    return _tagged(
        {
            **snapshots,
            "archive": archive.withColumn("sent_at", F.col("sent_at").cast("string")),
            "alerts": alerts.select("run_id", "n", F.col("gate").alias("message")),
            "run_log": log.groupBy("run_id", "check_point").agg(F.count("*").alias("n")),
            "roster_file": sent.select(
                *[F.col(f"`{head}`").alias(name) for head, name in ROSTER_FILE_COLUMNS.items()]
            ),
            "report_review": report.withColumn("patient_id", F.col("patient_id").cast("int")),
        }
    )


def catalog_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member months read through a catalog table and through a view of it."""
    name = f"checked_orders_{zlib.crc32(sf_dir.encode())}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{sf_dir}/orders.parquet'"
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY VIEW {name}_months AS
            SELECT cast(o_custkey as int) AS patient_id, year(o_orderdate) AS yearmo,
              o_orderkey % 25 AS contract_key, o_orderpriority AS payer_patient_id,
              o_orderstatus AS payer_subscriber, o_orderstatus AS payer_relation,
              o_orderstatus AS data_sys
            FROM {name}"""
    )
    months = check_source(read_source(spark, {"table": f"{name}_months"}), "member_month")
    orders = read_source(spark, {"table": name})
    # Both are resolved to the given files by now; nothing is left in the catalog.
    spark.catalog.dropTempView(f"{name}_months")
    spark.sql(f"DROP TABLE {name}")
    return _tagged(
        {
            "view": in_period(months).select("patient_id", "contract_key"),
            "table": orders.select(
                F.col("o_custkey").cast("int").alias("patient_id"),
                (F.col("o_orderkey") % 25).alias("contract_key"),
            ),
        }
    )


QUERIES = {
    "latest_period": latest_period_rows,
    "cohort_build": cohort_build,
    "contract_filter": contract_filter,
    "current_rows": current_relations,
    "recode_project": recode_project,
    "distinct_project": distinct_project,
    "ci_match": ci_match,
    "prefix_filter": prefix_filter,
    "left_on_filter": left_on_filter,
    "employed_providers": employed_list,
    "semi_membership": semi_membership,
    "anti_exists": anti_exists,
    "attribution_max": attribution_max,
    "rank_first": rank_first_code,
    "payer_ids": ranked_payer_ids,
    "historical_id": historical_ids,
    "strip_prefix": strip_prefix_ids,
    "normalize_code": normalized_codes,
    "active_codes": active_code_rows,
    "blank_override": blank_override,
    "correction_overlay": correction_overlay,
    "other_codes": other_code_rows,
    "concat_names": concat_names,
    "roster_assemble": stage_rows,
    "route_null_id": route_null_id,
    "review_extract": review_extract,
    "suppress_unreviewed": suppression_cases,
    "gate_counts": gate_rows,
    "step_log": step_log,
    "varchar_conform": varchar_conform,
    "header_union": header_rows,
    "string_agg": joined_ids,
    "snapshot_roundtrip": snapshot_roundtrip,
    "archive_append": archive_append,
    "report_roundtrip": report_roundtrip,
    "roster_outputs": roster_outputs,
    "catalog_sources": catalog_sources,
    "roster_flagship": current_roster,
}
