"""What the plans must look like at scale, and heavy keys against plain SQL."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from musterroll import RosterSources
from musterroll.operators.aggregates import string_agg
from musterroll.operators.joins import suppress
from musterroll.plans.cohort import build_cohort, contract_months, employed_relations
from musterroll.plans.identifiers import crosswalk, payer_ids
from musterroll.plans.providers import attribute, employed_providers
from musterroll.plans.roster import roster_stage
from musterroll.sinks.workspace import Workspace
from tests.fixtures import AS_OF, CONFIG, LOCAL_COPIES, SCHEMAS, local_frame, sources


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """The small population as parquet tables, read with shuffled joins only."""
    data = sources(spark)
    work = Workspace(spark, "scale")
    tables = {name: work.keep(data[name], name) for name in SCHEMAS}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield RosterSources({**LOCAL_COPIES, **tables})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    work.drop()


def test_stage_has_no_product_join_and_no_python(stored):
    plan = plan_of(roster_stage(stored, CONFIG, AS_OF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert word not in plan
    assert "SortMergeJoin" in plan


def test_ranks_are_cut_before_the_shuffle(stored):
    for df in (
        crosswalk(stored.id_crosswalk, CONFIG),
        payer_ids(stored.member_month, stored.contract_dim, CONFIG, top=2),
        employed_providers(
            stored.provider, stored.provider_plan, stored.provider_practice, CONFIG
        ),
    ):
        plan = plan_of(df)
        assert plan.count(", Partial") >= plan.count(", Final") >= 1


def test_counts_and_maxima_are_combined_before_the_shuffle(stored):
    plan = plan_of(attribute(stored.member_provider, stored.provider_dim, AS_OF, CONFIG))
    assert "partial_max(provider_key" in plan
    plan = plan_of(contract_months(stored.member_month, stored.contract_dim, CONFIG, 202402))
    assert "partial_count" in plan
    employed = employed_providers(
        stored.provider, stored.provider_plan, stored.provider_practice, CONFIG
    )
    plan = plan_of(
        employed_relations(stored.member_provider, stored.provider_dim, employed, CONFIG)
    )
    assert "partial_sum" in plan


def test_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(attribute(stored.member_provider, stored.provider_dim, AS_OF, CONFIG))
    assert "GreaterThan(relationship_end_date,2024-03-15" in plan
    assert "EqualTo(is_row_current,1)" in plan
    plan = plan_of(contract_months(stored.member_month, stored.contract_dim, CONFIG, 202402))
    assert "EqualTo(yearmo,202402)" in plan
    assert "payer_patient_id" not in plan
    plan = plan_of(contract_months(stored.member_month, stored.contract_dim, CONFIG))
    assert "EqualTo(yearmo,ScalarSubquery" in plan


def test_a_known_period_reads_its_partition_only(spark, stored, tmp_path):
    path = str(tmp_path / "months")
    stored.member_month.write.partitionBy("yearmo").parquet(path)
    plan = plan_of(contract_months(spark.read.parquet(path), stored.contract_dim, CONFIG, 202402))
    assert "PartitionFilters: [isnotnull(yearmo" in plan


def test_the_distinct_of_the_stage_needs_no_shuffle_of_its_own(stored):
    plan = plan_of(roster_stage(stored, CONFIG, AS_OF))
    above = plan[: plan.index("SortMergeJoin")]
    assert above.count("Aggregate(key=[patient_id") == 2
    assert "Exchange" not in above


def test_tables_bucketed_by_member_are_not_shuffled(spark, stored, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS roster_buckets LOCATION '{tmp_path}/db'")
    try:
        keys = {
            "member": "patient_id",
            "member_provider": "patient_id",
            "id_crosswalk": "individual_id",
        }
        tables = {name: stored[name] for name in SCHEMAS}
        for name, key in keys.items():
            table = f"roster_buckets.{name}"
            tables[name].write.bucketBy(4, key).sortBy(key).saveAsTable(table)
            tables[name] = spark.table(table)
        bucketed = RosterSources({**LOCAL_COPIES, **tables})

        def shuffles(data):
            return (
                plan_of(data.member.join(crosswalk(data.id_crosswalk, CONFIG), "patient_id")),
                plan_of(attribute(data.member_provider, data.provider_dim, AS_OF, CONFIG)),
            )

        for with_buckets, plain in zip(shuffles(bucketed), shuffles(stored), strict=True):
            assert "Exchange hashpartitioning(patient_id" in plain
            assert "Exchange hashpartitioning(individual_id" not in with_buckets
            assert "Exchange hashpartitioning(patient_id" not in with_buckets
    finally:
        spark.sql("DROP DATABASE IF EXISTS roster_buckets CASCADE")


def test_suppression_joins_on_the_key(spark, stored):
    members = stored.member.select("patient_id", "last_name")
    plan = plan_of(
        suppress(members, F.col("last_name").startswith("77"), "patient_id", stored.id_correction)
    )
    assert "SortMergeJoin [_key" in plan
    assert plan.count("SortMergeJoin") == 1 and "Union" not in plan
    assert "NestedLoop" not in plan


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_one_order_of_restriction(spark, stored, threshold):
    """Few keys or many: the maxima are taken first, heavy members shrink in the map tasks."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        shapes = set()
        for n in (2, 2_000_000):
            cohort = spark.range(n).select(F.col("id").cast("int").alias("patient_id"))
            df = attribute(stored.member_provider, stored.provider_dim, AS_OF, CONFIG, cohort)
            plan = df._jdf.queryExecution().analyzed().toString()
            shapes.add(tuple(re.findall(r"[A-Z][A-Za-z]+(?= |$)", line)[0] for line in plan.splitlines()[:12]))
            assert "partial_max(provider_key" in plan_of(df)
        assert len(shapes) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def small_skew(spark):
    """Sizes at which adaptive execution splits already on test data."""
    settings = {
        # With many partitions a heavy key stands far above the median, compressed or not.
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_provider_of_a_third_of_the_members_is_split(spark, small_skew):
    data = sources(spark)
    relations = spark.range(200_000).repartition(16).selectExpr(
        "cast(id as int) as patient_id",
        "case when id % 3 = 0 then 10L else id end as provider_key",
        "'Primary' as relationship_type",
        "1 as is_row_current",
    )
    providers = spark.range(1000).selectExpr(
        "id as provider_key", "'1111111111' as npi", "1 as is_row_current"
    )
    employed = employed_providers(
        data.provider, data.provider_plan, data.provider_practice, CONFIG
    )
    got = employed_relations(relations, providers, employed, CONFIG)
    rows = got.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(got)
    assert len(rows) == 66_667 + 666 and {r["relations"] for r in rows} == {1}


# -- a third of all rows under one key ----------------------------------------------


@pytest.fixture(scope="module")
def heavy():
    pick = random.Random(7)
    codes, months = [], []
    start = datetime(2024, 1, 1)
    for i in range(30_000):
        member = 1 if i % 3 == 0 else pick.randint(2, 4000)
        codes.append(
            (
                member,
                pick.choice(["Chart", "CLINIC ID", "Other"]),
                pick.choice([str(i), str(pick.randint(0, 50)), f"PRE{i}", f"X{i}"]),
                pick.choice(["Active", "ACTIVE ", "Closed"]),
                start + timedelta(days=pick.randint(0, 30)),
            )
        )
        months.append(
            (
                member,
                202402,
                pick.randint(1, 4),
                pick.choice([f"PRE{i}", f"{i % 97}", None]),
                "S",
                pick.choice(["1", "2"]),
                "North",
            )
        )
    return codes, months


def duck(rows, ddl, name):
    connection = duckdb.connect()
    names = [part.split()[0] for part in ddl.split(", ")]
    connection.register(name, pd.DataFrame(rows, columns=names))
    return connection


def test_heavy_member_in_the_crosswalk(spark, heavy):
    codes, _ = heavy
    got = crosswalk(local_frame(spark, codes, SCHEMAS["id_crosswalk"]).repartition(8), CONFIG)
    want = duck(codes, SCHEMAS["id_crosswalk"], "x").execute(
        """SELECT individual_id, code FROM (
             SELECT *, row_number() OVER (PARTITION BY individual_id
                                          ORDER BY last_upd_date DESC, code) AS rn
             FROM (SELECT *, right('0000000000' || external_code, 10) AS p,
                     CASE WHEN regexp_full_match(p, '[0-9]+')
                          THEN coalesce(nullif(ltrim(p, '0'), ''), '0') ELSE p END AS code
                   FROM x WHERE lower(type_desc) IN ('chart', 'clinic id')
                     AND external_code NOT LIKE 'PRE%' AND lower(rtrim(status)) = 'active'))
           WHERE rn = 1"""
    ).fetchall()
    assert sorted((r[0], r[1]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_heavy_member_in_the_payer_ids(spark, heavy, threshold):
    _, months = heavy
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        contracts = sources(spark).contract_dim
        cohort = spark.range(1, 1000).select(F.col("id").cast("int").alias("patient_id"))
        got = payer_ids(
            local_frame(spark, months, SCHEMAS["member_month"]).repartition(8),
            contracts,
            CONFIG,
            cohort=cohort,
            top=2,
        ).select("patient_id", "contract_name", "id_rank", "payer_patient_id", "lob").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    connection = duck(months, SCHEMAS["member_month"], "m")
    want = connection.execute(
        """SELECT patient_id, contract_name, id_rank, id, lob FROM (
             SELECT *, row_number() OVER (PARTITION BY patient_id, contract_name
                 ORDER BY id NULLS LAST, sub, lob) AS id_rank
             FROM (SELECT DISTINCT patient_id,
                     CASE WHEN payer_patient_id LIKE 'PRE%' THEN substring(payer_patient_id, 4)
                          ELSE payer_patient_id END AS id,
                     payer_subscriber || payer_relation AS sub, d.contract_name, d.lob
                   FROM m JOIN (VALUES (1, 'North Plan', 'HMO'), (2, 'North Plan', 'PPO'),
                                       (3, 'South Plan', 'HMO'), (4, 'North Plan', 'OLD'))
                        d(contract_key, contract_name, lob) USING (contract_key)))
           WHERE id_rank <= 2 AND patient_id < 1000"""
    ).fetchall()
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_heavy_member_in_the_counts(spark):
    """Members with many months and many relations stay one row with the full count."""
    many_months = spark.range(100_000).selectExpr(
        "1 as patient_id", "202402 as yearmo", "1L as contract_key", "'A' as payer_patient_id",
        "'S' as payer_subscriber", "'1' as payer_relation", "'North' as data_sys",
    )
    related = spark.range(100_000).selectExpr(
        "1 as patient_id", "10L as provider_key", "'Primary' as relationship_type",
        "timestamp_ntz'2099-01-01' as relationship_end_date", "1 as is_row_current",
    )
    data = sources(spark)
    employed = employed_providers(
        data.provider, data.provider_plan, data.provider_practice, CONFIG
    )
    got = build_cohort(
        data.member, many_months, data.contract_dim, related, data.provider_dim, employed, CONFIG
    )
    assert [(r["patient_id"], r["join_rows"]) for r in got.collect()] == [(1, 10**10)]


def test_order_of_the_input_does_not_matter(spark, heavy):
    codes, _ = heavy
    shuffled = list(codes)
    random.Random(3).shuffle(shuffled)

    def result(rows):
        got = crosswalk(local_frame(spark, rows, SCHEMAS["id_crosswalk"]).repartition(5), CONFIG)
        return sorted(map(tuple, got.collect()))

    assert result(codes) == result(shuffled)


def test_string_agg_counts_equal_values_before_grouping(spark):
    rows = spark.range(30_000).selectExpr("1 as k", "cast(id % 2 as string) as v")
    [row] = string_agg(rows, ["k"], "v").collect()
    assert row["v"] == "~".join(["0"] * 15_000 + ["1"] * 15_000)
