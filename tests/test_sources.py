from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from musterroll import RosterConfig, RosterSources, load_sources, roster_stage, run
from musterroll.plans.cohort import latest_period
from musterroll.sources.catalog import (
    SourceError,
    check_source,
    jdbc_options,
    partition_values,
    read_source,
)
from tests.fixtures import (
    AS_OF,
    CONFIG,
    DEFAULT_ROWS,
    LOCAL_COPIES,
    SCHEMAS,
    frame,
    local_frame,
    values,
)


def tables(spark):
    given = {name: frame(spark, name, DEFAULT_ROWS[name]) for name in SCHEMAS}
    return {**LOCAL_COPIES, **given}


def test_only_needed_columns_are_read(spark):
    extra = frame(spark, "id_blank", [(1, "2")]).withColumn("note", F.lit("x"))
    assert check_source(extra, "id_blank").columns == ["patient_id", "external_code"]


def test_boolean_flags_become_numbers(spark):
    contracts = frame(spark, "contract_dim", DEFAULT_ROWS["contract_dim"])
    contracts = contracts.withColumn("is_contracted", F.col("is_contracted") == 1)
    assert values(check_source(contracts, "contract_dim"), "is_contracted") == [(0,), (1,), (1,), (1,)]


def test_missing_and_mistyped_columns_are_named(spark):
    blanks = frame(spark, "id_blank", [])
    with pytest.raises(SourceError, match="external_code"):
        check_source(blanks.drop("external_code"), "id_blank")
    with pytest.raises(SourceError, match="patient_id: string is not a key"):
        check_source(blanks.withColumn("patient_id", F.lit("x")), "id_blank")


def test_missing_and_unknown_tables(spark):
    given = tables(spark)
    with pytest.raises(SourceError, match="member_month"):
        RosterSources({k: v for k, v in given.items() if k != "member_month"})
    with pytest.raises(SourceError, match="extra"):
        RosterSources({**given, "extra": given["member"]})


def test_a_table_is_read_when_first_used(spark):
    calls = []

    def read():
        calls.append(1)
        return frame(spark, "member_provider", DEFAULT_ROWS["member_provider"])

    data = RosterSources({**tables(spark), "member_provider": read})
    assert calls == []
    assert data.member_provider is data.member_provider_remote
    assert calls == [1]
    with pytest.raises(AttributeError):
        _ = data.nothing


def test_parquet_table_and_view(spark, tmp_path):
    blanks = frame(spark, "id_blank", [(1, "2")])
    blanks.write.parquet(str(tmp_path / "blanks"))
    blanks.createOrReplaceTempView("blank_view")
    for spec in ({"parquet": str(tmp_path / "blanks")}, {"table": "blank_view"}):
        assert values(read_source(spark, spec), "patient_id", "external_code") == [(1, "2")]
    for spec in ({}, {"parquet": "a", "table": "b"}, {"excel": "a"}):
        with pytest.raises(SourceError):
            read_source(spark, spec)


def test_load_sources_checks_everything(spark):
    specs = {}
    for name, df in tables(spark).items():
        if isinstance(df, str):
            specs[name] = df
            continue
        df.createOrReplaceTempView(f"t_{name}")
        specs[name] = {"table": f"t_{name}"}
    assert load_sources(spark, specs).member.count() == 1
    frame(spark, "id_blank", []).drop("patient_id").createOrReplaceTempView("t_id_blank")
    with pytest.raises(SourceError, match="id_blank"):
        load_sources(spark, specs)


def test_remote_reads_split_on_a_whole_range():
    base = {"url": "jdbc:x://host/db", "dbtable": "dim"}
    split = {"partitionColumn": "provider_key", "lowerBound": 1, "upperBound": 10**9, "numPartitions": 64}
    small = jdbc_options({**base, "single_task": True})
    assert small["fetchsize"] == "10000" and "single_task" not in small
    with pytest.raises(SourceError, match="single_task"):
        jdbc_options(base)
    assert jdbc_options({**base, **split})["numPartitions"] == "64"
    with pytest.raises(SourceError):
        jdbc_options({**base, "partitionColumn": "provider_key"})
    with pytest.raises(SourceError):
        jdbc_options({"url": "jdbc:x://host/db"})


def test_remote_copies_are_never_assumed(spark):
    given = {name: df for name, df in tables(spark).items() if not name.endswith("_remote")}
    with pytest.raises(SourceError, match="member_provider_remote"):
        RosterSources(given)
    with pytest.raises(SourceError, match="local"):
        RosterSources({**tables(spark), "provider_dim_remote": "elsewhere"})


def test_periods_from_a_partition_list(spark, tmp_path):
    months = local_frame(spark, [(1, 202401), (2, 202403)], "patient_id int, yearmo int")
    name = "months_by_period"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        months.write.partitionBy("yearmo").option("path", str(tmp_path / "m")).saveAsTable(name)
        periods = partition_values(spark, name, "yearmo")
        assert latest_period(periods).first()[0] == 202403
        assert "FileScan" not in periods._jdf.queryExecution().executedPlan().toString()
        assert partition_values(spark, name, "patient_id") is None
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_registered_partition_without_rows_is_no_period(spark, tmp_path):
    """The job and the lazy plan take the highest period that has rows."""
    given = tables(spark)
    name = "months_with_an_empty_partition"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        months = given["member_month"].select(
            *[c for c in given["member_month"].columns if c != "yearmo"], "yearmo"
        )
        months.write.partitionBy("yearmo").option("path", str(tmp_path / "m")).saveAsTable(name)
        newest = months.agg(F.max("yearmo")).first()[0]
        for later in (newest + 1, newest + 2):
            spark.sql(f"ALTER TABLE {name} ADD PARTITION (yearmo = {later})")
        given["member_month"] = spark.table(name)
        data = RosterSources(given, partition_values(spark, name, "yearmo"))
        assert latest_period(data.periods).first()[0] == newest + 2
        assert data.newest_period() == newest
        result = run(spark, data, CONFIG, AS_OF, "r", str(tmp_path / "out"))
        assert result.period == newest and result.counts["roster_current"] > 0
        lazy = roster_stage(data, CONFIG, AS_OF)
        assert lazy.count() == result.counts["stage"]
        months.where("false").write.mode("overwrite").insertInto(name)
        for partition in [r.yearmo for r in months.select("yearmo").distinct().collect()]:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (yearmo = {partition})")
        empty = RosterSources({**given, "member_month": spark.table(name)},
                              partition_values(spark, name, "yearmo"))
        assert empty.newest_period() is None
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_newest_period_without_a_partition_list(spark):
    given = tables(spark)
    data = RosterSources(given)
    assert data.newest_period() == latest_period(given["member_month"]).first()[0]
    none = RosterSources({**given, "member_month": given["member_month"].where("false")})
    assert none.newest_period() is None


def test_config_from_json(tmp_path):
    path = tmp_path / "config.json"
    path.write_text(
        '{"contract_names": ["A"], "plan_prefix": "p", "data_sys_prefix": "d", "id_prefix": "i",'
        ' "code_types": ["t"], "review_prefix": "r", "open_end_date": "2399-12-31"}'
    )
    cfg = RosterConfig.from_json(str(path))
    assert cfg.contract_names == ("A",)
    assert cfg.open_end_date == CONFIG.open_end_date
    with pytest.raises(ValueError, match="colour"):
        RosterConfig.from_dict({"colour": 1})
    with pytest.raises(TypeError):
        RosterConfig("A", "p", "d", "i", ("t",), "r")
    with pytest.raises(ValueError):
        RosterConfig(("A",), "p", "d", "i", ("t",), "r", on_overflow="cut")
