"""The latest period and the members the roster is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from musterroll.config import RosterConfig
from musterroll.functions.text import ci_eq, ci_in, day_text, fold, recode
from musterroll.plans.providers import current_rows


def latest_period(member_month: DataFrame) -> DataFrame:
    """The highest period as one row; NULL if there are no months."""
    return member_month.agg(F.max("yearmo").alias("yearmo"))


def in_period(member_month: DataFrame, period: int | Column | None = None) -> DataFrame:
    """The months of ``period``, by default of the latest one.

    A known period prunes partitions when the plan is made, the default one when
    its scalar subquery has run.
    """
    wanted = latest_period(member_month).scalar() if period is None else period
    return member_month.where(F.col("yearmo") == wanted)


def contract_months(
    member_month: DataFrame,
    contract_dim: DataFrame,
    cfg: RosterConfig,
    period: int | Column | None = None,
) -> DataFrame:
    """Members of the chosen contracts with the number of months behind each row.

    Names that fold alike get one spelling in the short contract table, so the long
    fact is grouped by plain values, in a hash table, before it is shuffled.
    """
    alike = Window.partitionBy(fold("lob"), fold("contract_name"))
    contracts = contract_dim.where(
        (F.col("is_contracted") == 1) & ci_in("contract_name", cfg.contract_names)
    ).select(
        "contract_key",
        F.min("lob").over(alike).alias("lob"),
        F.min("contract_name").over(alike).alias("contract_name"),
    )
    return (
        in_period(member_month, period)
        .select("patient_id", "contract_key")
        .join(contracts, "contract_key")
        .groupBy("patient_id", "lob", "contract_name")
        .agg(F.count(F.lit(1)).alias("months"))
    )


def employed_relations(
    member_provider: DataFrame,
    provider_dim: DataFrame,
    employed: DataFrame,
    cfg: RosterConfig,
) -> DataFrame:
    """Members with a current primary relation to an employed provider, counted.

    ``employed`` has one row per NPI, so a semi join finds the provider rows. It
    also keeps their size estimate at that of the provider table, so the long
    relation table meets few keys without a shuffle. Many keys are grouped by more
    than the join column: the join then reads both sides straight from a shuffle,
    where adaptive execution can split a provider that most members have.
    """
    npis = employed.where(ci_eq("employee", cfg.employed_label)).select(fold("npi").alias("_npi"))
    keys = (
        current_rows(provider_dim)
        .groupBy("provider_key", fold("npi").alias("_npi"))
        .agg(F.count(F.lit(1)).alias("provider_rows"))
        .join(npis, "_npi", "left_semi")
        .select("provider_key", "provider_rows")
    )
    return (
        current_rows(member_provider)
        .where(ci_eq("relationship_type", cfg.relationship_type))
        .select("patient_id", "provider_key")
        .join(keys, "provider_key")
        .groupBy("patient_id")
        .agg(F.sum("provider_rows").alias("relations"))
    )


def build_cohort(
    member: DataFrame,
    member_month: DataFrame,
    contract_dim: DataFrame,
    member_provider: DataFrame,
    provider_dim: DataFrame,
    employed: DataFrame,
    cfg: RosterConfig,
    period: int | Column | None = None,
) -> DataFrame:
    """Active members of the contracts in the period, one row per LOB and contract.

    The plain six-way join holds a row for each pair of a month and a relation.
    Months and relations are counted per member before they meet instead, and
    ``join_rows`` carries how many rows the plain join has, so that a member with
    very many of both stays one row.
    """
    months = contract_months(member_month, contract_dim, cfg, period)
    relations = employed_relations(member_provider, provider_dim, employed, cfg)
    return (
        member.where(ci_eq("patient_status", cfg.member_status))
        .join(months, "patient_id")
        .join(relations, "patient_id")
        .select(
            "patient_id",
            "last_name",
            "first_name",
            "middle_name",
            recode("gender", cfg.sex_codes, cfg.sex_other).alias("legal_sex"),
            day_text("birthdate").alias("date_of_birth"),
            "ssn",
            F.col("address_line1").alias("address"),
            F.col("address_line2").alias("address_second_line"),
            "city",
            "state",
            F.col("postal_code").alias("zip_code"),
            F.col("phone_primary").alias("phone_number"),
            "patient_status",
            "lob",
            "contract_name",
            (F.col("months") * F.col("relations")).alias("join_rows"),
        )
    )
