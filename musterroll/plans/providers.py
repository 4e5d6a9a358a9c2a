"""The employed-provider list and the attribution of members to providers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.config import RosterConfig
from musterroll.functions.text import (
    ci_eq,
    ci_in,
    ci_prefix,
    distinct_folded,
    fold,
    joined_name,
)
from musterroll.operators.ranking import rank_first
from musterroll.operators.joins import restrict_around


def current_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_row_current") == 1)


def after(df: DataFrame, column: str, as_of: datetime) -> Column:
    """``column`` later than ``as_of``, compared in the column's own type.

    The moment is typed like the column, so the test reaches the file scan.
    """
    moment = F.lit(as_of.isoformat(sep=" ")).cast(df.schema[column].dataType)
    return F.col(column) > moment


def primary_practices(provider_practice: DataFrame, cfg: RosterConfig) -> DataFrame:
    return provider_practice.where(
        ci_in("primary_office", cfg.primary_office_values)
        & ci_eq("provider_in_practice", cfg.practice_status)
    ).select("contact_id", "group_practice_name", "hospital_employee")


def employee_flag(cfg: RosterConfig) -> Column:
    employed = F.col("hospital_employee").isNotNull()
    return F.when(employed, cfg.employed_label).otherwise(F.lit(cfg.private_label))


def best_practice(provider_practice: DataFrame, cfg: RosterConfig) -> DataFrame:
    """One primary active practice per contact: employing ones first, then by name."""
    return rank_first(
        primary_practices(provider_practice, cfg),
        ["contact_id"],
        [
            F.col("hospital_employee").isNull().asc(),
            F.col("group_practice_name").asc_nulls_first(),
        ],
    )


def employed_providers(
    provider: DataFrame,
    provider_plan: DataFrame,
    provider_practice: DataFrame,
    cfg: RosterConfig,
) -> DataFrame:
    """One row per NPI of the plan's open providers, flagged employed or private.

    The best row of an NPI has the lowest status, then the latest inactive date,
    then an employing practice. The termination date is the same on every open
    row. Plans and practices are cut to the one row per contact that can win
    before the join, so a contact with many of them joins as one row.
    """
    open_end = F.lit(cfg.open_end_date).cast(provider_plan.schema["termination_date"].dataType)
    open_plans = (
        provider_plan.where(
            (F.col("termination_date") == open_end) & ci_prefix("med_plan", cfg.plan_prefix)
        )
        .groupBy("contact_id")
        .agg(F.min("med_plan").alias("med_plan"))
    )
    rows = (
        provider.where(F.col("npi").isNotNull())
        .join(open_plans, "contact_id")
        .join(best_practice(provider_practice, cfg), "contact_id", "left")
    )
    best = rank_first(
        rows,
        [fold("npi")],
        [
            fold("status").asc_nulls_first(),
            F.col("inactive_date").desc_nulls_last(),
            F.col("hospital_employee").isNull().asc(),
            F.col("group_practice_name").asc_nulls_first(),
            F.col("contact_id").asc(),
            F.col("med_plan").asc(),
        ],
    )
    return best.select(
        "npi",
        "med_plan",
        F.lit(cfg.open_end_date).alias("termination_date"),
        "group_practice_name",
        F.upper(joined_name("last_name", "first_name", sep=",")).alias("provider_name"),
        employee_flag(cfg).alias("employee"),
        "prov_type",
        "status",
        "inactive_date",
    )


def attribute(
    member_provider: DataFrame,
    provider_dim: DataFrame,
    as_of: datetime,
    cfg: RosterConfig,
    cohort: DataFrame | None = None,
) -> DataFrame:
    """The highest unexpired current primary provider of each member, with names.

    Without ``cohort`` every member is attributed, for callers that join the
    result to their members anyway.
    """

    def highest(relations: DataFrame) -> DataFrame:
        return relations.groupBy("patient_id").agg(F.max("provider_key").alias("provider_key"))

    relations = (
        current_rows(member_provider)
        .where(after(member_provider, "relationship_end_date", as_of))
        .where(F.col("patient_id").isNotNull())
        .where(ci_eq("relationship_type", cfg.relationship_type))
        .select("patient_id", "provider_key")
    )
    # A member has one provider key here, so what is distinct of a key's names is distinct
    # of the member's: the short table is reduced instead of the long one.
    names = provider_dim.select("provider_key", "npi", "first_name", "middle_name", "last_name")
    names = distinct_folded(names, ["npi", "first_name", "middle_name", "last_name"])
    attributed = restrict_around(relations, cohort, "patient_id", highest)
    return attributed.join(names, "provider_key").select("patient_id", *names.columns)
