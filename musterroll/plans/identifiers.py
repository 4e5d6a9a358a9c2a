"""Payer identifiers and cross-walked record numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from musterroll.config import RosterConfig
from musterroll.functions.text import (
    ci_eq,
    ci_in,
    ci_prefix,
    distinct_folded,
    fold,
    normalize_code,
    strip_prefix,
)
from musterroll.operators.joins import overlay, restrict_around, without_keys
from musterroll.operators.ranking import rank_first, rank_rows
from musterroll.plans.cohort import in_period


def payer_ids(
    member_month: DataFrame,
    contract_dim: DataFrame,
    cfg: RosterConfig,
    period: int | Column | None = None,
    cohort: DataFrame | None = None,
    top: int | None = 2,
) -> DataFrame:
    """Different payer ids of the period, ranked per member and contract.

    The roster uses ranks 1 and 2 only. Ids that differ by case or trailing blanks are
    one id. The grouping spreads on all columns and the rank limit then cuts each
    group inside the map tasks, so a member with very many ids is never gathered in
    one place; ``top=None`` ranks them all and does gather them.
    """
    contracts = contract_dim.select("contract_key", "contract_name", "lob")

    def ranked(months: DataFrame) -> DataFrame:
        rows = months.join(contracts, "contract_key").select(
            "patient_id",
            strip_prefix("payer_patient_id", cfg.id_prefix).alias("payer_patient_id"),
            F.concat("payer_subscriber", "payer_relation").alias("subscriber_id"),
            "contract_name",
            "lob",
        )
        return rank_rows(
            distinct_folded(
                rows, ["payer_patient_id", "subscriber_id", "contract_name", "lob"]
            ),
            ["patient_id", fold("contract_name")],
            [
                F.col("payer_patient_id").asc_nulls_last(),
                F.col("subscriber_id").asc_nulls_last(),
                F.col("lob").asc_nulls_last(),
                F.col("contract_name").asc_nulls_last(),
            ],
            name="id_rank",
            top=top,
        )

    months = in_period(member_month, period).where(
        F.col("patient_id").isNotNull() & ci_prefix("data_sys", cfg.data_sys_prefix)
    )
    return restrict_around(months, cohort, "patient_id", ranked)


def active_codes(id_crosswalk: DataFrame, cfg: RosterConfig) -> DataFrame:
    """Active external codes of the allowed types, normalized; NULL codes drop out."""
    return id_crosswalk.where(
        F.col("individual_id").isNotNull()
        & ci_in("type_desc", cfg.code_types)
        & ~ci_prefix("external_code", cfg.id_prefix)
        & ci_eq("status", cfg.code_status)
    ).select(
        F.col("individual_id").alias("patient_id"),
        normalize_code("external_code", cfg.code_width).alias("code"),
        F.length("external_code").alias("code_length"),
        "last_upd_date",
    )


def crosswalk(
    id_crosswalk: DataFrame, cfg: RosterConfig, cohort: DataFrame | None = None
) -> DataFrame:
    """The latest code of each member; equal dates are settled by the code."""

    def latest(codes: DataFrame) -> DataFrame:
        return rank_first(
            codes,
            ["patient_id"],
            [
                F.col("last_upd_date").desc_nulls_last(),
                F.col("code").asc(),
                F.col("code_length").asc(),
            ],
        )

    return restrict_around(active_codes(id_crosswalk, cfg), cohort, "patient_id", latest).select(
        "patient_id", "code", "code_length"
    )


def blank_codes(codes: DataFrame, blanks: DataFrame, width: int = 10) -> DataFrame:
    """Empty the code of listed (member, code) pairs."""
    return override_codes(codes, blanks, None, width)


def override_codes(
    codes: DataFrame,
    blanks: DataFrame,
    corrections: DataFrame | None,
    width: int = 10,
    written: bool = False,
) -> DataFrame:
    """Blank listed codes, then apply reviewed corrections; the order matters.

    Both lists are gathered per member, each in one row, so that ``codes`` meets them
    in one join on the member. A member's list of blanked codes is small. With
    ``written`` ``codes`` is a table, cheap to read again, and only its members' lists
    are gathered.
    """
    listed = blanks.select(
        F.col("patient_id"),
        fold(normalize_code("external_code", width)).alias("_blank"),
        F.lit(None).cast("string").alias("_value"),
        F.lit(False).alias("_correction"),
    ).where(F.col("patient_id").isNotNull() & F.col("_blank").isNotNull())
    if corrections is not None:
        fixed = corrections.where(F.col("patient_id").isNotNull()).select(
            F.col("patient_id"),
            F.lit(None).cast("string"),
            F.col("correct_external_code"),
            F.lit(True),
        )
        listed = listed.union(fixed)

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.groupBy("patient_id").agg(
            F.collect_set("_blank").alias("_blanks"),
            F.min("_value").alias("_value"),
            F.bool_or("_correction").alias("_corrected"),
        )

    fixes = restrict_around(
        listed, codes if written else None, "patient_id", gathered
    ).withColumnRenamed("patient_id", "_fix_id")
    blanked = F.when(F.array_contains("_blanks", fold("code")), "").otherwise(F.col("code"))
    return (
        codes.join(fixes, codes["patient_id"] == fixes["_fix_id"], "left")
        .withColumn("code", F.when(F.col("_corrected"), F.col("_value")).otherwise(blanked))
        .select(*codes.columns)
    )


def other_codes(
    id_crosswalk: DataFrame, codes: DataFrame, cfg: RosterConfig, cohort: DataFrame | None = None
) -> DataFrame:
    """Allowed codes of each member other than the chosen one, active or not.

    The chosen code is compared with the code as stored, padded ones included.
    """
    stored = id_crosswalk.where(
        F.col("individual_id").isNotNull()
        & ci_in("type_desc", cfg.code_types)
        & ~ci_prefix("external_code", cfg.id_prefix)
    ).select(
        F.col("individual_id").alias("patient_id"),
        fold("external_code").alias("_stored"),
        F.right(
            F.concat(F.lit("0" * cfg.code_width), F.col("external_code")), F.lit(cfg.code_width)
        ).alias("code"),
    )
    chosen = codes.select("patient_id", fold("code").alias("_stored"))

    def others(rows: DataFrame) -> DataFrame:
        left = without_keys(rows.distinct(), chosen, ["patient_id", "_stored"])
        return distinct_folded(left.select("patient_id", "code"), ["code"])

    return restrict_around(stored, cohort, "patient_id", others)


def first_ids(ranked: DataFrame) -> DataFrame:
    """First payer ids per member and contract, each with the member's second id.

    With second ids in several contracts the first contract's one is taken. Ranks
    1 and 2 of a member are at most two rows per contract name, so the member
    window stays small.
    """
    place = F.struct(
        F.col("contract_name").isNull().alias("no_contract"),
        F.col("contract_name"),
        F.col("payer_patient_id"),
    )
    second = F.min(F.when(F.col("id_rank") == 2, place)).over(W.partitionBy("patient_id"))
    return (
        ranked.where(F.col("id_rank") <= 2)
        .withColumn("second_id", second["payer_patient_id"])
        .where(F.col("id_rank") == 1)
        .select("patient_id", "payer_patient_id", "contract_name", "lob", "second_id")
    )


def historical_id(stage: DataFrame, ranked: DataFrame) -> DataFrame:
    """Put each member's second payer id into a stage; members without one stay."""
    second = rank_first(
        ranked.where(F.col("id_rank") == 2),
        ["patient_id"],
        [F.col("contract_name").asc_nulls_last(), F.col("payer_patient_id").asc_nulls_last()],
    ).select("patient_id", F.col("payer_patient_id").alias("second_id"))
    return overlay(stage, second, "patient_id", "historical_person_id", "second_id")
