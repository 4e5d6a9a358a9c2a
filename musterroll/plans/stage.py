"""Putting the roster together and sending its rows to the output tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from musterroll.config import RosterConfig
from musterroll.functions.text import ci_prefix, distinct_folded, joined_name
from musterroll.operators.joins import suppress, without_keys
from musterroll.plans.identifiers import first_ids
from musterroll.schemas import ROSTER_COLUMNS, STAGE_SCHEMA

_DEMOGRAPHICS = [
    "patient_id",
    "last_name",
    "first_name",
    "middle_name",
    "legal_sex",
    "date_of_birth",
    "ssn",
    "address",
    "address_second_line",
    "city",
    "state",
    "zip_code",
    "phone_number",
]


def assemble(
    cohort: DataFrame, codes: DataFrame, ranked_ids: DataFrame, attribution: DataFrame
) -> DataFrame:
    """One distinct row per member, first payer id and contract.

    Rows that differ by case or trailing blanks only are one row. All four inputs meet
    on the member, so each is shuffled once at most and the distinct finds its rows
    already together. The historical id is the same on
    all rows of a member, so taking it along does not change what is distinct.
    """
    ids = first_ids(ranked_ids).select(
        "patient_id",
        F.col("payer_patient_id").alias("person_id"),
        F.col("second_id").alias("historical_person_id"),
        F.col("lob").alias("id_lob"),
        F.col("contract_name").alias("id_contract"),
    )
    record_numbers = codes.select("patient_id", F.col("code").alias("record_number"))
    providers = attribution.select(
        "patient_id",
        F.col("npi").alias("provider_npi"),
        F.col("last_name").alias("provider_last_name"),
        F.col("first_name").alias("provider_first_name"),
        F.col("middle_name").alias("provider_middle_name"),
        joined_name("first_name", "middle_name", "last_name").alias("provider_full_name"),
    )
    rows = (
        cohort.select(*_DEMOGRAPHICS, "lob", "contract_name")
        .join(record_numbers, "patient_id", "left")
        .join(ids, "patient_id", "left")
        .join(providers, "patient_id", "left")
        .withColumn("lob", F.coalesce("id_lob", "lob"))
        .withColumn("contract_name", F.coalesce("id_contract", "contract_name"))
        .select(*STAGE_SCHEMA.names)
    )
    return distinct_folded(rows, [name for name in STAGE_SCHEMA.names if name != "patient_id"])


@dataclass(frozen=True)
class Routed:
    current: DataFrame
    missing: DataFrame
    review: DataFrame


def has_review_name(cfg: RosterConfig) -> Column:
    return ci_prefix("last_name", cfg.review_prefix)


def route(stage: DataFrame, cfg: RosterConfig, corrections: DataFrame | None = None) -> Routed:
    """Rows with a payer id, rows without one, and rows to review (of either kind).

    The stage is distinct and its historical id depends on the member alone, so
    dropping that column makes no equal rows and the outputs need no second
    distinct. An empty payer id is an id. With ``cfg.only_unreviewed`` members in
    ``corrections`` are left out of the review rows.
    """
    rows = stage.select(*ROSTER_COLUMNS)
    review = rows.where(has_review_name(cfg))
    if cfg.only_unreviewed:
        if corrections is None:
            raise ValueError("only_unreviewed needs the corrections")
        review = without_keys(review, corrections, ["patient_id"])
    return Routed(
        current=rows.where(F.col("person_id").isNotNull()),
        missing=rows.where(F.col("person_id").isNull()),
        review=review,
    )


def gate_counts(stage: DataFrame, cfg: RosterConfig) -> DataFrame:
    """The two gates' counts in one pass over the stage: missing_id and review."""
    return stage.agg(
        F.count_if(F.col("person_id").isNull()).alias("missing_id"),
        F.count_if(has_review_name(cfg)).alias("review"),
    )


def suppress_unreviewed(
    current: DataFrame, corrections: DataFrame, cfg: RosterConfig, written: bool = False
) -> DataFrame:
    """Hold back review names whose record number nobody has looked up yet.

    With ``written`` the rows come from a table and other names are not shuffled.
    """
    return suppress(current, has_review_name(cfg), "patient_id", corrections, written=written)


def sent_rows(current: DataFrame) -> DataFrame:
    """Archive rows: the sent columns and a subscriber id that is never filled."""
    return current.select(*ROSTER_COLUMNS, F.lit(None).cast("string").alias("subscriber_id"))

