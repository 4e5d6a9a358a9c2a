"""A small invented population: every table of the roster with a few rows."""

from __future__ import annotations

from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from musterroll import RosterConfig, RosterSources

AS_OF = datetime(2024, 3, 15)
OPEN = date(2399, 12, 31)
LATER = datetime(2099, 1, 1)

CONFIG = RosterConfig(
    contract_names=("North Plan",),
    plan_prefix="open",
    data_sys_prefix="north",
    id_prefix="PRE",
    code_types=("CHART", "CLINIC ID"),
    review_prefix="77",
)

SCHEMAS = {
    "provider": "contact_id bigint, npi string, first_name string, last_name string, "
    "degree string, prov_type string, status string, inactive_date date",
    "provider_plan": "contact_id bigint, med_plan string, termination_date date",
    "provider_practice": "contact_id bigint, group_practice_name string, primary_office string, "
    "provider_in_practice string, hospital_employee string",
    "member": "patient_id int, last_name string, first_name string, middle_name string, "
    "gender string, birthdate date, ssn string, address_line1 string, address_line2 string, "
    "city string, state string, postal_code string, phone_primary string, patient_status string",
    "member_month": "patient_id int, yearmo int, contract_key bigint, payer_patient_id string, "
    "payer_subscriber string, payer_relation string, data_sys string",
    "contract_dim": "contract_key bigint, contract_name string, lob string, is_contracted int",
    "member_provider": "patient_id int, provider_key bigint, relationship_type string, "
    "relationship_end_date timestamp_ntz, is_row_current int",
    "provider_dim": "provider_key bigint, npi string, first_name string, middle_name string, "
    "last_name string, is_row_current int",
    "id_crosswalk": "individual_id int, type_desc string, external_code string, status string, "
    "last_upd_date timestamp_ntz",
    "id_correction": "patient_id int, correct_external_code string",
    "id_blank": "patient_id int, external_code string",
}


def frame(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return local_frame(spark, rows, SCHEMAS[name])


def local_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


def person(patient_id, last_name="Oak", middle_name="M", gender="Male", state="ZZ", status="Active"):
    return (
        patient_id,
        last_name,
        f"First{patient_id}",
        middle_name,
        gender,
        date(1980, 1, 2),
        f"000-00-{patient_id:04d}",
        "1 Test Way",
        None,
        "Testville",
        state,
        "00000",
        "555-0100",
        status,
    )


def month(patient_id, yearmo=202402, contract_key=1, payer_id="PREA1", data_sys="North Feed"):
    return (patient_id, yearmo, contract_key, payer_id, f"S{patient_id}", "01", data_sys)


def relation(patient_id, provider_key=10, kind="Primary", end=LATER, current=1):
    return (patient_id, provider_key, kind, end, current)


def code(patient_id, external_code, when=datetime(2024, 1, 1), kind="Chart", status="Active"):
    return (patient_id, kind, external_code, status, when)


DEFAULT_ROWS = {
    "provider": [(100, "1111111111", "Ann", "Elm", "MD", "PCP", "Active", None)],
    "provider_plan": [(100, "Open Choice", OPEN)],
    "provider_practice": [(100, "Elm Street", "Yes", "Active", "Y")],
    "member": [person(1)],
    "member_month": [month(1)],
    "contract_dim": [
        (1, "North Plan", "HMO", 1),
        (2, "North Plan", "PPO", 1),
        (3, "South Plan", "HMO", 1),
        (4, "North Plan", "OLD", 0),
    ],
    "member_provider": [relation(1)],
    "provider_dim": [
        (10, "1111111111", "Ann", "B", "Elm", 1),
        (11, "2222222222", "Bob", None, "Ash", 1),
    ],
    "id_crosswalk": [code(1, "42")],
    "id_correction": [],
    "id_blank": [],
}


# The remote copies, where a test has no rows of their own for them.
LOCAL_COPIES = {"member_provider_remote": "local", "provider_dim_remote": "local"}


def sources(spark: SparkSession, **rows) -> RosterSources:
    """The default tables with some of them replaced."""
    unknown = set(rows) - set(SCHEMAS) - {"member_provider_remote", "provider_dim_remote"}
    assert not unknown, unknown
    tables = {
        name: frame(spark, name, rows.get(name, DEFAULT_ROWS[name])) for name in SCHEMAS
    }
    for copy in LOCAL_COPIES:
        if copy in rows:
            tables[copy] = frame(spark, copy.removesuffix("_remote"), rows[copy])
    return RosterSources({**LOCAL_COPIES, **tables})


def values(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples, NULLs first."""
    rows = [tuple(row) for row in df.select(*columns).collect()]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])
