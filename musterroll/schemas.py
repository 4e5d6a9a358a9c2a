"""Columns of the inputs and outputs.

Source columns carry a kind instead of one exact type, because the same master
table arrives as int or bigint keys, boolean or 0/1 flags, and either timestamp
type, depending on where it is read from.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY, TEXT, DAY, MOMENT, FLAG = "key", "text", "day", "moment", "flag"

KIND_TYPES: dict[str, tuple[type, ...]] = {
    KEY: (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType),
    TEXT: (T.StringType, T.VarcharType, T.CharType),
    DAY: (T.DateType, T.TimestampType, T.TimestampNTZType),
    MOMENT: (T.TimestampType, T.TimestampNTZType, T.DateType),
    FLAG: (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType),
}

_MEMBER_PROVIDER = {
    "patient_id": KEY,
    "provider_key": KEY,
    "relationship_type": TEXT,
    "relationship_end_date": MOMENT,
    "is_row_current": FLAG,
}
_PROVIDER_DIM = {
    "provider_key": KEY,
    "npi": TEXT,
    "first_name": TEXT,
    "middle_name": TEXT,
    "last_name": TEXT,
    "is_row_current": FLAG,
}

SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "provider": {
        "contact_id": KEY,
        "npi": TEXT,
        "first_name": TEXT,
        "last_name": TEXT,
        "degree": TEXT,
        "prov_type": TEXT,
        "status": TEXT,
        "inactive_date": DAY,
    },
    "provider_plan": {"contact_id": KEY, "med_plan": TEXT, "termination_date": DAY},
    "provider_practice": {
        "contact_id": KEY,
        "group_practice_name": TEXT,
        "primary_office": TEXT,
        "provider_in_practice": TEXT,
        "hospital_employee": TEXT,
    },
    "member": {
        "patient_id": KEY,
        "last_name": TEXT,
        "first_name": TEXT,
        "middle_name": TEXT,
        "gender": TEXT,
        "birthdate": DAY,
        "ssn": TEXT,
        "address_line1": TEXT,
        "address_line2": TEXT,
        "city": TEXT,
        "state": TEXT,
        "postal_code": TEXT,
        "phone_primary": TEXT,
        "patient_status": TEXT,
    },
    "member_month": {
        "patient_id": KEY,
        "yearmo": KEY,
        "contract_key": KEY,
        "payer_patient_id": TEXT,
        "payer_subscriber": TEXT,
        "payer_relation": TEXT,
        "data_sys": TEXT,
    },
    "contract_dim": {
        "contract_key": KEY,
        "contract_name": TEXT,
        "lob": TEXT,
        "is_contracted": FLAG,
    },
    # The cohort and the attribution read their own copies of these two tables.
    "member_provider": _MEMBER_PROVIDER,
    "member_provider_remote": _MEMBER_PROVIDER,
    "provider_dim": _PROVIDER_DIM,
    "provider_dim_remote": _PROVIDER_DIM,
    "id_crosswalk": {
        "individual_id": KEY,
        "type_desc": TEXT,
        "external_code": TEXT,
        "status": TEXT,
        "last_upd_date": MOMENT,
    },
    "id_correction": {"patient_id": KEY, "correct_external_code": TEXT},
    "id_blank": {"patient_id": KEY, "external_code": TEXT},
}


def _row(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# The stage's columns and their greatest lengths.
STAGE_SCHEMA = _row(
    ("patient_id", T.IntegerType()),
    ("person_id", T.VarcharType(50)),
    ("historical_person_id", T.VarcharType(50)),
    ("last_name", T.VarcharType(100)),
    ("first_name", T.VarcharType(100)),
    ("middle_name", T.VarcharType(100)),
    ("legal_sex", T.VarcharType(50)),
    ("date_of_birth", T.VarcharType(10)),
    ("ssn", T.VarcharType(11)),
    ("address", T.VarcharType(100)),
    ("address_second_line", T.VarcharType(100)),
    ("city", T.VarcharType(50)),
    ("state", T.VarcharType(2)),
    ("zip_code", T.VarcharType(10)),
    ("phone_number", T.VarcharType(20)),
    ("lob", T.VarcharType(250)),
    ("contract_name", T.VarcharType(50)),
    ("provider_npi", T.VarcharType(10)),
    ("provider_last_name", T.VarcharType(100)),
    ("provider_first_name", T.VarcharType(100)),
    ("provider_middle_name", T.VarcharType(100)),
    ("provider_full_name", T.VarcharType(100)),
    ("record_number", T.VarcharType(100)),
)

# The three snapshot tables: the stage without the historical id.
ROSTER_COLUMNS = [f.name for f in STAGE_SCHEMA if f.name != "historical_person_id"]

# Fixed order of the alert report; the historical id is there but never filled.
REPORT_COLUMNS = ["record_number", "patient_id", "person_id", "historical_person_id"] + [
    name for name in ROSTER_COLUMNS if name not in ("record_number", "patient_id", "person_id")
]

# The roster file's headings, in order, and the roster columns under them.
ROSTER_FILE_COLUMNS = {
    "Person ID": "record_number",
    "Historical Person ID": "historical_person_id",
    "Last Name": "last_name",
    "First Name": "first_name",
    "Middle Name": "middle_name",
    "Legal Sex": "legal_sex",
    "Date of Birth": "date_of_birth",
    "Social Security Number": "ssn",
    "Address": "address",
    "Address Second Line": "address_second_line",
    "City": "city",
    "State": "state",
    "Zip Code": "zip_code",
    "Phone Number": "phone_number",
}

RUN_LOG_SCHEMA = _row(
    ("run_id", T.StringType()),
    ("procedure_name", T.StringType()),
    ("check_point", T.StringType()),
    ("run_time", T.TimestampNTZType()),
    ("message", T.StringType()),
    ("row_count", T.LongType()),
)
