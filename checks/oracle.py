"""The SQL each query is compared to, written as the plain joins and windows."""

from __future__ import annotations

import re

_MEMBER_COLUMNS = (
    "patient_id, last_name, first_name, middle_name, gender, birthdate, ssn, address_line1, "
    "address_line2, city, state, postal_code, phone_primary, patient_status"
)
_DEMOGRAPHICS = (
    "patient_id, last_name, first_name, middle_name, legal_sex, date_of_birth, ssn, address, "
    "address_second_line, city, state, zip_code, phone_number"
)
_PROVIDER_COLUMNS = (
    "provider_npi, provider_last_name, provider_first_name, provider_middle_name, "
    "provider_full_name, record_number"
)
_ROSTER_COLUMNS = (
    "patient_id, person_id, last_name, first_name, middle_name, legal_sex, date_of_birth, ssn, "
    "address, address_second_line, city, state, zip_code, phone_number, lob, contract_name, "
    + _PROVIDER_COLUMNS
)
_REPORT_COLUMNS = (
    "record_number, CAST(patient_id AS VARCHAR) AS patient_id, person_id, "
    "CAST(NULL AS VARCHAR) AS historical_person_id, last_name, first_name, middle_name, "
    "legal_sex, date_of_birth, ssn, address, address_second_line, city, state, zip_code, "
    "phone_number, lob, contract_name, provider_npi, provider_last_name, provider_first_name, "
    "provider_middle_name, provider_full_name"
)

_STAGE_TEXT = (
    "person_id, historical_person_id, last_name, first_name, middle_name, legal_sex, "
    "date_of_birth, ssn, address, address_second_line, city, state, zip_code, phone_number, lob, "
    "contract_name, provider_npi, provider_last_name, provider_first_name, provider_middle_name, "
    "provider_full_name, record_number"
).split(", ")


def _folded(rows: str) -> str:
    """One row of those that differ by case or trailing blanks only."""
    kept = ", ".join(f"min({name}) AS {name}" for name in _STAGE_TEXT)
    keys = ", ".join(f"lower(rtrim({name}))" for name in _STAGE_TEXT)
    return f"SELECT patient_id, {kept} FROM {rows} GROUP BY patient_id, {keys}"


# Named pieces; a piece may use the given tables and other pieces.
PIECES = {
    "member": """
        SELECT CAST(c_custkey AS INTEGER) AS patient_id,
               c_mktsegment || ' ' || CAST(c_custkey AS VARCHAR) AS last_name,
               c_name AS first_name, nullif(c_mktsegment, 'BUILDING') AS middle_name,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Male' WHEN 'BUILDING' THEN 'FEMALE  '
                    WHEN 'FURNITURE' THEN 'u' WHEN 'MACHINERY' THEN 'Unknown' END AS gender,
               DATE '1940-01-01' + (CAST(floor(c_acctbal) AS INTEGER) + 1000) AS birthdate,
               lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn,
               c_name || ' Street' AS address_line1,
               nullif(c_mktsegment, 'FURNITURE') AS address_line2,
               c_mktsegment AS city, CAST(c_nationkey AS VARCHAR) AS state,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code,
               lpad(CAST(c_custkey AS VARCHAR), 10, '5') AS phone_primary,
               CASE WHEN c_acctbal < 0 THEN 'Inactive' WHEN c_mktsegment = 'MACHINERY'
                    THEN 'ACTIVE  ' ELSE 'active' END AS patient_status
        FROM customer""",
    "member_month": """
        SELECT CAST(o_custkey AS INTEGER) AS patient_id,
               CAST(year(o_orderdate) AS INTEGER) AS yearmo, o_orderkey % 25 AS contract_key,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN 'XID' || CAST(o_custkey AS VARCHAR) || o_orderstatus
                    WHEN '2-HIGH' THEN 'xid' || CAST(o_custkey AS VARCHAR) || '     '
                    WHEN '5-LOW' THEN NULL
                    WHEN '3-MEDIUM' THEN CAST(o_custkey AS VARCHAR) || '-' || lower(o_orderstatus)
                    ELSE CAST(o_custkey AS VARCHAR) || '-' || o_orderstatus
                         || CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE '' END END
                    AS payer_patient_id,
               'S' || CAST(o_custkey AS VARCHAR) AS payer_subscriber,
               nullif(o_orderpriority, '3-MEDIUM') AS payer_relation,
               CASE o_orderstatus WHEN 'O' THEN 'ROSTER feed' WHEN 'P' THEN 'roster-2'
                    ELSE 'other' END AS data_sys
        FROM orders""",
    "contract_dim": """
        SELECT CAST(n_nationkey AS BIGINT) AS contract_key,
               CASE WHEN n_nationkey < 10 THEN r_name ELSE lower(r_name) || ' ' END
                    AS contract_name,
               n_name AS lob, CASE WHEN n_nationkey = 12 THEN 0 ELSE 1 END AS is_contracted
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "member_provider": """
        SELECT CAST(l_partkey AS INTEGER) AS patient_id, l_suppkey AS provider_key,
               CASE l_returnflag WHEN 'A' THEN 'PRIMARY' WHEN 'N' THEN 'primary '
                    ELSE 'Specialist' END AS relationship_type,
               l_shipdate AS relationship_end_date,
               CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS is_row_current
        FROM lineitem""",
    "provider_dim": """
        SELECT s_suppkey AS provider_key,
               lpad(CAST(s_suppkey // 2 AS VARCHAR), 10, '0') AS npi,
               CASE WHEN tail = '' THEN s_name ELSE lower(s_name) END AS first_name,
               CASE WHEN s_acctbal < 1000 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END
                    AS middle_name,
               'Supplier ' || CAST(s_suppkey AS VARCHAR) || tail AS last_name,
               CASE WHEN s_nationkey = 3 THEN 0 ELSE 1 END AS is_row_current
        FROM supplier JOIN (VALUES (''), (' ')) AS tails(tail)
             ON tail = '' OR s_suppkey % 2 = 0""",
    "member_provider_remote": """
        SELECT * REPLACE (CASE WHEN patient_id % 7 = 0 THEN 0 ELSE is_row_current END
                          AS is_row_current)
        FROM member_provider""",
    "provider_dim_remote": """
        SELECT * REPLACE (CASE WHEN provider_key % 11 = 0 THEN 0 ELSE is_row_current END
                          AS is_row_current)
        FROM provider_dim""",
    "provider": """
        SELECT s_suppkey AS contact_id,
               CASE WHEN s_nationkey = 4 THEN NULL
                    WHEN s_nationkey < 9
                    THEN lpad(CAST(s_suppkey // 2 AS VARCHAR), 10, '0') || ' '
                    ELSE lpad(CAST(s_suppkey // 2 AS VARCHAR), 10, '0') END AS npi,
               s_name AS first_name, 'Supplier ' || CAST(s_suppkey AS VARCHAR) AS last_name,
               CASE WHEN s_acctbal < 5000 THEN 'PCP' ELSE 'SPEC' END AS prov_type,
               CASE WHEN s_acctbal < 3000 THEN 'inactive' WHEN s_nationkey < 12 THEN 'Active'
                    ELSE 'ACTIVE' END AS status,
               CASE WHEN s_acctbal < 3000
                    THEN DATE '2000-01-01' + CAST(floor(s_acctbal) AS INTEGER) END
                    AS inactive_date
        FROM supplier""",
    "provider_plan": """
        SELECT p_partkey // 20 AS contact_id, p_brand AS med_plan,
               CASE WHEN p_size > 20 THEN DATE '2399-12-31' ELSE DATE '1999-01-01' END
                    AS termination_date
        FROM part""",
    "provider_practice": """
        SELECT p_partkey // 20 AS contact_id, p_name AS group_practice_name,
               CASE p_type WHEN 'PROMO' THEN '1' WHEN 'SMALL' THEN 'YES  '
                    WHEN 'MEDIUM' THEN 'yes' ELSE 'No' END AS primary_office,
               CASE WHEN p_size <= 25 THEN 'ACTIVE' ELSE 'Former' END AS provider_in_practice,
               CASE WHEN p_size <= 8 THEN 'Y' END AS hospital_employee
        FROM part""",
    "id_crosswalk": """
        SELECT CAST(user_id AS INTEGER) AS individual_id, event_type AS type_desc,
               CASE event_type
                    WHEN 'click' THEN CAST(event_id AS VARCHAR)
                         || CASE WHEN value > 50 THEN '   ' ELSE '' END
                    WHEN 'view' THEN 'V' || CAST(event_id AS VARCHAR)
                    WHEN 'purchase' THEN lpad(CAST(event_id AS VARCHAR), 12, '7')
                    WHEN 'signup' THEN 'xid' || CAST(event_id AS VARCHAR)
                    ELSE CASE WHEN value > 60 THEN '' ELSE '000' END END AS external_code,
               CASE WHEN value >= 10 THEN 'ACTIVE ' ELSE 'closed' END AS status,
               CAST(date_trunc('day', ts) AS TIMESTAMP) AS last_upd_date
        FROM events""",
    "id_correction": """
        SELECT CAST(s_suppkey AS INTEGER) AS patient_id,
               CASE WHEN s_nationkey = 7 THEN NULL ELSE 'C' || CAST(s_suppkey AS VARCHAR) END
                    AS correct_external_code
        FROM supplier""",
    "id_blank": """
        SELECT CAST(user_id AS INTEGER) AS patient_id,
               '0' || CAST(event_id AS VARCHAR)
                   || CASE WHEN value > 80 THEN ' ' ELSE '' END AS external_code
        FROM events WHERE event_type = 'click' AND value > 20""",
    "latest_month": """
        SELECT * FROM member_month WHERE yearmo = (SELECT max(yearmo) FROM member_month)""",
    "practice_rows": """
        SELECT contact_id, group_practice_name, hospital_employee FROM provider_practice
        WHERE lower(rtrim(primary_office)) IN ('1', 'yes')
          AND lower(rtrim(provider_in_practice)) = 'active'""",
    "employed_rows": """
        SELECT p.*, m.med_plan, m.termination_date, e.group_practice_name, e.hospital_employee,
               row_number() OVER (PARTITION BY lower(rtrim(p.npi))
                   ORDER BY lower(rtrim(p.status)) NULLS FIRST, m.termination_date DESC NULLS LAST,
                            p.inactive_date DESC NULLS LAST,
                            CASE WHEN e.hospital_employee IS NULL THEN 1 ELSE 0 END,
                            e.group_practice_name NULLS FIRST, p.contact_id, m.med_plan) AS rn
        FROM provider p
        JOIN provider_plan m ON m.contact_id = p.contact_id
             AND lower(m.med_plan) LIKE 'brand#2%' AND m.termination_date = DATE '2399-12-31'
        LEFT JOIN practice_rows e ON e.contact_id = p.contact_id""",
    "employed": """
        SELECT npi, med_plan, termination_date, group_practice_name,
               upper(last_name || ',' || first_name) AS provider_name,
               CASE WHEN hospital_employee IS NOT NULL THEN 'EMPLOYED' ELSE 'PRIVATE' END
                    AS employee,
               prov_type, status, inactive_date
        FROM employed_rows WHERE npi IS NOT NULL AND rn = 1""",
    "cohort_rows": """
        SELECT p.patient_id, p.last_name, p.first_name, p.middle_name,
               CASE lower(rtrim(p.gender)) WHEN 'male' THEN 'M' WHEN 'female' THEN 'F'
                    WHEN 'u' THEN 'U' ELSE 'OTH' END AS legal_sex,
               strftime(p.birthdate, '%Y%m%d') AS date_of_birth, p.ssn,
               p.address_line1 AS address, p.address_line2 AS address_second_line, p.city,
               p.state, p.postal_code AS zip_code, p.phone_primary AS phone_number,
               p.patient_status, d.lob, d.contract_name
        FROM member p
        JOIN latest_month m ON p.patient_id = m.patient_id
        JOIN contract_dim d ON d.contract_key = m.contract_key AND d.is_contracted = 1
        JOIN member_provider_remote r ON r.patient_id = m.patient_id
             AND lower(rtrim(r.relationship_type)) = 'primary' AND r.is_row_current = 1
        JOIN provider_dim_remote v ON v.provider_key = r.provider_key AND v.is_row_current = 1
        JOIN employed e ON lower(rtrim(e.npi)) = lower(rtrim(v.npi)) AND e.employee = 'EMPLOYED'
        WHERE lower(rtrim(d.contract_name)) IN ('asia', 'europe')
          AND lower(rtrim(p.patient_status)) = 'active'""",
    "cohort": f"""
        SELECT {_DEMOGRAPHICS}, patient_status, min(lob) AS lob,
               min(contract_name) AS contract_name, count(*) AS join_rows
        FROM cohort_rows
        GROUP BY {_DEMOGRAPHICS}, patient_status, lower(rtrim(lob)),
                 lower(rtrim(contract_name))""",
    "all_attributions": """
        SELECT k.patient_id, k.provider_key, min(d.npi) AS npi, min(d.first_name) AS first_name,
               min(d.middle_name) AS middle_name, min(d.last_name) AS last_name
        FROM (SELECT patient_id, max(provider_key) AS provider_key FROM member_provider
              WHERE relationship_end_date > TIMESTAMP '2001-06-01 00:00:00'
                AND is_row_current = 1 AND lower(rtrim(relationship_type)) = 'primary'
              GROUP BY patient_id) k
        JOIN provider_dim d ON d.provider_key = k.provider_key
        GROUP BY k.patient_id, k.provider_key, lower(rtrim(d.npi)), lower(rtrim(d.first_name)),
                 lower(rtrim(d.middle_name)), lower(rtrim(d.last_name))""",
    "stripped_ids": """
        SELECT *, CASE WHEN lower(payer_patient_id) LIKE 'xid%'
                       THEN substring(payer_patient_id, 4, length(rtrim(payer_patient_id)))
                       ELSE payer_patient_id END AS stripped_id
        FROM member_month""",
    "payer_rows": """
        SELECT m.patient_id, min(m.stripped_id) AS payer_patient_id,
               min(m.payer_subscriber || m.payer_relation) AS subscriber_id,
               min(d.contract_name) AS contract_name, min(d.lob) AS lob
        FROM stripped_ids m JOIN contract_dim d ON d.contract_key = m.contract_key
        WHERE m.yearmo = (SELECT max(yearmo) FROM member_month)
          AND lower(m.data_sys) LIKE 'roster%'
        GROUP BY m.patient_id, lower(rtrim(m.stripped_id)),
                 lower(rtrim(m.payer_subscriber || m.payer_relation)),
                 lower(rtrim(d.contract_name)), lower(rtrim(d.lob))""",
    "ranked_ids": """
        SELECT *, row_number() OVER (PARTITION BY patient_id, lower(rtrim(contract_name))
                      ORDER BY payer_patient_id NULLS LAST, subscriber_id NULLS LAST,
                               lob NULLS LAST, contract_name NULLS LAST) AS id_rank
        FROM payer_rows""",
    "second_ids": """
        SELECT patient_id, payer_patient_id AS second_id
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
                            ORDER BY contract_name NULLS LAST, payer_patient_id) AS pick
              FROM ranked_ids WHERE id_rank = 2)
        WHERE pick = 1""",
    "padded_codes": """
        SELECT *, right('0000000000' || external_code, 10) AS padded_code FROM id_crosswalk""",
    "code_rows": """
        SELECT individual_id AS patient_id,
               CASE WHEN regexp_full_match(trim(padded_code, ' '), '[0-9]+')
                    THEN coalesce(nullif(ltrim(trim(padded_code, ' '), '0'), ''), '0')
                    ELSE padded_code END AS code,
               CAST(length(external_code) AS INTEGER) AS code_length, last_upd_date
        FROM padded_codes
        WHERE lower(rtrim(type_desc)) IN ('click', 'view', 'purchase', 'signup', 'error')
          AND lower(external_code) NOT LIKE 'xid%' AND lower(rtrim(status)) = 'active'""",
    "latest_codes": """
        SELECT patient_id, code, code_length
        FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
                            ORDER BY last_upd_date DESC NULLS LAST, code, code_length)
                       AS rn
              FROM code_rows)
        WHERE rn = 1""",
    "blanked_codes": """
        SELECT c.patient_id, c.code_length,
               CASE WHEN EXISTS (SELECT 1 FROM id_blank b WHERE b.patient_id = c.patient_id
                                 AND ltrim(rtrim(b.external_code), '0') = c.code)
                    THEN '' ELSE c.code END AS code
        FROM latest_codes c""",
    "member_codes": """
        SELECT c.patient_id, c.code_length,
               CASE WHEN r.patient_id IS NOT NULL THEN r.correct_external_code ELSE c.code END
                    AS code
        FROM blanked_codes c LEFT JOIN id_correction r ON r.patient_id = c.patient_id""",
    "stage_spellings": """
        SELECT a.patient_id, p.payer_patient_id AS person_id,
               s.second_id AS historical_person_id, a.last_name, a.first_name, a.middle_name,
               a.legal_sex, a.date_of_birth, a.ssn, a.address, a.address_second_line, a.city,
               a.state, a.zip_code, a.phone_number, coalesce(p.lob, a.lob) AS lob,
               coalesce(p.contract_name, a.contract_name) AS contract_name,
               v.npi AS provider_npi, v.last_name AS provider_last_name,
               v.first_name AS provider_first_name, v.middle_name AS provider_middle_name,
               v.first_name || ' ' || v.middle_name || ' ' || v.last_name AS provider_full_name,
               c.code AS record_number
        FROM cohort_rows a
        LEFT JOIN member_codes c ON c.patient_id = a.patient_id
        LEFT JOIN ranked_ids p ON p.patient_id = a.patient_id AND p.id_rank = 1
        LEFT JOIN second_ids s ON s.patient_id = a.patient_id
        LEFT JOIN all_attributions v ON v.patient_id = a.patient_id""",
    "stage": _folded("stage_spellings"),
    "review_rows": f"""
        SELECT DISTINCT {_ROSTER_COLUMNS} FROM stage WHERE lower(last_name) LIKE 'house%'""",
    "missing_rows": f"""
        SELECT DISTINCT {_ROSTER_COLUMNS} FROM stage WHERE person_id IS NULL""",
    "current_rows": f"""
        SELECT DISTINCT {_ROSTER_COLUMNS} FROM stage
        WHERE person_id IS NOT NULL
          AND NOT coalesce(lower(last_name) LIKE 'house%'
                           AND patient_id NOT IN (SELECT patient_id FROM id_correction), FALSE)""",
    "unchosen_codes": """
        SELECT x.individual_id AS patient_id, min(x.padded_code) AS code
        FROM padded_codes x
        WHERE lower(rtrim(x.type_desc)) IN ('click', 'view', 'purchase', 'signup', 'error')
          AND lower(x.external_code) NOT LIKE 'xid%'
          AND NOT EXISTS (SELECT 1 FROM latest_codes c WHERE c.patient_id = x.individual_id
                          AND lower(rtrim(c.code)) = lower(rtrim(x.external_code)))
        GROUP BY x.individual_id, lower(rtrim(x.padded_code))""",
    "gate_rows": """
        SELECT 'missing_id' AS gate, count(*) AS n FROM missing_rows
        UNION ALL SELECT 'review', count(*) FROM review_rows""",
    "cohort_ids": """
        SELECT payer_patient_id FROM ranked_ids
        WHERE id_rank <= 2 AND patient_id IN (SELECT patient_id FROM cohort)""",
    "cohort_codes": """
        SELECT code_length FROM latest_codes
        WHERE patient_id IN (SELECT patient_id FROM cohort)""",
    "counted_steps": """
        SELECT 'cohort' AS message, count(*) AS row_count FROM cohort
        UNION ALL SELECT 'payer_id', count(*) FROM cohort_ids
        UNION ALL SELECT 'crosswalk', count(*) FROM cohort_codes
        UNION ALL SELECT 'attribution', count(*) FROM all_attributions
                  WHERE patient_id IN (SELECT patient_id FROM cohort)
        UNION ALL SELECT 'stage', count(*) FROM stage
        UNION ALL SELECT 'roster_current', count(*) FROM current_rows
        UNION ALL SELECT 'roster_missing_id', count(*) FROM missing_rows
        UNION ALL SELECT 'roster_review', count(*) FROM review_rows
        UNION ALL SELECT 'roster_archive', count(*) FROM current_rows
        UNION ALL SELECT 'roster_file', NULL
        UNION ALL SELECT 'roster', NULL""",
    "log_rows": """
        SELECT 'START' AS check_point, message, NULL AS row_count FROM counted_steps
        UNION ALL SELECT 'FINISH', message, row_count FROM counted_steps
        UNION ALL SELECT 'FINISH', 'payer_id: rows without payer_patient_id',
                         count(*) FILTER (payer_patient_id IS NULL) FROM cohort_ids
        UNION ALL SELECT 'FINISH', 'codes cut to their last characters',
                         count(*) FILTER (code_length > 10) FROM cohort_codes
        UNION ALL SELECT 'FINISH', 'stage: rows without person_id',
                         count(*) FILTER (person_id IS NULL) FROM stage
        UNION ALL SELECT 'FINISH', 'stage: rows without record_number',
                         count(*) FILTER (record_number IS NULL) FROM stage
        UNION ALL SELECT 'FINISH', 'stage: rows without provider_npi',
                         count(*) FILTER (provider_npi IS NULL) FROM stage
        UNION ALL SELECT 'ERROR', CASE gate
                         WHEN 'missing_id' THEN 'There are rows without a payer id in the roster.'
                         ELSE 'There are rows whose record number needs a review.' END, NULL
                  FROM gate_rows WHERE n > 1""",
    "listed_members": """
        SELECT nullif(patient_id, 3) AS patient_id, nullif(last_name, 'HOUSEHOLD 5') AS last_name
        FROM member""",
}

_SUPPRESSED = """
    SELECT '{name}' AS list, patient_id, last_name FROM listed_members
    WHERE NOT coalesce(lower(last_name) LIKE 'house%'
                       AND patient_id NOT IN ({keys}), FALSE)"""

FINAL = {
    "latest_period": "SELECT * FROM latest_month",
    "cohort_build": "SELECT * FROM cohort",
    "contract_filter": """SELECT * FROM contract_dim
        WHERE is_contracted = 1 AND lower(rtrim(contract_name)) IN ('asia', 'europe')""",
    "current_rows": "SELECT * FROM member_provider WHERE is_row_current = 1",
    "recode_project": """SELECT patient_id,
        CASE lower(rtrim(gender)) WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' WHEN 'u' THEN 'U'
             ELSE 'OTH' END AS legal_sex,
        strftime(birthdate, '%Y%m%d') AS date_of_birth, postal_code AS zip_code FROM member""",
    "distinct_project": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
    "ci_match": """SELECT patient_id, patient_status FROM member
        WHERE lower(rtrim(patient_status)) = 'active'""",
    "prefix_filter": """SELECT patient_id, yearmo, payer_patient_id, data_sys FROM member_month
        WHERE lower(data_sys) LIKE 'roster%' AND lower(payer_patient_id) NOT LIKE 'xid%'""",
    "left_on_filter": """SELECT p.contact_id, p.last_name, e.group_practice_name,
        CASE WHEN e.hospital_employee IS NOT NULL THEN 'EMPLOYED' ELSE 'PRIVATE' END AS employee
        FROM provider p LEFT JOIN practice_rows e ON e.contact_id = p.contact_id""",
    "employed_providers": "SELECT * FROM employed",
    "semi_membership": """SELECT patient_id, last_name FROM member
        WHERE patient_id IN (SELECT patient_id FROM latest_month)""",
    "anti_exists": """SELECT p.patient_id, p.last_name FROM member p
        WHERE NOT EXISTS (SELECT 1 FROM latest_month m WHERE m.patient_id = p.patient_id)""",
    "attribution_max": """SELECT DISTINCT a.* FROM all_attributions a
        WHERE a.patient_id IN (SELECT patient_id FROM cohort_rows)""",
    "rank_first": "SELECT * FROM latest_codes",
    "payer_ids": """SELECT patient_id, payer_patient_id, subscriber_id, contract_name, lob,
        CAST(id_rank AS INTEGER) AS id_rank FROM ranked_ids
        WHERE id_rank <= 2 AND patient_id IN (SELECT patient_id FROM cohort_rows)""",
    "historical_id": """SELECT p.patient_id, s.second_id AS historical_person_id
        FROM member p LEFT JOIN second_ids s ON s.patient_id = p.patient_id""",
    "strip_prefix": """SELECT patient_id, yearmo, payer_patient_id, stripped_id,
        payer_subscriber || payer_relation AS subscriber_id FROM stripped_ids""",
    "normalize_code": """SELECT individual_id, external_code, padded_code,
        CASE WHEN regexp_full_match(trim(padded_code, ' '), '[0-9]+')
             THEN coalesce(nullif(ltrim(trim(padded_code, ' '), '0'), ''), '0')
             ELSE padded_code END AS code
        FROM padded_codes""",
    "active_codes": "SELECT * FROM code_rows",
    "blank_override": "SELECT * FROM blanked_codes",
    "correction_overlay": "SELECT * FROM member_codes",
    "other_codes": "SELECT * FROM unchosen_codes WHERE TRUE",
    "concat_names": """SELECT provider_key, upper(last_name || ',' || first_name) AS provider_name,
        first_name || ' ' || middle_name || ' ' || last_name AS provider_full_name
        FROM provider_dim""",
    "roster_assemble": "SELECT * FROM stage",
    "route_null_id": f"""SELECT patient_id, person_id, lob,
        CASE WHEN person_id IS NULL THEN 'missing' ELSE 'current' END AS output
        FROM (SELECT DISTINCT {_ROSTER_COLUMNS} FROM stage)""",
    "review_extract": "SELECT * FROM review_rows",
    "suppress_unreviewed": " UNION ALL ".join(
        [
            _SUPPRESSED.format(name="empty", keys="SELECT 1 WHERE FALSE"),
            _SUPPRESSED.format(name="keys", keys="SELECT patient_id FROM id_correction"),
            _SUPPRESSED.format(
                name="null_key", keys="SELECT nullif(patient_id, 5) FROM id_correction"
            ),
        ]
    ),
    "gate_counts": """
        SELECT 'missing_id' AS gate, count(*) AS n, 1 AS threshold, count(*) > 1 AS fired
        FROM missing_rows
        UNION ALL SELECT 'review', count(*), 1, count(*) > 1 FROM review_rows""",
    "step_log": """
        SELECT 'run-1' AS run_id, 'member_roster' AS procedure_name, check_point,
               TIMESTAMP '2001-06-01 00:00:00' AS run_time, message,
               CAST(row_count AS BIGINT) AS row_count
        FROM log_rows""",
    "varchar_conform": """SELECT patient_id, last_name, city, patient_status,
        concat_ws(',', CASE WHEN length(rtrim(last_name)) > 12 THEN 'last_name' END,
                  CASE WHEN length(rtrim(city)) > 9 THEN 'city' END,
                  CASE WHEN length(rtrim(patient_status)) > 6 THEN 'patient_status' END)
            AS overflow_columns
        FROM (SELECT patient_id, last_name, city,
                     CASE WHEN length(rtrim(patient_status)) > 6 THEN patient_status
                          ELSE substring(patient_status, 1, 6) END AS patient_status
              FROM member)""",
    "header_union": """SELECT 'patient_id' AS patient_id, 'last_name' AS last_name,
        'middle_name' AS middle_name
        UNION ALL SELECT CAST(patient_id AS VARCHAR), last_name, middle_name FROM member""",
    "string_agg": """SELECT patient_id,
        coalesce(string_agg(payer_patient_id, '~' ORDER BY payer_patient_id), '')
            AS payer_patient_ids
        FROM ranked_ids WHERE payer_patient_id IS NOT NULL GROUP BY patient_id""",
    "snapshot_roundtrip": f"SELECT {_MEMBER_COLUMNS} FROM member",
    "archive_append": """SELECT patient_id, last_name, run_id FROM member,
        (VALUES ('2001'), ('2002')) AS runs(run_id)""",
    "report_roundtrip": f"SELECT {_REPORT_COLUMNS} FROM review_rows",
    "roster_outputs": """
        SELECT *, 'current' AS output FROM current_rows
        UNION ALL BY NAME SELECT *, 'missing_id' AS output FROM missing_rows
        UNION ALL BY NAME SELECT *, 'review' AS output FROM review_rows
        UNION ALL BY NAME
        SELECT *, CAST(NULL AS VARCHAR) AS subscriber_id, '2001-06-01 00:00:00' AS sent_at,
               'run-1' AS run_id, 'archive' AS output FROM current_rows
        UNION ALL BY NAME
        SELECT 'run-1' AS run_id, n, gate AS message, 'alerts' AS output
        FROM gate_rows WHERE n > 1
        UNION ALL BY NAME
        SELECT 'run-1' AS run_id, check_point, 2 * count(*) AS n, 'run_log' AS output
        FROM log_rows GROUP BY check_point
        UNION ALL BY NAME
        SELECT record_number, CAST(NULL AS VARCHAR) AS historical_person_id, last_name, first_name,
               middle_name, legal_sex, date_of_birth, ssn, address, address_second_line, city,
               state, zip_code, phone_number, 'roster_file' AS output FROM current_rows
        UNION ALL BY NAME
        SELECT *, 'report_review' AS output FROM review_rows
        WHERE (SELECT count(*) FROM review_rows) > 1""",
    "catalog_sources": """
        SELECT patient_id, contract_key, 'view' AS output FROM latest_month
        UNION ALL
        SELECT CAST(o_custkey AS INTEGER), o_orderkey % 25, 'table' FROM orders""",
    "roster_flagship": "SELECT * FROM current_rows",
}

_NAMES = re.compile(r"\b(" + "|".join(PIECES) + r")\b")


def _needed(sql: str, done: list[str], given: set[str]) -> list[str]:
    """The pieces ``sql`` uses, each after the ones it uses itself."""
    for name in _NAMES.findall(sql):
        if name not in done and name not in given:
            _needed(PIECES[name], done, given)
            if name not in done:
                done.append(name)
    return done


def complete(sql: str, given: set[str] = frozenset()) -> str:
    """``sql`` with the pieces it needs; those in ``given`` exist as tables."""
    pieces = [f"{name} AS ({PIECES[name]})" for name in _needed(sql, [], given)]
    return f"WITH {', '.join(pieces)} {sql}" if pieces else sql


ORACLE_SQL = {name: complete(sql) for name, sql in FINAL.items()}
