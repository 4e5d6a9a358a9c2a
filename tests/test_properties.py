"""Random populations, with NULLs and repeats everywhere, against the plain SQL."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import duckdb
import pandas as pd
import pytest

from checks.compare import differences
from checks.oracle import FINAL, complete
from checks.standins import AS_OF, CONFIG
from musterroll import RosterSources
from musterroll.plans.identifiers import crosswalk, other_codes, override_codes, payer_ids
from musterroll.plans.providers import attribute, employed_providers
from musterroll.plans.roster import cohort_of, roster_stage
from musterroll.plans.stage import route, suppress_unreviewed
from musterroll.schemas import ROSTER_COLUMNS
from tests.fixtures import LOCAL_COPIES, OPEN, SCHEMAS, local_frame

MEMBERS = 40


def random_rows(seed: int) -> dict[str, list[tuple]]:
    pick = random.Random(seed)

    def some(*choices):
        return pick.choice(choices)

    def anyone():
        return pick.choice([None, *range(1, MEMBERS + 3)])

    def day(year=2001):
        return some(None, datetime(year, 1, 1) + timedelta(days=pick.randint(0, 400)))

    # A NULL key in the corrections stops all suppression; try it both ways.
    reviewed = pick.sample(range(1, MEMBERS + 1), 12) + ([None] if seed % 2 else [])
    return {
        "provider": [
            (
                contact, some(None, "n1", "N1 ", "n2", "n3", "N4"), some("Ann", None), f"L{contact}",
                "MD", some("PCP", None), some("Active", "ACTIVE", "inactive", None),
                some(None, date(2020, 1, 1), date(2021, 1, 1)),
            )
            for contact in range(1, 16)
        ],
        "provider_plan": [
            (pick.randint(1, 18), some("Brand#2", "brand#21", "Brand#3", None),
             some(OPEN, OPEN, date(1999, 1, 1), None))
            for _ in range(60)
        ],
        "provider_practice": [
            (pick.randint(1, 18), some("P1", "P2", "P3", None), some("1", "YES ", "yes", "No", None),
             some("Active", "ACTIVE ", "Former", None), some("Y", None))
            for _ in range(120)
        ],
        "member": [
            (
                i, some("Oak", "HOUSE of Oak", "house", None), some("Al", None), some("M", None),
                some("Male", "female ", "u", "x", None), some(None, date(1980, 1, 2)),
                f"{i}", "1 Way", some(None, "Apt"), "T", "ZZ", "00000", None,
                some("Active", "ACTIVE ", "active", "Deceased", None),
            )
            for i in range(1, MEMBERS + 1)
        ],
        "member_month": [
            (
                anyone(), some(2000, 2001, 2001, 2001), some(1, 2, 3, 4, 5, None),
                some(None, "", "XID1", "xid2  ", "1", "2", "3", "XID3"), some("S1", "S2", None),
                some("01", "02", None), some("Roster A", "ROSTER", "other", None),
            )
            for _ in range(260)
        ],
        "contract_dim": [
            (1, "Asia", "HMO", 1), (2, "ASIA ", "PPO", 1), (3, "europe", "HMO", 1),
            (4, "Africa", None, 1), (5, "Asia", "OLD", 0), (6, None, "HMO", 1),
        ],
        "member_provider": [
            (anyone(), some(1, 2, 3, 4, 5, 9, None), some("Primary", "PRIMARY ", "Other", None),
             day(), some(1, 1, 0, None))
            for _ in range(500)
        ],
        "provider_dim": [
            (some(1, 2, 3, 4, 5), some("n1", "N1", "n2 ", "n3", "n4", None), some("Ann", "Bo"),
             some("M", None), f"D{i}", some(1, 1, 0))
            for i in range(14)
        ],
        "id_crosswalk": [
            (anyone(), some("click", "CLICK ", "View", "none", None),
             some("7", "0000000042", "0", "AB12", "991234567890", "1E5", "", "xid9", None,
                  str(pick.randint(0, 99))),
             some("Active", "ACTIVE ", "closed", None), day(2000))
            for _ in range(160)
        ],
        "id_correction": [(i, some(None, f"C{i}", "")) for i in reviewed],
        "id_blank": [(anyone(), some("7", "42", "0042", "9", None)) for _ in range(30)],
    }


@pytest.fixture(scope="module", params=[1, 2, 3])
def population(spark, request):
    rows = random_rows(request.param)
    connection = duckdb.connect()
    for name, ddl in SCHEMAS.items():
        kinds = {"timestamp_ntz": "timestamp", "string": "varchar", "int": "integer"}
        parts = [part.split() for part in ddl.split(", ")]
        columns = ", ".join(f"{column} {kinds.get(kind, kind)}" for column, kind in parts)
        connection.execute(f"CREATE TABLE {name} ({columns})")
        marks = ", ".join("?" for _ in parts)
        connection.executemany(f"INSERT INTO {name} VALUES ({marks})", rows[name])
    frames = {name: local_frame(spark, rows[name], SCHEMAS[name]) for name in SCHEMAS}
    for copy in LOCAL_COPIES:
        original = copy.removesuffix("_remote")
        connection.execute(f"CREATE VIEW {copy} AS SELECT * FROM {original}")
    return RosterSources({**LOCAL_COPIES, **frames}), connection


def same(population, df, sql: str) -> int:
    _, connection = population
    rows, problem = differences(df, connection, complete(sql, {*SCHEMAS, *LOCAL_COPIES}))
    assert problem is None
    return rows


def test_steps(population):
    data, _ = population
    cohort = cohort_of(data, CONFIG)
    codes = crosswalk(data.id_crosswalk, CONFIG)
    employed = employed_providers(
        data.provider, data.provider_plan, data.provider_practice, CONFIG
    )
    same(population, employed, FINAL["employed_providers"])
    assert same(population, cohort, FINAL["cohort_build"]) > 0
    assert same(population, codes, f"{FINAL['rank_first']} WHERE patient_id IS NOT NULL") > 0
    same(population, override_codes(codes, data.id_blank, data.id_correction),
         f"{FINAL['correction_overlay']} WHERE patient_id IS NOT NULL")
    same(population, other_codes(data.id_crosswalk, codes, CONFIG),
         f"{FINAL['other_codes']} AND patient_id IS NOT NULL")
    same(population, payer_ids(data.member_month, data.contract_dim, CONFIG, cohort=cohort),
         FINAL["payer_ids"])
    same(population, attribute(data.member_provider, data.provider_dim, AS_OF, CONFIG, cohort),
         FINAL["attribution_max"])


def test_stage_and_outputs(spark, population):
    data, connection = population
    rows = roster_stage(data, CONFIG, AS_OF).collect()
    ddl = ", ".join(
        f"{name} {'int' if name == 'patient_id' else 'string'}" for name in rows[0].asDict()
    )
    stage = local_frame(spark, [tuple(row) for row in rows], ddl)
    assert same(population, stage, FINAL["roster_assemble"]) > 0
    routed = route(stage, CONFIG)
    kept = suppress_unreviewed(routed.current, data.id_correction, CONFIG)
    same(population, routed.review, "SELECT * FROM review_rows")
    same(population, routed.missing, "SELECT * FROM missing_rows")
    same(population, kept, "SELECT * FROM current_rows")

    def whole(df):
        return [tuple(row) for row in df.select(*ROSTER_COLUMNS).collect()]

    current, missing, after = whole(routed.current), whole(routed.missing), whole(kept)
    assert len(set(current)) == len(current) and len(set(missing)) == len(missing)
    assert not set(current) & set(missing)
    assert set(current) | set(missing) == set(whole(stage))
    assert set(after) <= set(current)
    number_of = {}
    for row in rows:
        assert number_of.setdefault(row["patient_id"], row["record_number"]) == row["record_number"]


def test_random_tables_hold_nulls():
    for name, rows in random_rows(1).items():
        if name not in ("contract_dim",):
            assert pd.DataFrame(rows).isna().any().any(), name
