"""The edge cases of each step on invented rows."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from musterroll.functions.text import distinct_folded
from musterroll.plans.cohort import build_cohort, in_period, latest_period
from musterroll.plans.identifiers import (
    blank_codes,
    crosswalk,
    historical_id,
    other_codes,
    override_codes,
    payer_ids,
)
from musterroll.plans.providers import attribute, employed_providers
from musterroll.plans.roster import cohort_of, roster_stage
from musterroll.plans.stage import assemble, route, sent_rows, suppress_unreviewed
from musterroll.schemas import ROSTER_COLUMNS, STAGE_SCHEMA
from tests.fixtures import (
    AS_OF,
    CONFIG,
    LATER,
    OPEN,
    code,
    frame,
    local_frame,
    month,
    person,
    relation,
    sources,
    values,
)

PAST = datetime(2020, 1, 1)


def stage(spark, **rows):
    return roster_stage(sources(spark, **rows), CONFIG, AS_OF)


def employed(spark, **rows):
    data = sources(spark, **rows)
    return employed_providers(data.provider, data.provider_plan, data.provider_practice, CONFIG)


# -- period ---------------------------------------------------------------------


def test_only_the_latest_period_counts(spark):
    months = [month(1, 202401, payer_id="OLD"), month(1, 202402, payer_id="PRENEW"), month(2, 202401)]
    data = sources(spark, member=[person(1), person(2)], member_month=months,
                   member_provider=[relation(1), relation(2)])
    assert values(latest_period(data.member_month), "yearmo") == [(202402,)]
    assert values(in_period(data.member_month), "patient_id") == [(1,)]
    assert values(in_period(data.member_month, 202401), "patient_id") == [(1,), (2,)]
    assert values(roster_stage(data, CONFIG, AS_OF), "patient_id", "person_id") == [(1, "NEW")]


def test_empty_fact_gives_an_empty_roster(spark):
    data = sources(spark, member_month=[])
    assert values(latest_period(data.member_month), "yearmo") == [(None,)]
    assert roster_stage(data, CONFIG, AS_OF).count() == 0


# -- employed providers ------------------------------------------------------------


def test_an_employing_practice_wins(spark):
    got = employed(
        spark,
        provider_practice=[
            (100, "A Private", "1", "ACTIVE", None),
            (100, "B Hospital", "yes ", "active ", "Y"),
            (100, "A Hospital", "Yes", "Active", "Y"),
            (100, "0 Former", "Yes", "Former", "Y"),
            (100, "0 Second", "No", "Active", "Y"),
        ],
    )
    assert values(got, "npi", "group_practice_name", "employee", "provider_name") == [
        ("1111111111", "A Hospital", "EMPLOYED", "ELM,ANN")
    ]


def test_without_a_primary_practice_a_provider_is_private(spark):
    got = employed(spark, provider_practice=[(100, "Elm Street", "No", "Active", "Y")])
    assert values(got, "npi", "group_practice_name", "employee") == [("1111111111", None, "PRIVATE")]


def test_null_npi_and_closed_or_foreign_plans_drop_out(spark):
    got = employed(
        spark,
        provider=[
            (100, None, "Ann", "Elm", "MD", "PCP", "Active", None),
            (101, "2", "Bob", "Ash", "MD", "PCP", "Active", None),
            (102, "3", "Cy", "Fir", "MD", "PCP", "Active", None),
            (103, "4", "Di", "Yew", "MD", "PCP", "Active", None),
            (104, "5", "Ed", "Bay", "MD", "PCP", "Active", None),
        ],
        provider_plan=[
            (100, "open", OPEN),
            (101, "OPENLY", OPEN),
            (102, "Open", date(2023, 1, 1)),
            (103, "Shut", OPEN),
        ],
    )
    assert values(got, "npi") == [("2",)]


def test_best_row_of_an_npi(spark):
    def provider(contact, status, inactive):
        return (contact, "9 " if contact % 2 else "9", f"F{contact}", "L", "MD", "PCP", status, inactive)

    plans = [(c, "Open", OPEN) for c in range(1, 6)]
    rows = [
        provider(1, "Inactive", None),
        provider(2, "active", date(2020, 1, 1)),
        provider(3, "ACTIVE", date(2021, 1, 1)),
        provider(4, "Active", None),
    ]
    assert values(employed(spark, provider=rows, provider_plan=plans), "provider_name") == [("L,F3",)]
    tie = [provider(4, "Active", None), provider(2, "Active", None)]
    assert values(employed(spark, provider=tie, provider_plan=plans), "provider_name") == [("L,F2",)]
    missing_status = [provider(4, "Active", None), provider(5, None, None)]
    got = employed(spark, provider=missing_status, provider_plan=plans)
    assert values(got, "provider_name") == [("L,F5",)]


# -- cohort -------------------------------------------------------------------------


def test_cohort_rules(spark):
    data = sources(
        spark,
        member=[
            person(1, status="ACTIVE "),
            person(2, status="Deceased"),
            person(3),
            person(4),
            person(5),
            person(6),
            person(7),
            person(8),
        ],
        member_month=[
            month(1), month(2), month(3, contract_key=3), month(4, contract_key=4), month(5),
            month(6), month(7), month(8),
        ],
        member_provider=[
            relation(1, kind="PRIMARY "),
            relation(2), relation(3), relation(4),
            relation(5, kind="Specialist"),
            relation(6, current=0),
            relation(7, provider_key=11),
        ],
    )
    assert values(cohort_of(data, CONFIG), "patient_id") == [(1,)]


def test_cohort_counts_the_rows_of_the_plain_join(spark):
    data = sources(
        spark,
        member_month=[month(1), month(1), month(1, contract_key=2)],
        member_provider=[relation(1), relation(1), relation(1, end=PAST)],
        provider_dim=[
            (10, "1111111111", "Ann", "B", "Elm", 1),
            (10, "1111111111 ", "Anne", "B", "Elm", 1),
            (10, "1111111111", "Ann", "B", "Elm", 0),
        ],
    )
    assert values(cohort_of(data, CONFIG), "patient_id", "lob", "join_rows") == [
        (1, "HMO", 12), (1, "PPO", 6),
    ]


def test_cohort_reads_the_remote_copies(spark):
    data = sources(spark, member_provider=[], member_provider_remote=[relation(1)])
    assert values(cohort_of(data, CONFIG), "patient_id") == [(1,)]
    assert values(roster_stage(data, CONFIG, AS_OF), "patient_id", "provider_npi") == [(1, None)]


def test_build_cohort_takes_a_known_period(spark):
    data = sources(spark, member_month=[month(1, 202401), month(1, 202402)])
    providers = employed(spark)
    for period, rows in ((202401, 1), (202403, 0)):
        got = build_cohort(data.member, data.member_month, data.contract_dim, data.member_provider,
                           data.provider_dim, providers, CONFIG, period)
        assert got.count() == rows


def test_legal_sex(spark):
    spellings = ["Male", "female", "U", "Unknown", None]
    people = range(1, len(spellings) + 1)
    data = sources(
        spark,
        member=[person(i, gender=spelling) for i, spelling in zip(people, spellings, strict=True)],
        member_month=[month(i) for i in people],
        member_provider=[relation(i) for i in people],
    )
    got = values(cohort_of(data, CONFIG), "patient_id", "legal_sex")
    assert [sex for _, sex in got] == ["M", "F", "U", "OTH", "OTH"]


def test_two_lobs_are_one_row_with_a_payer_id_and_two_without(spark):
    both = [month(1), month(1, contract_key=2)]
    assert values(stage(spark, member_month=both), "lob", "person_id") == [("HMO", "A1")]
    without = [month(1, data_sys="South"), month(1, contract_key=2, data_sys="South")]
    assert values(stage(spark, member_month=without), "lob", "person_id") == [
        ("HMO", None), ("PPO", None),
    ]


# -- attribution ---------------------------------------------------------------------


def test_highest_unexpired_provider(spark):
    cases = [
        ([relation(1, 10), relation(1, 11)], 11),
        ([relation(2, 10), relation(2, 11, end=PAST)], 10),
        ([relation(3, 10), relation(3, 11, end=None)], 10),
        ([relation(4, 10), relation(4, 11, current=0)], 10),
        ([relation(5, 10), relation(5, 11, kind="Specialist")], 10),
        ([relation(6, 10, end=PAST), relation(6, 11, end=AS_OF)], None),
    ]
    data = sources(spark, member_provider=[row for rows, _ in cases for row in rows])
    got = attribute(data.member_provider, data.provider_dim, AS_OF, CONFIG)
    assert values(got, "patient_id", "provider_key") == [
        (i, key) for i, (_, key) in enumerate(cases, 1) if key
    ]


def test_without_an_unexpired_provider_a_member_stays(spark):
    assert values(stage(spark, member_provider=[relation(1, end=PAST)]), "provider_npi") == [(None,)]


def test_attribution_is_restricted_to_the_cohort(spark):
    data = sources(spark, member_provider=[relation(1), relation(2)])
    every = attribute(data.member_provider, data.provider_dim, AS_OF, CONFIG)
    assert values(every, "patient_id") == [(1,), (2,)]
    cohort = spark.createDataFrame([(1,), (1,)], "patient_id int")
    some = attribute(data.member_provider, data.provider_dim, AS_OF, CONFIG, cohort)
    assert values(some, "patient_id", "provider_key", "last_name") == [(1, 10, "Elm")]


def test_expiry_is_compared_in_the_type_of_the_column(spark):
    data = sources(spark)
    zoned = data.member_provider.withColumn(
        "relationship_end_date", F.lit("2024-03-15 00:00:01").cast("timestamp")
    )
    got = attribute(zoned, data.provider_dim, AS_OF, CONFIG)
    assert got.count() == 1
    assert "cast(relationship_end_date" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_all_versions_of_a_provider_row_are_joined(spark):
    rows = [(10, "1111111111", "Ann", "B", "Elm", 1), (10, "1111111111", "Ann", "C", "Elm", 0)]
    got = stage(spark, provider_dim=rows)
    assert values(got, "provider_middle_name") == [("B",), ("C",)]


def test_full_name_is_null_without_a_middle_name(spark):
    got = stage(spark, member_provider=[relation(1, 10), relation(1, 11)])
    assert values(got, "provider_last_name", "provider_full_name") == [("Ash", None)]
    assert values(stage(spark), "provider_full_name") == [("Ann B Elm",)]


# -- payer ids ------------------------------------------------------------------------


def test_payer_id_prefix(spark):
    given = ["PRE77", "pre77", "77", None, ""]
    data = sources(spark, member_month=[month(i, payer_id=v) for i, v in enumerate(given)])
    got = payer_ids(data.member_month, data.contract_dim, CONFIG)
    assert [v for _, v in values(got, "patient_id", "payer_patient_id")] == ["77", "77", "77", None, ""]


def test_two_payer_ids_in_one_contract(spark):
    got = stage(spark, member_month=[month(1, payer_id="PREB"), month(1, payer_id="A"), month(1, payer_id="C")])
    assert values(got, "person_id", "historical_person_id") == [("A", "B")]


def test_payer_ids_in_two_contracts_make_two_rows(spark):
    months = [
        month(1, payer_id="A"), month(1, payer_id="B"),
        month(1, payer_id="Y", contract_key=3), month(1, payer_id="Z", contract_key=3),
    ]
    got = stage(spark, member_month=months)
    assert values(got, "person_id", "contract_name", "historical_person_id") == [
        ("A", "North Plan", "B"), ("Y", "South Plan", "B"),
    ]


def test_payer_id_ranks(spark):
    data = sources(
        spark,
        member_month=[
            month(1, payer_id="B"), month(1, payer_id="B"), month(1, payer_id=None),
            month(1, payer_id="A", contract_key=2), month(1, payer_id="A"),
            month(1, payer_id="0", data_sys="South"), month(1, 202401, payer_id="0"),
        ],
    )
    got = payer_ids(data.member_month, data.contract_dim, CONFIG, top=None)
    assert values(got, "id_rank", "payer_patient_id", "lob", "subscriber_id") == [
        (1, "A", "HMO", "S101"), (2, "A", "PPO", "S101"), (3, "B", "HMO", "S101"),
        (4, None, "HMO", "S101"),
    ]
    assert payer_ids(data.member_month, data.contract_dim, CONFIG).count() == 2


def test_spellings_of_one_payer_id_give_no_second_id(spark):
    months = [month(1, payer_id=i) for i in ("AB1", "ab1 ", "Ab1  ")]
    data = sources(spark, member_month=months)
    got = payer_ids(data.member_month, data.contract_dim, CONFIG)
    assert values(got, "id_rank", "payer_patient_id") == [(1, "AB1")]
    assert values(stage(spark, member_month=months), "person_id", "historical_person_id") == [
        ("AB1", None)
    ]


def test_spellings_of_one_provider_give_one_row(spark):
    names = [
        (10, "1111111111", "Ann", "B", name, 1) for name in ("Stone", "STONE ", "stone")
    ]
    assert stage(spark, provider_dim=names).count() == 1


def test_contract_spellings_are_one_contract(spark):
    got = stage(
        spark,
        contract_dim=[(1, "North Plan", "HMO", 1), (2, "NORTH PLAN ", "HMO", 1)],
        member_month=[month(1, payer_id="A"), month(1, payer_id="B", contract_key=2)],
    )
    assert values(got, "person_id", "historical_person_id", "contract_name") == [("A", "B", "North Plan")]


def test_historical_id_update_agrees_with_the_stage(spark):
    months = [
        month(1, payer_id="A"), month(1, payer_id="B"), month(2, payer_id="C"),
        month(3, payer_id="D"), month(3, payer_id=None),
        month(1, payer_id="Y", contract_key=3), month(1, payer_id="Z", contract_key=3),
    ]
    people = [1, 2, 3]
    data = sources(spark, member=[person(i) for i in people], member_month=months,
                   member_provider=[relation(i) for i in people])
    filled = roster_stage(data, CONFIG, AS_OF)
    ids = payer_ids(data.member_month, data.contract_dim, CONFIG)
    emptied = filled.withColumn("historical_person_id", F.lit(None).cast("string"))
    columns = ("patient_id", "person_id", "historical_person_id")
    assert values(historical_id(emptied, ids), *columns) == values(filled, *columns)
    kept = historical_id(filled.withColumn("historical_person_id", F.lit("old")), ids)
    assert values(kept.where("patient_id > 1"), *columns) == [(2, "C", "old"), (3, "D", None)]


# -- codes ----------------------------------------------------------------------------


def test_crosswalk_filters(spark):
    rows = [
        code(1, "1", kind="CHART "), code(2, "2", status="active"), code(3, "3", status="Closed"),
        code(4, "4", kind="Other"), code(5, "pre5"), code(6, None), code(7, ""),
    ]
    got = crosswalk(frame(spark, "id_crosswalk", rows), CONFIG)
    assert values(got, "patient_id", "code") == [(1, "1"), (2, "2"), (7, "0")]


def test_blanks_around_a_number_do_not_count(spark):
    rows = [code(1, "12345  "), code(2, "A1  "), code(3, "  00012345")]
    got = crosswalk(frame(spark, "id_crosswalk", rows), CONFIG)
    assert values(got, "patient_id", "code") == [(1, "12345"), (2, "000000A1  "), (3, "12345")]
    blanks = frame(spark, "id_blank", [(1, "0012345 "), (2, "a1")])
    assert values(blank_codes(got, blanks), "patient_id", "code") == [
        (1, ""), (2, "000000A1  "), (3, "12345"),
    ]


def test_latest_code_and_its_ties(spark):
    day = datetime(2024, 2, 1)
    rows = [
        code(1, "9", day), code(1, "30", day), code(1, "1", datetime(2024, 1, 1)),
        code(2, "5", None), code(2, "6", datetime(2000, 1, 1)),
        code(3, "5", None),
    ]
    got = crosswalk(frame(spark, "id_crosswalk", rows), CONFIG)
    assert values(got, "patient_id", "code") == [(1, "30"), (2, "6"), (3, "5")]


def test_blank_then_correct(spark):
    codes = spark.createDataFrame([(1, "42"), (2, "42"), (3, "7"), (4, "8"), (5, "AB")], "patient_id int, code string")
    blanks = frame(spark, "id_blank", [(1, "0042"), (1, "42"), (2, "43"), (3, "7"), (None, "8"), (4, None)])
    fixes = frame(spark, "id_correction", [(3, "C3"), (4, None), (9, "C9")])
    assert values(blank_codes(codes, blanks), "patient_id", "code") == [
        (1, ""), (2, "42"), (3, ""), (4, "8"), (5, "AB"),
    ]
    assert values(override_codes(codes, blanks, fixes), "patient_id", "code") == [
        (1, ""), (2, "42"), (3, "C3"), (4, None), (5, "AB"),
    ]


def test_a_correction_without_a_code_has_no_effect(spark):
    got = stage(spark, id_crosswalk=[], id_correction=[(1, "C1")])
    assert values(got, "patient_id", "record_number") == [(1, None)]
    assert values(stage(spark, id_correction=[(1, "C1")]), "record_number") == [("C1",)]


def test_other_codes_leave_out_the_chosen_one(spark):
    rows = [
        code(1, "0000000042", datetime(2024, 2, 1)), code(1, "42"), code(1, "77", status="Closed"),
        code(1, "77", kind="Clinic Id"), code(1, "PRE1"), code(2, "5"),
    ]
    table = frame(spark, "id_crosswalk", rows)
    got = other_codes(table, crosswalk(table, CONFIG), CONFIG)
    assert values(got, "patient_id", "code") == [(1, "0000000042"), (1, "0000000077")]
    cohort = spark.createDataFrame([(2,)], "patient_id int")
    assert other_codes(table, crosswalk(table, CONFIG), CONFIG, cohort).count() == 0


# -- stage and routing ------------------------------------------------------------------


def test_stage_has_the_declared_columns(spark):
    assert stage(spark).columns == STAGE_SCHEMA.names


def test_only_the_lists_of_members_with_a_code_are_gathered(spark):
    codes = spark.sql("VALUES (1, '42'), (2, '42'), (3, '7'), (NULL, '8') AS t(patient_id, code)")
    blanks = frame(spark, "id_blank", [(1, "0042"), (2, "43"), (9, "42"), (None, "8")])
    fixes = frame(spark, "id_correction", [(3, None), (8, "z")])
    plain = override_codes(codes, blanks, fixes)
    written = override_codes(codes, blanks, fixes, written=True)
    for got in (plain, written):
        assert set(map(tuple, got.collect())) == {(1, ""), (2, "42"), (3, None), (None, "8")}
    plan = written._jdf.queryExecution().optimizedPlan().toString()
    # The members are known below the grouping of the lists.
    assert plan.rindex("LeftSemi") > plan.index("collect_set")


def test_folded_values_are_one_key(spark):
    names = [f"c{k}" for k in range(12)]
    rows = [(1, *["A "] * 12), (1, *["a"] * 12), (1, *[None] * 12), (1, *[None] * 12), (2, *["a"] * 12)]
    df = spark.createDataFrame(rows, ["k", *names])
    got = distinct_folded(df, names)
    assert sorted(got.collect(), key=str) == sorted(
        [(1, *["A "] * 12), (1, *[None] * 12), (2, *["a"] * 12)], key=str
    )
    grouped = re.search(r"Aggregate \[([^\]]*)\]", got._jdf.queryExecution().optimizedPlan().toString())
    assert grouped[1].count(",") == 1


def test_stage_rows_are_distinct(spark):
    one = [month(1), month(1), month(1, contract_key=2)]
    got = stage(spark, member=[person(1), person(1)], member_month=one,
                member_provider=[relation(1), relation(1)])
    assert got.count() == 1


def test_assemble_keeps_members_without_partners(spark):
    data = sources(spark)
    cohort = cohort_of(data, CONFIG)
    ids = payer_ids(data.member_month, data.contract_dim, CONFIG)
    nothing = assemble(
        cohort,
        crosswalk(frame(spark, "id_crosswalk", []), CONFIG),
        ids.where(F.lit(False)),
        attribute(frame(spark, "member_provider", []), data.provider_dim, AS_OF, CONFIG),
    )
    assert values(nothing, "patient_id", "person_id", "record_number", "lob", "contract_name") == [
        (1, None, None, "HMO", "North Plan")
    ]


@pytest.fixture(scope="module")
def routed_stage(spark):
    people = [(1, "Oak", "A"), (2, "Fir", None), (3, "Yew", ""), (4, "77Ash", None), (5, "77Elm", "B")]
    rows = stage(
        spark,
        member=[person(i, name) for i, name, _ in people],
        member_month=[month(i, payer_id=payer_id) for i, _, payer_id in people],
        member_provider=[relation(i) for i, _, _ in people],
        id_crosswalk=[],
    )
    ddl = ", ".join(f"{name} {'int' if name == 'patient_id' else 'string'}" for name in rows.columns)
    return local_frame(spark, [tuple(row) for row in rows.collect()], ddl)


def test_route(routed_stage):
    got = route(routed_stage, CONFIG)
    assert values(got.current, "patient_id") == [(1,), (3,), (5,)]
    assert values(got.missing, "patient_id") == [(2,), (4,)]
    assert values(got.review, "patient_id") == [(4,), (5,)]
    assert got.current.columns == ROSTER_COLUMNS
    for output in (got.current, got.missing, got.review):
        assert output.count() == output.distinct().count()


def test_only_unreviewed(spark, routed_stage):
    cfg = replace(CONFIG, only_unreviewed=True)
    fixes = frame(spark, "id_correction", [(5, "C5"), (None, "C")])
    assert values(route(routed_stage, cfg, fixes).review, "patient_id") == [(4,)]
    with pytest.raises(ValueError):
        route(routed_stage, cfg)


@pytest.mark.parametrize(
    "fixes,kept", [([], [1, 3]), ([(5, "C5")], [1, 3, 5]), ([(9, "C9"), (None, "C")], [1, 3, 5])]
)
def test_suppression_of_the_current_roster(spark, routed_stage, fixes, kept):
    current = route(routed_stage, CONFIG).current
    fixes = frame(spark, "id_correction", fixes)
    got = suppress_unreviewed(current, fixes, CONFIG)
    again = suppress_unreviewed(current, fixes, CONFIG, written=True)
    assert values(again, "patient_id") == values(got, "patient_id")
    assert values(got, "patient_id") == [(i,) for i in kept]


def test_sent_rows_have_an_empty_subscriber_id(routed_stage):
    sent = sent_rows(route(routed_stage, CONFIG).current)
    assert sent.columns == [*ROSTER_COLUMNS, "subscriber_id"]
    assert values(sent, "subscriber_id") == [(None,)] * 3


def test_later_is_later():
    assert AS_OF < LATER
