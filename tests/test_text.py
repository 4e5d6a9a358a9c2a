from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from musterroll.config import SEX_CODES, SEX_OTHER
from musterroll.functions import text
from musterroll.functions.text import (
    ci_eq,
    ci_in,
    ci_prefix,
    day_text,
    joined_name,
    normalize_code,
    pad_code,
    recode,
    strip_prefix,
)
from tests.fixtures import local_frame


def evaluate(spark, inputs, *expressions):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    rows = df.select("i", *[e.alias(f"r{n}") for n, e in enumerate(expressions)]).orderBy("i")
    return [tuple(row)[1:] for row in rows.collect()]


def test_equality_ignores_case_and_trailing_blanks(spark):
    got = evaluate(spark, ["Yes", "YES  ", " yes", "no", None], ci_eq("x", "yes "), ci_in("x", ["1", "Yes"]))
    assert [r[0] for r in got] == [True, True, False, False, None]
    assert [r[1] for r in got] == [True, True, False, False, None]


def test_prefix_and_its_negation_drop_null(spark):
    got = evaluate(spark, ["PRE1", "pre2", "xPRE", "", None], ci_prefix("x", "Pre"), ~ci_prefix("x", "Pre"))
    assert got == [(True, False), (True, False), (False, True), (False, True), (None, None)]


def test_prefix_is_not_a_pattern(spark):
    assert evaluate(spark, ["a_b", "axb"], ci_prefix("x", "A_")) == [(True,), (False,)]


def test_strip_prefix(spark):
    inputs = ["PRE123", "pre9", "123", None, "PRE", "PRE12      "]
    got = [r[0] for r in evaluate(spark, inputs, strip_prefix("x", "PRE"))]
    assert got == ["123", "9", "123", None, "", "12   "]


# Code as stored -> code as sent.
CODES = [
    ("7", "7"),
    ("0000000042", "42"),
    ("0", "0"),
    ("AB12", "000000AB12"),
    ("991234567890", "1234567890"),
    ("990000000042", "42"),
    ("9999999999", "9999999999"),
    ("1E5", "00000001E5"),
    ("-5", "00000000-5"),
    ("+5", "00000000+5"),
    ("1.5", "00000001.5"),
    ("", "0"),
    (None, None),
]


def test_normalize_code(spark):
    got = [r[0] for r in evaluate(spark, [c for c, _ in CODES], normalize_code("x"))]
    assert got == [sent for _, sent in CODES]


def test_normalize_code_is_stable_on_short_codes(spark):
    short = [c for c, _ in CODES if c is not None and len(c) <= 10]
    once = normalize_code("x")
    got = evaluate(spark, short, once, normalize_code(once))
    assert all(a == b for a, b in got)


def test_pad_code_keeps_the_last_characters(spark):
    assert evaluate(spark, ["5", "123456789012"], pad_code("x", 4)) == [("0005",), ("9012",)]


def test_recode_has_an_other_arm(spark):
    inputs = ["Male", "FEMALE ", "u", "U", "Unknown", "Other", None]
    got = [r[0] for r in evaluate(spark, inputs, recode("x", SEX_CODES, SEX_OTHER))]
    assert got == ["M", "F", "U", "U", "OTH", "OTH", "OTH"]


def test_joined_name_is_null_if_a_part_is(spark):
    got = evaluate(spark, ["Ann", None], joined_name(F.lit("A"), "x", F.lit("C")))
    assert got == [("A Ann C",), (None,)]


@pytest.mark.parametrize("day,text", [("1980-01-02", "19800102"), (None, None)])
def test_day_text(spark, day, text):
    assert evaluate(spark, [day], day_text(F.to_date("x"))) == [(text,)]


LOOKALIKES = ["north", "NORTH ", "North Plan", "\u212aelvin", "KELVIN", "kelvin  ", "\u0130stan", "i\u0307stan",
              "ISTAN", "", "  ", None, "nort", "77a", "7 7", "\u00c5ngstr\u00f6m", "\u212bngstr\u00d6m", "\u1e9e", "\u00df",
              "\u039f\u0394\u039f\u03a3", "\u03bf\u03b4\u03bf\u03c2", "\u03a3\u03b1", "\u03c3\u03b1"]


@pytest.mark.parametrize("literal", ["North", "kelvin", "K", "i\u0307stan", "i", "", " ", "77", "\u00e5ngstr\u00f6m", "\u00df",
                                     "\u039f\u0394\u039f\u03a3", "\u03c3\u03b1"])
def test_implied_beginnings_lose_nothing(spark, literal):
    """Tests with the weaker one beside them give what the folded comparison alone gives."""
    df = local_frame(spark, [(x,) for x in LOOKALIKES], "x string")
    exact = text.fold("x") == text.fold_text(literal)
    prefix = F.lower("x").startswith(literal.lower())
    got = df.select(
        text.ci_eq("x", literal), text.ci_in("x", [literal, "north"]), text.ci_prefix("x", literal),
        exact, text.fold("x").isin([text.fold_text(literal), "north"]), prefix,
    ).collect()
    for row in got:
        # A filter keeps what is true.
        assert [x is True for x in row[:3]] == [x is True for x in row[3:]]


def test_every_spelling_of_a_letter_is_known(spark):
    """The session's own lower case knows no other character than the ones spelt out."""
    df = spark.range(1, 0x3000).selectExpr("cast(id as int) as c").where("c not between 55296 and 57343")
    chars = df.select(F.decode(F.unhex(F.lpad(F.hex("c"), 8, "0")), "UTF-32").alias("x"))
    found = {}
    for row in chars.select("x", F.lower("x").alias("y")).collect():
        found.setdefault(row.y[:1], set()).add(row.x)
    for letter in "abcdefghijklmnopqrstuvwxyz0789\u00e5\u00df":
        assert found[letter] <= set(text.spellings(letter))


def test_beginnings_reach_the_file_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr(
        "concat(if(id < 10, 'NORTH ', 'south '), id) as x", "cast(id as string) as y"
    ).write.parquet(path)
    df = spark.read.parquet(path)
    for test, n in ((text.ci_prefix("x", "north"), 10), (text.ci_eq("x", "North 3"), 1),
                    (text.ci_in("x", ["north 3 ", "SOUTH 11"]), 2), (text.ci_prefix("y", "77"), 11)):
        got = df.where(test)
        assert got.count() == n
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "StringStartsWith(" in plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
