from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.operators.aggregates import string_agg
from musterroll.operators.conform import OVERFLOW_COLUMN, conform, split_overflow
from musterroll.operators.joins import (
    only_keys,
    overlay,
    restrict_around,
    suppress,
    without_keys,
)
from musterroll.operators.ranking import rank_first, rank_rows
from tests.fixtures import values


def test_rank_rows_and_rank_first(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", None), ("b", 5)], "k string, v int")
    order = [F.col("v").asc_nulls_last()]
    assert values(rank_rows(df, ["k"], order), "k", "v", "row_rank") == [
        ("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("b", None, 2), ("b", 5, 1),
    ]
    assert values(rank_rows(df, ["k"], order, top=2), "k", "v") == [
        ("a", 1), ("a", 2), ("b", None), ("b", 5),
    ]
    assert values(rank_first(df, ["k"], order), "k", "v") == [("a", 1), ("b", 5)]


def test_semi_and_anti_never_multiply_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert values(only_keys(df, keys, "k"), "k") == [(1,), (1,)]
    assert values(without_keys(df, keys, ["k"]), "k") == [(None,), (2,)]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_restriction_gives_the_same_rows_before_and_after(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.createDataFrame([(1, 5), (1, 7), (2, 9), (3, 1)], "k int, v int")
        keys = spark.range(1, 3).select(F.col("id").cast("int").alias("k"))
        got = restrict_around(df, keys, "k", lambda d: d.groupBy("k").agg(F.max("v").alias("v")))
        assert values(got, "k", "v") == [(1, 7), (2, 9)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_overlay(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "id int, c string")
    fixes = spark.createDataFrame(
        [(1, "x"), (2, None), (4, "y"), (3, "n"), (3, "m"), (3, None), (None, "z")], "id int, fix string"
    )
    got = overlay(df, fixes, "id", "c", "fix")
    assert got.columns == ["id", "c"]
    assert values(got, "id", "c") == [(None, "e"), (1, "x"), (1, "x"), (2, None), (3, "m")]


ROSTER = [(1, "8X"), (2, "8Y"), (3, "Z"), (4, None), (None, "8N")]


@pytest.mark.parametrize(
    "listed,kept",
    [
        ([], [(3, "Z"), (4, None)]),
        ([1], [(None, "8N"), (1, "8X"), (3, "Z"), (4, None)]),
        ([1, 1], [(None, "8N"), (1, "8X"), (3, "Z"), (4, None)]),
        ([1, None], [(None, "8N"), (1, "8X"), (2, "8Y"), (3, "Z"), (4, None)]),
        ([None], [(None, "8N"), (1, "8X"), (2, "8Y"), (3, "Z"), (4, None)]),
    ],
)
@pytest.mark.parametrize("written", [False, True])
def test_suppress_follows_three_valued_not_in(spark, listed, kept, written):
    df = spark.createDataFrame(ROSTER, "id int, name string")
    keys = spark.createDataFrame([(k,) for k in listed], "id int")
    got = suppress(df, F.col("name").startswith("8"), "id", keys, written=written)
    assert values(got, "id", "name") == kept


@pytest.mark.parametrize("written", [False, True])
def test_suppress_keeps_duplicates_and_columns(spark, written):
    df = spark.createDataFrame([(1, "8X"), (1, "8X"), (2, "Q"), (2, "Q")], "id int, name string")
    keys = spark.createDataFrame([(1,), (1,)], "reviewed int")
    got = suppress(df, F.col("name").startswith("8"), "id", keys, "reviewed", written)
    assert got.columns == ["id", "name"]
    assert got.count() == 4


def test_rows_of_a_table_that_cannot_be_listed_are_not_shuffled(spark, tmp_path):
    """Of 4,000 rows 40 have a name that could be held back; only these are shuffled."""
    spark.range(4000).selectExpr(
        "cast(id as int) as id", "if(id % 100 = 0, concat('8', id), concat('n', id)) as name"
    ).write.parquet(str(tmp_path / "t"))
    spark.range(300).selectExpr("cast(id as int) as id").write.parquet(str(tmp_path / "k"))
    df, keys = (spark.read.parquet(str(tmp_path / name)) for name in "tk")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = {}
        for written in (False, True):
            got = suppress(df, F.col("name").startswith("8"), "id", keys, written=written)
            assert len(got.collect()) == 3963
            moved[written] = shuffled_rows(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved[False] > 4000
    assert moved[True] < 40 + 300 + 50


def shuffled_rows(df) -> int:
    """Rows that the exchanges of a plan that ran have written, those of subqueries aside."""
    found, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        metrics = node.metrics()
        if node.nodeName() == "Exchange":
            found += metrics.apply("shuffleRecordsWritten").value()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind in ("ShuffleQueryStageExec", "ResultQueryStageExec"):
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_suppress_takes_a_frame_of_one_column(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    keys = spark.createDataFrame([(1,)], "id int")
    got = suppress(df, F.lit(True), "id", keys)
    assert values(got, "id") == [(None,), (1,)]
    assert got.columns == ["id"]


def test_suppress_is_one_join_in_one_pass(spark):
    df = spark.range(9).select(F.col("id").cast("int").alias("id"), F.lit("8X").alias("name"))
    keys = spark.createDataFrame([(1,)], "id int")
    plan = suppress(df, F.col("name").startswith("8"), "id", keys)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.count("Join LeftOuter") == 1 and "Union" not in text


def test_string_agg(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, "z"), (3, None)], "k int, v string"
    )
    assert values(string_agg(df, ["k"], "v"), "k", "v") == [(1, "a~b~b"), (2, "z")]


SHAPE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("state", T.VarcharType(2)),
        T.StructField("note", T.VarcharType(5)),
    ]
)


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("ab", 7), ("c    ", 8), (None, 9)], "state string, id bigint")
    got = conform(df, SHAPE)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "string", "string"]
    assert values(got, "id", "state", "note") == [(7, "ab", None), (8, "c ", None), (9, None, None)]


def test_conform_raises_without_showing_the_value(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "secret")], "id int, state string")
    with pytest.raises(PySparkException) as error:
        conform(df, SHAPE).collect()
    assert "state is longer than 2 characters" in str(error.value)
    assert "secret" not in str(error.value)


def test_conform_quarantine(spark):
    df = spark.createDataFrame(
        [(1, "ab", "x"), (2, "abc", "toolong"), (3, "abc", "ok")], "id int, state string, note string"
    )
    good, bad = split_overflow(conform(df, SHAPE, "quarantine"))
    assert values(good, "id", "state") == [(1, "ab")]
    assert values(bad, "id", "state", OVERFLOW_COLUMN) == [
        (2, "abc", ["state", "note"]),
        (3, "abc", ["state"]),
    ]


def test_conform_rejects_an_unknown_mode(spark):
    with pytest.raises(ValueError):
        conform(spark.range(1), SHAPE, "truncate")
