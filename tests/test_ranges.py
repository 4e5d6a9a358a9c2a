"""Ranges planned for a remote table; a view stands in for the database."""

from __future__ import annotations

import random

import pytest

from musterroll.sources import catalog
from musterroll.sources.catalog import SourceError, jdbc_options, read_remote
from musterroll.sources.ranges import cut_points, planned


@pytest.fixture(scope="module")
def remote(spark):
    """Keys far apart, crowded in places, one with a third of the rows, some NULL."""
    pick = random.Random(4)
    keys = [7] * 1000 + [pick.randrange(100, 140) for _ in range(600)]
    keys += [pick.randrange(-(10**15), 10**15) for _ in range(400)]
    keys += [10**17 + k for k in range(900)] + [None] * 50
    spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int").createOrReplaceTempView(
        "remote_rows"
    )
    asked = []

    def ask(query):
        asked.append(query)
        return spark.sql(query).collect()

    yield keys, ask, asked
    spark.catalog.dropTempView("remote_rows")


@pytest.mark.parametrize("parts", [1, 4, 20])
def test_every_row_is_in_one_range_and_ranges_are_even(spark, remote, parts):
    keys, ask, asked = remote
    asked.clear()
    found = planned(ask, "remote_rows", "k", parts)
    assert len(asked) < 40
    counts = [spark.sql(f"SELECT count(*) FROM remote_rows WHERE {p}").first()[0] for p in found]
    assert sum(counts) == len(keys)
    either = " OR ".join(f"({p})" for p in found)
    assert spark.sql(f"SELECT count(*) FROM remote_rows WHERE {either}").first()[0] == len(keys)
    share = len([k for k in keys if k is not None]) / parts
    assert len(found) <= 2 * parts + 1
    # One range is the heavy key's, and the first has the rows without a key.
    assert sum(n > 2 * share + 50 for n in counts) <= 1


def test_tables_of_nothing_and_of_one_key(spark):
    ask = lambda query: spark.sql(query).collect()
    for rows in ([], [(None,)], [(5,)] * 9):
        spark.createDataFrame(rows, "k long").createOrReplaceTempView("remote_few")
        assert planned(ask, "remote_few", "k", 8) == ["1 = 1"]
    spark.createDataFrame([(1,), (2,)], "k long").createOrReplaceTempView("remote_few")
    assert cut_points(ask, "remote_few", "k", 8) == [2]
    spark.catalog.dropTempView("remote_few")
    for bad in (("k; drop", 2), ("k", 0)):
        with pytest.raises(ValueError):
            planned(ask, "remote_few", *bad)


def test_options_of_a_planned_read():
    base = {"url": "jdbc:x", "dbtable": "t"}
    assert jdbc_options({**base, "splitColumn": "k", "parts": 9}) == {**base, "fetchsize": "10000"}
    for more in ({"splitColumn": "k"}, {"splitColumn": "k", "parts": 2, "single_task": True},
                 {"splitColumn": "k", "parts": 2, "partitionColumn": "k", "lowerBound": 0,
                  "upperBound": 1, "numPartitions": 2}):
        with pytest.raises(SourceError, match="splitColumn"):
            jdbc_options({**base, **more})


def test_a_planned_read_hands_its_ranges_to_the_reader(monkeypatch):
    """The reader is a stand-in, as no database may run here."""
    class Reader:
        format = options = load = lambda self, *_, **__: self
        read = property(lambda self: self)

        def collect(self):
            return [(1, 1, 3)]

        def jdbc(self, url, table, predicates, properties):
            return url, table, predicates, properties

    monkeypatch.setattr(catalog, "planned", lambda ask, *how: [str(how), str(ask("q"))])
    spec = {"url": "jdbc:x", "dbtable": "t", "splitColumn": "k", "parts": 9, "user": "u"}
    assert read_remote(Reader(), spec) == (
        "jdbc:x", "t", ["('t', 'k', 9)", "[(1, 1, 3)]"], {"user": "u", "fetchsize": "10000"}
    )
