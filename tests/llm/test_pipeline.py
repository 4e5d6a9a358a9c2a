"""The pipeline's stages, each against a plain computation on its own input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from musterroll.llm import secrets, simhash
from tests.llm.test_exact import (
    decontaminate,
    plain_base_spans,
    plain_components,
    plain_fingerprint,
    plain_matches,
    token_row,
)
from tests.llm.test_exact import library as library  # noqa: F401 - a fixture


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents):
    """The rows before the first stage and after each."""
    frames = [documents]
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, frames[-1], sf_dir)
        frames.append(spark.createDataFrame(made.collect(), made.schema))
    return frames


def texts_of(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "secret_masking", "tokens",
    ]
    for frame in stages[1:5]:
        assert frame.schema.simpleString() == stages[0].schema.simpleString()
    counts = [frame.count() for frame in stages]
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] == counts[5] > 0


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = texts_of(stages[1]), texts_of(stages[2])
    groups = plain_components({i: plain_fingerprint(t) for i, t in before.items()})
    assert set(after) == {i for i, (_, first) in groups.items() if i == first}


def test_decontamination_drops_matches_only(spark, sf_dir, stages):
    before, after = texts_of(stages[2]), texts_of(stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    short = {i: t for i, t in before.items() if len(t) < 12_000}
    found = {d for d, _ in plain_matches(short.items(), items, decontaminate.Decontamination())}
    assert {i for i in short if i not in after} == found


def test_secrets_are_gone(stages):
    before = texts_of(stages[3])
    for row in stages[4].collect():
        text = before[row.doc_id]
        assert row.text == secrets.mask(text, secrets.scan([text])[0])
        assert row.n_chars == len(row.text)
        assert not plain_base_spans(row.text)


def test_tokens(stages, library):  # noqa: F811
    texts = texts_of(stages[4])
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages[5].collect()}
    assert got == {i: token_row(library, t) for i, t in texts.items()}


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))
    assert got == sorted(map(tuple, stages[5].collect()))


def test_stages_take_odd_rows(spark, sf_dir, odd):
    """Rows without an id or with a repeated one are judged apart; all columns stay."""
    docs = odd.withColumn("n_chars", F.lit(None).cast("long"))
    sizes = []
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        rows = stage(spark, rows, sf_dir)
        assert rows.schema.simpleString() == docs.schema.simpleString()
        rows = spark.createDataFrame(rows.collect(), docs.schema)
        sizes.append(rows.count())
    kept = {(r.doc_id, r.text) for r in rows.collect()}
    # Very long texts here repeat their windows, and go; the row twice goes once.
    assert sizes == [4, 3, 3, 3]
    assert {i for i, _ in kept} == {None, 5, 6}
    assert {r.matches for r in rows.collect()} == {r.spans for r in rows.collect()} == {"x"}
    assert all(r.n_chars == len(r.text) for r in rows.collect())
    masked = next(text for i, text in kept if i == 6)
    assert masked.endswith("<assign>")
    last = corpus_pipeline.STAGES[4][1](spark, rows, sf_dir)
    assert {r.doc_id for r in last.collect()} == {None, 5, 6}


def test_stages_take_an_empty_table(spark, sf_dir, nothing):
    docs = nothing.drop("n_chars")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == nothing.columns
        assert docs.count() == 0


def test_one_row_of_repeated_rows_stays(spark):
    text = "a text of some length that many rows repeat word by word"
    rows = [(None, text, 1), (None, text, 2), (4, text, 3), (4, text, 4), (9, text, 5), (None, "other words", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.one_of_each(df).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("4", text), ("None", "other words")]
    assert {r.fp for r in got} < {3, 4, 6}
