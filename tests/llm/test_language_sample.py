"""The labelled sample of the language model: all languages, whole texts."""

from __future__ import annotations

import numpy as np

from musterroll.llm.language_id import BUCKETS, Fusion, fit, trigram_buckets


def test_every_language_keeps_rows(spark):
    names = [f"l{k:02d}" for k in range(10)]
    rows = [(10 * k + i, f"text {name} of {name}", name) for k, name in enumerate(names) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert fit(docs, Fusion(per_language=4, most_languages=2)).languages == names
    assert fit(docs, Fusion(per_language=1, most_languages=3)).languages == names


def test_whole_texts_are_counted(spark):
    texts = {"aa": "begin " * 900 + "quite other words at the end", "bb": "some short text"}
    rows = [(i, text, name) for i, (name, text) in enumerate(texts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(docs, Fusion())
    table = np.stack(
        [np.bincount(trigram_buckets(t), minlength=BUCKETS) for t in texts.values()], axis=1
    ) + Fusion().smoothing
    assert model.languages == ["aa", "bb"]
    assert np.allclose(model.table, np.log(table / table.sum(axis=0)), atol=1e-5)
