"""Text of HTML, statistics over several indexes, exact samples, whole training texts."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from musterroll.llm import corpus, decontaminate, language_id, quality_classifier, warc
from musterroll.llm.sql import _plain_text

PAGES = {
    "<noscript><style>..</style>X</noscript>after": "after",
    "a<script>s='</style>';Y</script>b": "a b",
    '<a title="a>b">link</a>': "link",
    "caf&eacute; &#8217;&mdash;&#x1F600; &amp;lt; &nosuch; & &#0; &#xD800;&#99999999; x&nbsp;y&#160;z":
        "café ’—\U0001F600 &lt; &nosuch; & � �� x y z",
    "<SCRIPT type='x>y'>1</ScripT >text<br/>line<p class=it's>end": "text\nline\nend",
    "<template>a</template><!-- <p> -->b<img src=a?b=c&d=e alt='>'>": "b",
    "open <b unfinished": "open <b unfinished",
    "<style>never closed": "never closed",
    "": "",
    "&": "&",
}


def test_text_of_html_in_spark_and_sql(spark):
    rows = list(PAGES.items())
    df = spark.createDataFrame([(html,) for html, _ in rows], "html string")
    got = [r[0] for r in df.select(warc.plain_text(F.col("html"))).collect()]
    assert got == [want.strip("\n ") for _, want in rows]
    connection = duckdb.connect()
    for html, want in rows:
        sql = f"SELECT {_plain_text('html')} FROM (SELECT ? AS html)"
        assert connection.execute(sql, [html]).fetchone()[0] == want


def test_text_of_html_is_computed_once(spark):
    """Each step's pattern runs once a page, not once for each use of the text."""
    df = spark.createDataFrame([("<p>a &amp; b</p>",)], "html string")
    made = df.select(warc.plain_text(F.col("html")).alias("text"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("regexp_replace(") <= len(warc.STEPS)


def test_mixed_html_in_spark_and_sql(spark):
    rng = random.Random(8)
    bits = [
        "<p>", "</P >", "<br/>", "<b a='>' c=d>", "</b>", "<!-- & -->", "<script>x", "</script>",
        "&amp;", "&#65;", "&nosuch;", "&", ";", " ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "é", "word", "<", "=",
    ]
    pages = ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, html string").coalesce(1)
    got = [r[1] for r in df.select("k", warc.plain_text(F.col("html"))).orderBy("k").collect()]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE p AS SELECT unnest(?) AS html, unnest(range(?)) AS k", [pages, len(pages)])
    want = connection.execute(f"SELECT {_plain_text('html')} FROM p ORDER BY k").fetchall()
    assert got == [row[0] for row in want]
    assert len(set(got)) > 200


def test_very_long_html_and_clashing_columns(spark):
    long = "<p a=1>" + "word &lt; " * 200_000 + "<i title='" + "x" * 300_000 + "'></i></p>"
    df = spark.createDataFrame([(1, "u", long)], "page_id long, url string, html string")
    df = df.withColumns({"block": F.lit("x"), "refers_to": F.lit("y"), "body": F.lit("z")})
    rows = warc.derivatives(warc.responses(df, "2024-01-01T00:00:00Z")).collect()
    [text] = [r.block for r in rows if r.warc_type == "conversion"]
    assert text == ("word < " * 200_000).strip()


def test_one_index_gives_what_many_give(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(8, 30)))) for k in range(60)]
    docs = []
    for k, text in items:
        mixed = text.split()
        for at in rng.sample(range(len(mixed)), len(mixed) // 6):
            mixed[at] = rng.choice(words)
        docs.append((k, " ".join(rng.choices(words, k=20) + mixed + rng.choices(words, k=20))))
    tables = (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items + items[:3] + [(None, "x"), (99, ""), (98, None)],
                              "item_id long, text string"),
    )

    def found(most):
        settings = decontaminate.Decontamination(max_item_bytes=most, overlap=0.0, share=0.5)
        rows = decontaminate.with_matches(*tables, settings).collect()
        return {(r.doc_id, m.item_id, m.share) for r in rows for m in r.matches}

    one = found(32 << 20)
    assert len(one) > 40
    assert found(400) == one == found(1)


@pytest.mark.parametrize("each", [1, 7, 500])
def test_least_hashes_of_every_language(spark, each):
    rows = [(i, "hot" if i % 3 else f"l{i % 5}") for i in range(3000)] + [(7, "hot"), (7, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, lang string")
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    want = Counter()
    lists = {}
    for r in df.withColumn("h", h).orderBy("h", "doc_id").collect():
        lists.setdefault(r.lang, []).append(r.doc_id)
    for lang, ids in lists.items():
        want.update((i, lang) for i in ids[:each])
    for bits in (2, 12):
        got = Counter(map(tuple, language_id.least_hashes(df, each, bits).collect()))
        assert got == want


def test_measures_and_calibration_by_hand(spark):
    """The classifier's numbers from plain compressions and from plain gradient steps."""
    rng = random.Random(2)
    good = [" ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(60)) for _ in range(80)]
    bad = [" ".join(rng.choice("buy now cheap click".split()) for _ in range(60)) for _ in range(80)]
    long = "alpha beta cheap " * 9000
    texts = dict(enumerate([*good, *bad, long]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(160)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)

    def plain(text):
        sizes = []
        for dictionary in (model.good, model.bad):
            data = zstandard.ZstdCompressionDict(dictionary)
            compressor = zstandard.ZstdCompressor(
                level=model.level, dict_data=data, write_content_size=False, write_dict_id=False
            )
            sizes.append(len(compressor.compress(text)))
        a, b = sizes
        n = len(text)
        d, r, s, t = (a - b) / n, (a - b) / (a + b), min(a, b) / n, np.log(n)
        return [d, d * d, r, r * r, s, s * s, t, t * t, s * t]

    got = {r.doc_id: r.score for r in quality_classifier.scored(docs, model).collect()}
    for i in (0, 79, 80, 159, 160):
        x = (np.array(plain(texts[i].encode())) - model.center) / model.scale
        want = 1 / (1 + np.exp(-(model.weights[0] + x @ model.weights[1:])))
        assert got[i] == pytest.approx(want, abs=0.02)
    assert min(got[i] for i in range(80)) > max(got[i] for i in range(80, 160))
    rows = np.random.default_rng(0).normal(size=(200, 3))
    y = (rows @ [1.0, -2.0, 0.5] + 0.3 > 0).astype(float)
    weights = quality_classifier.calibrated(rows, y, 0.05)
    x = np.c_[np.ones(200), rows]
    slope = x.T @ (y - 1 / (1 + np.exp(-x @ weights))) - np.r_[1e-9, [10.0] * 3] * weights
    assert np.abs(slope).max() < 1e-6


def test_training_texts_are_whole_or_passed_over(spark):
    texts = {1: "g" * 50, 2: "good words " * 400, 3: "bad", 4: "worse " * 300}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sample = docs.selectExpr(
        "doc_id", "encode(text, 'UTF-8') as text", "doc_id as r",
        "if(doc_id < 3, 1, 0) as quality", "'dictionary' as use",
    )
    settings = quality_classifier.Training(dictionary_texts=100)
    assert quality_classifier._texts(sample, 1, settings) == [texts[1].encode()]
    assert quality_classifier._texts(sample, 0, settings) == [b"bad"]
    assert len(quality_classifier._texts(sample, 0, quality_classifier.Training())) == 2


@pytest.mark.parametrize("most", [0, 10])
def test_rows_without_a_key(spark, most):
    rows = [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)] + [(5, None)]
    df = spark.createDataFrame(rows, "id long, host string")
    keys = spark.createDataFrame([("hot",), ("k3",), ("none",)], "host string")
    got = corpus.without(df, keys, "host", most).select("id", "host").collect()
    assert Counter(map(tuple, got)) == Counter(r for r in rows if r[1] not in ("hot", "k3"))
