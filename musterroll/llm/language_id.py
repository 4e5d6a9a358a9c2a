"""Language of web pages by fusing evidence.

The likelihood of the text, the language that the markup declares, the suffix of the
address and a prior of the host are multiplied. The last three are learnt from all
pages by grouped sums of the text's posteriors, each without the page's own part. A
host's prior is smoothed towards its domain's, and that towards all pages'.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from musterroll.llm.corpus import small_batches, stored
from musterroll.llm.warc import plain_text

BUCKETS = 1 << 16


@dataclass(frozen=True)
class Fusion:
    """``per_language`` texts of a language, read whole, train the text model, and at
    most as many as that for ``most_languages`` languages in all: beyond, all languages
    share them. A text weighs as at most ``trigrams`` independent trigrams. The smoothing
    counts are in pages."""

    per_language: int = 500
    trigrams: float = 40.0
    smoothing: float = 0.05
    host_pages: float = 10.0
    domain_pages: float = 10.0
    evidence_pages: float = 5.0
    most_languages: int = 64


@dataclass
class TextModel:
    languages: list[str] = field(default_factory=list)
    table: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))


def trigram_buckets(text: str) -> np.ndarray:
    """A bucket for each three letters in a row; what is between words is one blank."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    codes = np.frombuffer(f" {' '.join(letters.split())} ".encode("utf-32-le"), np.uint32)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = codes[:-2] * np.uint32(0x9E3779B1)
    mixed = (mixed ^ (mixed >> np.uint32(15))) + codes[1:-1] * np.uint32(0x85EBCA77)
    mixed = (mixed ^ (mixed >> np.uint32(13))) + codes[2:] * np.uint32(0xC2B2AE3D)
    return ((mixed ^ (mixed >> np.uint32(16))) % BUCKETS).astype(np.int64)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """language, text -> language, bucket, n for the trigrams of each text."""
    for batch in small_batches(batches, "text"):
        for language, text in zip(batch.column("language"), batch.column("text")):
            buckets, n = np.unique(trigram_buckets(text.as_py()), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([language.as_py()] * len(buckets), pa.string()),
                    pa.array(buckets.astype(np.int32)),
                    pa.array(n.astype(np.int64)),
                ],
                ["language", "bucket", "n"],
            )


def least_hashes(rows: DataFrame, each: int, bits: int = 12) -> DataFrame:
    """Of ``rows`` (doc_id, lang) the ``each`` of every language with the least hashes.

    Rows are counted by language and leading bits of the hash, and only those that may be
    among the least go on to be counted by more bits. What is ranked in the end is hardly
    more than what is kept, also of a language with most rows.
    """
    # Without its sign, so that leading bits keep the order.
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    for level in (1, 2):
        part = F.shiftright("h", 63 - bits * level)
        counts = rows.groupBy("lang", part.alias("part")).agg(F.count("h").alias("n"))
        order = Window.partitionBy("lang").orderBy("part")
        before = counts.select("lang", "part", (F.sum("n").over(order) - F.col("n")).alias("n"))
        # As many rows come before the last part that is needed as are wanted, or fewer.
        last = before.where(F.col("n") < each).groupBy("lang").agg(F.max("part").alias("last"))
        rows = rows.join(last, "lang").where(part <= F.col("last")).drop("last")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    ranked = rows.withColumn("n", F.row_number().over(order))
    return ranked.where(F.col("n") <= each).select("doc_id", "lang")


def fit(docs: DataFrame, settings: Fusion = Fusion()) -> TextModel:
    """The text model from ``docs`` (doc_id, text, lang): per language the rows with the
    least hash of doc_id. Rows with a NULL or empty field are not used."""
    rows = docs.where("text <> '' and lang <> '' and doc_id is not null")
    # One number reaches the driver. All labelled languages share the bound on rows.
    languages = rows.select("lang").distinct().count()
    bound = settings.per_language * settings.most_languages
    each = min(settings.per_language, max(1, bound // max(1, languages)))
    chosen = least_hashes(rows.select("doc_id", "lang"), each)
    chosen = chosen.select("doc_id", F.col("lang").alias("language"))
    sample = (
        rows.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("language", "text")
        .mapInArrow(_counted, "language string, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("language")
        .agg(F.collect_list(F.col("n") * BUCKETS + F.col("bucket")).alias("packed"))
        .toLocalIterator()
    )
    counts: dict[str, np.ndarray] = {}
    for language, packed in sample:  # a row a language, of at most BUCKETS numbers
        found = np.array(packed, np.int64)
        counts[language] = np.zeros(BUCKETS, np.int64)
        counts[language][found % BUCKETS] = found // BUCKETS
    if not counts:
        return TextModel()
    languages = sorted(counts)
    table = np.stack([counts[name] for name in languages], axis=1) + settings.smoothing
    return TextModel(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def text_likelihoods(pages: DataFrame, model: TextModel, settings: Fusion) -> DataFrame:
    """``pages`` (with a ``text``) with ``loglik``, one number a language, instead of it."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # one fixed-size table
    keep = [c for c in pages.columns if c != "text"]
    schema = pages.select(*keep, F.expr("cast(array() as array<double>)").alias("loglik")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.table
        for batch in small_batches(batches, "text"):
            rows = []
            for text in batch.column("text"):
                at = trigram_buckets(text.as_py() or "")
                total = np.zeros(table.shape[1])
                for start in range(0, len(at), 65_536):
                    total += table[at[start : start + 65_536]].sum(axis=0, dtype=np.float64)
                rows.append((total * min(1.0, settings.trigrams / max(1, len(at)))).tolist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.float64()))],
                [*keep, "loglik"],
            )

    return pages.mapInArrow(run, schema)


def softmax(logs: str) -> Column:
    top = F.array_max(logs)
    raw = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raw, lambda x: x / total)


def parts_of_address(url: str = "url") -> dict[str, Column]:
    """Host, domain (its last two labels) and suffix (the last); '' if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    host = F.coalesce(host, F.lit(""))
    return {
        "host": host,
        "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1),
        "suffix": F.regexp_extract(host, r"([^.]+)$", 1),
    }


def declared_language(html: str = "html") -> Column:
    """Primary subtag of the html element's lang attribute; '' if there is none."""
    return F.coalesce(
        F.lower(F.regexp_extract(html, r"(?i)<html(?:\s[^>]*)?\slang\s*=\s*[\"']?([a-zA-Z]+)", 1)),
        F.lit(""),
    )


def _sums(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Pages and summed posteriors of each value of ``key``."""
    sums = [F.sum(F.col("p")[i]) for i in range(n)]
    return stored(
        rows.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"{key}_n"), F.array(*sums).alias(f"{key}_sums")
        )
    )


def languages(
    pages: DataFrame, model: TextModel, settings: Fusion = Fusion()
) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, lang, probability, text_lang,
    declared, host.

    ``lang`` has the largest posterior, ``text_lang`` the largest likelihood; ties go to
    the first name. NULL html is an empty page, judged by its other evidence; a NULL or
    odd url has host and suffix ''. Repeated rows count and are returned one by one;
    other columns are ignored; an empty table gives none. A model without languages
    gives NULL languages.
    """
    names, n = model.languages, len(model.languages)
    base = pages.select(
        F.col("page_id").cast("long"),
        declared_language().alias("declared"),
        *[c.alias(name) for name, c in parts_of_address().items()],
        plain_text(F.coalesce("html", F.lit(""))).alias("text"),
    )
    if not n:
        none = F.lit(None)
        return base.select(
            "page_id",
            none.cast("string").alias("lang"),
            none.cast("double").alias("probability"),
            none.cast("string").alias("text_lang"),
            "declared",
            "host",
        )
    rows = stored(text_likelihoods(base, model, settings).withColumn("p", softmax("loglik")))
    total = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("p")[i]) for i in range(n)]).alias("sums"),
    ).first()
    # One number a language; a table without rows has none.
    overall = [((s or 0.0) + 1) / (total["n"] + n) for s in total["sums"]]
    for key in ("host", "domain", "declared", "suffix"):
        rows = rows.join(_sums(rows, key, n), key)
    prior, pages_in_all = F.array(*[F.lit(x) for x in overall]), float(max(1, total["n"]))
    language_sums = F.array(*[F.lit(x or 0.0) for x in total["sums"]])

    def smoothed(key: str, before: str, weight: float) -> Column:
        """Shares of the languages among a key's other pages, smoothed towards ``before``."""
        return F.expr(
            f"""transform({before}, (x, i) ->
                  (greatest({key}_sums[i] - p[i], 0d) + {weight}d * x) / ({key}_n - 1 + {weight}d))"""
        )

    def evidence(key: str) -> Column:
        """log P(value | language), from other pages, smoothed towards the value's share."""
        weight = settings.evidence_pages
        return F.expr(
            f"""transform(language_sums, (x, i) -> ln(
                  (greatest({key}_sums[i] - p[i], 0d) + {weight}d * {key}_n / {pages_in_all}d)
                  / (greatest(x - p[i], 0d) + {weight}d)))"""
        )

    fused = (
        rows.withColumns({"overall": prior, "language_sums": language_sums})
        .withColumn("domain_prior", smoothed("domain", "overall", settings.domain_pages))
        .withColumn("prior", smoothed("host", "domain_prior", settings.host_pages))
        .withColumns({"by_declared": evidence("declared"), "by_suffix": evidence("suffix")})
        .withColumn(
            "logs",
            F.expr("transform(loglik, (x, i) -> x + ln(prior[i]) + by_declared[i] + by_suffix[i])"),
        )
        .withColumn("posterior", softmax("logs"))
    )
    known = F.array(*[F.lit(name) for name in names])

    def best(values: str) -> Column:
        return F.get(known, F.array_position(values, F.array_max(values)).cast("int") - 1)

    return fused.select(
        "page_id",
        best("posterior").alias("lang"),
        F.array_max("posterior").alias("probability"),
        best("loglik").alias("text_lang"),
        "declared",
        "host",
    )
