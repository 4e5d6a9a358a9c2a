"""Host-level quality rules (DataFrame functions only).

Each document is measured and judged by rules; failures are counted by host, the
hosts' rates are shrunk with a beta prior fitted to all hosts, and the verdict on a
host is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import WHITE_SPACE, set_apart, stored, without

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["failed_length", "failed_repeats", "failed_symbols", "failed_lines"]


@dataclass(frozen=True)
class HostRules:
    """``symbols_per_100_words`` and ``dup_lines_percent`` fail a document,
    ``host_rate`` (of a rule's shrunk failure rate) fails a host. The prior counts
    as ``least_strength`` to ``most_strength`` documents."""

    symbols_per_100_words: int = 20
    dup_lines_percent: int = 50
    host_rate: float = 0.5
    least_strength: float = 2.0
    most_strength: float = 10_000.0


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of its ``text`` (NULL: an empty text).

    Words are runs of characters other than blank and \\x09-\\x0D. A 5-word window is
    known by a 64-bit hash within its own document. Columns of ``docs`` that have a
    measure's name are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.withColumns(
        {
            "_words": F.array_remove(F.split(text, WHITE_SPACE), ""),
            "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "_length": F.length(text),
            "_plain": F.length(F.regexp_replace(text, r"[#*$%&|<>]", "")),
        }
    )
    windows = words.withColumn(
        "_windows",
        F.expr(
            """if(size(_words) < 5, cast(array() as array<bigint>),
                  transform(sequence(0, size(_words) - 5), i -> xxhash64(
                    _words[i], _words[i + 1], _words[i + 2], _words[i + 3], _words[i + 4])))"""
        ),
    )
    # Only a document with a repeated window needs its windows in order.
    ordered = windows.withColumn(
        "_ordered",
        F.expr(
            """if(size(array_distinct(_windows)) = size(_windows), null, array_sort(
                  transform(_windows, (h, i) -> struct(h as h, i as i))))"""
        ),
    )
    repeats = ordered.withColumn(
        "_repeats",
        F.expr(
            """array_sort(transform(filter(
                  transform(_ordered, (w, k) -> struct(w.i as i,
                    coalesce(w.h = get(_ordered, k - 1).h, false)
                    or coalesce(w.h = get(_ordered, k + 1).h, false) as again)),
                  w -> w.again), w -> w.i))"""
        ),
    )
    covered = """coalesce(aggregate(
        transform(_repeats, (i, k) -> least(5, coalesce(get(_repeats, k + 1) - i, 5))),
        0, (total, n) -> total + n), 0)"""
    return repeats.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.col("_length") - F.col("_plain")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.expr(covered).cast("long"),
        }
    ).drop("_words", "_lines", "_length", "_plain", "_windows", "_ordered", "_repeats")


def failures(rules: HostRules) -> dict[str, F.Column]:
    """Whether a measured document fails each rule."""
    return {
        "failed_length": F.col("n_words") < 10,
        "failed_repeats": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        "failed_symbols": 100 * F.col("n_symbols")
        > rules.symbols_per_100_words * F.col("n_words"),
        "failed_lines": 100 * F.col("n_dup_lines") > rules.dup_lines_percent * F.col("n_lines"),
    }


def failed_hosts(judged: DataFrame, rules: HostRules) -> DataFrame:
    """``host`` of every host that fails, from one row of counts a host.

    Per rule the prior has the mean failure rate of all documents and a strength
    from the spread of the hosts' rates (method of moments, by documents).
    """
    hosts = stored(
        judged.groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(r)).alias(r) for r in RULES]
        )
    )
    # Two rows of four numbers reach the driver; an empty table has none.
    means = hosts.agg(*[(F.sum(r) / F.sum("n")).alias(r) for r in RULES]).first()
    means = {r: means[r] or 0.0 for r in RULES}
    spread = hosts.agg(
        *[
            (F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - means[r], 2)) / F.sum("n")).alias(r)
            for r in RULES
        ]
    ).first()
    rates = []
    for rule in RULES:
        mean, var = means[rule], spread[rule] or 0.0
        strength = rules.most_strength
        if var > 0:
            strength = min(max(mean * (1 - mean) / var - 1, rules.least_strength), strength)
        rates.append((F.col(rule) + mean * strength) / (F.col("n") + strength))
    return hosts.where(F.greatest(*rates) > rules.host_rate).select("host")


def judged_documents(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """One row per row of ``docs``: doc_id, measures, ``base_failed``, ``host_failed``,
    ``kept``.

    ``docs`` has doc_id, text and source (the host; NULL and '' are one host); other
    columns are ignored. NULL text counts as empty, fails by length and is not kept.
    Repeated rows are judged and counted one by one. An empty table gives none.
    """
    checks = failures(rules)
    judged = stored(
        measured(docs.select("doc_id", "text", F.coalesce("source", F.lit("")).alias("host")))
        .drop("text")
        .withColumns(checks)
    )
    # Stored, so that both sides of the join come straight from a shuffle and a host
    # with many documents can be split.
    bad = stored(failed_hosts(judged, rules).withColumn("host_failed", F.lit(True)))
    base = F.col("failed_length") | F.col("failed_repeats")
    host_failed = F.coalesce("host_failed", F.lit(False))
    own = base | F.col("failed_symbols") | F.col("failed_lines")
    return judged.join(bad, "host", "left").select(
        "doc_id",
        *MEASURES,
        base.alias("base_failed"),
        (~own & ~host_failed).alias("kept"),
        host_failed.alias("host_failed"),
        "failed_symbols",
        "failed_lines",
    )


def kept_documents(docs: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, any others) that ``judged_documents``
    keeps, with all their columns.

    The verdict lies on the row, so rows without an id, or with the same one, are judged
    apart. Texts of rows that fail by themselves are not stored.
    """
    plain, name = set_apart(docs)
    text = F.col(name["text"]).cast("string")
    source = F.col(name["source"]).cast("string")
    rows = plain.select(
        F.struct(*plain.columns).alias("row"),
        text.alias("text"),
        F.coalesce(source, F.lit("")).alias("host"),
    )
    judged = stored(
        measured(rows)
        .withColumns(failures(rules))
        .select("host", F.when(~F.greatest(*RULES), F.col("row")).alias("row"), *RULES)
    )
    bad = stored(failed_hosts(judged, rules))
    kept = without(judged.where("row is not null"), bad, "host")
    return kept.select("row.*").toDF(*docs.columns)
