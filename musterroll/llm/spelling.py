"""Spelling variants through one-edit neighbourhoods in a reduced alphabet.

Letters are hashed to a few symbols, so that words become short strings over a small
alphabet and a whole one-edit neighbourhood of such a string is small: everything one
deletion or one replacement away, and the string itself, for two letters may have one
symbol. The neighbourhoods are joined with the reduced vocabulary, and the words behind
each pair of reduced strings are compared letter by letter.

A pair is generated from one end only: an insertion is the other string's deletion, and
a replacement is made towards the smaller symbol. Neighbourhoods therefore hold no
insertions, and no pair of words is compared twice. No list of words is gathered: a
reduced string with many words is a join key, which Spark can split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHERS = "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Spelling:
    """Words have ``least_length`` letters and ``least_count`` occurrences or more; a
    form occurs ``ratio`` times as often as its variant. ``symbols``, the size of the
    reduced alphabet, changes the work and never the result: neighbourhoods grow with
    it, and words that share a reduced string become fewer."""

    least_length: int = 7
    least_count: int = 2
    ratio: int = 10
    symbols: int = 6
    typo_every: int = 31


def occurrences(docs: DataFrame, settings: Spelling) -> DataFrame:
    """``word`` per occurrence in ``docs`` (doc_id, text), those too short left out.

    A run of letters loses the letter at ``hash % length`` if ``typo_every`` divides
    its hash, the crc32 of ``doc_id:run``.
    """
    # A deletion never makes a short run long enough; the pattern takes maximal runs only.
    pattern = f"([A-Za-z\\u00C0-\\u00FF]{{{settings.least_length},}})"
    text = F.translate(F.col("text").cast("string"), CAPITALS, SMALL)
    runs = docs.select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("owner"),
        F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("run"),
    ).withColumn("h", F.crc32(F.concat("owner", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run"))
    )
    word = F.when(F.col("h") % settings.typo_every == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= settings.least_length)


def vocabulary(docs: DataFrame, settings: Spelling) -> DataFrame:
    """``word, n`` of the words of ``docs``; counted in the map tasks first."""
    counts = occurrences(docs, settings).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= settings.least_count)


def reduced(word: F.Column, symbols: int) -> F.Column:
    letters = SMALL + OTHERS
    return F.translate(word, letters, "".join(SYMBOLS[ord(c) % symbols] for c in letters))


def neighbourhood(text: str, symbols: int) -> F.Column:
    """Distinct hashes of the reduced string in column ``text`` and of its neighbours."""
    alphabet = ", ".join(f"'{c}'" for c in SYMBOLS[:symbols])
    return F.expr(
        f"""array_distinct(transform(
          concat(
            array({text}),
            transform(sequence(1, length({text})),
              i -> concat(substring({text}, 1, i - 1), substring({text}, i + 1))),
            flatten(transform(sequence(1, length({text})), i -> transform(
              filter(array({alphabet}), s -> s < substring({text}, i, 1)),
              s -> concat(substring({text}, 1, i - 1), s, substring({text}, i + 1)))))),
          x -> xxhash64(x)))"""
    )


def near_pairs(words: DataFrame, settings: Spelling) -> DataFrame:
    """``a, n, b, m``: every pair of ``words`` (word, n) one edit apart, once, with counts."""
    keyed = words.select("word", "n", reduced(F.col("word"), settings.symbols).alias("r"))
    # Small as a table, but each string is about to become its whole neighbourhood.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strings = stored(keyed.select("r").distinct().repartition(tasks, "r"))
    wanted = strings.select(F.xxhash64("r").alias("near")).distinct()
    pairs = strings.select(
        F.xxhash64("r").alias("key"),
        F.explode(neighbourhood("r", settings.symbols)).alias("near"),
    ).join(wanted, "near")
    left = keyed.select(
        F.xxhash64("r").alias("key"), F.col("word").alias("a"), "n", F.col("r").alias("p")
    )
    right = keyed.select(
        F.xxhash64("r").alias("near"), F.col("word").alias("b"), F.col("n").alias("m"),
        F.col("r").alias("q"),
    )
    # The order in which pairs are generated.
    first = F.struct(F.length("p"), "p", "a") > F.struct(F.length("q"), "q", "b")
    one_edit = F.levenshtein(F.col("a"), F.col("b"), 1) == 1
    found = pairs.join(left, "key").join(right, "near").where(first & one_edit)
    # Only strings whose hashes are equal can have given a pair twice.
    return found.select("a", "n", "b", "m").distinct()


def spelling_forms(docs: DataFrame, settings: Spelling = Spelling()) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs`` (doc_id, text).

    Words are near if one inserted, deleted or replaced letter makes them equal. The form
    of a word is its near word with the largest count (ties: the smallest in code-point
    order) if that is ``ratio`` times its own, else NULL; ``root`` is where forms lead,
    the word itself without one. NULL and empty texts have no words; a NULL doc_id counts
    as an empty one; repeated rows count each time; texts are taken whole; other columns
    are ignored; an empty table gives none. Reduced strings are known by 64-bit hashes,
    which can only add comparisons.
    """
    words = stored(vocabulary(docs, settings))
    pairs = stored(near_pairs(words, settings))
    near = pairs.select(
        F.col("a").alias("word"), "n", F.col("m").alias("near_n"), F.col("b").alias("near")
    ).union(pairs.select("b", "m", "n", "a"))
    none = words.select(
        "word", "n", F.lit(None).cast("long").alias("near_n"), F.lit(None).cast("string").alias("near")
    )
    counted = near.union(none).groupBy("word").agg(
        F.max("n").alias("n"),
        F.count("near").alias("n_near"),
        F.min(F.when(F.col("near").isNotNull(), F.struct(-F.col("near_n"), F.col("near")))).alias("best"),
    )
    enough = -F.col("best.col1") >= settings.ratio * F.col("n")
    formed = stored(
        counted.select(
            "word",
            "n",
            "n_near",
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.col1")).alias("form_n"),
        )
    )
    return formed.join(roots(formed), "word", "left").withColumn(
        "root", F.coalesce("root", "word")
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of every word of ``formed`` (word, form) that has a form.

    Counts grow along the way, so there are no circles; each step is a join and halves
    what is left of the longest way.
    """
    ways = stored(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = stored(ways.join(further, "root", "left").select("word", "root", "next"))
        moved = not ways.where("next is not null").isEmpty()
        ways = ways.select("word", F.coalesce("next", "root").alias("root"))
        if not moved:
            return ways
