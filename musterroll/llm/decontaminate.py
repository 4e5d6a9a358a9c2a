"""Benchmark decontamination with a BM25 index of the test items.

Every passage of every document is a query; every item whose BM25 score reaches a
share of its own best score is retrieved, then its question and answer are looked
for in the passage. Pruning is by block maxima: postings lie in blocks of items with
the largest impact of each (term, block); the bound of a block is the sum over the
passage's terms, and only blocks whose bound reaches the threshold are scored. The
pivot test of WAND is made for all blocks of many passages at once, in arrays,
instead of list by list. Pruning loses nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import small_batches

TERM = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.!?]\s+|\n+")


@dataclass(frozen=True)
class Decontamination:
    """``share`` of an item's own BM25 score that retrieves it; ``overlap`` of the
    question's and of the answer's ``shingle``-word shingles that confirms it.
    ``max_item_bytes`` bounds the texts of one index; more items make more indexes,
    each used on all documents. ``cells_at_once`` bounds memory, not results."""

    share: float = 0.6
    overlap: float = 0.8
    shingle: int = 5
    k1: float = 1.2
    b: float = 0.75
    block: int = 16
    least_passage: int = 64
    max_item_bytes: int = 32 << 20
    cells_at_once: int = 1 << 18


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(text.lower()) if text else []


def shingles(terms: list[str], n: int) -> set[tuple[str, ...]]:
    """The n-term shingles; a shorter list is one shingle, an empty one has none."""
    if not terms:
        return set()
    return {tuple(terms[i : i + n]) for i in range(max(1, len(terms) - n + 1))}


def question_answer(text: str, shingle: int) -> tuple[list[str], list[str]]:
    """Terms of an item's question and answer: its last sentence is the answer.

    A single sentence is split after three quarters of its terms. An item too short
    for a shingle of each is one sequence, with no answer apart.
    """
    if len(terms_of(text)) < 2 * shingle:
        return terms_of(text), []
    ends = [m.end() for m in SENTENCE_END.finditer(text) if terms_of(text[m.end() :])]
    for end in reversed(ends):
        if terms_of(text[:end]):
            return terms_of(text[:end]), terms_of(text[end:])
    terms = terms_of(text)
    cut = max(1, len(terms) * 3 // 4)
    return terms[:cut], terms[cut:]


def contained(wanted: list[str], terms: list[str], n: int) -> float:
    """Share of the n-term shingles of ``wanted`` in ``terms``; 1 if there are none."""
    parts = shingles(wanted, n)
    if not parts:
        return 1.0
    size = len(next(iter(parts)))
    have = {tuple(terms[i : i + size]) for i in range(len(terms) - size + 1)}
    return len(parts & have) / len(parts)


@dataclass(frozen=True)
class Collection:
    """What BM25 takes from all items, whichever index they are in: their number, mean
    length, and how many hold each term."""

    items: int
    mean: float
    frequency: dict[str, int]

    @classmethod
    def of(cls, texts: Iterable[str]) -> Collection:
        lists = [terms for terms in map(terms_of, texts) if terms]
        frequency = Counter(term for terms in lists for term in set(terms))
        return cls(len(lists), sum(map(len, lists)) / max(1, len(lists)), frequency)


class Index:
    """BM25 impacts of items, divided by each item's own score, in CSR arrays.

    ``collection`` has the statistics of all items, these and those of other indexes.
    """

    def __init__(
        self,
        items: list[tuple[int, str]],
        settings: Decontamination,
        collection: Collection | None = None,
    ):
        self.settings = settings
        collection = collection or Collection.of(text for _, text in items)
        rows = [(i, text, terms_of(text)) for i, text in sorted(items)]
        rows = [row for row in rows if row[2]]
        self.ids = [row[0] for row in rows]
        self.parts = [question_answer(row[1], settings.shingle) for row in rows]
        self.longest = max([len(row[2]) for row in rows], default=0)
        self.vocabulary: dict[str, int] = {}
        counts: list[dict[int, int]] = []
        for _, _, terms in rows:
            tf: dict[int, int] = {}
            for term in terms:
                t = self.vocabulary.setdefault(term, len(self.vocabulary))
                tf[t] = tf.get(t, 0) + 1
            counts.append(tf)
        lengths = np.array([len(row[2]) for row in rows], float)
        mean = collection.mean or 1.0
        item = np.array([i for i, tf in enumerate(counts) for _ in tf], np.int64)
        term = np.array([t for tf in counts for t in tf], np.int64)
        tf = np.array([n for tf in counts for n in tf.values()], float)
        df = np.array([collection.frequency[t] for t in self.vocabulary], float)
        idf = np.log(1 + (collection.items - df + 0.5) / (df + 0.5))
        k1, b = settings.k1, settings.b
        impact = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[item] / mean))
        own = np.bincount(item, impact, minlength=len(rows))
        impact = impact / own[item]
        order = np.lexsort((item, term))
        self.item, self.impact, term = item[order], impact[order], term[order]
        self.start = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        # Blocks: the largest impact of each term among the items of a block.
        key = term * (len(rows) // settings.block + 1) + self.item // settings.block
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        self.block_max = np.maximum.reduceat(self.impact, first) if len(first) else self.impact
        self.block_of = self.item[first] // settings.block
        self.block_start = np.searchsorted(term[first], np.arange(len(self.vocabulary) + 1))
        self.block_first = np.r_[first, len(key)]
        self.blocks = (len(rows) + settings.block - 1) // settings.block
        # Any run of as many terms as the longest item lies whole in some passage.
        self.stride = max(settings.least_passage, self.longest)

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text's place, item's place, share, question overlap, answer overlap) of the
        best passage of each confirmed pair."""
        if not self.ids:
            return
        pending: list[tuple[int, int, np.ndarray]] = []
        size, most = 0, max(1, self.settings.cells_at_once // self.blocks)
        kept: dict[int, list[str]] = {}
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for at, text in enumerate(texts):
            terms = terms_of(text)
            if not terms:
                continue
            kept[at] = terms
            get = self.vocabulary.get
            known = np.fromiter((get(t, -1) for t in terms), np.int64, len(terms))
            for start in range(0, max(1, len(terms) - self.stride), self.stride):
                pending.append((at, start, known[start : start + 2 * self.stride]))
                size += 1
                if size >= most:
                    self._search(pending, kept, found)
                    pending, size = [], 0
                    kept = {at: terms}
        self._search(pending, kept, found)
        for (at, item), best in sorted(found.items()):
            yield (at, item, *best)

    def _search(self, passages, kept, found) -> None:
        if not passages:
            return
        s, width = self.settings, len(self.vocabulary)
        owner = np.repeat(np.arange(len(passages)), [len(p[2]) for p in passages])
        term = np.concatenate([p[2] for p in passages])
        pairs = np.unique(owner[term >= 0] * width + term[term >= 0])
        owner, term = pairs // width, pairs % width
        # Bound of every (passage, block).
        at, source = _expand(self.block_start, term)
        cell = owner[source] * self.blocks + self.block_of[at]
        bound = np.bincount(cell, self.block_max[at], minlength=len(passages) * self.blocks)
        live = bound >= s.share - 1e-9
        hit = live[cell]
        if not hit.any():
            return
        # Score the items of the blocks that may hold a match.
        entries, source2 = _expand(self.block_first, at[hit])
        pair = owner[source[hit][source2]] * len(self.ids) + self.item[entries]
        pair, inverse = np.unique(pair, return_inverse=True)
        score = np.bincount(inverse, self.impact[entries])
        for p, share in zip(pair[score >= s.share - 1e-9], score[score >= s.share - 1e-9]):
            at_passage, item = divmod(int(p), len(self.ids))
            doc, start, _ = passages[at_passage]
            terms = kept[doc][start : start + 2 * self.stride]
            question, answer = self.parts[item]
            q = contained(question, terms, s.shingle)
            a = contained(answer, terms, s.shingle)
            if q >= s.overlap and a >= s.overlap:
                best = (round(float(share), 6), q, a)
                found[doc, item] = max(found.get((doc, item), best), best)


def _expand(starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the lists of ``keys``, and which key each belongs to."""
    sizes = starts[keys + 1] - starts[keys]
    source = np.repeat(np.arange(len(keys)), sizes)
    offset = np.arange(len(source)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[keys][source] + offset, source


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_id, text -> the same with its length in terms and its distinct terms."""
    for batch in small_batches(batches, "text"):
        lists = [terms_of(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(list(map(len, lists)), pa.int64()),
                pa.array([sorted(set(terms)) for terms in lists], pa.list_(pa.string())),
            ],
            [*batch.schema.names, "length", "terms"],
        )


def indexes(items: DataFrame, settings: Decontamination) -> Iterator[Index]:
    """Indexes of the test items, each over at most ``max_item_bytes`` bytes of text.

    The test set is the bounded side; items stream through the driver one index at a
    time, each with the frequencies of its terms among all items. Items without an id or
    without a word are left out; repeated items count once.
    """
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(
        "item_id is not null and text is not null"
    )
    listed = rows.distinct().mapInArrow(
        _terms, "item_id long, text string, length long, terms array<string>"
    ).where("length > 0")
    total = listed.agg(F.count("length").alias("n"), F.sum("length").alias("length")).first()
    mean = (total.length or 0) / max(1, total.n)
    each = listed.select("item_id", "text", F.explode("terms").alias("term"))
    found = each.groupBy("term").agg(F.count("term").alias("n"))
    known = each.join(found, "term").groupBy("item_id", "text").agg(
        F.collect_list(F.struct("term", "n")).alias("terms")
    )
    block: list[tuple[int, str]] = []
    frequency: dict[str, int] = {}
    size = 0
    for row in known.orderBy("item_id", "text").toLocalIterator():
        length = len(row.text.encode())
        if size and size + length > settings.max_item_bytes:
            yield Index(block, settings, Collection(total.n, mean, frequency))
            block, frequency, size = [], {}, 0
        block.append((row.item_id, row.text))
        frequency.update(row.terms)
        size += length
    yield Index(block, settings, Collection(total.n, mean, frequency))


MATCHES = "array<struct<item_id:bigint,share:double,question_overlap:double,answer_overlap:double>>"


def _searching(shared, place: int, column: int):
    """The task that adds one index's matches to those already in ``column``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, place):
            index = shared.value
            found = batch.column(column).to_pylist()
            for at, item, share, question, answer in index.matches(
                batch.column(place).to_pylist()
            ):
                found[at].append(
                    {
                        "item_id": index.ids[item],
                        "share": share,
                        "question_overlap": question,
                        "answer_overlap": answer,
                    }
                )
            values = pa.array(found, batch.schema.field(column).type)
            yield batch.set_column(column, batch.schema.field(column), values)

    return run


def with_matches(
    docs: DataFrame,
    items: DataFrame,
    settings: Decontamination = Decontamination(),
    into: str = "matches",
) -> DataFrame:
    """``docs`` with the column ``into``: the confirmed test items of each row.

    A column of that name is replaced, all others pass through. NULL and empty texts
    have no matches; repeated rows are searched one by one; tied passages give the
    one score; an empty item table gives no matches, an empty document table no rows.
    Frequencies and lengths are those of all items, however many indexes they make. The
    rows are not shuffled.
    """
    context = docs.sparkSession.sparkContext
    result = docs.withColumn(into, F.expr(f"cast(array() as {MATCHES})"))
    place, column = docs.columns.index("text"), result.columns.index(into)
    for index in indexes(items, settings):
        shared = context.broadcast(index)  # made of at most max_item_bytes of text
        result = result.mapInArrow(_searching(shared, place, column), result.schema)
    return result
