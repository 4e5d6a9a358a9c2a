"""Repeated passages between documents, found through difference-cover anchors.

Anchors are windows of ``anchor`` words at the places whose remainder modulo the
period lies in a difference cover. Whatever the places of two equal long windows, they
hold an anchor at the same offset, so only hashes at cover places are exchanged. Around
anchors that occur in two documents the match is extended: the full windows that
contain such an anchor are hashed and the least doc_id of each is found.

Documents are dealt to buckets by a hash. A bucket sends each anchor and each window
once, however many of its documents hold it, so a passage in a third of all rows is as
many entries as there are buckets. Hashes travel packed, by ranges of their values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import words_of

# Every difference modulo 31 is a difference of two of these six.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Passages:
    """``window``: words of a repeated passage. ``bucket_chars``: text of a bucket,
    which one task holds in memory. ``range_chars``: text whose anchors one task compares.
    Both bound memory, not results, and should grow with the executors: packed rows are as
    many as buckets times ranges."""

    window: int = 50
    bucket_chars: int = 8 << 20
    range_chars: int = 8 << 20

    @property
    def anchor(self) -> int:
        return self.window - PERIOD + 1


class Numbers(dict):
    """word -> its number in the bucket."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as long as needed."""

    def __init__(self, base: int):
        self.steps = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            with np.errstate(over="ignore"):
                self.tables = [
                    np.cumprod(np.r_[np.uint64(1), np.full(n, step, np.uint64)])
                    for step in self.steps
                ]
        return [table[:n] for table in self.tables]


POWERS = [Powers(base) for base in BASE]


class BucketWords:
    """The words of a bucket's documents, one document after the other, in arrays.

    Rows without a doc_id have no words here. ``left`` is the number of words from a
    place to the end of its document, ``place`` its distance from the beginning.
    """

    def __init__(self, docs: pa.Table, settings: Passages):
        self.settings = settings
        self.ids = docs.column("doc_id").to_pylist()
        numbers, pieces = Numbers(), []
        for doc, text in zip(self.ids, docs.column("text").cast(pa.binary()).to_pylist()):
            words = text.split() if text and doc is not None else []
            pieces.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        self.size = np.array([len(piece) for piece in pieces], np.int64)
        self.tokens = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        digests = b"".join(map(xxhash.xxh3_128_digest, numbers))
        self.lanes = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2).T
        self.start = np.cumsum(self.size) - self.size
        self.owner = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(self.tokens)) - self.start[self.owner]
        self.left = self.size[self.owner] - self.place

    def hashes(self, lane: int, n: int, at: np.ndarray) -> np.ndarray:
        """Of the ``n`` words from each place of ``at``: a polynomial modulo 2**64 in
        their hashes, from running sums over all words."""
        up, down = POWERS[lane].upto(len(self.tokens) + 1)
        with np.errstate(over="ignore"):
            sums = np.cumsum(self.lanes[lane][self.tokens] * up[:-1])
            sums = np.r_[np.uint64(0), sums]
            values = (sums[at + n] - sums[at]) * down[at]
        return values ^ (values >> np.uint64(29))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors of documents long enough for a window."""
        covered = np.isin(np.arange(PERIOD), COVER)[self.place % PERIOD]
        fits = (self.left >= self.settings.anchor) & (
            self.size[self.owner] >= self.settings.window
        )
        at = np.flatnonzero(covered & fits)
        return at, self.hashes(0, self.settings.anchor, at)

    def windows(self) -> np.ndarray:
        """Places of all full windows."""
        return np.flatnonzero(self.left >= self.settings.window)

    def checks(self, at: np.ndarray) -> np.ndarray:
        """32 bits of a second hash of the windows at ``at``."""
        values = self.hashes(1, self.settings.window, at)
        return (values >> np.uint64(32)).astype(np.uint32)

    def doc_ids(self, at: np.ndarray) -> np.ndarray:
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        return ids[self.owner[at]]

    def marked(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether each place lies in one of the runs from ``first`` to before ``end``."""
        n = len(self.tokens) + 1
        change = np.bincount(first, minlength=n) - np.bincount(end, minlength=n)
        return np.cumsum(change[:-1]) > 0


PACKED = "bucket int, part int, hashes binary, checks binary, docs binary, shared binary"


def _parts(h: np.ndarray, count: int) -> list[tuple[int, np.ndarray]]:
    """Which entries go to each of ``count`` ranges of hashes."""
    part = ((h >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(count + 1))
    return [(p, order[a:b]) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]


def _pack(bucket: int, count: int, h, shared, g=None, doc=None) -> pa.Table:
    """A bucket's entries as one row for each range of hashes."""
    parts = _parts(h, count)

    def packed(values) -> pa.Array:
        return pa.array(
            [b"" if values is None else values[rows].tobytes() for _, rows in parts], pa.binary()
        )

    return pa.table(
        {
            "bucket": pa.array([bucket] * len(parts), pa.int32()),
            "part": pa.array([p for p, _ in parts], pa.int32()),
            "hashes": packed(h),
            "checks": packed(g),
            "docs": packed(doc),
            "shared": packed(shared),
        }
    )


def _column(values: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind)


def _anchors_task(settings: Passages, count: int):
    """(bucket, doc_id, text) of whole buckets -> their distinct anchors, packed.

    ``shared`` says that two documents of the bucket hold the anchor.
    """

    def run(table: pa.Table) -> pa.Table:
        words = BucketWords(table, settings)
        at, h = words.anchors()
        if not len(at):
            return _empty()
        doc = words.doc_ids(at)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        last = np.r_[first[1:], len(h)] - 1
        shared = (doc[first] != doc[last]).astype(np.uint8)
        return _pack(table.column("bucket")[0].as_py(), count, h[first], shared)

    return run


def _empty() -> pa.Table:
    return pa.schema(
        [("bucket", pa.int32()), ("part", pa.int32())]
        + [(c, pa.binary()) for c in ("hashes", "checks", "docs", "shared")]
    ).empty_table()


def _shared_anchors(table: pa.Table) -> pa.Table:
    """One range of anchor hashes -> for each bucket those in two documents or more."""
    values = [np.frombuffer(x.as_py(), "<u8") for x in table.column("hashes")]
    flags = [np.frombuffer(x.as_py(), np.uint8) for x in table.column("shared")]
    h = np.concatenate(values)
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    again = np.zeros(len(h), bool)
    same = sorted_h[1:] == sorted_h[:-1]
    again[order[1:]] |= same
    again[order[:-1]] |= same
    again |= np.concatenate(flags).astype(bool)
    hits = np.split(again, np.cumsum([len(v) for v in values])[:-1])
    found = [v[hit].tobytes() for v, hit in zip(values, hits)]
    return _reply(table, found)


def _reply(table: pa.Table, hashes, checks=None, docs=None) -> pa.Table:
    empty = [b""] * table.num_rows
    reply = pa.table(
        {
            "bucket": table.column("bucket"),
            "part": table.column("part"),
            "hashes": pa.array(hashes, pa.binary()),
            "checks": pa.array(checks or empty, pa.binary()),
            "docs": pa.array(docs or empty, pa.binary()),
            "shared": pa.array(empty, pa.binary()),
        }
    )
    return reply.filter(pa.array([len(x) > 0 for x in hashes], pa.bool_()))


def _windows_task(settings: Passages, count: int):
    """A bucket's documents and shared anchors -> the windows around those, packed.

    Per distinct window: the least doc_id of the bucket, and whether a larger one has
    it too.
    """

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows or not replies.num_rows:
            return _empty()
        wanted = np.unique(_column(replies.column("hashes").to_pylist(), "<u8"))
        words, slack = BucketWords(docs, settings), settings.window - settings.anchor
        at, values = words.anchors()
        at = at[_places(wanted, values) >= 0]
        # The windows that hold a shared anchor: they begin at it or up to ``slack`` before.
        near = words.marked(np.maximum(at - slack, words.start[words.owner[at]]), at + 1)
        near = np.flatnonzero(near & (words.left >= settings.window))
        if not len(near):
            return _empty()
        h, g = words.hashes(0, settings.window, near), words.checks(near)
        doc = words.doc_ids(near)
        order = np.lexsort((doc, g, h))
        h2, g2, doc2 = h[order], g[order], doc[order]
        new = np.r_[True, (h2[1:] != h2[:-1]) | (g2[1:] != g2[:-1])]
        start = np.flatnonzero(new)
        end = np.r_[start[1:], len(h2)] - 1
        # In the order of documents, equal ids lie together and pack well.
        place = np.argsort(order[start], kind="stable")
        start, end = start[place], end[place]
        several = (doc2[start] != doc2[end]).astype(np.uint8)
        bucket = docs.column("bucket")[0].as_py()
        return _pack(bucket, count, h2[start], several, g2[start], doc2[start])

    return run


def _places(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value is in ``sorted_values``; -1 if it is not."""
    if not len(sorted_values):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[at] == values, at, -1)


def _least_docs(table: pa.Table) -> pa.Table:
    """One range of window hashes -> for each bucket the windows that a document of it
    holds and a smaller one, with the least doc_id of all."""
    lists = {c: table.column(c).to_pylist() for c in ("hashes", "checks", "docs", "shared")}
    h, g = _column(lists["hashes"], "<u8"), _column(lists["checks"], "<u4")
    doc, shared = _column(lists["docs"], "<i8"), _column(lists["shared"], np.uint8)
    order = np.lexsort((doc, g, h))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])]
    least = np.empty(len(h), np.int64)
    least[order] = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    hit = (least < doc) | (shared > 0)
    cuts = np.cumsum([len(x) // 8 for x in lists["hashes"]])[:-1]
    columns = [
        [values[keep].tobytes() for values, keep in zip(np.split(v, cuts), np.split(hit, cuts))]
        for v in (h, g, least)
    ]
    return _reply(table, *columns)


def _removal_task(settings: Passages):
    """A bucket's documents and its repeated windows -> what is left of each document."""

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        lists = {c: replies.column(c).to_pylist() for c in ("hashes", "checks", "docs")}
        h, g = _column(lists["hashes"], "<u8"), _column(lists["checks"], "<u4")
        least = _column(lists["docs"], "<i8")
        order = np.lexsort((g, h))
        h, g, least = h[order], g[order], least[order]
        starts = np.unique(h)
        first = np.searchsorted(h, starts)
        size = np.searchsorted(h, starts, side="right") - first
        words = BucketWords(docs, settings)
        gone = np.zeros(len(words.tokens), bool)
        if len(starts):
            windows = words.windows()
            at = _places(starts, words.hashes(0, settings.window, windows))
            hit, at = windows[at >= 0], at[at >= 0]
            check, mine = words.checks(hit), words.doc_ids(hit)
            again = np.zeros(len(hit), bool)
            for turn in range(int(size[at].max()) if len(at) else 0):
                entry = np.minimum(first[at] + turn, len(h) - 1)
                again |= (turn < size[at]) & (g[entry] == check) & (least[entry] < mine)
            gone = words.marked(hit[again], hit[again] + settings.window)
        totals, removed, spans, texts = [], [], [], []
        for start, n, text in zip(words.start, words.size, docs.column("text")):
            found = words_of(text.as_py())
            mine = gone[start : start + n]
            edges = np.flatnonzero(np.diff(np.r_[False, mine, False]))
            totals.append(len(found))
            removed.append(int(mine.sum()))
            spans.append(edges.tolist())
            kept = list(compress(found, ~mine)) if len(edges) else found
            texts.append(b" ".join(kept))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(totals, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, pa.list_(pa.int64())),
                "kept_text": pa.array([t.decode() for t in texts], pa.string()),
            }
        )

    return run


RESULT = "doc_id long, n_words long, n_removed long, removed array<long>, kept_text string"


def without_repeats(docs: DataFrame, settings: Passages = Passages()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, removed, kept_text.

    A word goes if a window of ``settings.window`` words covers it whose words also
    start in a document with a smaller doc_id. ``removed`` holds start and end (exclusive)
    of each run of such words, one after the other. NULL and empty texts have no words; a
    row without doc_id loses nothing and takes nothing; rows with one doc_id take nothing
    from each other; shorter texts have no window. Texts are taken whole. Other columns
    are ignored; an empty table gives none. Windows are known by 96 bits of hashes.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-chars // settings.bucket_chars))
    ranges = max(1, -(-chars // settings.range_chars))
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).cast("int")
    # All three passes read this one exchange.
    dealt = rows.withColumn("bucket", bucket).repartition(count, "bucket")
    anchors = dealt.groupBy("bucket").applyInArrow(_anchors_task(settings, ranges), PACKED)
    shared = anchors.groupBy("part").applyInArrow(_shared_anchors, PACKED)
    windows = (
        dealt.groupBy("bucket")
        .cogroup(shared.groupBy("bucket"))
        .applyInArrow(_windows_task(settings, ranges), PACKED)
    )
    repeated = windows.groupBy("part").applyInArrow(_least_docs, PACKED)
    return (
        dealt.groupBy("bucket")
        .cogroup(repeated.groupBy("bucket"))
        .applyInArrow(_removal_task(settings), RESULT)
    )
