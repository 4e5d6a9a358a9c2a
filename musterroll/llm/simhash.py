"""SimHash near-duplicates through an inverted index on byte positions.

Fingerprints that differ in at most two bits differ in at most two of their eight
bytes, so they share at least six positional bytes. The index lists fingerprints
under every six positional bytes they have (28 ways to choose six positions), the
least count that a link guarantees: a pair with six, seven or eight shared bytes
meets in 1, 7 or 28 lists, a pair with fewer in none. Lists of single positional
bytes would hold a 256th of all fingerprints each and their pairs would grow with the
square of the table; lists of six hold at most 65,536 fingerprints, whatever the
table. Inside a list the shared-byte count is already reached; the two free bytes
are compared bit by bit, against the 136 ways to flip one or two of 16 bits, so the
work on a list grows with its length, not with its pairs. With a greatest distance of b
bits, all this holds for 8 - b shared bytes and b free ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.components import components
from musterroll.llm.corpus import set_apart, small_batches, stored, words_of

HASH_SEED = 42


@dataclass(frozen=True)
class SimHash:
    """``words`` of a shingle; fingerprints link at ``bits`` or fewer differing bits."""

    words: int = 3
    bits: int = 2

    @property
    def free_bytes(self) -> list[tuple[int, ...]]:
        """The choices of bytes in which linked fingerprints may differ."""
        return list(combinations(range(8), self.bits))

    @property
    def flips(self) -> list[int]:
        """What up to ``bits`` differing bits change in the free bytes."""
        places = range(8 * self.bits)
        chosen = (c for n in range(1, self.bits + 1) for c in combinations(places, n))
        return [sum(1 << i for i in c) for c in chosen]


def fingerprint(text: str | None, shingle: int = SimHash.words) -> int:
    """Signed 64-bit SimHash of the word shingles of ``text``; 0 without words.

    A-Z are lower-cased. A text of fewer words than a shingle is one shingle.
    """
    words = [word.lower() for word in words_of(text)]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), 65_536):
        hashes = np.array(
            [
                digest(joined[a:b], HASH_SEED)
                for a, b in zip(starts[at : at + 65_536], last[at : at + 65_536])
            ],
            "<u8",
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(2 * counts > len(last), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """``doc_id, fp`` per row of ``docs``; NULL text has fingerprint 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            values = [fingerprint(text.as_py(), settings.words) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, fp long"
    )


def _linked(owner: np.ndarray, free: np.ndarray, settings: SimHash) -> np.ndarray:
    """For each (list, free bytes) the least row linked to it inside its list."""
    code = (owner.astype(np.int64) << 8 * settings.bits) | free
    order = np.argsort(code, kind="stable")
    code = code[order]
    label = np.arange(len(code))
    left, right = [], []
    for flip in settings.flips:
        other = code ^ flip
        at = np.minimum(np.searchsorted(code, other), len(code) - 1)
        hit = np.flatnonzero((code[at] == other) & (other > code))
        left.append(hit)
        right.append(at[hit])
    a, b = np.concatenate(left), np.concatenate(right)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    result = np.empty(len(code), np.int64)
    result[order] = order[label]
    return result


def links(groups: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """Edges ``a, b`` that join all linked distinct fingerprints of ``groups`` (fp).

    In each list every member points at one linked member; links within a list are
    never written out pair by pair.
    """
    free_bytes = settings.free_bytes

    def kept_bytes(free: tuple[int, ...]) -> int:
        return _signed(~sum(0xFF << 8 * i for i in free))

    lists = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(kept_bytes(free))).alias("key")
            )
            for k, free in enumerate(free_bytes)
        ]
    )
    # Few bytes, but each fingerprint is about to be listed many times.
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = (
        groups.select("fp")
        .repartition(tasks, "fp")
        .select("fp", F.explode(lists).alias("posting"))
        .groupBy("posting.k", "posting.key")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fps")
            if not len(fps):
                continue
            values = fps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pc.list_value_length(fps).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            chosen = np.array(free_bytes)[batch.column("k").to_numpy(zero_copy_only=False)]
            shifts = (8 * chosen[owner]).astype(np.uint64)
            plain, free = values.view(np.uint64), np.zeros(len(values), np.int64)
            for place in range(settings.bits):
                byte = (plain >> shifts[:, place]) & np.uint64(0xFF)
                free |= byte.astype(np.int64) << 8 * place
            to = _linked(owner, free, settings)
            moved = np.flatnonzero(to != np.arange(len(to)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[moved]), pa.array(values[to[moved]])], ["a", "b"]
            )

    return postings.mapInArrow(run, "a long, b long").distinct()


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def classes(fps: DataFrame, settings: SimHash) -> DataFrame:
    """``fp, component_id, root`` of each fingerprint of ``fps`` (doc_id, fp): the
    smallest doc_id of its component, and a fingerprint that stands for the component."""
    groups = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(groups, settings)).select(F.col("node").alias("fp"), "root")
    # Fingerprints without a link are their own roots.
    placed = stored(
        groups.join(roots, "fp", "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        )
    )
    least = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return stored(placed.join(least, "root").select("fp", "component_id", "root"))


def near_duplicates(docs: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """``doc_id, fp, component_id`` per row of ``docs`` (doc_id, text).

    Fingerprints link at two or fewer differing bits; component_id is the smallest
    doc_id reachable, the row's own included. Rows of one fingerprint are linked,
    texts without words among them, and are represented by it. A row without doc_id
    takes part, never gives the id, and has a NULL component_id only if no linked row
    has an id. Repeated rows are returned as often as they occur; other columns are
    ignored; an empty table gives none.
    """
    fps = stored(fingerprints(docs, settings))
    class_ids = classes(fps, settings).select("fp", "component_id")
    return fps.join(class_ids, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """One row of ``docs`` (doc_id, text, any others) for each component of near
    duplicates, with all its columns.

    It has the smallest doc_id; of several such rows, and of rows without an id where no
    other is linked, some one stays. Verdicts lie on rows, not on ids: the rows are
    stored with their fingerprints, and a row is known by its place there.
    """
    plain, name = set_apart(docs)
    place = plain.columns.index(name["text"])
    schema = plain.withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, place):
            values = [fingerprint(t.as_py(), settings.words) for t in batch.column(place)]
            yield batch.append_column("fp", pa.array(values, pa.int64()))

    # The places of stored rows do not change, whoever reads them and however often.
    rows = stored(plain.mapInArrow(run, schema)).withColumn("row", F.monotonically_increasing_id())
    fps = rows.select(F.col(name["doc_id"]).cast("long").alias("doc_id"), "fp", "row")
    found = classes(fps, settings).select("fp", "root")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    winners = fps.join(found, "fp").groupBy("root").agg(best).select("best.row")
    return rows.join(winners, "row", "left_semi").select(*plain.columns).toDF(*docs.columns)


def hex_digits(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
