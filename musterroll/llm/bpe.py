"""Byte-level BPE by overlapping chunks, and decoding.

A text is cut into chunks that overlap. Chunks are split into pre-tokens on their
own, in parallel; where a chunk's boundaries meet those of the chunk before inside
the overlap, both go on alike, since a pre-token depends only on what follows its
start. The chunks are stitched at the first such boundary and the pieces between
stitches are encoded. A chunk that shares no boundary with the one before it (one
pre-token longer than the overlap) is joined to it. Chunks of a long text are rows of
their own and any task's work; those of other texts stay in the task that has the text,
which is not shuffled. A text of one chunk is one piece. Decoding joins the bytes of the
ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from musterroll.llm.corpus import small_batches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@dataclass(frozen=True)
class Chunks:
    """Characters of a chunk and of its overlap with the next, and of the longest text
    whose chunks stay in one task."""

    size: int = 4_096
    overlap: int = 256
    spread: int = 65_536


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The vocabulary file is part of the workers' Python installation."""
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={}
    )


@lru_cache(maxsize=4)
def _splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


# A cut chunk can change a pre-token that ends within this many characters of the cut:
# the longest contraction has three.
UNSURE = 2


def boundaries(chunk: str, pattern: str, last: bool) -> list[int]:
    """Starts of the pre-tokens of ``chunk`` that do not depend on what follows it."""
    sure = len(chunk) if last else len(chunk) - UNSURE
    return [0, *(m.end() for m in _splitter(pattern).finditer(chunk) if m.end() <= sure)]


def pieces_of(text: str, pattern: str, chunks: Chunks) -> list[str]:
    """``text`` cut where chunks are stitched: at the first boundary that a chunk shares
    with the one before it. After a chunk that shares none nothing is known to be in step."""
    size, overlap = chunks.size, chunks.overlap
    starts, tail = [0], set()
    for at in range(0, len(text), size):
        last = at + size >= len(text)
        found = [at + b for b in boundaries(text[at : at + size + overlap], pattern, last)]
        if at:
            shared = tail.intersection(b for b in found if b < at + overlap)
            if not shared:
                break
            starts.append(min(shared))
        tail = {b for b in found if b >= at + size}
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


def _encoding_task(
    path: str, pattern: str, place: int, column: int, chunks: Chunks | None = None
):
    """With ``chunks`` the texts are cut into pieces first, else they are pieces."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path, pattern).encode_ordinary

        def ids_of(text: str) -> np.ndarray:
            if chunks is None or len(text) <= chunks.size:
                return np.array(encode(text), np.int32)
            pieces = pieces_of(text, pattern, chunks)
            return np.concatenate([np.array(encode(piece), np.int32) for piece in pieces])

        for batch in small_batches(batches, place):
            ids = [ids_of(text.as_py() or "") for text in batch.column(place)]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]))
            )
            field = batch.schema.field(column)
            yield batch.set_column(column, field, lists.cast(field.type))

    return run


def _splitting_task(pattern: str, chunks: Chunks):
    """Texts -> chunks, then (doc_id, key, k, last, chunk) -> the same with boundaries."""
    size, overlap = chunks.size, chunks.overlap

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            for row in batch.to_pylist():
                text = row["text"]
                count = (len(text) - 1) // size + 1
                for first in range(0, count, 64):
                    ks = range(first, min(first + 64, count))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["doc_id"]] * len(ks), pa.int64()),
                            pa.array([row["key"]] * len(ks), pa.string()),
                            pa.array(ks, pa.int32()),
                            pa.array([k == count - 1 for k in ks], pa.bool_()),
                            pa.array([text[k * size : (k + 1) * size + overlap] for k in ks]),
                        ],
                        ["doc_id", "key", "k", "last", "chunk"],
                    )

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in small_batches(batches, "chunk"):
            heads, tails = [], []
            for k, last, chunk in zip(
                batch.column("k").to_pylist(),
                batch.column("last").to_pylist(),
                batch.column("chunk").to_pylist(),
            ):
                found = boundaries(chunk, pattern, last)
                heads.append([k * size + b for b in found if b < overlap] if k else [0])
                tails.append([] if last else [k * size + b for b in found if b >= size])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)],
                [*batch.schema.names, "head", "tail"],
            )

    return cut, split


def _encoded(
    pieces: DataFrame, text: str, path: str, pattern: str, chunks: Chunks | None = None
) -> DataFrame:
    result = pieces.withColumn("ids", F.expr("cast(array() as array<int>)"))
    task = _encoding_task(
        path, pattern, pieces.columns.index(text), result.columns.index("ids"), chunks
    )
    return result.mapInArrow(task, result.schema)


def encoded(
    docs: DataFrame,
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
    chunks: Chunks = Chunks(),
) -> DataFrame:
    """``doc_id, ids`` per row of ``docs`` (doc_id, text), without special tokens.

    NULL and empty texts have no ids. Repeated rows are returned as often as they
    occur: equal rows whose chunks are spread are encoded once and repeated. Other
    columns are ignored. An empty table gives no rows. The ids of one document are
    one array; all else is per chunk.
    """
    size = chunks.size
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    near = rows.where(F.length("text") <= chunks.spread)
    whole = _encoded(near, "text", path, pattern, chunks).select("doc_id", "ids")

    cut, split = _splitting_task(pattern, chunks)
    found = (
        rows.where(F.length("text") > chunks.spread)
        .withColumn("key", F.sha2("text", 256))
        .mapInArrow(cut, "doc_id long, key string, k int, last boolean, chunk string")
        .groupBy("doc_id", "key", "k")
        .agg(
            F.first("last").alias("last"),
            F.first("chunk").alias("chunk"),
            F.count("k").alias("copies"),
        )
        .mapInArrow(
            split,
            "doc_id long, key string, k int, last boolean, chunk string, copies long, "
            "head array<int>, tail array<int>",
        )
    )
    order = Window.partitionBy("doc_id", "key").orderBy("k")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    # The first boundary a chunk shares with the one before it begins a piece. Chunks
    # after one that shares none are not known to be in step and join its piece.
    stitched = (
        found.withColumn("shared", F.when(F.col("k") == 0, 0).otherwise(shared))
        .withColumn("lost", F.max(F.col("shared").isNull()).over(order))
        .withColumn("begin", F.when(~F.col("lost"), F.col("shared")))
        .withColumn("piece", F.count("begin").over(order))
        .withColumn("next", F.lead("begin").over(order))
    )
    upto = (
        F.when(F.col("last"), F.lit(2**31 - 1))
        .when(F.col("next").isNull(), (F.col("k") + 1) * size)
        .otherwise(F.col("next"))
    )
    first, length = F.col("since") - F.col("k") * size + 1, upto - F.col("since")
    pieces = (
        stitched.withColumn("since", F.coalesce("begin", F.col("k") * size))
        .select(
            "doc_id",
            "key",
            "piece",
            "k",
            "copies",
            F.substring("chunk", first, length).alias("part"),
        )
        .groupBy("doc_id", "key", "piece")
        .agg(
            F.first("copies").alias("copies"),
            F.array_sort(F.collect_list(F.struct("k", "part"))).alias("parts"),
        )
        .select("doc_id", "key", "piece", "copies", F.array_join("parts.part", "").alias("text"))
    )
    joined = (
        _encoded(pieces, "text", path, pattern)
        .groupBy("doc_id", "key")
        .agg(
            F.first("copies").alias("copies"),
            F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"),
        )
        .select("doc_id", F.flatten("parts.ids").alias("ids"), "copies")
        .select("doc_id", "ids", F.explode(F.expr("sequence(1L, copies)")))
        .select("doc_id", "ids")
    )
    return whole.union(joined)


def _decoding_task(path: str, place: int, column: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {i: piece for piece, i in load_ranks(path).items()}.__getitem__
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = [i.values.to_numpy() if i.is_valid else () for i in batch.column(place)]
                made = [
                    [b"".join(map(table, values.tolist() if len(values) else ())) for values in ids],
                    [np.asarray(values, "<u4").tobytes() for values in ids],
                ]
                for offset, data in enumerate(made):
                    field = batch.schema.field(column + offset)
                    batch = batch.set_column(column + offset, field, pa.array(data, field.type))
                yield batch

    return run


def decoded(ids: DataFrame, path: str = RANKS) -> DataFrame:
    """``ids`` with two columns: ``bytes``, those of its ``ids`` column joined, and
    ``packed``, the ids as little-endian unsigned 32-bit integers.

    NULL and empty lists give no bytes; columns of these names are replaced; an id
    outside the vocabulary is an error.
    """
    plain = ids.drop("bytes", "packed")
    result = plain.withColumns({"bytes": F.lit(b""), "packed": F.lit(b"")})
    task = _decoding_task(path, plain.columns.index("ids"), len(plain.columns))
    return result.mapInArrow(task, result.schema)
