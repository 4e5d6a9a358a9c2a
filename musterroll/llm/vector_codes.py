"""Vector code compression: product codes learnt by walking a trie of distinct parts.

Vectors of integers are cut into equal parts, and each part position has a codebook. The
distinct parts of a position, with their counts, lie in order, so they are a trie of their
components: parts that begin alike follow each other. A depth-first walk carries the
vector of accumulated squared distances to all entries and extends it once for each
component prefix; at a leaf the nearest entry is taken and the part is added to that
entry's sum with its count. Only these sums, as many as a codebook has components, leave
a task. Codes and errors of the vectors come from the same walk over each batch's parts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import stored


@dataclass(frozen=True)
class ProductCodes:
    """``scale`` makes integers of components; ``parts`` equal parts have ``entries``
    codebook entries each, moved ``rounds`` times."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6


def prepared(vectors: DataFrame, settings: ProductCodes, vector: str, label: str) -> DataFrame:
    """``vec_id, label, ints``: the rows whose vectors have only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & finite).select(
        "vec_id",
        F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * settings.scale)).alias("ints"),
    )


def checked_length(kept: DataFrame, settings: ProductCodes) -> int | None:
    """Components of a vector; None for an empty table. A table whose distances could
    leave 64-bit integers, or whose vectors cannot be cut alike, is refused."""
    found = kept.agg(
        F.min(F.size("ints")).alias("least"),
        F.max(F.size("ints")).alias("most"),
        F.max(F.array_max(F.transform("ints", F.abs))).alias("largest"),
    ).first()
    if found.least is None:
        return None
    if found.least != found.most or found.most % settings.parts:
        raise ValueError(
            f"vectors have {found.least} to {found.most} components;"
            f" one length that {settings.parts} divides is needed"
        )
    width = max(1, found.most // settings.parts)
    if (found.largest or 0) > math.isqrt(((1 << 63) - 1) // width) // 2:
        raise ValueError(f"a component is too large for parts of {width} components")
    return found.most


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of ``parts``, distinct rows in order, to ``entries``.

    A depth-first walk: a node is a run of parts with a common prefix and the distances
    accumulated over that prefix. A node's children are extended together; a child with
    one part left shares nothing more and is finished at once.
    """
    n, width = parts.shape
    result = np.zeros((n, len(entries)), np.int64)
    nodes = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []
    while nodes:
        start, end, depth, sums = nodes.pop()
        if depth == width:
            result[start:end] = sums
            continue
        values = parts[start:end, depth]
        first = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1]
        size = np.diff(np.r_[first, len(values)])
        below = sums + (values[first, None] - entries[None, :, depth]) ** 2
        alone = size == 1
        leaves = start + first[alone]
        rest = parts[leaves, None, depth + 1 :] - entries[None, :, depth + 1 :]
        result[leaves] = below[alone] + (rest**2).sum(axis=2)
        for at in np.flatnonzero(~alone)[::-1]:
            low = start + first[at]
            nodes.append((low, low + size[at], depth + 1, below[at]))
    return result


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _sums_task(codebooks: list[np.ndarray], width: int):
    """Distinct parts (position, part, n) in order -> per entry and component: parts, total."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(codebooks), len(codebooks[0])), np.int64)
        totals = np.zeros((*counts.shape, width), np.int64)
        for batch in batches:
            position = batch.column("position").to_numpy()
            parts, weight = _matrix(batch.column("part"), width), batch.column("n").to_numpy()
            for p in np.unique(position):
                mine = position == p
                nearest = distances(parts[mine], codebooks[p]).argmin(axis=1)
                np.add.at(counts[p], nearest, weight[mine])
                np.add.at(totals[p], nearest, weight[mine, None] * parts[mine])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(p, width), pa.int32()),
                pa.array(np.repeat(e, width), pa.int32()),
                pa.array(np.tile(np.arange(width), len(p)), pa.int32()),
                pa.array(np.repeat(counts[p, e], width)),
                pa.array(totals[p, e].ravel()),
            ],
            ["position", "entry", "place", "n", "total"],
        )

    return run


def _codes_task(codebooks: list[np.ndarray], width: int):
    """Vectors -> their codes, errors and nothing else of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(codebooks)), np.int64)
            error = np.zeros(batch.num_rows, np.int64)
            for p, entries in enumerate(codebooks if width else ()):
                vectors = _matrix(batch.column("ints"), width * len(codebooks))
                parts = vectors[:, p * width : (p + 1) * width]
                distinct, place = np.unique(parts, axis=0, return_inverse=True)
                found = distances(distinct, entries)
                codes[:, p] = found.argmin(axis=1)[place.ravel()]
                error += found.min(axis=1)[place.ravel()]
            texts = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(texts, pa.string()),
                    pa.array(error),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return run


def fit(kept: DataFrame, length: int, settings: ProductCodes) -> list[np.ndarray]:
    """The codebooks: one array (entries, components) for each part position.

    They begin with the parts of the vectors with the smallest vec_ids (NULL last, ties
    by components). Only codebooks and their sums are on the driver.
    """
    width = length // settings.parts
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(settings.entries)
    seeds = np.array([row.ints for row in first.select("ints").collect()], np.int64)
    codebooks = list(seeds.reshape(len(seeds), settings.parts, width).transpose(1, 0, 2))
    if not width:
        return codebooks
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(settings.parts - 1)),
        lambda p: F.slice("ints", p * width + 1, width),
    )
    distinct = (
        kept.select(F.posexplode(cut).alias("position", "part"))
        .groupBy("position", "part")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # In order over all tasks: a task holds whole subtrees, but for those at its ends.
    trie = stored(
        distinct.repartitionByRange("position", "part").sortWithinPartitions("position", "part")
    )
    for _ in range(settings.rounds):
        sums = trie.mapInArrow(
            _sums_task(codebooks, width), "position int, entry int, place int, n long, total long"
        )
        means = sums.groupBy("position", "entry", "place").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
        )
        codebooks = [book.copy() for book in codebooks]
        for row in means.collect():  # as many rows as the codebooks have components
            codebooks[row.position][row.entry, row.place] = int(row.total) // row.n
    return codebooks


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, in decimal, comma-joined."""
    numbers = (str(x) for book in codebooks for x in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    settings: ProductCodes = ProductCodes(),
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` per kept row.

    Rows whose vector is NULL or holds a NULL or a component that is not finite are
    dropped. ``code`` has two hex digits for each part; ``error`` is the squared distance
    to the entries, ``label_error`` its sum over the rows of a label (NULL is one).
    Nearest entries tie towards the lower index; an entry without parts stays. Fewer
    vectors than entries make shorter codebooks; repeated rows and vec_ids count one by
    one and a NULL vec_id comes last; vectors without components have error 0; other
    columns are ignored; an empty table, or one without a kept row, gives none. Vectors
    of several lengths, or of a length that does not divide, are refused.
    """
    kept = prepared(vectors, settings, vector, label)
    length = checked_length(kept, settings)
    kinds = dict(kept.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    if length is None:
        coded, digest = kept.sparkSession.createDataFrame([], schema), None
    else:
        codebooks = fit(kept, length, settings)
        digest = codebooks_digest(codebooks)
        task = _codes_task(codebooks, length // settings.parts)
        coded = stored(kept.mapInArrow(task, schema))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.withColumnRenamed("label", "of")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "label", "code", "error", "label_error",
        F.lit(digest).cast("string").alias("codebooks_sha256"),
    )
