"""Quality by compression with two dictionaries.

One zstandard dictionary is trained on texts labelled good, one on texts labelled bad.
A text is compressed with each; the difference of its two sizes over its length, with
the sizes themselves, is turned into a probability by logistic calibration on labelled
texts that neither dictionary has seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import small_batches


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample, in rows: ``per_label`` texts for each dictionary
    and ``calibration`` texts for the calibration, whole. Of the former, those are used,
    in order, that together have at most ``dictionary_texts`` bytes; a text that does not
    fit any more is passed over. ``ridge`` is the penalty on the calibration's weights."""

    per_label: int = 1_200
    calibration: int = 3_000
    dictionary_texts: int = 24 << 20
    dictionary: int = 112_640
    level: int = 3
    ridge: float = 1e-3


@dataclass
class Model:
    good: bytes
    bad: bytes
    level: int
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = (measures(texts, self.good, self.bad, self.level) - self.center) / self.scale
        z = self.weights[0] + (x * self.weights[1:]).sum(axis=1)
        # Rounded, so that a text's score does not depend on the batch it came in.
        return np.round(1 / (1 + np.exp(-np.clip(z, -40, 40))), 9)


_compressors: dict[tuple[int, int], zstandard.ZstdCompressor] = {}


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    key = (hash(dictionary), level)
    if key not in _compressors:
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=level)
        _compressors[key] = zstandard.ZstdCompressor(
            dict_data=data, write_content_size=False, write_dict_id=False
        )
    return _compressors[key]


def measures(texts: list[bytes], good: bytes, bad: bytes, level: int) -> np.ndarray:
    """The normalised size difference, the sizes and the length, with their squares.

    An empty text has zeros.
    """
    with_good, with_bad = _compressor(good, level), _compressor(bad, level)
    rows = np.zeros((len(texts), 9))
    for row, text in zip(rows, texts):
        if text:
            a, b = len(with_good.compress(text)), len(with_bad.compress(text))
            difference, size, length = (a - b) / len(text), min(a, b) / len(text), math.log(len(text))
            relative = (a - b) / (a + b)
            row[:] = (
                *(difference, difference**2, relative, relative**2),
                *(size, size**2, length, length**2, size * length),
            )
    return rows


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-9, *[ridge * len(x)] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (y - p) - penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, settings: Training = Training()) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Rows with a NULL id, text or label, and labels other than 0 and 1, are not used.
    The rows are those with the least hash of their doc_id, so the sample has one size
    for any table. Without texts of both labels fitting is an error.
    """
    keyed = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .select("doc_id", "quality", F.xxhash64(F.lit("dictionary"), "doc_id").alias("r"))
    )
    for_calibration = (
        keyed.where("pmod(r, 2) = 0").orderBy("r").limit(settings.calibration)
    ).withColumn("use", F.lit("calibration"))
    chosen = for_calibration
    for label in (0, 1):
        chosen = chosen.union(
            keyed.where(f"pmod(r, 2) = 1 and quality = {label}")
            .orderBy("r")
            .limit(settings.per_label)
            .withColumn("use", F.lit("dictionary"))
        )
    # At most calibration + 2 * per_label ids.
    sample = docs.select("doc_id", F.encode("text", "UTF-8").alias("text")).where(
        "text is not null and octet_length(text) > 0"
    ).join(F.broadcast(chosen), "doc_id")
    good, bad = (_dictionary(_texts(sample, label, settings), settings) for label in (1, 0))
    held = _measured(sample.where("use = 'calibration'"), good, bad, settings.level)
    if len(set(held[1])) < 2:  # too few to set some apart
        held = _measured(sample, good, bad, settings.level)
    x, y = held
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = calibrated((x - center) / scale, y, settings.ridge)
    return Model(good, bad, settings.level, center, scale, weights)


def _texts(sample: DataFrame, label: int, settings: Training) -> list[bytes]:
    """The whole texts a dictionary is trained on: their sizes first, then those that fit."""
    mine = sample.where((F.col("use") == "dictionary") & (F.col("quality") == label))
    sizes = mine.select("r", "doc_id", F.octet_length("text").alias("n")).collect()
    fitting, total = [], 0
    for row in sorted(sizes):
        if total + row.n <= settings.dictionary_texts:
            total += row.n
            fitting.append(row.doc_id)
    texts = mine.where(F.col("doc_id").isin(fitting)).select("r", "doc_id", "text").collect()
    if not texts:
        raise ValueError("training needs texts of both labels")
    return [bytes(row.text) for row in sorted(texts)]


def _measured(sample: DataFrame, good: bytes, bad: bytes, level: int):
    """Nine measures and the label of each whole text; the texts stay in the tasks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = measures(batch.column("text").to_pylist(), good, bad, level)
            yield pa.RecordBatch.from_arrays(
                [batch.column("r"), batch.column("quality"), pa.array(rows.tolist())],
                ["r", "quality", "x"],
            )

    found = sample.select("r", "quality", "text").mapInArrow(
        run, "r long, quality int, x array<double>"
    )
    rows = sorted((row.r, row.quality, row.x) for row in found.collect())
    return np.array([x for _, _, x in rows]), np.array([q for _, q, _ in rows], float)


def _dictionary(texts: list[bytes], settings: Training) -> bytes:
    """A trained dictionary; for a few small texts their own bytes."""
    try:
        return zstandard.train_dictionary(
            settings.dictionary, texts, level=settings.level
        ).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-settings.dictionary :]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` per row of ``docs`` (doc_id, text); NULL text counts as empty.

    A text is compressed whole. Equal texts have equal scores. Other columns are
    ignored; an empty table gives none. Rows are not shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = [(text.as_py() or "").encode() for text in batch.column("text")]
            scores = pa.array(shared.value.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double"
    )
