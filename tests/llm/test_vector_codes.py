"""Product codes against plain loops over all vectors and entries."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from musterroll.llm.vector_codes import ProductCodes, distances, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, settings=ProductCodes()):
    kept = []
    for i, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(settings.scale * float(np.float32(x))) for x in vector], label))
    if not kept:
        return Counter()
    width = len(kept[0][1]) // settings.parts
    cut = [[v[p * width : (p + 1) * width] for p in range(settings.parts)] for _, v, _ in kept]
    seeds = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    books = [[cut[r][p] for r in seeds[: settings.entries]] for p in range(settings.parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(settings.rounds):
        for p, book in enumerate(books):
            members = defaultdict(list)
            for parts in cut:
                members[nearest(parts[p], book)[1]].append(parts[p])
            for k, found in members.items():
                book[k] = [sum(x) // len(found) for x in zip(*found)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    result = []
    for (i, _, label), parts in zip(kept, cut):
        hits = [nearest(part, book) for part, book in zip(parts, books)]
        result.append((i, label, "".join(f"{k:02x}" for _, k in hits), sum(d for d, _ in hits)))
    totals = Counter()
    for _, label, _, error in result:
        totals[label] += error
    return Counter((i, code, error, totals[label], digest) for i, label, code, error in result)


def codes(df, settings=ProductCodes()):
    names = "vec_id", "code", "error", "label_error", "codebooks_sha256"
    return Counter(map(tuple, vector_codes(df, settings).select(*names).collect()))


def test_given_vectors(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert codes(df) == plain_codes([(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-0.5, 0.0, 0.25, 0.250001)) for _ in range(16)], i % 3) for i in range(90)]
    rows += [(5, rows[7][1], None), (5, rows[7][1], None), (None, rows[8][1], 1)] * 2
    rows += [(-1, None, 1), (-2, [0.1] * 15 + [None], 1), (-3, [0.1] * 15 + [float("nan")], 2)]
    rows += [(-4, [float("inf")] + [0.1] * 15, 2)] + [(200 + i, rows[9][1], 2) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.selectExpr("*", "'x' as ints", "'y' as code", "1 as error", "2 as `of`", "3 as n")
    assert codes(clash) == plain_codes(rows)


@pytest.mark.parametrize("length", [0, 8, 24])
def test_few_vectors(spark, length):
    rows = [(i, [i / 7 - 0.2] * length, None) for i in range(3)]
    assert codes(spark.createDataFrame(rows, SCHEMA)) == plain_codes(rows)
    assert codes(spark.createDataFrame(rows[:0], SCHEMA)) == Counter()
    assert codes(spark.createDataFrame([(1, None, 1)], SCHEMA)) == Counter()


def test_refused_vectors(spark):
    for rows in ([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], [(1, [0.5] * 9, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(ValueError):
            vector_codes(spark.createDataFrame(rows, SCHEMA))


def test_walk_gives_all_distances():
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-2, 3, (400, 6)), axis=0)
    entries = rng.integers(-3, 4, (5, 6))
    assert (distances(parts, entries) == ((parts[:, None] - entries) ** 2).sum(axis=2)).all()
    assert distances(parts[:0], entries).shape == (0, 5)
