"""Automaton scores against probabilities worked out from counts of all n-grams."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from musterroll.llm.lm_scoring import Automaton, BackoffModel, Grams, packed, scored, unpacked

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain_scores(rows, settings):
    """n-gram tables of the training rows, then each token's probability by recursion."""
    texts = [(i, ["<begin>", *WORD.findall((t or "").translate(LOWER)), "<end>"]) for i, t in rows]
    counts = Counter()
    for i, words in texts:
        if not is_held_out(i):
            for n in range(1, settings.order + 1):
                counts.update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    single = {g[0]: c for g, c in counts.items() if len(g) == 1 and g[0] != "<begin>"}
    tokens, types = sum(single.values()), len(single)

    def chance(context, word):
        if not context:
            return (single.get(word, 0) + 1) / (tokens + types + 1)
        c = counts[context]
        shorter = chance(context[1:], word)
        return (counts[(*context, word)] + settings.prior * shorter) / (c + settings.prior)

    result = []
    for i, words in texts:
        score = sum(
            math.log10(chance(tuple(words[max(0, k - settings.order + 1) : k]), words[k]))
            for k in range(1, len(words))
        )
        base = sum(math.log10(chance((), w)) for w in words[1:])
        known = sum(w in single for w in words[1:])
        result.append((i, is_held_out(i), len(words) - 1, known, tokens, base, score))
    return result


def check(df, **settings):
    settings = BackoffModel(**settings)
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(map(tuple, scored(df, held_out(), settings).collect()), key=order)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = sorted(plain_scores(rows, settings), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return got


@pytest.mark.parametrize(
    "settings",
    [{}, {"order": 3, "prior": 2.0, "bucket_chars": 60_000, "range_chars": 30_000}, {"order": 1}],
)
def test_given_documents(documents, settings):
    got = check(documents, **settings)
    held = [r for r in got if r[1]]
    if settings.get("order") != 1:
        assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_odd_rows(odd, nothing):
    check(odd)
    check(odd, order=3, bucket_chars=20_000)
    assert check(nothing) == []


def test_without_training_texts(spark):
    held = [i for i in range(60) if is_held_out(i)]
    df = spark.createDataFrame([(i, "some words here") for i in held], "doc_id long, text string")
    assert {r[3:6] for r in check(df)} == {(0, 0, 0.0)}


def test_probabilities_add_up():
    """Every state's chances of all known tokens and of one unknown token are 1 together."""
    texts = [b"a b a b c", b"b a c c", b"", b"a b d z"]
    grams = Grams(texts, np.array([True, True, True, False]), 3)
    counts = [level.count for level in grams.levels]
    model = Automaton(grams, counts, 12, 4, 0.7)
    names = dict(zip(grams.levels[0].last.tolist(), range(len(counts[0]))))
    known = [t for t in names if t and counts[0][names[t]]]
    unknown = next(t for t in names if t > 1 and t not in known)
    # The context's n-gram of each state, and from it the arc of each token.
    context = {model.start: (1, names[0]), 0: (0, 0)}
    for n, level in enumerate(grams.levels[:-1], 1):
        for g in np.flatnonzero((counts[n - 1] > 0) & (level.last != 1)):
            arc = model.arcs[n - 1][g]
            if arc >= 0:
                context[model.target[arc]] = (n, g)

    def arcs(place, token):
        """Of the n-grams of each length that end with the token after this context."""
        found = [model.arcs[0][names[token]]]
        chain = []
        while place[0]:
            chain.append(place)
            level = grams.levels[place[0] - 1]
            place = (place[0] - 1, level.suffix[place[1]])
        for n, g in reversed(chain):
            longer = grams.levels[n]
            hit = np.flatnonzero((longer.prefix == g) & (longer.last == token))
            found.append(model.arcs[n][hit[0]] if len(hit) else -1)
        return found + [-1] * (3 - len(found))

    assert len(context) > 5
    for state, place in context.items():
        model.start = state
        chances = [10 ** model.score([arcs(place, t)]) for t in [*known, unknown]]
        assert sum(chances) == pytest.approx(1)


def test_packing():
    for values in ([], [0], [1 << 63, 5, 0], list(range(1000))):
        assert unpacked(packed(np.array(values, np.uint64))).tolist() == values
