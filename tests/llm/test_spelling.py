"""Spelling variants against a comparison of all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from musterroll.llm.spelling import Spelling, near_pairs, spelling_forms

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, least=7, count=2):
    found = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(words, ratio=10):
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v)) for w, x in near.items() if x}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    rows = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return rows


def forms(df, **settings):
    rows = spelling_forms(df, Spelling(**settings)).select(
        "word", "form", "root", "n", "n_near", "form_n"
    ).collect()
    assert len(rows) == len({r.word for r in rows})
    return set(map(tuple, rows))


@pytest.mark.parametrize("symbols", [2, 8])
def test_given_documents(documents, texts, symbols):
    assert forms(documents, symbols=symbols) == plain_forms(plain_words(texts.items()))


def test_chains_ties_and_accents(spark):
    """Forms that lead on, equal counts, letters outside ASCII, other scripts between."""
    counts = {
        "wordsmith": 900, "wordsmit": 50, "wordsmi": 3,
        "königreich": 40, "konigreich": 4, "königreiche": 40, "Àccented": 2, "àccented": 20,
        "letterab": 2, "letteraa": 30, "letterac": 30, "×÷symbol": 2, "plain漢字simple": 3,
    }
    rows = [(10_000 + i, w) for i, w in enumerate(w for w, n in counts.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = plain_words(rows)
    got = forms(df)
    assert got == plain_forms(words)
    assert {r[2] for r in got if r[0] == "wordsmi"} == {"wordsmith"}
    assert {r[1] for r in got if r[0] == "letterab"} <= {"letteraa", "letterac"}


def test_each_pair_is_compared_once(spark):
    """Many words behind one reduced string, and every pair of them is given once."""
    words = ["aaaa" + a + b + c for a in "aiqy" for b in "aiqy" for c in "aiq"]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = near_pairs(df, Spelling()).collect()
    want = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    assert len(pairs) == len(want)
    assert {tuple(sorted((r.a, r.b))) for r in pairs} == want


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert forms(odd) == plain_forms(plain_words(rows))
    assert forms(nothing) == set()
