"""Language-model scores from a weighted backoff automaton.

States are the contexts that occur in training texts, the empty one among them. A state
has an arc for each token seen after its context, with the smoothed log probability, and
a failure arc to the state of the context without its first token, with the log of the
backoff weight. One walk over a text from left to right carries the state: it follows the
arc of the next token, or failure arcs until there is one, and adds up what it passes.

Probabilities are smoothed towards the shorter context as by a Dirichlet prior,
p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m), down to (c(w) + 1) / (N + V + 1); what an
unseen token gets, m / (c(h) + m) of the shorter context's, is the weight of the failure
arc, so each state's probabilities add up to one.

The model grows with the corpus, so no task and not the driver holds it. Documents are
dealt to buckets; a bucket asks for the counts of the n-grams in its own texts and builds
the part of the automaton that its texts can reach. Questions travel packed, by ranges of
hashes and once per bucket, however often a bucket has an n-gram; answers are counts in
the order of the questions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, END = 0, 1
ROOT = 0


@dataclass(frozen=True)
class BackoffModel:
    """``order``: tokens of the longest n-gram. ``prior``: what the shorter context
    counts as, in occurrences. ``bucket_chars`` and ``range_chars``: text whose n-grams
    one task holds when it scores and when it counts; they bound memory, not results, and
    should grow with the executors: questions are as many rows as buckets times ranges."""

    order: int = 2
    prior: float = 64.0
    bucket_chars: int = 8 << 20
    range_chars: int = 8 << 20


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass
class Level:
    """The distinct n-grams of one length in a bucket, in the order of their hashes:
    hash, last token, number of the n-gram without its last and without its first token,
    occurrences in training texts."""

    hashes: np.ndarray
    last: np.ndarray
    prefix: np.ndarray
    suffix: np.ndarray
    count: np.ndarray


class Numbers(dict):
    """word -> its number in the bucket, from 2 on."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 2
        return number


class Grams:
    """A bucket's texts as token numbers, and their n-grams.

    ``tokens`` is all texts one after the other, each begun by BEGIN and closed by END;
    ``starts`` has the place of each BEGIN, which an n-gram may hold as its first token.
    ``at`` has, for each level, the number of the n-gram that ends at each place, or -1.
    """

    def __init__(self, texts: list[bytes | None], training: np.ndarray, order: int):
        numbers = Numbers()
        pieces, starts, size = [], [], 0
        for text in texts:
            words = (text or b"").lower().split()  # of bytes: A-Z and these six blanks only
            known = map(numbers.__getitem__, words)
            pieces.append(np.fromiter(chain((BEGIN,), known, (END,)), np.int64, len(words) + 2))
            starts.append(size)
            size += len(words) + 2
        self.tokens = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        self.starts = np.array(starts, np.int64)
        names = [b" ", b"\n", *numbers]  # no word holds a blank
        self.names = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
        lengths = np.diff(np.r_[self.starts, size])
        place = np.arange(size) - np.repeat(self.starts, lengths)
        self.at: list[np.ndarray] = []
        self.levels = list(self._levels(order, np.repeat(training, lengths), place))

    def _levels(self, order: int, learnt: np.ndarray, place: np.ndarray) -> Iterator[Level]:
        """n-grams are numbered by their hashes, which come from the one before's."""
        words = _mixed(self.names)
        by_hash = np.argsort(words)
        number = np.empty(len(words), np.int64)
        number[by_hash] = np.arange(len(words))
        at, hashes = number[self.tokens], words[self.tokens]
        none = np.zeros(len(words), np.int64)
        count = np.bincount(at[learnt], minlength=len(words))
        self.at.append(at)
        yield Level(words[by_hash], by_hash, none, none, count)
        for n in range(2, order + 1):
            before, hashes = np.r_[0, at[:-1]], np.r_[hashes[:1], hashes[:-1]]
            with np.errstate(over="ignore"):
                hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + self.names[self.tokens])
            inside = np.flatnonzero(place >= n - 1)
            by_hash = inside[np.argsort(hashes[inside])]
            distinct = hashes[by_hash]
            new = np.r_[True, distinct[1:] != distinct[:-1]][: len(distinct)]
            here = np.full(len(at), -1)
            here[by_hash] = np.cumsum(new) - 1
            first = by_hash[new]
            count = np.bincount(here[inside][learnt[inside]], minlength=len(first))
            yield Level(distinct[new], self.tokens[first], before[first], at[first], count)
            self.at.append(here)
            at = here


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, compressed by the place of their bytes."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def _cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of hashes begins in ``hashes``, which are in order."""
    part = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))


QUESTIONS = "bucket int, part int, level int, hashes binary, counts binary"
ANSWERS = "bucket int, part int, level int, counts binary, tokens long, types long"


def _questions_task(settings: BackoffModel, ranges: int):
    """(bucket, text, training) of a whole bucket -> its n-grams with their counts in its
    training texts, a row for each range and length."""

    def run(table: pa.Table) -> pa.Table:
        grams = _grams(table, settings)
        rows = [[], [], [], []]
        for n, level in enumerate(grams.levels, 1):
            cuts = _cuts(level.hashes, ranges)
            for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                steps = np.diff(np.r_[np.uint64(0), level.hashes[a:b]])
                row = part, n, packed(steps), packed(level.count[a:b])
                for column, value in zip(rows, row):
                    column.append(value)
        bucket = [table.column("bucket")[0].as_py()] * len(rows[0])
        kinds = pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
        return pa.table(
            [pa.array(x, kind) for x, kind in zip([bucket, *rows], kinds)],
            names=["bucket", "part", "level", "hashes", "counts"],
        )

    return run


def _answers_task(table: pa.Table) -> pa.Table:
    """A range of hashes of one length -> for each bucket the counts over all buckets.

    Each answer also has the range's training tokens and distinct ones among them, which
    add up to those of the corpus in every bucket, as every bucket asks in every range.
    """
    hashes = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in table.column("hashes")]
    counts = [unpacked(x.as_py()) for x in table.column("counts")]
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, place, np.concatenate(counts))
    answers = np.split(total[place], np.cumsum([len(h) for h in hashes])[:-1])
    known = np.full(table.num_rows, np.count_nonzero(total))
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "part": table.column("part"),
            "level": table.column("level"),
            "counts": pa.array([packed(x) for x in answers], pa.binary()),
            "tokens": pa.array(np.full(table.num_rows, int(total.sum())), pa.int64()),
            "types": pa.array(known, pa.int64()),
        }
    )


def _grams(table: pa.Table, settings: BackoffModel) -> Grams:
    training = table.column("training").to_numpy(zero_copy_only=False).astype(bool)
    return Grams(table.column("text").cast(pa.binary()).to_pylist(), training, settings.order)


class Automaton:
    """States, arcs and failure arcs that a bucket's texts can reach.

    ``counts`` has the corpus counts of the n-grams of each level. An n-gram that
    occurs in training is an arc, from the state of its context with its last token.
    Arcs are numbered level by level; ``arcs`` has the number of each n-gram, or -1, so
    that the arc of the next token is found by the n-gram that ends there.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, types: int, prior: float):
        self.arcs: list[np.ndarray] = []
        self.weight: list[float] = []
        self.target: list[int] = []
        # Of each state: weight and target of its failure arc, tokens of its context.
        self.back, self.fail, self.depth = [0.0], [ROOT], [0]
        # Of the n-grams one shorter: count, probability, and their state or, if they are
        # none, that of the longest context they end in.
        held, chance, state = np.array([tokens]), np.ones(1), np.array([ROOT])
        for n, (level, count) in enumerate(zip(grams.levels, counts), 1):
            if n == 1:
                chance = (count + 1) / (tokens + types + 1)
                seen = level.last != BEGIN  # the empty context has an arc for any token
            else:
                context = held[level.prefix]
                chance = (count + prior * chance[level.suffix]) / (context + prior)
                seen = count > 0
            shorter = state[level.suffix]
            # A text's end is no context, nor are the longest n-grams.
            longer = (count > 0) & (level.last != END) & (n < len(grams.levels))
            state = np.where(longer, len(self.back) - 1 + np.cumsum(longer), shorter)
            self.back += np.log10(prior / (count[longer] + prior)).tolist()
            self.fail += shorter[longer].tolist()
            self.depth += [n] * int(longer.sum())
            self.arcs.append(np.where(seen, len(self.weight) - 1 + np.cumsum(seen), -1))
            self.weight += np.log10(chance[seen]).tolist()
            self.target += state[seen].tolist()
            if n == 1:
                self.start = int(state[np.flatnonzero(level.last == BEGIN)[0]])
            held = count

    def score(self, tokens: list[list[int]]) -> float:
        """Log10 probability of a text, in one walk from left to right.

        ``tokens`` has, for each token, the arcs of the n-grams of each length that end
        with it, or -1: the one of the state's context and the token is what it is after.
        """
        weight, target, back = self.weight, self.target, self.back
        fail, depth = self.fail, self.depth
        state, total = self.start, 0.0
        for arcs in tokens:
            arc = arcs[depth[state]]
            while arc < 0:
                total += back[state]
                state = fail[state]
                arc = arcs[depth[state]]
            total += weight[arc]
            state = target[arc]
        return total

    def scores(self, grams: Grams) -> list[float]:
        ends = np.r_[grams.starts[1:], len(grams.tokens)]
        result = []
        for start, end in zip(grams.starts + 1, ends):
            found = []
            for arcs, at in zip(self.arcs, grams.at):
                here = at[start:end]
                found.append(np.where(here >= 0, arcs[here], -1) if len(arcs) else here)
            result.append(self.score(np.stack(found, axis=1).tolist()))
        return result


SCORES = (
    "doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def _scores_task(settings: BackoffModel):
    """A bucket's documents and the answers to it -> their scores."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        grams = _grams(docs, settings)
        answers = answers.sort_by([("level", "ascending"), ("part", "ascending")])
        level = answers.column("level").to_numpy()
        data = answers.column("counts").to_pylist()
        counts = [
            np.concatenate([unpacked(data[i]) for i in np.flatnonzero(level == n)]).astype(np.int64)
            for n in range(1, settings.order + 1)
        ]
        first = grams.levels[0]
        # Beginnings are counted as contexts and are no tokens.
        ours = level == 1
        begins = int(counts[0][first.last == BEGIN].sum())
        tokens = int(answers.column("tokens").to_numpy()[ours].sum()) - begins
        types = int(answers.column("types").to_numpy()[ours].sum()) - (begins > 0)
        count = np.zeros(len(first.last), np.int64)
        count[first.last] = counts[0]
        base = np.log10((count + 1) / (tokens + types + 1))
        automaton = Automaton(grams, counts, tokens, types, settings.prior)
        texts = [
            grams.tokens[a + 1 : b]
            for a, b in zip(grams.starts, np.r_[grams.starts[1:], len(grams.tokens)])
        ]
        columns = [
            pa.array([len(text) for text in texts], pa.int64()),
            pa.array([np.count_nonzero(count[text]) for text in texts], pa.int64()),
            pa.array([tokens] * len(texts), pa.int64()),
            pa.array([math.fsum(base[text].tolist()) for text in texts], pa.float64()),
            pa.array(automaton.scores(grams), pa.float64()),
        ]
        training = docs.column("training").to_numpy(zero_copy_only=False).astype(bool)
        return pa.table(
            [docs.column("doc_id"), pa.array(~training), *columns], names=names
        )

    return run


def scored(
    docs: DataFrame, held_out: F.Column, settings: BackoffModel = BackoffModel()
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of
    ``docs`` (doc_id, text).

    Tokens are words with A-Z lower-cased, then one end. All texts are scored whole; the
    model learns from those that ``held_out`` (NULL: false) does not name. ``base_score``
    is the log10 probability by tokens alone, with one added to each count, ``score`` the
    automaton's; ``n_known`` tokens occur in training. NULL and empty texts are an end
    alone; repeated rows are learnt from and scored one by one; without training texts all
    tokens are unknown; other columns are ignored; an empty table gives none. n-grams are
    known by 64-bit hashes.
    """
    rows = docs.select(
        "doc_id",
        F.col("text").cast("string"),
        (~F.coalesce(held_out, F.lit(False))).alias("training"),
    )
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // settings.bucket_chars))
    ranges = max(1, -(-chars * settings.order // (2 * settings.range_chars)))
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")
    # Counting and scoring read this one exchange.
    dealt = rows.withColumn("bucket", bucket).repartition(buckets, "bucket")
    questions = dealt.groupBy("bucket").applyInArrow(_questions_task(settings, ranges), QUESTIONS)
    answers = questions.groupBy("part", "level").applyInArrow(_answers_task, ANSWERS)
    return (
        dealt.groupBy("bucket")
        .cogroup(answers.groupBy("bucket"))
        .applyInArrow(_scores_task(settings), SCORES.format(kind=dict(rows.dtypes)["doc_id"]))
    )
