"""Unigram token counts by dynamic programming shared through a trie.

The best split of a pre-token into pieces is found left to right: the best score of a
prefix needs only its own shorter prefixes, so pre-tokens with a common beginning share
those scores. Distinct pre-tokens are put into a trie of bytes; each node keeps the
forward score and count of its prefix, worked out once; a pre-token's count is stored
when its end is reached.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.bpe import RANKS, load_ranks
from musterroll.llm.corpus import small_batches


@dataclass(frozen=True)
class Unigram:
    """The vocabulary is a rank file; a piece's log probability follows its rank by
    Zipf's law, in millionths, so that sums are exact. Bytes outside the vocabulary
    are pieces of score ``unknown``. ``most_nodes`` and ``depth`` bound the trie's
    memory, not the results: beyond ``depth`` bytes a prefix is scored, not kept."""

    path: str = RANKS
    pattern: str = public_tokenizers.PATTERN
    unknown: int = -30_000_000
    most_nodes: int = 1_000_000
    depth: int = 128


@lru_cache(maxsize=4)
def piece_scores(path: str) -> dict[bytes, int]:
    ranks = load_ranks(path)
    total = sum(1 / (rank + 2) for rank in ranks.values())
    return {
        piece: round(-1e6 * (math.log(rank + 2) + math.log(total))) for piece, rank in ranks.items()
    }


PIECES = 1 << 32


def unpacked(value: int) -> tuple[int, int]:
    """Score and number of pieces of ``score * PIECES - pieces``; such numbers compare
    by score, then by fewer pieces, and add up."""
    pieces = -value % PIECES
    return (value + pieces) // PIECES, pieces


class Trie(dict):
    """pre-token -> packed score and count, from the forward scores of its prefixes.

    A node of the trie is a prefix; ``forward`` has its best score. Ties go to fewer
    pieces. All is forgotten when there are ``most_nodes`` prefixes.
    """

    def __init__(self, settings: Unigram):
        self.settings = settings
        scores = piece_scores(settings.path)
        self.scores = {piece: score * PIECES - 1 for piece, score in scores.items()}
        self.unknown = settings.unknown * PIECES - 1
        self.longest = max(map(len, scores), default=1)
        self.child: dict[int, int] = {}
        self.forward = [0]

    def __missing__(self, token: str) -> int:
        if len(self.forward) > self.settings.most_nodes:
            self.clear()
            self.child.clear()
            self.forward = [0]
        self[token] = value = self._insert(token.encode())
        return value

    def _insert(self, word: bytes) -> int:
        child, forward, depth = self.child, self.forward, self.settings.depth
        node, path = 0, [0]
        for end, byte in enumerate(word, 1):
            if end > depth:
                path.append(self._best(word, end, path))
                continue
            edge = node << 8 | byte
            node = child.get(edge)
            if node is None:
                node = child[edge] = len(forward)
                forward.append(self._best(word, end, path))
            path.append(forward[node])
        return path[-1]

    def _best(self, word: bytes, end: int, path: list[int]) -> int:
        get = self.scores.get
        best = path[end - 1] + get(word[end - 1 : end], self.unknown)
        for start in range(max(0, end - self.longest), end - 1):
            more = get(word[start:end])
            if more is not None and path[start] + more > best:
                best = path[start] + more
        return best


def token_counts(docs: DataFrame, settings: Unigram = Unigram()) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens, score`` per row of ``docs`` (doc_id, text).

    ``score`` is the log probability of the best split, in millionths. NULL and empty
    texts count 0; repeated rows are counted one by one; texts are taken whole; other
    columns are ignored; an empty table gives none. Rows are not shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, split = Trie(settings), regex.compile(settings.pattern)
        for batch in small_batches(batches, "text"):
            rows: list[list[int]] = [[], [], []]
            for text in batch.column("text"):
                tokens = split.findall(text.as_py() or "")
                score, pieces = unpacked(sum(map(trie.__getitem__, tokens)))
                for row, value in zip(rows, (len(tokens), pieces, score)):
                    row.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(r, pa.int64()) for r in rows)],
                ["doc_id", "n_pretokens", "n_tokens", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_pretokens long, n_tokens long, score long"
    )
