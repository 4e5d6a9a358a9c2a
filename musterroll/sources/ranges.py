"""Ranges of a remote table's key with about as many rows each.

Equal steps of a key are equal work only if its values lie evenly. The planner asks the
database for counts of rows in bins of the key, looks closer into bins that hold too many,
and cuts where a share of the rows is full. Counts come back, never rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import Any

NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")

Ask = Callable[[str], Sequence[Sequence[Any]]]


def _binned(ask: Ask, table: str, column: str, low: int, high: int, bins: int):
    """(first key, width, rows) of the bins with rows in low..high, in order."""
    width = -(-(high - low + 1) // bins)
    # Not all databases divide whole numbers alike: what is left over is taken off first.
    away = f"({column} - ({low}))"
    bin_ = f"({away} - MOD({away}, {width})) / {width}" if width > 1 else away
    rows = ask(
        f"SELECT {bin_} AS bin, COUNT(*) AS n FROM {table}"
        f" WHERE {column} >= {low} AND {column} <= {high} GROUP BY {bin_}"
    )
    return [(low + int(b) * width, width, int(n)) for b, n in sorted((int(b), n) for b, n in rows)]


def cut_points(ask: Ask, table: str, column: str, parts: int, bins: int = 256) -> list[int]:
    """Keys at which a new range begins, ascending: at most ``parts`` - 1 or a few more.

    A range has no more than about twice the rows of an even share, but for a key that
    holds more by itself, which is a range of its own. Bins with more than half a share,
    fewer than twice ``parts``, are asked for again in narrower bins until a bin is one key.
    """
    low, high, known = ask(
        f"SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT({column}) AS n FROM {table}"
    )[0]
    if not known or low == high:
        return []
    share = max(1, known // parts)
    open_bins, counted = [(int(low), int(high))], []
    while open_bins:
        first, last = open_bins.pop()
        for start, width, n in _binned(ask, table, column, first, last, bins):
            end = min(start + width - 1, last)
            if 2 * n > share and end > start:
                open_bins.append((start, end))
            else:
                counted.append((start, n))
    cuts, rows = [], 0
    for start, n in sorted(counted):
        if rows and rows + n > share:
            cuts.append(start)
            rows = 0
        rows += n
    return cuts


def predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """One condition a range; every row, also without a key, meets exactly one."""
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def planned(ask: Ask, table: str, column: str, parts: int) -> list[str]:
    """The conditions under which ``parts`` tasks or so read ``table`` by ``column``, a
    whole number."""
    if not NAME.fullmatch(column):
        raise ValueError(f"not a column name: {column}")
    if parts < 1:
        raise ValueError("parts must be 1 or more")
    return predicates(column, cut_points(ask, table, column, parts))
