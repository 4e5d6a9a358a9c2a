"""Text rules shared by every operator: comparison, identifiers, codes, names.

The roster's text comparisons ignore case and trailing blanks, so every equality
on text, join keys included, goes through ``fold``. A file's statistics know nothing of
folded text; beside each exact test stands a weaker one on plain beginnings, which
Spark hands to the file scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fold_text(value: str) -> str:
    return value.rstrip(" ").lower()


def fold(value: ColumnLike) -> Column:
    return F.lower(F.rtrim(_col(value)))


def distinct_folded(df: DataFrame, text: Iterable[str]) -> DataFrame:
    """Distinct rows, where spellings of ``text`` columns that fold alike are one value.

    The smallest spelling of each column is kept. Partial aggregation removes most
    repeats before the shuffle. The folded values are one key, an array, as sorting by
    very many keys takes long.
    """
    text = list(text)
    keys = [name for name in df.columns if name not in text]
    folded = F.array(*[fold(name) for name in text]).alias("_folded")
    kept = df.groupBy(*keys, folded).agg(*[F.min(name).alias(name) for name in text])
    return kept.select(*df.columns)


# Capital sigma has two lower cases, by what follows it.
UNSURE = "\u03c3\u03c2"


@lru_cache(maxsize=1)
def _capitals() -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for c in map(chr, range(0x80000)):
        if (lower := c.lower()) != c:
            found.setdefault(lower[0], []).append(c)
    return found


def spellings(character: str) -> list[str]:
    """All characters whose lower case begins with ``character``, itself lower case."""
    return [character, *_capitals().get(character, ())]


def leading_spellings(folded: str, most: int = 4) -> list[str]:
    """Beginnings of which every text has one that folds to something like ``folded``.

    As many of its first characters are spelt out as give ``most`` beginnings or fewer;
    none if the first one gives more or there is none.
    """
    found = [""]
    for character in folded:
        choices = spellings(character)
        if len(found) * len(choices) > most or character in UNSURE:
            break
        found = [begin + c for begin in found for c in choices]
        # A dotted capital I becomes two characters: what follows it is not known.
        if any(len(c.lower()) > 1 for c in choices):
            break
    return [] if found == [""] else found


def _begins_like(value: Column, folded: Iterable[str]) -> Column | None:
    """A test that is implied where ``value`` folds to, or begins like, one of ``folded``.

    It compares plain beginnings, which a file's statistics can answer; None if it
    would say nothing.
    """
    begins = [leading_spellings(text) for text in folded]
    if not begins or not all(begins):
        return None
    tests = [value.startswith(begin) for begin in sorted({b for bs in begins for b in bs})]
    return reduce(Column.__or__, tests)


def _with_implied(exact: Column, implied: Column | None) -> Column:
    return exact if implied is None else implied & exact


def _folded_eq(value: ColumnLike, literal: str) -> Column:
    return fold(value) == F.lit(fold_text(literal))


def ci_eq(value: ColumnLike, literal: str) -> Column:
    return _with_implied(_folded_eq(value, literal), _begins_like(_col(value), [fold_text(literal)]))


def ci_in(value: ColumnLike, literals: Iterable[str]) -> Column:
    folded = [fold_text(item) for item in literals]
    return _with_implied(fold(value).isin(folded), _begins_like(_col(value), folded))


def ci_prefix(value: ColumnLike, prefix: str) -> Column:
    exact = F.lower(_col(value)).startswith(prefix.lower())
    return _with_implied(exact, _begins_like(_col(value), [prefix.lower()]))


def recode(value: ColumnLike, codes: Mapping[str, str], other: str) -> Column:
    """Map known spellings to codes; NULL and everything else become ``other``."""
    result = None
    for spelling, code in codes.items():
        test = _folded_eq(value, spelling)
        result = F.when(test, code) if result is None else result.when(test, code)
    return F.lit(other) if result is None else result.otherwise(F.lit(other))


def day_text(value: ColumnLike) -> Column:
    return F.date_format(_col(value), "yyyyMMdd")


def strip_prefix(value: ColumnLike, prefix: str) -> Column:
    """Drop a leading ``prefix``.

    The length taken is the length without trailing blanks, counted from behind
    the prefix, so at most ``len(prefix)`` trailing blanks survive.
    """
    source = _col(value)
    rest = F.substring(source, F.lit(len(prefix) + 1), F.length(F.rtrim(source)))
    return F.when(ci_prefix(source, prefix), rest).otherwise(source)


def pad_code(value: ColumnLike, width: int = 10) -> Column:
    """Left-pad with zeros and keep the last ``width`` characters."""
    return F.right(F.concat(F.lit("0" * width), _col(value)), F.lit(width))


def normalize_code(value: ColumnLike, width: int = 10) -> Column:
    """Pad, then strip leading zeros where the result is a number.

    Blanks around a number do not count, as in text of a fixed width; other codes
    keep theirs.
    """
    padded = pad_code(value, width)
    number = F.trim(padded)
    bare = F.coalesce(F.nullif(F.ltrim(number, F.lit("0")), F.lit("")), F.lit("0"))
    return F.when(number.rlike("^[0-9]+$"), bare).otherwise(padded)


def joined_name(*parts: ColumnLike, sep: str = " ") -> Column:
    """Concatenate parts; NULL if any part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(_col(part))
    return F.concat(*pieces)
