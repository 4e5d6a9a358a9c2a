"""Secret scans through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived (what a
match must contain). Each block of documents is indexed once: postings of the
documents that hold a trigram, for the trigrams the queries use. Intersecting and
uniting postings leaves the candidates of a rule, which its expression then verifies
on their whole texts. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

# Python's own parser of regular expressions.
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from musterroll.llm.corpus import small_batches

# A query is None (always true), a trigram, or ("and" | "or", parts).
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The base rules, in the order of their kinds.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
# Further well-known shapes; they add spans and never take one away.
MORE_RULES = (
    Rule(
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*"
        r"(?:-----END [A-Z ]*PRIVATE KEY-----)?",
    ),
    Rule("code_host", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@"),
)
RULES = BASE_RULES + MORE_RULES


def _grams(text: str):
    return _and([text[i : i + 3] for i in range(len(text) - 2)])


def _and(parts: list):
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _or(parts: list):
    if any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _strings(texts: list[str]):
    """The query for texts of which one must occur."""
    return _or([_grams(text) for text in texts]) if texts else None


def trigram_query(pattern: str):
    """What every match of ``pattern`` contains, in lower-case trigrams.

    Runs of items with few possible strings are joined before they are cut into
    trigrams; anything else ends a run and adds its own query.
    """

    def sequence(items) -> tuple[list[str] | None, object]:
        """All strings an item sequence matches (if few), else its query."""
        run, parts, whole = [""], [], True
        for op, value in items:
            strings, query = item(op, value)
            if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
                run = [a + b for a, b in product(run, strings)]
                continue
            parts += [_strings(run), query if strings is None else None]
            run, whole = (strings if strings is not None else [""]), False
        return (run, None) if whole else (None, _and([*parts, _strings(run)]))

    def item(op, value) -> tuple[list[str] | None, object]:
        if op is sre.LITERAL:
            return [chr(value).lower()], None
        if op is sre.IN:
            chars = []
            for kind, what in value:
                if kind is sre.LITERAL:
                    chars.append(chr(what).lower())
                elif kind is sre.RANGE and what[1] - what[0] < 4:
                    chars += [chr(c).lower() for c in range(what[0], what[1] + 1)]
                else:
                    return None, None
            return (sorted(set(chars)), None) if len(set(chars)) <= 8 else (None, None)
        if op is sre.SUBPATTERN:
            return sequence(value[3])
        if op is sre.BRANCH:
            found = [sequence(branch) for branch in value[1]]
            if all(s is not None for s, _ in found) and sum(len(s) for s, _ in found) <= MOST_STRINGS:
                return [text for s, _ in found for text in s], None
            return None, _or([q if s is None else _strings(s) for s, q in found])
        if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = value
            strings, query = sequence(inner)
            if (least, most) == (0, 1) and strings is not None:
                return ["", *strings], None
            if least == 0:
                return None, None
            if strings is not None and least == most and len(strings) ** least <= MOST_STRINGS:
                return ["".join(p) for p in product(strings, repeat=least)], None
            return None, query if strings is None else _strings(strings)
        if op is sre.AT:
            return [""], None
        return None, None

    strings, query = sequence(sre_parse.parse(pattern))
    return query if strings is None else _strings(strings)


def grams_in(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(grams_in, query[1]))


class Block:
    """Postings of a block of texts for some trigrams of ASCII characters."""

    def __init__(self, texts: list[str], codes: np.ndarray):
        data = [text.encode().lower() for text in texts]
        ends = np.cumsum([len(d) + 2 for d in data])
        raw = np.frombuffer(b"\0\0".join(data) + b"\0\0", np.uint8)
        wanted = np.zeros(1 << 21, bool)
        wanted[codes] = True
        self.size, self.postings = len(texts), {}
        places: list[np.ndarray] = []
        grams: list[np.ndarray] = []
        for at in range(0, len(raw) - 2, 1 << 20):  # bounds memory; the parts overlap
            part = raw[at : at + (1 << 20) + 2].astype(np.uint32)
            code = (part[:-2] << 14) | (part[1:-1] << 7) | part[2:]
            ascii_only = (part[:-2] | part[1:-1] | part[2:]) < 128
            hit = np.flatnonzero(wanted[np.where(ascii_only, code, 0)])
            places.append(hit + at)
            grams.append(code[hit])
        if places:
            owner = np.searchsorted(ends, np.concatenate(places), side="right")
            key = np.unique(np.concatenate(grams).astype(np.int64) * self.size + owner)
            gram, owner = key // self.size, key % self.size
            cuts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(key) else []
            for a, b in zip(cuts, [*cuts[1:], len(key)] if len(key) else []):
                self.postings[int(gram[a])] = owner[a:b]

    def candidates(self, query) -> np.ndarray:
        if query is None:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings.get(gram_code(query), np.zeros(0, np.int64))
        parts = [self.candidates(part) for part in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        found = parts[0]
        for part in parts[1:]:
            found = np.intersect1d(found, part, assume_unique=True)
        return found


def gram_code(gram: str) -> int:
    a, b, c = gram.encode("ascii")
    return a << 14 | b << 7 | c


def scan(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """Per text (start, rule's place, end) of its spans, in order, in code points."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    # Lower-cased ASCII; a query with other characters is not used.
    queries = [q if all(g.isascii() for g in grams_in(q)) else None for q in queries]
    codes = np.array(sorted({gram_code(g) for q in queries for g in grams_in(q)}), np.int64)
    block = Block(texts, codes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for place, (rule, query) in enumerate(zip(rules, queries)):
        search = _search(rule)
        for at in block.candidates(query):
            for start, end in search(texts[at]):
                found[at].append((start, place, end))
    return [sorted(spans) for spans in found]


def _search(rule: Rule):
    """Leftmost non-overlapping matches of a rule, without those that are too short."""
    runs = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    if runs and rule.group == 0 and not rule.ignore_case:
        # Matches of one repeated class are the runs of it: ask for the length at once.
        pattern = re.compile(f"{runs[1]}{{{rule.least},}}", re.ASCII)
        return lambda text: (m.span() for m in pattern.finditer(text))
    pattern = rule.compiled()
    return lambda text: (
        m.span()
        for m in pattern.finditer(text)
        if m.end(rule.group) - m.start(rule.group) >= rule.least
    )


SPANS = "array<struct<kind:string,start:int,end:int>>"
def _scanning(rules: tuple[Rule, ...], place: int, column: int, masked: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each of these batches is a block with an index of its own.
        for batch in small_batches(batches, place):
            texts = batch.column(place).to_pylist()
            spans = scan([text or "" for text in texts], rules)
            if masked:
                texts = [
                    mask(text, found, rules) if found else text
                    for text, found in zip(texts, spans)
                ]
                field = batch.schema.field(place)
                batch = batch.set_column(place, field, pa.array(texts, field.type))
            rows = [
                [{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in found]
                for found in spans
            ]
            field = batch.schema.field(column)
            yield batch.set_column(column, field, pa.array(rows, field.type))

    return run


def mask(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...] = RULES) -> str:
    """``text`` with each stretch of overlapping spans replaced by its first kind."""
    parts, done = [], 0
    for start, rule, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{rules[rule].kind}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def with_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    masked: bool = False,
    into: str = "spans",
) -> DataFrame:
    """``docs`` with the column ``into``: kind, start and end (exclusive, in code points)
    of each secret in ``text``, by start and then by the order of ``rules``.

    With ``masked`` the text has them replaced by ``<kind>``. A column of that name is
    replaced, all others pass through. NULL and empty texts have no spans; a text is
    searched whole, whatever its length; kinds that start at one place keep the order
    of the rules; repeated rows are scanned one by one; an empty table gives no rows.
    The rows are not shuffled.
    """
    result = docs.withColumn(into, F.expr(f"cast(array() as {SPANS})"))
    run = _scanning(rules, docs.columns.index("text"), result.columns.index(into), masked)
    return result.mapInArrow(run, result.schema)


def digest_columns(spans: str = "spans") -> dict[str, F.Column]:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    names = [rule.kind for rule in BASE_RULES]

    def joined(array):
        return F.array_join(
            F.transform(array, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ","
        )

    def count(name: str) -> F.Column:
        return F.size(F.filter(spans, lambda s: s.kind == name)).cast("long")

    counts = {f"n_{name}": count(name) for name in names}
    base = F.filter(spans, lambda s: s.kind.isin(names))
    return {**counts, "base_sha256": F.sha2(joined(base), 256), "spans": joined(F.col(spans))}
