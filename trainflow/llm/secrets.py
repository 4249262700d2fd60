"""Secrets in texts: rules are looked up in a trigram index before they are tried.

Each rule's pattern gives a Boolean query on trigrams (lower-case bytes) that every match must
contain, as alternatives of sets. Each batch of texts becomes a segment of the index: postings, that
is text numbers, of the trigrams that some query asks for. Queries intersect and unite postings;
candidates are verified with the pattern on the whole text. A rule without a mandatory trigram is
tried on every text. Segments are built where the texts are read, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from re import _constants as kinds
from re import _parser as parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.llm import words

#: Most strings that a part of a pattern is spelled out to, and most alternatives of a query.
SPELLED, ALTERNATIVES = 64, 256

Query = frozenset[frozenset[bytes]]
#: Nothing is mandatory.
ANY: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, whether letters match in either case, a group with a least length."""

    kind: str
    pattern: str
    either_case: bool = False
    group: int = 0
    least: int = 0
    regex: re.Pattern = field(init=False, compare=False, repr=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "regex", re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0)))

    def matches(self, text: str) -> Iterator[tuple[int, int]]:
        for m in self.regex.finditer(text):
            if len(m[self.group]) >= self.least:
                yield m.span()


#: Fixed values. A run of 24 hex digits or more is matched at once, which finds the same runs as
#: matching every run and dropping short ones; so are keys of 20 characters or more.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        either_case=True,
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Public token formats beyond the base rules.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
RULES = BASE + MORE


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > ALTERNATIVES:
        return min(a, b, key=len)
    return _least(x | y for x in a for y in b)


def _least(sets) -> Query:
    """Without alternatives that another one implies."""
    own = set(sets)
    return frozenset(x for x in own if not any(y < x for y in own))


def _spelled(strings: set[bytes]) -> Query:
    """A text that contains one of the strings has their trigrams."""
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings) if strings else ANY


def _class(members: list) -> set[bytes] | None:
    """The characters of a class, if they are few and plain."""
    out: set[bytes] = set()
    for kind, value in members:
        if kind is kinds.LITERAL:
            codes = range(value, value + 1)
        elif kind is kinds.RANGE:
            codes = range(value[0], value[1] + 1)
        else:
            return None
        if len(codes) > SPELLED or codes[-1] > 127:
            return None
        out |= {chr(c).lower().encode() for c in codes}
    return out if len(out) <= 16 else None


def _part(kind, value) -> tuple[set[bytes] | None, Query]:
    """All strings that a part matches, if they are few; else what its matches must contain."""
    if kind is kinds.LITERAL:
        return ({chr(value).lower().encode()}, ANY) if value < 128 else (None, ANY)
    if kind is kinds.IN:
        return _class(value), ANY
    if kind is kinds.SUBPATTERN:
        return _sequence(value[-1])
    if kind is kinds.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in found):
            return set().union(*(strings for strings, _ in found)), ANY
        return None, _least(x for strings, query in found for x in (query if strings is None else _spelled(strings)))
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {b""}, ANY
        if strings is not None and least == most == 1:
            return strings, ANY
        if least:
            return None, query if strings is None else _spelled(strings)
        return None, ANY
    return None, ANY


def _sequence(parts) -> tuple[set[bytes] | None, Query]:
    whole, strings, query = True, {b""}, ANY
    for kind, value in parts:
        if kind is kinds.AT:  # a place, not a character
            continue
        own, needed = _part(kind, value)
        if own is not None and len(strings) * len(own) <= SPELLED:
            strings = {a + b for a in strings for b in own}
            continue
        whole = False
        query = _both(query, _spelled(strings))
        strings = {b""} if own is None else own
        query = _both(query, needed)
    return (strings, ANY) if whole else (None, _both(query, _spelled(strings)))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams, one of which every match contains whole; ``ANY`` if there are none."""
    strings, query = _sequence(parser.parse(pattern))
    query = query if strings is None else _spelled(strings)
    return ANY if frozenset() in query else query


class Index:
    """Queries of rules, and what their trigrams are in a table of all trigrams."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.trigrams = sorted({t for q in self.queries for x in q for t in x})
        self.numbers = {t: i for i, t in enumerate(self.trigrams)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.numbers.items():
            self.table[t[0] | t[1] << 8 | t[2] << 16] = i + 1

    def postings(self, data: np.ndarray, at: np.ndarray) -> dict[int, np.ndarray]:
        """Sorted numbers of the texts that have each trigram."""
        if len(data) < 3:
            return {}
        codes = data[:-2].astype(np.uint32) | data[1:-1].astype(np.uint32) << 8 | data[2:].astype(np.uint32) << 16
        found = self.table[codes]
        places = np.flatnonzero(found)
        texts = np.searchsorted(at, places, "right") - 1
        pairs = np.unique(found[places].astype(np.int64) * len(at) + texts)
        trigrams, texts = pairs // len(at) - 1, pairs % len(at)
        edges = np.flatnonzero(np.diff(trigrams, prepend=-1))
        return dict(zip(trigrams[edges].tolist(), np.split(texts, edges[1:]), strict=True))

    def candidates(self, query: Query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
        if query == ANY:
            return np.arange(n)
        none = np.empty(0, np.int64)
        found = none
        for alternative in query:
            lists = sorted((postings.get(self.numbers[t], none) for t in alternative), key=len)
            own = lists[0]
            for other in lists[1:]:
                own = np.intersect1d(own, other, assume_unique=True)
            found = np.union1d(found, own)
        return found


_INDEXES: dict[tuple[Rule, ...], Index] = {}


def _index(rules: tuple[Rule, ...]) -> Index:
    if rules not in _INDEXES:
        _INDEXES[rules] = Index(rules)
    return _INDEXES[rules]


def scan(texts: Sequence[str | None], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[str, int, int]]]:
    """Kind, start and end (code points, end exclusive) of all secrets of each text, by start, then rule."""
    index = _index(rules)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    raw = [None if t is None else t.encode() for t in texts]
    for first, data, at in words.grouped(raw, lower=True):
        n = len(at) - 1
        postings = index.postings(data, at)
        for r, (rule, query) in enumerate(zip(rules, index.queries, strict=True)):
            for i in index.candidates(query, postings, n).tolist():
                spans[first + i] += [(a, r, b) for a, b in rule.matches(texts[first + i] or "")]
    return [[(rules[r].kind, a, b) for a, r, b in sorted(own)] for own in spans]


def with_spans(
    docs: DataFrame, text: str = "text", name: str = "spans", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Adds the secrets of every text as an array of ``kind, start, end``; all rows and columns stay.

    Matches of one kind are leftmost and do not overlap; kinds may. Null and empty texts have none.
    """
    own = tuple(rules)

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans(texts: pd.Series) -> pd.Series:
        found = scan(texts.tolist(), own)
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in found], dtype=object)

    return docs.withColumn(name, spans(F.coalesce(F.col(text).cast("string"), F.lit(""))))
