"""Licences in texts, by patience alignment with template texts.

Places where enough of a template's telling words (all but common ones) stand close together are
aligned with it: words that occur once on both sides are anchors, the longest run of anchors in the
same order on both sides is kept, and the gaps between them are aligned in the same way; a gap without
anchors is aligned by its longest common subsequence. The coverage is the share of the
template's words that are aligned within a stretch of at most ``STRETCH`` times its length.
Notices of few words are found by the licence's name and version, which have to be there whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainflow.llm import words
from trainflow.llm.license_texts import COMMON, FRAME, TEXTS

#: Least coverage of a found licence, longest stretch of text for a template, in template lengths.
LEAST, STRETCH = 0.8, 1.5
#: Templates of fewer words are notices: what names the licence and version has to stand there word by word.
SHORT = 20

Pairs = list[tuple[int, int]]


def _increasing(pairs: Pairs) -> Pairs:
    """The longest part of pairs, sorted by the first, whose second numbers rise."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        before.append(ends[k - 1] if k else -1)
        if k == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[k], ends[k] = b, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _common(text: Sequence, template: Sequence, a: int, b: int) -> Pairs:
    """A longest common subsequence of two sequences, with places counted from ``a`` and ``b``.

    From the end of the text, a row of bits for each of its words: bit k is 0 where the template's last
    k + 1 words have one more word in common with the rest of the text than its last k.
    """
    n, m = len(text), len(template)
    full = (1 << m) - 1
    spots: dict = {}
    for j, w in enumerate(template):
        spots[w] = spots.get(w, 0) | 1 << (m - 1 - j)
    row, rows = full, [full] * (n + 1)
    for i in range(n - 1, -1, -1):
        met = row & spots.get(text[i], 0)
        row = rows[i] = (row + met | row - met) & full
    out, i, j = [], 0, 0
    while i < n and j < m:
        if text[i] == template[j]:
            out.append((a + i, b + j))
            i, j = i + 1, j + 1
        elif rows[i] >> (m - 1 - j) & 1:
            j += 1
        else:
            i += 1
    return out


def aligned(text: Sequence, template: Sequence) -> Pairs:
    """Places of text and template that are aligned, rising on both sides."""
    out: Pairs = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        if a == b or c == d:
            continue
        left, right = text[a:b], template[c:d]
        once = {w for w, n in Counter(left).items() if n == 1} & {w for w, n in Counter(right).items() if n == 1}
        if not once:
            out += _common(left, right, a, c)
            continue
        place = {w: c + j for j, w in enumerate(right) if w in once}
        anchors = _increasing([(a + i, place[w]) for i, w in enumerate(left) if w in once])
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


def _densest(pairs: Pairs, stretch: int) -> Pairs:
    """The most pairs within a stretch of the text."""
    best, first = (0, 0), 0
    for last, (i, _) in enumerate(pairs):
        while i - pairs[first][0] >= stretch:
            first += 1
        if last + 1 - first > best[1] - best[0]:
            best = (first, last + 1)
    return pairs[best[0] : best[1]]


def _closest(text: np.ndarray, template: Sequence, low: int, high: int, first: int, stretch: int) -> Pairs:
    """The best aligned stretch from ``low`` to ``high``, aligned again over all the words it may reach.

    Those may lie behind ``high``, but not before ``first``; words around them can mislead anchors.
    """
    pairs = [(low + i, j) for i, j in _densest(aligned(text[low:high].tolist(), template), stretch)]
    if not pairs:
        return pairs
    (a, c), (b, d) = pairs[0], pairs[-1]
    begin = max(first, a - c)
    again = _densest(_common(text[begin : b + len(template) - d].tolist(), template, begin, 0), stretch)
    return max(again, pairs, key=len)


def _split(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(text.lower(), np.uint8)
    starts, ends = words.spans(data, words.WORD)
    return starts, ends, words.hashes(data, starts, ends)


class Find(NamedTuple):
    """A licence in a text: its name, the share of the template's words, and the numbers of their partners."""

    name: str
    coverage: float
    places: list[int]

    def between(self) -> int:
        """Words from the first to the last place that are no partners."""
        return self.places[-1] + 1 - self.places[0] - len(self.places)


class Templates:
    """Hashed words of the templates, and how often each holds its telling ones."""

    def __init__(self, texts: Sequence[tuple[str, str]]) -> None:
        common = set(_split(" ".join(sorted(COMMON)).encode())[2].tolist())
        self.names = [name for name, _ in texts]
        self.words = [_split(text.encode())[2].tolist() for _, text in texts]
        telling = [Counter(x for x in w if x not in common) for w in self.words]
        # With this many telling words missing, the coverage cannot be reached.
        self.needed = np.array(
            [max(1, t.total() - int((1 - LEAST) * len(w) + 1e-9)) for t, w in zip(telling, self.words, strict=True)],
            np.int64,
        )
        frame = set(_split(" ".join(sorted(FRAME)).encode())[2].tolist())
        #: First and last word, and one more, of what names the licence in a notice; the notices of each name.
        self.named: dict[int, tuple[int, int]] = {}
        self.notices: dict[tuple, list[int]] = {}
        for k, w in enumerate(self.words):
            if 0 < len(w) < SHORT:
                naming = [j for j, x in enumerate(w) if x not in frame] or range(len(w))
                low, high = self.named[k] = naming[0], naming[-1] + 1
                self.notices.setdefault(tuple(w[low:high]), []).append(k)
                telling[k] = Counter()
                self.needed[k] = np.iinfo(np.int64).max
        self.all = np.array(sorted(set().union(*telling)), np.uint64)
        #: A row for each telling word of any template, a column for each template.
        self.counts = np.array([[t[w] for t in telling] for w in self.all.tolist()], np.int32).reshape(-1, len(texts))
        self.member = self.counts > 0


@cache
def _templates(texts: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(texts)


def _likely(places: np.ndarray, kinds: np.ndarray, most: np.ndarray, stretch: int) -> np.ndarray:
    """For each place of a word: how many words of the stretch from there a template can match at most.

    Of each kind of word no more than ``most`` count, as the template has no more of it.
    """
    n = len(places)
    order = np.argsort(kinds, kind="stable")
    earlier = np.arange(n) - most[order]
    same = (earlier >= 0) & (kinds[order[np.maximum(earlier, 0)]] == kinds[order])
    # A word counts from behind the one that makes it one too many, and while it is in the stretch.
    first = np.zeros(n, np.int64)
    first[order[same]] = order[earlier[same]] + 1
    first = np.maximum(first, np.searchsorted(places, places - stretch, "right"))
    change = np.bincount(first, minlength=n + 1) - np.bincount(np.arange(n) + 1, minlength=n + 1)
    return np.cumsum(change)[:n]


def _found(hashes: np.ndarray, hits: np.ndarray, kinds: np.ndarray, own: Templates, k: int) -> list[Find]:
    """The places where template ``k`` is found."""
    chosen = own.member[kinds, k]
    places, kinds = hits[chosen], kinds[chosen]
    size, needed = len(own.words[k]), own.needed[k]
    stretch = int(STRETCH * size)
    starts = places[_likely(places, kinds, own.counts[kinds, k], stretch) >= needed]
    out, after, i = [], 0, 0
    while i < len(starts):
        start = int(starts[i])
        if start < after:
            i = int(np.searchsorted(starts, after))
            continue
        low = max(after, start - stretch)
        pairs = _closest(hashes, own.words[k], low, start + stretch, after, stretch)
        if len(pairs) >= LEAST * size:
            out.append(Find(own.names[k], len(pairs) / size, [a for a, _ in pairs]))
            after = out[-1].places[-1] + 1
        # What begins up to half a stretch later is seen whole from there, too.
        i = max(i + 1, int(np.searchsorted(starts, start + stretch // 2, "right")) - 1)
    return out


def _named(hashes: np.ndarray, name: tuple) -> np.ndarray:
    """Where the words of a name stand one after the other."""
    at = np.flatnonzero(hashes == np.uint64(name[0]))
    for j, w in enumerate(name[1:], 1):
        at = at[at + j < len(hashes)]
        at = at[hashes[at + j] == np.uint64(w)]
    return at


def _noticed(text: np.ndarray, at: int, own: Templates, k: int) -> Find | None:
    """Template ``k``, a notice whose name stands at ``at``, if enough of the words around the name are there."""
    wanted, (low, high) = own.words[k], own.named[k]
    reach = int(STRETCH * len(wanted)) - (high - low)
    # Backwards from the name, so that the nearest words count.
    before = _common(text[max(0, at - reach) : at][::-1].tolist(), wanted[:low][::-1], 0, 0)
    first = at - 1 - before[-1][0] if before else at
    end = at + high - low
    after = _common(text[end : end + reach - (at - first)].tolist(), wanted[high:], end, high)
    places = [at - 1 - i for i, _ in before[::-1]] + list(range(at, end)) + [i for i, _ in after]
    return Find(own.names[k], len(places) / len(wanted), places) if len(places) >= LEAST * len(wanted) else None


def _best(found: list[Find]) -> list[Find]:
    """Of finds of one licence that overlap the longest stays, of finds that share words the one with most.

    Finds of different licences share words if more than half of the smaller one's are words of the other.
    """
    kept: list[Find] = []
    for x in sorted(found, key=lambda f: (-len(f.places), -f.coverage, f.places[0], f.name)):
        mine = set(x.places)
        for y in kept:
            if x.places[-1] < y.places[0] or y.places[-1] < x.places[0]:
                continue
            if x.name == y.name or 2 * len(mine.intersection(y.places)) > len(mine):
                break
        else:
            kept.append(x)
    return sorted(kept, key=lambda f: (f.places[0], f.places[-1], f.name))


def scan(texts: Sequence[bytes | None], templates: tuple[tuple[str, str], ...] = TEXTS) -> list[list[tuple]]:
    """Name, coverage, start and end (code points) of the licences of each text, by place."""
    own = _templates(templates)
    out: list[list[tuple]] = [[] for _ in texts]
    for first, data, at in words.grouped(list(texts), lower=True):
        starts, ends = words.spans(data, words.WORD)
        hashes = words.hashes(data, starts, ends)
        edges = np.searchsorted(starts, at)
        near = np.searchsorted(own.all, hashes)
        hits = np.flatnonzero(own.all[np.minimum(near, len(own.all) - 1)] == hashes) if len(own.all) else near[:0]
        kinds = near[hits]
        cuts = np.searchsorted(hits, edges)
        finds: dict[int, list[Find]] = {}
        for name, notices in own.notices.items():
            for spot in _named(hashes, name).tolist():
                t = int(np.searchsorted(edges, spot, "right")) - 1
                if spot + len(name) <= edges[t + 1]:
                    stated = [_noticed(hashes[edges[t] : edges[t + 1]], spot - edges[t], own, k) for k in notices]
                    # Of the ways to say it the best covered one, then the one with the fewest words between.
                    tight = sorted((f for f in stated if f), key=lambda f: (f.coverage, -f.between(), len(f.places)))
                    finds.setdefault(t, []).extend({f.name: f for f in tight}.values())
        for t in np.flatnonzero(np.diff(cuts) >= own.needed.min(initial=1 << 62)).tolist():
            mine = slice(cuts[t], cuts[t + 1])
            part = slice(edges[t], edges[t + 1])
            for k in np.flatnonzero(own.member[kinds[mine]].sum(axis=0) >= own.needed).tolist():
                more = _found(hashes[part], hits[mine] - edges[t], kinds[mine], own, k)
                finds.setdefault(t, []).extend(more)
        for t, found in finds.items():
            part = slice(edges[t], edges[t + 1])
            text = texts[first + t] or b""
            for f in _best(found):
                begin, end = int(starts[part][f.places[0]] - at[t]), int(ends[part][f.places[-1]] - at[t])
                begin_at = len(text[:begin].decode())
                out[first + t].append((f.name, f.coverage, begin_at, begin_at + len(text[begin:end].decode())))
    return out


def with_licenses(
    docs: DataFrame, text: str = "text", name: str = "licenses", templates: Sequence[tuple[str, str]] = TEXTS
) -> DataFrame:
    """Adds the licences of every text as an array of ``name, coverage, start, end``; all rows and columns stay.

    Null and empty texts have none. Words are ASCII letters (either case), digits and characters
    beyond ASCII; what stands between them does not matter.
    """
    own = tuple(templates)

    @F.pandas_udf("array<struct<name:string,coverage:double,start:bigint,end:bigint>>")
    def found(texts: pd.Series) -> pd.Series:
        keys = ("name", "coverage", "start", "end")
        return pd.Series([[dict(zip(keys, x, strict=True)) for x in f] for f in scan(texts.tolist(), own)], dtype=object)

    return docs.withColumn(name, found(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
