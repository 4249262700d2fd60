"""Token ids of whole texts by a byte-level BPE of the tokenizers library."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

#: Words whose ids are remembered, and characters encoded at once.
MOST_WORDS = 900_000
CHARACTERS = 1 << 21
#: Words given to the library in one text.
TOGETHER = 64
#: Letters in every version of Unicode: such words need no cutting rule of the library.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Fixed value: how byte-level vocabularies write a blank.
BLANK = "Ġ"


class _Codes(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


class Encoder:
    """Encodes texts; remembers the ids of words it has met.

    The library cuts a text before each blank that stands between two other characters, and no
    token reaches over a cut. So the ids of a text are those of its first word and of each later
    word with its blank; new words are given to the library many at a time. Texts with more white
    space beside a blank go to the library whole, and so do texts that hold an added token. Special
    tokens written in a text are text with ``as_text``, else the library gives their ids, as by default.
    """

    def __init__(self, definition: str, as_text: bool = True) -> None:
        self.library, self.plain = Tokenizer.from_str(definition), Tokenizer.from_str(definition)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.opens = np.zeros(size, bool)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.opens[i] = token.startswith(BLANK)
        blanks = pre_tokenizers.Split(" ", "merged_with_next")
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([blanks, letters])
        for t in (self.library, self.plain):
            t.encode_special_tokens = as_text
            t.model._resize_cache(0)
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not (as_text and t.special)]
        # Words that are learned together must not make a token that none of them holds.
        self.together = 1 if any(" " in t for t in self.added) else TOGETHER
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.ids, self.sizes, self.bad = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, bool)

    @staticmethod
    def _encoded(library: Tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Appends the ids of new words, in the order of their numbers."""
        sizes = np.zeros(len(words), np.int64)
        bad = np.array([not w or w[0].isspace() or w[-1].isspace() for w in words], bool)
        simple = np.array([bool(LETTERS.fullmatch(w)) for w in words], bool)
        order, ids = [], []
        for library, chosen in ((self.plain, simple), (self.library, ~simple & ~bad)):
            places = np.flatnonzero(chosen)
            some = [words[i] for i in places.tolist()]
            step = self.together
            texts = [" " + " ".join(some[k : k + step]) for k in range(0, len(some), step)]
            got = np.fromiter(chain.from_iterable(self._encoded(library, texts)), np.uint32)
            at = np.flatnonzero(self.opens[got])
            if len(at) != len(some):  # a vocabulary whose tokens don't show their blank
                parts = self._encoded(self.library, [" " + w for w in some])
                got = np.fromiter(chain.from_iterable(parts), np.uint32)
                at = np.cumsum([0, *map(len, parts)])[:-1].astype(np.int64)
            sizes[places] = np.diff(np.append(at, len(got)))
            order.append(places)
            ids.append(got)
        places, got = np.concatenate(order), np.concatenate(ids)
        lengths = sizes[places]
        starts = np.zeros(len(words), np.int64)
        starts[places] = np.cumsum(lengths) - lengths
        self.ids = np.concatenate((self.ids, _gathered(got, starts, sizes)))
        self.sizes, self.bad = np.concatenate((self.sizes, sizes)), np.concatenate((self.bad, bad))

    def _some(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.codes) > MOST_WORDS:
            self._forget()
        known = len(self.codes)
        split = [t.split(" ") for t in texts]
        heads = self._encoded(self.library, [w[0] for w in split])
        count = np.array([len(w) - 1 for w in split], np.int64)
        later = chain.from_iterable(islice(w, 1, None) for w in split)
        codes = np.fromiter(map(self.codes.__getitem__, later), np.int64, int(count.sum()))
        if len(self.codes) > known:
            self._learn(list(islice(self.codes, known, None)))
        sizes = self.sizes[codes]
        flat = _gathered(self.ids, (np.cumsum(self.sizes) - self.sizes)[codes], sizes)
        text = np.concatenate(([0], np.cumsum(count)))
        bounds = np.concatenate(([0], np.cumsum(sizes)))[text]
        bad = np.diff(np.concatenate(([0], np.cumsum(self.bad[codes])))[text]) > 0
        bad |= np.array([w[0][-1:].isspace() or (not w[0] and len(w) > 1) for w in split], bool)
        if self.added:
            bad |= np.array([any(a in t for a in self.added) for t in texts], bool)
        whole = iter(self._encoded(self.library, [t for t, b in zip(texts, bad.tolist(), strict=True) if b]))
        parts = zip(heads, bounds[:-1].tolist(), bounds[1:].tolist(), bad.tolist(), strict=True)
        return [
            np.array(next(whole), np.uint32) if b else np.concatenate((np.array(h, np.uint32), flat[i:j]))
            for h, i, j, b in parts
        ]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers; a null text has none."""
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last] or "") <= CHARACTERS):
                size += len(texts[last] or "")
                last += 1
            yield from self._some([t or "" for t in texts[first:last]])
            first = last


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces of ``ids`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]


_ENCODERS: dict[tuple[int, bool], Encoder] = {}


def encoder(definition: str, as_text: bool = True) -> Encoder:
    """The encoder of a definition, kept as long as the worker process lives."""
    key = hash(definition), as_text
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition, as_text)
    return _ENCODERS[key]
