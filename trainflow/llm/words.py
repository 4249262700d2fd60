"""Words of UTF-8 texts as arrays: where they are, and a 64-bit hash of each."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: Bytes whose powers and sums are held at once.
BLOCK = 1 << 18
#: Odd multipliers; two of them give two independent hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def byte_class(members: bytes) -> np.ndarray:
    """A table of 256 booleans."""
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: Bytes of words between white space (space, tab to carriage return).
NOT_SPACE = ~byte_class(b" \t\n\x0b\x0c\r")
#: Bytes of words of lower-case letters, digits and everything beyond ASCII.
WORD = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    both = []
    for x in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, x, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return both[0], both[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << max(size, 1 << 10).bit_length())


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of member bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = members[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """A hash of each span; equal bytes have equal hashes."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = powers(base, high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mixed(out)


def rolled(values: np.ndarray, width: int, base: int = BASES[1]) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values; shorter inputs give none."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    out = np.zeros(len(values) - width + 1, np.uint64)
    factor = 1
    for k in range(width):
        out += values[k : k + len(out)] * np.uint64(factor)
        factor = factor * base % (1 << 64)
    return mixed(out)


def grouped(texts: list[bytes | None], lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts glued with a blank between, a block or one longer text at a time.

    Yields the number of the first text, the bytes, and where each text starts (one more at the end).
    """
    first = 0
    while first < len(texts):
        last, size, parts = first, 0, []
        while last < len(texts) and (not parts or size + len(texts[last] or b"") <= BLOCK):
            parts.append(texts[last] or b"")
            size += len(parts[-1]) + 1
            last += 1
        glued = b" ".join([*parts, b""])
        at = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
        yield first, np.frombuffer(glued.lower() if lower else glued, np.uint8), at
        first = last
