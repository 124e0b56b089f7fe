"""Words of UTF-8 texts as 64-bit hashes, a whole batch at a time.

A word is a run of ASCII digits, ASCII letters (A-Z count as a-z) and any other
characters beyond ASCII.
"""

from __future__ import annotations

import numpy as np

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15
POSITIONS = 1 << 20

#: The byte a word is hashed with; 0 for bytes that part words.
CODE = np.zeros(256, np.uint8)
CODE[0x80:] = np.arange(0x80, 0x100)
for _first, _last in ("09", "az"):
    CODE[ord(_first) : ord(_last) + 1] = np.arange(ord(_first), ord(_last) + 1)
CODE[ord("A") : ord("Z") + 1] = CODE[ord("a") : ord("z") + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    """base^0, base^1, … modulo 2^64."""
    out = np.ones(1, np.uint64)
    while len(out) < POSITIONS:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


POWERS, INVERSES = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (and the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    code = CODE[data]
    inside = code > 0
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & ~before)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    if not len(starts):
        return np.empty(0, np.uint64), bounds
    # A word's hash is a polynomial of its bytes; the place it starts at is divided out.
    place = np.arange(len(data)) % POSITIONS
    terms = code.astype(np.uint64) * POWERS[place]
    sums = np.add.reduceat(terms, starts)
    ends = np.flatnonzero(~inside & before)
    lap = starts // POSITIONS != (ends - 1) // POSITIONS
    hashes = sums * INVERSES[place[starts]]
    for i in np.flatnonzero(lap):  # the few words that cross a multiple of POSITIONS
        own = code[starts[i] : ends[i]].astype(np.uint64)
        hashes[i] = np.add.reduce(own * _cycled(len(own)))
    return mix(hashes), bounds


def _cycled(n: int) -> np.ndarray:
    return POWERS[np.arange(n) % POSITIONS]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words each; of all words together where there are fewer."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        size = n
    out = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(BASE) + words[i : n - size + 1 + i]
    return mix(out + np.uint64(size))
