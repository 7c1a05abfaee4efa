"""Hashes of words and of word shingles, vectorised over a text's bytes; runs inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: Words of a shingle.
WORDS = 5
#: Bytes hashed at once; a longer text is cut at a blank.
STEP = 1 << 20
# An odd base has an inverse modulo 2^64, so a word's hash doesn't depend on its place.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TURNS = (np.arange(1, WORDS + 1, dtype=U) * U(0xD6E8FEB86659FD93)) | U(1)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        _powers[base] = known = np.concatenate([[U(1)], np.cumprod(np.full(max(n, STEP), U(base)), dtype=U)])
    return known[:n]


def _hash_words(data: np.ndarray) -> np.ndarray:
    solid = np.concatenate([[False], ~_BLANK[data], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    begins, ends = edges[::2], edges[1::2]
    total = np.zeros(len(data) + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * _power(_BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[begins]) * _power(_INVERSE, len(data) + 1)[begins])


def word_hashes(text: str | None) -> np.ndarray:
    """One number per run of characters between ASCII blanks, in order."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) <= STEP:
        return _hash_words(data)
    found, begin = [], 0
    while begin < len(data):
        end = min(begin + STEP, len(data))
        while end < len(data):  # to the next blank
            blank = np.flatnonzero(_BLANK[data[end : end + STEP]])
            if len(blank):
                end += int(blank[0])
                break
            end = min(end + STEP, len(data))
        found.append(_hash_words(data[begin:end]))
        begin = end
    return np.concatenate(found)


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """A number per run of ``size`` words; fewer words, but one at least, are one shingle."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    turns = _TURNS if size == WORDS else (np.arange(1, size + 1, dtype=U) * U(0xD6E8FEB86659FD93)) | U(1)
    total = np.full(n, U(min(size, len(words))))
    for j in range(min(size, len(words))):
        total += words[j : j + n] * turns[j]
    return mix(total)
