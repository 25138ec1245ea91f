"""Hashes of the words and shingles of UTF-8 texts, in a few vector operations per text.

Words are the runs of bytes outside [\\x20\\x09-\\x0D], as ``bytes.split()`` gives them. A word's hash is
a polynomial over 64-bit random values of its bytes, from differences of running sums, mixed with
its length.
"""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)
PART_BYTES = 1 << 20

_BYTES = np.random.default_rng(256).integers(1, 2 ** 64, 256, dtype="u8")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list = [np.ones(1, dtype="u8"), np.ones(1, dtype="u8")]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MIX to the powers 0 to ``n``, and their inverses, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        size = max(n, 1 << 15)
        inverse = np.uint64(pow(int(MIX), -1, 1 << 64))
        one = np.ones(1, dtype="u8")
        _POWERS[:] = [np.concatenate([one, np.cumprod(np.full(size, m, dtype="u8"))])
                      for m in (MIX, inverse)]
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * MIX
    return x ^ (x >> np.uint64(31))


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each pair, whatever the place."""
    up, down = powers(len(values))
    total = np.concatenate([np.zeros(1, dtype="u8"), np.cumsum(values * up[:len(values)])])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype("u8"))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of ``text``, in order. Long texts go in parts cut before a space."""
    if len(text) > PART_BYTES:
        parts, at = [], 0
        while at < len(text):
            stop = at + PART_BYTES
            while stop < len(text) and not _SPACE[text[stop]]:
                stop += 1
            parts.append(_word_hashes(text[at:stop]))
            at = stop
        return np.concatenate(parts)
    return _word_hashes(text)


def _word_hashes(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, dtype="u1")
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[raw], [True]]).view("i1")))
    return _runs(_BYTES[raw], edge[::2], edge[1::2])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype="u8")
    starts = np.arange(m)
    return _runs(mixed(hashes), starts, starts + n)


def shingles(text: bytes, n: int = 5) -> np.ndarray:
    """The sorted set of hashes of ``n``-word shingles; with fewer words the whole sequence is one."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    return np.unique(grams(hashes, min(n, len(hashes))))
