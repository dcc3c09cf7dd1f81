"""Hashes of words and of word shingles, for many texts at once in numpy."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.RandomState(20_240)
_BYTE = _RANDOM.randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all (uint64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (bytes but ASCII white space, A-Z lower-cased), and how many
    words each text has."""
    data = _FOLD[np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)]
    space = _SPACE[data]
    before = np.r_[True, space[:-1]]
    starts = np.flatnonzero(~space & before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.flatnonzero(space & ~before)
    lengths = ends - starts
    letters = data[~space]
    first = np.cumsum(lengths) - lengths  # of each word in letters
    inside = np.arange(len(letters)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), _STEP, dtype=np.uint64))
        hashes = mix(np.add.reduceat(_BYTE[letters] * powers[inside], first))
    limits = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.r_[0, np.searchsorted(starts, limits)])


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``size`` words; a text of fewer words
    has its whole sequence, one without words nothing."""
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    with np.errstate(over="ignore"):
        for n in counts.tolist():
            own = hashes[at : at + n]
            at += n
            if not n:
                out.append(own)
                continue
            width = min(n, size)
            total = np.full(n - width + 1, width, dtype=np.uint64)
            for i in range(width):
                total = total * _STEP + own[i : n - width + 1 + i]
            out.append(np.unique(mix(total)))
    return out
