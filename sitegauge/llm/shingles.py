"""Sets of word shingles and their signatures by one-permutation hashing.

One hash per shingle: its top bits name one of BINS bins, the smallest hash of a bin is the
bin's value. Empty bins take the value of a filled one by optimal densification: every bin has
its own fixed order of all bins, and the first filled one of it gives the value, so that two
sets with the same filled bins agree on the source.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np

from sitegauge.llm.common import Words, mix

SHINGLE = 5
BINS = 256
BAND_ROWS = 7
BANDS = BINS // BAND_ROWS
#: Chance that two sets of the least similarity share no bucket.
MISSED = 1e-6

_ORDER_SEED = 20_011


def _ranks() -> np.ndarray:
    """``ranks[i, j]``: the place of bin j in the order in which empty bin i looks for a value."""
    rng = np.random.default_rng(_ORDER_SEED)
    return np.argsort(rng.random((BINS, BINS)), axis=1).argsort(axis=1).astype(np.int16)


RANKS = _ranks()
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of one document's words.

    Fewer words, but not none, are one shingle.
    """
    n = len(hashes)
    if not n:
        return hashes
    width = min(n, SHINGLE)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width, dtype=np.uint64)
        for i in range(width):
            out += hashes[i : n - width + 1 + i] * _ODD[i]
    return np.unique(mix(out))


def sets_of(words: Words) -> list[np.ndarray]:
    """The shingle set of each document. Shingles are made over the whole run, then cut."""
    n = len(words.hashes)
    if n >= SHINGLE:
        with np.errstate(over="ignore"):
            every = np.full(n - SHINGLE + 1, SHINGLE, dtype=np.uint64)
            for i in range(SHINGLE):
                every += words.hashes[i : n - SHINGLE + 1 + i] * _ODD[i]
        every = mix(every)
    out = []
    for first, end in zip(words.bounds[:-1], words.bounds[1:]):
        if end - first > SHINGLE:
            out.append(np.unique(every[first : end - SHINGLE + 1]))
        else:
            out.append(shingle_hashes(words.hashes[first:end]))
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """Values of all bins for a set of at least one sorted hash."""
    bins = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = bins[first]
    out = np.zeros(BINS, dtype=np.uint64)
    out[filled] = hashes[first]
    if len(filled) < BINS:
        empty = np.ones(BINS, dtype=bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        out[empty] = hashes[first][RANKS[np.ix_(empty, filled)].argmin(axis=1)]
    return out


def layout(percent: int) -> tuple[int, int]:
    """Number of bands and bins per band for sets with a similarity of ``percent`` or more.

    The longest bands of which there are enough that such sets miss each other in all of them
    with at most MISSED.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"a similarity of {percent} per cent")
    if percent == 100:
        return BANDS, BAND_ROWS
    for rows in range(BINS, 0, -1):
        apart = log(1 - (percent / 100) ** rows)
        if apart and ceil(log(MISSED) / apart) * rows <= BINS:
            return ceil(log(MISSED) / apart), rows
    raise ValueError(f"{BINS} bins are too few for a similarity of {percent} per cent")


def bands(values: np.ndarray, n: int = BANDS, width: int = BAND_ROWS) -> np.ndarray:
    """One bucket key for each of ``n`` bands of ``width`` bins."""
    rows = values[: n * width].reshape(n, width)
    with np.errstate(over="ignore"):
        key = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
        for i in range(width):
            key = mix(key + rows[:, i])
    return key


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        one = np.sum(hashes, dtype=np.uint64)
        two = np.sum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))
