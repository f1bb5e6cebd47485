"""Suffix arrays of bytes with their common prefixes, in numpy.

Several texts stand one after another in one array of symbols: a byte counts one more than its
value, 0 stands between two texts.
"""

from __future__ import annotations

import numpy as np

SEPARATOR, END = 0, 257
# Symbols of nine bits that are sorted at once in the first round.
FIRST_WIDTH = 7
# Positions of one lane of Kasai's walk, and symbols compared at once after the first four.
LANE, STRETCH = 256, 64


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, a separator after each, and the first position of each."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8).astype(np.uint16) + np.uint16(1)
    raw[starts + sizes] = SEPARATOR
    return raw, starts


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and each position's place in that order.

    Larsson and Sadakane's refinement: suffixes sorted by their first h symbols form groups; a
    group is sorted by the groups of the suffixes h symbols further on, which doubles h, and
    only groups of more than one suffix are touched again. The end is smaller than all symbols.
    """
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(FIRST_WIDTH, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(FIRST_WIDTH):
        key <<= 9
        key |= padded[i : i + n]
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if n else order
    # A suffix's rank is one more than the place of the first of its group; 0 is the end.
    group = np.repeat(heads, np.diff(np.append(heads, n)))
    rank = np.zeros(n + 1, dtype=np.int64)
    rank[order] = group + 1
    sizes = np.diff(np.append(heads, n))
    left = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    width = FIRST_WIDTH
    while len(left):
        at = order[left]
        key = group[left] * (n + 1) + rank[np.minimum(at + width, n)]
        by_key = np.argsort(key)
        key = key[by_key]
        order[left] = at[by_key]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(heads, len(key)))
        group[left] = np.repeat(left[heads], sizes)
        rank[order[left]] = group[left] + 1
        left = left[np.repeat(sizes, sizes) > 1]
        width *= 2
    return order, rank[:n] - 1


def common_prefixes(symbols: np.ndarray, order: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Symbols that each suffix, in order, shares with the one before it; 0 for the first.

    Kasai's walk in the order of the text: with one position to the next at most one symbol is
    lost. The text is walked in lanes of LANE positions side by side; only a lane's first
    position begins from nothing.
    """
    n = len(symbols)
    out = np.zeros(n, dtype=np.int64)
    if not n:
        return out
    text = np.concatenate([symbols, np.full(STRETCH + 4, END, dtype=np.uint16)]).astype("<u2")
    four = np.ndarray((n + STRETCH,), dtype="<u8", buffer=text, strides=(2,))
    before = np.where(place > 0, order[np.maximum(place - 1, 0)], -1)
    lanes = np.arange(0, n, LANE)
    shared = np.zeros(len(lanes), dtype=np.int64)
    ahead = np.arange(0, STRETCH, 4)
    for step in range(min(LANE, n)):
        at = lanes + step
        if at[-1] >= n:
            lanes, at, shared = lanes[:-1], at[:-1], shared[:-1]
        other = before[at]
        shared = np.where(other >= 0, np.maximum(shared - 1, 0), 0)
        live = np.flatnonzero(other >= 0)
        a, b = (at + shared)[live], (other + shared)[live]
        apart = four[a] ^ four[b]
        shared[live] += _equal(apart)
        live = live[apart == 0]
        while len(live):
            a, b = (at + shared)[live, None] + ahead, (other + shared)[live, None] + ahead
            # Where one of both reaches the end, END differs from any symbol of the other.
            apart = four[np.minimum(a, n + STRETCH - 1)] ^ four[np.minimum(b, n + STRETCH - 1)]
            some = apart != 0
            first = np.where(some.any(axis=1), some.argmax(axis=1), len(ahead))
            whole = first == len(ahead)
            tail = _equal(apart[np.arange(len(live)), np.minimum(first, len(ahead) - 1)])
            shared[live] += first * 4 + np.where(whole, 0, tail)
            live = live[whole]
        out[place[at]] = shared
    return out


def _equal(apart: np.ndarray) -> np.ndarray:
    """Equal leading symbols of four, given the exclusive or of both."""
    return (
        ((apart & np.uint64(0xFFFF)) == 0).astype(np.int64)
        + ((apart & np.uint64(0xFFFFFFFF)) == 0)
        + ((apart & np.uint64(0xFFFFFFFFFFFF)) == 0)
        + (apart == 0)
    )
