"""FM-index over the words of a run of documents.

Documents stand one after another, each followed by a separator. The index has the last
column of the sorted suffixes as a wavelet matrix, the first column as counts, and sampled
suffix positions. Sequences of words are found by backward search for all patterns at once,
their places by steps back to the next sampled position.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, fields

import numpy as np

# Every SAMPLE-th position of the text keeps its place in the sorted suffixes.
SAMPLE = 8
SEPARATOR = 0


def suffix_order(symbols: np.ndarray, separators: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; separators differ and stand in text order.

    Prefix doubling that, after the first round, sorts only suffixes whose prefix is shared.
    """
    # Places fit into 32 bits, as they do in the index. What is not needed any more goes at once: all
    # arrays are as long as the text, and several of them side by side are a worker's peak.
    n = len(symbols)
    rank = symbols.astype(np.int32) + np.int32(len(separators))
    rank[separators] = np.arange(len(separators), dtype=np.int32)
    order = np.argsort(rank, kind="stable").astype(np.int32)
    sorted_rank = rank[order]
    new = np.empty(n, dtype=bool)
    new[0] = True
    np.not_equal(sorted_rank[1:], sorted_rank[:-1], out=new[1:])
    del sorted_rank
    # A suffix's rank is the place of the first one of its group.
    heads = np.flatnonzero(new).astype(np.int32)
    group = np.repeat(heads, np.diff(heads, append=np.int32(n)))
    del heads
    rank[order] = group
    width = 1
    alone = new & np.append(new[1:], True)
    open_at = np.flatnonzero(~alone).astype(np.int32)
    del new, alone
    while len(open_at):
        at = order[open_at]
        key = group[open_at].astype(np.int64)
        key <<= 32
        # The suffix ``width`` further on, or the last one; at + width itself might not fit.
        key |= rank[np.minimum(at, max(0, n - 1 - width)) + min(width, n - 1)]
        by_key = np.argsort(key, kind="stable")
        key = key[by_key]
        order[open_at] = at[by_key]
        del at, by_key
        changed = np.empty(len(key), dtype=bool)
        changed[0] = True
        np.not_equal(key[1:], key[:-1], out=changed[1:])
        starts = np.flatnonzero(changed).astype(np.int32)
        sizes = np.diff(starts, append=np.int32(len(key)))
        del key, changed
        group[open_at] = np.repeat(open_at[starts], sizes)
        rank[order[open_at]] = group[open_at]
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        width *= 2
    return order


@dataclass
class FmIndex:
    """Arrays of the index; ``words`` are the sorted word hashes, symbol i + 1 is ``words[i]``."""

    words: np.ndarray
    first: np.ndarray  # suffixes that start with a smaller symbol
    bits: np.ndarray  # per level, 64 to a number, of the wavelet matrix
    ones: np.ndarray  # per level, set bits before each number
    zeros: np.ndarray  # per level, number of clear bits
    marked: np.ndarray  # whether a sorted suffix keeps its position
    marked_before: np.ndarray
    positions: np.ndarray
    starts: np.ndarray  # first position of each document, then the length of the text

    @classmethod
    def build(cls, hashes: np.ndarray, bounds: np.ndarray) -> FmIndex:
        """``hashes[bounds[i]:bounds[i + 1]]`` are the words of document i."""
        n_docs = len(bounds) - 1
        words = np.unique(hashes)
        n = len(hashes) + n_docs
        separators = bounds[1:] + np.arange(n_docs)
        text = np.zeros(n, dtype=np.int32)
        inside = np.ones(n, dtype=bool)
        inside[separators] = False
        text[inside] = np.searchsorted(words, hashes) + 1
        del inside
        order = suffix_order(text, separators)
        last = text[order - 1]
        sigma = len(words) + 1
        first = np.zeros(sigma + 1, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=sigma), out=first[1:])
        levels = max(1, int(sigma - 1).bit_length())
        size = -(-(n + 1) // 64)
        bits = np.zeros((levels, size), dtype=np.uint64)
        ones = np.zeros((levels, size), dtype=np.int32)
        zeros = np.zeros(levels, dtype=np.int64)
        column = last
        for level in range(levels):
            bit = (column >> (levels - 1 - level)) & 1 == 1
            padded = np.zeros(size * 64, dtype=np.uint8)
            padded[:n] = bit
            bits[level] = np.packbits(padded, bitorder="little").view(np.uint64)
            ones[level, 1:] = np.cumsum(np.bitwise_count(bits[level, :-1]), dtype=np.int32)
            zeros[level] = n - int(bit.sum())
            column = np.concatenate([column[~bit], column[bit]])
        starts = np.append(bounds[:-1] + np.arange(n_docs), n)
        sampled = np.zeros(n + 1, dtype=bool)
        sampled[:n:SAMPLE] = True
        sampled[starts] = True
        keep = sampled[order]
        padded = np.zeros(size * 64, dtype=np.uint8)
        padded[:n] = keep
        marked = np.packbits(padded, bitorder="little").view(np.uint64)
        before = np.zeros(size, dtype=np.int32)
        before[1:] = np.cumsum(np.bitwise_count(marked[:-1]), dtype=np.int32)
        return cls(words, first, bits, ones, zeros, marked, before, order[keep].astype(np.int32), starts)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f.name: getattr(self, f.name) for f in fields(self)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> FmIndex:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{f.name: arrays[f.name] for f in fields(cls)})

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words; -1 if the shard does not have the word."""
        if not len(self.words):
            return np.full(hashes.shape, -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, -1)

    def _ones_before(self, level: int, at: np.ndarray) -> np.ndarray:
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        below = self.bits[level, block] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.ones[level, block] + np.bitwise_count(below)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the last column before each place."""
        levels = len(self.zeros)
        low = np.zeros_like(at)
        for level in range(levels):
            bit = (symbols >> (levels - 1 - level)) & 1 == 1
            up, up_low = self._ones_before(level, at), self._ones_before(level, low)
            at = np.where(bit, self.zeros[level] + up, at - up)
            low = np.where(bit, self.zeros[level] + up_low, low - up_low)
        return at - low

    def step_back(self, at: np.ndarray) -> np.ndarray:
        """The place, among the sorted suffixes, of the suffix that is one word longer."""
        levels = len(self.zeros)
        symbol = np.zeros_like(at)
        low = np.zeros_like(at)
        place = at
        for level in range(levels):
            block, rest = place >> 6, (place & 63).astype(np.uint64)
            bit = (self.bits[level, block] >> rest) & np.uint64(1) == 1
            up, up_low = self._ones_before(level, place), self._ones_before(level, low)
            place = np.where(bit, self.zeros[level] + up, place - up)
            low = np.where(bit, self.zeros[level] + up_low, low - up_low)
            symbol = (symbol << 1) | bit
        return self.first[symbol] + place - low

    def find(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of sorted suffixes that start with each pattern (rows of word hashes, right-padded)."""
        symbols = self.symbols_of(patterns)
        width = patterns.shape[1]
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.first[-1], dtype=np.int64)
        known = ((symbols >= 0) | (np.arange(width) >= lengths[:, None])).all(axis=1)
        high[~known] = 0
        for back in range(width):
            live = np.flatnonzero((high > low) & (lengths > back))
            if not len(live):
                break
            symbol = symbols[live, lengths[live] - 1 - back]
            low[live] = self.first[symbol] + self.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions in the text of sorted suffixes."""
        out = np.zeros(len(at), dtype=np.int64)
        steps = np.zeros(len(at), dtype=np.int64)
        left = np.arange(len(at))
        place = at.copy()
        while len(left):
            block, rest = place >> 6, (place & 63).astype(np.uint64)
            known = (self.marked[block] >> rest) & np.uint64(1) == 1
            below = self.marked[block] & ((np.uint64(1) << rest) - np.uint64(1))
            slot = self.marked_before[block] + np.bitwise_count(below)
            done = left[known]
            out[done] = self.positions[slot[known]] + steps[done]
            left, place = left[~known], place[~known]
            place = self.step_back(place)
            steps[left] += 1
        return out
