"""Online logistic mixing of hashed-context bit predictors over words.

A word is a path of bits in a binary code: frequent words have codes of their own, all others
share one escape. Each bit is predicted by several predictors, whose contexts are hashed to
counts of zeros and ones. Their predictions, as logits, are added with weights that a gate
picks by the bit's depth; the weights follow the coding error from bit to bit, and a map from
prediction to probability refines the result the same way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

from sitegauge.llm.common import mix

#: Words with a code of their own, and frequent ones that count as a text's anchor.
CODED, ANCHORS = 4095, 64
#: Slots of the predictors: by node alone; by last anchor, by last word, by last two words.
SLOTS = (1 << 13, 1 << 19, 1 << 19, 1 << 20)
OFFSETS = tuple(int(x) for x in np.cumsum((0, *SLOTS)))
TOTAL = OFFSETS[-1]
INPUTS = len(SLOTS) + 1  # and a constant

GATES = 8
START, RATE = 0.35, 0.02
MAP_CELLS, MAP_RATE, MAP_REACH = 17, 0.02, 8.0
#: Bits after which a lane starts again from the trained weights, and lanes worked on at once.
LANE_BITS, LANES = 1024, 4096
# Bits of the lanes that are laid out at once.
LAID_OUT = 128
PRIOR = 0.4


@dataclass
class Code:
    """Paths of symbols 0 (escape) to n: ``nodes`` and ``bits`` from ``offsets[s]`` on."""

    offsets: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray

    @classmethod
    def build(cls, counts: np.ndarray) -> Code:
        """Binary code with the least mean length for these counts; ties go to earlier symbols."""
        counts = np.maximum(np.asarray(counts, dtype=float), 0.5)
        if len(counts) == 1:
            return cls(np.array([0, 0]), np.zeros(0, np.int64), np.zeros(0, np.int64))
        heap = [(c, s, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        node = len(counts)
        while len(heap) > 1:
            (c0, _, left), (c1, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            parent[left], parent[right] = (node, 0), (node, 1)
            heapq.heappush(heap, (c0 + c1, node, node))
            node += 1
        root = node - 1
        nodes, bits, offsets = [], [], [0]
        for symbol in range(len(counts)):
            path, at = [], symbol
            while at != root:
                at, bit = parent[at]
                path.append((root - at, bit))
            nodes += [p[0] for p in reversed(path)]
            bits += [p[1] for p in reversed(path)]
            offsets.append(len(nodes))
        return cls(np.array(offsets), np.array(nodes, dtype=np.int64), np.array(bits, dtype=np.int64))


@dataclass
class Events:
    """Bits of a run of words: slots by predictor, bit, depth, and the number of bits per word."""

    slots: list[np.ndarray]
    bits: np.ndarray
    depth: np.ndarray
    sizes: np.ndarray


def events(hashes: np.ndarray, symbols: np.ndarray, starts: np.ndarray, code: Code) -> Events:
    """``starts`` are the first words of documents; contexts do not cross them.

    The words given must begin with a document.
    """
    n = len(symbols)
    place = np.arange(n)
    first = np.zeros(n, dtype=np.int64)
    first[starts[starts < n]] = starts[starts < n]
    np.maximum.accumulate(first, out=first)
    # The last anchor before each word, within its document.
    anchor = np.where((symbols > 0) & (symbols <= ANCHORS), place, -1)
    last = np.concatenate([[-1], np.maximum.accumulate(anchor)[:-1]]) if n else anchor
    near = np.where(last >= first, symbols[np.maximum(last, 0)], 0).astype(np.uint64)
    one = np.where(place - 1 >= first, np.roll(hashes, 1), np.uint64(0))
    two = np.where(place - 2 >= first, np.roll(hashes, 2), np.uint64(0))
    with np.errstate(over="ignore"):
        contexts = [mix(near + np.uint64(11)), mix(one + np.uint64(13)), mix(mix(two + np.uint64(17)) + one)]
    sizes = np.diff(code.offsets)[symbols]
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(n, dtype=np.int32), sizes)
    depth = np.arange(len(word), dtype=np.int32) - (ends - sizes).astype(np.int32)[word]
    at = code.offsets[symbols].astype(np.int32)[word] + depth
    node = code.nodes.astype(np.int32)[at]
    # A slot is the context's hash, in which the node's own hash turns over some bits.
    spread = mix(np.arange(1, len(code.offsets) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    slots = [node]
    for context, size, offset in zip(contexts, SLOTS[1:], OFFSETS[1:]):
        shift = np.uint64(64 - size.bit_length() + 1)
        mine, turned = (context >> shift).astype(np.int32), (spread >> shift).astype(np.int32)
        slot = mine[word]
        slot ^= turned[node]
        slot += np.int32(offset)
        slots.append(slot)
    return Events(slots, code.bits.astype(np.int8)[at], depth.astype(np.int8), sizes)


def count_into(table: np.ndarray, found: Events) -> None:
    """Adds zeros and ones of all predictors to ``table`` (TOTAL rows, two columns)."""
    flat = table.reshape(-1)
    for slots, low, high in zip(found.slots, OFFSETS, OFFSETS[1:]):
        part = np.bincount((slots - low) * 2 + found.bits, minlength=2 * (high - low))
        flat[2 * low : 2 * high] += part.astype(table.dtype)


def logits_of(table: np.ndarray) -> np.ndarray:
    """Logit of a one by slot; 0 where nothing was counted."""
    return (np.log(table[:, 1] + PRIOR) - np.log(table[:, 0] + PRIOR)).astype(np.float32)


def logits_left_out(table: np.ndarray) -> np.ndarray:
    """Logits by slot as if one bit of it had not been counted: a zero in column 0, a one in column 1."""
    zero, one = np.log(table[:, 0] + PRIOR), np.log(table[:, 1] + PRIOR)
    less_zero, less_one = (np.log(np.maximum(table[:, bit] - 1, 0) + PRIOR) for bit in (0, 1))
    return np.stack([one - less_zero, less_one - zero], axis=1).astype(np.float32)


def left_out(logits: np.ndarray, found: Events) -> Iterator[np.ndarray]:
    """Logits by predictor without the bit itself, out of ``logits_left_out``."""
    flat = logits.reshape(-1)
    return (flat.take(slots * 2 + found.bits, mode="clip") for slots in found.slots)


def lanes_of(sizes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bit, number of bits and document of every lane.

    ``sizes`` are bits per word, ``docs`` the words' bounds of documents.
    """
    upto = np.concatenate([[0], np.cumsum(sizes)])[docs]
    length = np.diff(upto)
    pieces = -(-length // LANE_BITS)
    doc = np.repeat(np.arange(len(length)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = upto[:-1][doc] + piece * LANE_BITS
    return first, np.minimum(LANE_BITS, upto[1:][doc] - first), doc


def run_lanes(
    inputs: Iterable[np.ndarray],
    bits: np.ndarray,
    depth: np.ndarray,
    first: np.ndarray,
    length: np.ndarray,
    start: np.ndarray,
    logs: np.ndarray | None = None,
) -> np.ndarray:
    """The sum of the lanes' last weights; a lane counts in it as often as it has bits.

    ``logs``, if given, gets the natural log of the probability of every bit.

    All lanes go forward together, bit by bit; longer ones stand first, so that the live ones
    are always a prefix.
    """
    last = np.zeros((GATES, INPUTS))
    cells = np.linspace(-MAP_REACH, MAP_REACH, MAP_CELLS, dtype=np.float32)
    by_length = np.argsort(-length, kind="stable")

    def ahead(values: np.ndarray) -> np.ndarray:
        """The LAID_OUT values from each place on."""
        return sliding_window_view(np.concatenate([values, np.zeros(LAID_OUT, values.dtype)]), LAID_OUT)

    wide, wide_bits, wide_depth = [ahead(v) for v in inputs], ahead(bits), ahead(depth)
    for group in range(0, len(first), LANES):
        lane = by_length[group : group + LANES]
        n, steps = len(lane), int(length[lane[0]]) if len(lane) else 0
        live = np.searchsorted(-length[lane], -np.arange(steps), side="left")
        begin = first[lane]
        # By input, then by lane and gate.
        weights = np.tile(start.T.astype(np.float32), n)
        refined = np.tile(cells, n)
        base = np.arange(n) * MAP_CELLS
        for t in range(steps):
            k, row = live[t], t % LAID_OUT
            if row == 0:
                place, rows = begin[:k] + t, min(LAID_OUT, steps - t)
                x = np.full((rows, INPUTS, k), 0.3, dtype=np.float32)
                for i, values in enumerate(wide):
                    x[:, i] = values[place, :rows].T
                y = wide_bits[place, :rows].T.astype(np.float32, order="C")
                gate = np.minimum(wide_depth[place, :rows].T, GATES - 1) + np.arange(k)[None, :] * GATES
            xt, yt, at = x[row, :, :k], y[row, :k], gate[row, :k]
            w = weights.take(at, axis=1, mode="clip")
            z = np.clip((w * xt).sum(0), -MAP_REACH + 0.01, MAP_REACH - 0.01)
            p = 1 / (1 + np.exp(-z))
            w += (RATE * (yt - p)) * xt
            for i in range(INPUTS):
                weights[i][at] = w[i]
            if logs is None:
                continue
            near = ((z + MAP_REACH) * ((MAP_CELLS - 1) / (2 * MAP_REACH)) + 0.5).astype(np.int64)
            cell = base[:k] + near
            moved = refined.take(cell, mode="clip")
            q = 1 / (1 + np.exp(cells.take(near, mode="clip") - z - moved))
            refined[cell] = moved + MAP_RATE * (yt - q) * 4
            # The mean of both is the chance of a one; of a zero, it is what is left.
            logs[begin[:k] + t] = np.log(np.abs(1 - yt - (p + q) / 2))
        last += np.tensordot(weights.reshape(INPUTS, n, GATES), length[lane].astype(float), (1, 0)).T
    return last


def first_weights() -> np.ndarray:
    out = np.full((GATES, INPUTS), START)
    out[:, -1] = 0
    return out


