"""Recall of passages: what training texts held after the same words.

A text is cut at anchors: the place after its first CONTEXT words, and places whose CONTEXT words
before have a hash of one kind, about one in 2^RARE. From an anchor up to the next one, or to the
text's end, is a passage. If training has the same words before an anchor elsewhere, the passage
is one that training held after them with a chance learned by gate, and any other text else. The
counts of passages grow with the corpus; Spark joins them to the blocks that hold their words.
"""

from __future__ import annotations

import numpy as np

from sitegauge.llm.common import mix

CONTEXT, RARE = 4, 6
#: Gates by the number of times that the words before were seen, in powers of two, and by whether
#: the passage before was one that had been seen (2), was not (1), or none could be (0).
POWERS = 8
GATES = 3 * POWERS
_STEP = np.uint64(0x9E3779B97F4A7C15)


def anchors(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, the hash of the words before each, and that with its passage.

    ``bounds`` are the documents' bounds among the words; none is empty.
    """
    n = len(hashes)
    if n <= CONTEXT:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        context = np.zeros(n - CONTEXT, dtype=np.uint64)
        for back in range(1, CONTEXT + 1):
            context += hashes[CONTEXT - back : n - back] * np.uint64(2 * back + 1)
        inside = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
        inside = inside[CONTEXT:]
        rare = (context * _STEP >> np.uint64(64 - RARE)) == 0
        chosen = np.flatnonzero((inside == CONTEXT) | (rare & (inside > CONTEXT)))
        at, context = chosen + CONTEXT, mix(context[chosen])
        starts = np.union1d(bounds[:-1], at)
        within = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        # A word counts by its place, as an odd multiple of its hash.
        passage = np.add.reduceat(hashes * (within.astype(np.uint64) * np.uint64(2) + np.uint64(1)), starts)
        passage = passage[np.searchsorted(starts, at)]
        return at, context, mix(passage + context * np.uint64(3))


def ends(places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First word after each anchor's passage."""
    doc = np.searchsorted(bounds, places, side="right")
    return np.minimum(np.append(places[1:], bounds[-1])[: len(places)], bounds[doc])


def chances(
    places: np.ndarray, pairs: np.ndarray, bounds: np.ndarray, train: np.ndarray, seen: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors whose words before stand elsewhere in training, their gates, and the passage's share.

    ``seen`` has a column (number among the block's different pairs, count of the pair, count of
    the words before) for the pairs that can matter. An anchor of a training document does not
    count itself.
    """
    unique, inverse = np.unique(pairs, return_inverse=True)
    counts = np.zeros((2, len(unique)), dtype=np.int64)
    counts[:, seen[0]] = seen[1:]
    doc = np.searchsorted(bounds, places, side="right") - 1
    pair, total = np.maximum(counts[:, inverse] - train[doc], 0)
    known = np.flatnonzero(total > 0)
    pair, total, doc = pair[known], total[known], doc[known]
    previous = np.zeros(len(known), dtype=np.int64)
    previous[1:] = np.where(doc[1:] == doc[:-1], 1 + (pair[:-1] > 0), 0)
    power = np.minimum(np.log2(total).astype(np.int64), POWERS - 1)
    return known, power * 3 + previous, pair / total


def gain(mixed: np.ndarray, share: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """What recall adds to the natural log ``mixed`` of a passage's probability.

    The passage's probability is chance * share + (1 - chance) * exp(mixed).
    """
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log1p(-chance), np.log(chance * share) - mixed)
