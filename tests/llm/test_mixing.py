"""The context mixing of whole texts against a version that goes bit by bit, and the choice of coded words."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitegauge.llm import lm_scoring, recall
from sitegauge.llm import context_mixing as cm
from sitegauge.llm.common import SPACED, words_of

END = "\0end"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text) + [END]


def squash(x):
    return 1 / (1 + math.exp(-x))


class ByBit:
    """Scores one bit after the other, contexts in dictionaries."""

    def __init__(self, training, coded):
        counts = collections.Counter(t for text in training for t in tokens(text))
        self.top = [w for w, _ in counts.most_common(coded)]
        assert len(set(counts.values())) == len(counts)  # no ties, whose order would be that of hashes
        rest = sum(counts.values()) - sum(counts[w] for w in self.top)
        self.code = cm.Code.build(np.array([rest, *[counts[w] for w in self.top]]))
        self.counts = [collections.defaultdict(lambda: [0, 0]) for _ in range(4)]
        for text in training:
            for contexts, bit, _ in self.bits(text):
                for table, c in zip(self.counts, contexts):
                    table[c][bit] += 1
        sums, n = np.zeros((cm.GATES, cm.INPUTS)), 0
        for text in training:
            for lane in self.lanes(text):
                last = self.run(lane, cm.first_weights(), 1)[1]
                sums, n = sums + len(lane) * last, n + len(lane)
        self.weights = sums / n
        unknown = len(counts) - len(self.top) + 1
        self.after = collections.defaultdict(collections.Counter)
        for text in training:
            for before, passage, _ in self.passages(text):
                self.after[before][passage] += 1
        self.again = collections.defaultdict(lambda: [0, 0])
        for text in training:
            for gate, share, _, _ in self.known(text, 1):
                self.again[gate][0] += share > 0
                self.again[gate][1] += 1
        self.plain = {w: math.log10((c + 0.5) / (rest + 0.5 * unknown)) for w, c in counts.items()}
        self.other = math.log10(0.5 / (rest + 0.5 * unknown))

    def bits(self, text):
        """(contexts by predictor, bit, depth) of all bits."""
        words, near = tokens(text), None
        for i, w in enumerate(words):
            symbol = self.top.index(w) + 1 if w in self.top else 0
            one, two = words[i - 1] if i > 0 else None, words[i - 2] if i > 1 else None
            a, b = self.code.offsets[symbol : symbol + 2]
            for depth, (node, bit) in enumerate(zip(self.code.nodes[a:b], self.code.bits[a:b])):
                yield (int(node), (near, node), (one, node), (two, one, node)), int(bit), depth
            if 0 < symbol <= cm.ANCHORS:
                near = symbol

    def lanes(self, text):
        every = list(self.bits(text))
        return [every[i : i + cm.LANE_BITS] for i in range(0, len(every), cm.LANE_BITS)]

    def run(self, lane, start, own):
        """Natural log of the lane's probability, its last weights and each bit's log; ``own`` is 1 to leave each bit's own count out."""
        weights = np.array(start, dtype=float)
        cells = np.linspace(-cm.MAP_REACH, cm.MAP_REACH, cm.MAP_CELLS)
        moved, logs = cells.copy(), []
        for contexts, bit, depth in lane:
            x = []
            for table, c in zip(self.counts, contexts):
                n = list(table[c])
                n[bit] = max(n[bit] - own, 0)
                x.append(math.log(n[1] + cm.PRIOR) - math.log(n[0] + cm.PRIOR))
            x, gate = np.array([*x, 0.3]), min(depth, cm.GATES - 1)
            z = min(max(weights[gate] @ x, -cm.MAP_REACH + 0.01), cm.MAP_REACH - 0.01)
            p = squash(z)
            weights[gate] += cm.RATE * (bit - p) * x
            cell = int((z + cm.MAP_REACH) * (cm.MAP_CELLS - 1) / (2 * cm.MAP_REACH) + 0.5)
            q = squash(z + moved[cell] - cells[cell])
            moved[cell] += cm.MAP_RATE * (bit - q) * 4
            p = (p + q) / 2
            logs.append(math.log(p if bit else 1 - p))
        return sum(logs), weights, logs

    def passages(self, text):
        """(words before, passage, its first word) for all anchors; only the anchors are the library's."""
        words, data = tokens(text), np.frombuffer(text.encode(), np.uint8)
        hashes = np.append(words_of(data, np.array([0, len(data)]), SPACED).hashes, lm_scoring.END_HASH)
        cuts = recall.anchors(hashes, np.array([0, len(words)]))[0].tolist()
        for at, end in zip(cuts, [*cuts[1:], len(words)]):
            yield tuple(words[at - recall.CONTEXT : at]), tuple(words[at:end]), at

    def known(self, text, own):
        """(gate, share, first word, end) of passages after words that stand elsewhere in training."""
        previous = 0
        for before, passage, at in self.passages(text):
            total, n = (x - own for x in (self.after[before].total(), self.after[before][passage]))
            if total > 0:
                yield (min(total.bit_length(), recall.POWERS), previous), max(n, 0) / total, at, at + len(passage)
                previous = 1 + (n > 0)

    def score(self, text, own):
        each, words = [], tokens(text)
        for lane in self.lanes(text):
            each += self.run(lane, self.weights, 0)[2]
        logs = []
        for w in words:
            symbol = self.top.index(w) + 1 if w in self.top else 0
            n = int(np.diff(self.code.offsets[symbol : symbol + 2])[0])
            logs.append(sum(each[:n]) / math.log(10) + (0 if symbol else self.plain.get(w, self.other)))
            each = each[n:]
        total = sum(logs)
        for gate, share, at, end in self.known(text, own):
            hits, n = self.again[gate]
            chance, mixed = (hits + 0.5) / (n + 1), sum(logs[at:end])
            total += math.log10(chance * share + (1 - chance) * 10**mixed) - mixed
        return total


@pytest.mark.parametrize("coded", [4095, 5])
def test_scores_equal_those_bit_by_bit(spark, monkeypatch, coded):
    monkeypatch.setattr(cm, "CODED", coded)
    rng = np.random.default_rng(3)
    words = "tree of the river and stone".split()
    rows = [(i, " ".join(rng.choice(words, int(n), p=[0.4, 0.25, 0.15, 0.1, 0.06, 0.04]))) for i, n in enumerate(rng.integers(0, 40, 30))]
    rows += [(50 + i, rows[5 + i % 3][1] + " unseen" * (i % 2)) for i in range(8)]
    rows += [(40, "river unseen unseen words of the tree"), (41, ""), (42, " ".join(rng.choice(words, 900)))]
    trained = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows}
    learned = [text for i, text in rows if trained[i]]
    model = ByBit(learned, coded)
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert got[i] == pytest.approx(model.score(text, int(trained[i])), rel=2e-4, abs=2e-4)


def test_left_out_logits_are_those_of_smaller_counts():
    rng = np.random.default_rng(1)
    table = rng.integers(0, 4, (50, 2))
    out = cm.logits_left_out(table)
    for bit in (0, 1):
        less = table.copy()
        less[:, bit] = np.maximum(less[:, bit] - 1, 0)
        assert (out[:, bit] == cm.logits_of(less)).all()


def test_as_many_codes_for_flat_vocabularies_of_any_size(spark):
    for size in (900_000, 1_200_000):
        words = spark.range(size).select(F.xxhash64("id").alias("hash"), F.lit(1).cast("long").alias("n"))
        top = lm_scoring.most_frequent(words, cm.CODED)
        assert len({r["hash"] for r in top}) == cm.CODED


@pytest.mark.parametrize("counts", ["1 + id % 3", "1 + CAST(100000 / (id + 1) AS LONG)", "id + 1", "7"])
def test_most_frequent_words_are_exact(spark, monkeypatch, counts):
    monkeypatch.setattr(lm_scoring, "SORTED_WORDS", 40)
    words = spark.range(5000).selectExpr("xxhash64(id) AS hash", f"CAST({counts} AS LONG) AS n")
    every = [(-r["n"], (r["hash"] & (1 << 64) - 1) >> 32, r["hash"]) for r in words.collect()]
    for k in (1, 30, 700, 6000):
        got = [(-r["n"], r["hash"]) for r in lm_scoring.most_frequent(words, k)]
        assert got == [(n, h) for n, _, h in sorted(every)[:k]]
    assert lm_scoring.most_frequent(words.limit(0), 5) == []


def test_recall_tells_texts_that_occur_twice_from_others(spark):
    """Every word pair is as frequent in single texts as in doubled ones; only longer passages tell them apart."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, 120)) for _ in range(400)]
    rows = list(enumerate(texts)) + [(1000 + i, texts[i]) for i in range(40)]
    got = lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    trained = {r["doc_id"] for r in got if not r["held_out"]}
    bits = {r["doc_id"]: r["bits_per_byte"] for r in got}
    twice = {i + more for i in range(40) for more in (0, 1000) if i + 1000 - more in trained}
    once = {i for i in bits if 40 <= i < 1000}
    assert max(bits[i] for i in twice) < 0.8 * min(bits[i] for i in once)


def test_passages_of_blocks_are_counted_over_all(spark, monkeypatch):
    """Scores do not depend on how documents fall into blocks."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 9, n))) for i, n in enumerate(rng.integers(0, 90, 60))]
    rows += [(100 + i, rows[i % 4][1]) for i in range(12)] + [(200, None), (201, ""), (202, "one"), (None, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted((r["doc_id"] or -1, r["score"]) for r in lm_scoring.score(docs.coalesce(1)).collect())
    many = sorted((r["doc_id"] or -1, r["score"]) for r in lm_scoring.score(docs.repartition(7, "doc_id", "text")).collect())
    assert [i for i, _ in one] == [i for i, _ in many]
    assert np.allclose([s for _, s in one], [s for _, s in many], rtol=1e-4)


def test_passages_follow_one_another():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    bounds = np.array([0, 1, 5, 10, 1500, 1504, 5000])
    places, context, pairs = recall.anchors(hashes, bounds)
    assert (np.diff(places) > 0).all()
    doc = np.searchsorted(bounds, places, side="right") - 1
    assert (places - bounds[doc] >= recall.CONTEXT).all()
    assert set(bounds[:-1][np.diff(bounds) > recall.CONTEXT] + recall.CONTEXT) <= set(places.tolist())
    ends = recall.ends(places, bounds)
    assert all(e == (p if d == c else bounds[d + 1]) for e, p, d, c in zip(ends[:-1], places[1:], doc[:-1], doc[1:]))
    assert ends[-1] == 5000
    again = recall.anchors(np.concatenate([hashes[10:1500], hashes[10:1500]]), np.array([0, 1490, 2980]))
    half = len(again[0]) // 2
    assert (again[1][:half] == again[1][half:]).all() and (again[2][:half] == again[2][half:]).all()
    assert recall.anchors(hashes[:3], np.array([0, 3]))[0].tolist() == []
