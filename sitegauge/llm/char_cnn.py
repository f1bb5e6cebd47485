"""A small convolutional network over characters, in numpy.

Input is a row of character codes and a row of segments (0 none, 1 context, 2 candidate).
Characters and segments have learned vectors; filters of five characters run over their sum;
each filter's largest answer within the candidate, and within the context, feed one logit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from sitegauge.llm.linear import logistic, platt

CODES = 97  # 0 for none, 1 to 95 for printable ASCII, 96 for all else
SIZE, WIDTH, FILTERS = 12, 5, 24
BATCH = 128


def codes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    return np.where((raw >= 32) & (raw < 127), raw - 31, 96).astype(np.uint8)


@dataclass
class CharCnn:
    letters: np.ndarray
    segments: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    constant: np.ndarray

    @classmethod
    def new(cls, rng: np.random.Generator) -> CharCnn:
        def draw(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        return cls(
            draw(CODES, SIZE) * 3, draw(3, SIZE), draw(WIDTH * SIZE, FILTERS), np.zeros(FILTERS, np.float32),
            draw(2 * FILTERS), np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.letters, self.segments, self.filters, self.shift, self.out, self.constant]

    def flat(self) -> np.ndarray:
        """All parameters, one after another."""
        return np.concatenate([p.reshape(-1) for p in self.parameters()])

    def filled(self, flat: np.ndarray) -> CharCnn:
        """A network of this shape with the parameters one after another in ``flat``."""
        cuts = np.cumsum([p.size for p in self.parameters()])[:-1]
        return CharCnn(*[a.reshape(p.shape).copy() for a, p in zip(np.split(flat, cuts), self.parameters())])

    def _forward(self, x: np.ndarray, seg: np.ndarray):
        body = self.letters[x] + self.segments[seg]
        body[seg == 0] = 0
        view = np.lib.stride_tricks.sliding_window_view(body, WIDTH, axis=1)
        columns = np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(x), -1, WIDTH * SIZE)
        answers = np.maximum(columns @ self.filters + self.shift, 0)
        middle = seg[:, WIDTH // 2 : seg.shape[1] - WIDTH // 2]
        pooled, where = [], []
        for kind in (2, 1):
            part = np.where((middle == kind)[:, :, None], answers, 0)
            at = part.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(part, at[:, None, :], axis=1)[:, 0, :])
        hidden = np.concatenate(pooled, axis=1)
        return columns, where, hidden, hidden @ self.out + self.constant[0]

    def logits(self, x: np.ndarray, seg: np.ndarray) -> np.ndarray:
        parts = [self._forward(x[i : i + 512], seg[i : i + 512])[3] for i in range(0, len(x), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _slopes(
        self, x: np.ndarray, seg: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None
    ) -> list[np.ndarray]:
        columns, where, hidden, logit = self._forward(x, seg)
        n = len(x)
        d_logit = ((logistic(logit) - y) / n * (1 if weight is None else weight)).astype(np.float32)
        d_hidden = d_logit[:, None] * self.out[None, :] * (hidden > 0)
        d_filters, d_columns = np.zeros_like(self.filters), np.zeros_like(columns)
        d_shift = np.zeros_like(self.shift)
        rows = np.repeat(np.arange(n), FILTERS)
        for half in range(2):
            d = d_hidden[:, half * FILTERS : (half + 1) * FILTERS]
            at = where[half].reshape(-1)
            picked = columns[rows, at].reshape(n, FILTERS, -1)
            d_filters += np.einsum("nf,nfc->cf", d, picked)
            d_shift += d.sum(0)
            np.add.at(d_columns, (rows, at), (d[:, :, None] * self.filters.T[None]).reshape(n * FILTERS, -1))
        spread = d_columns.reshape(n, -1, WIDTH, SIZE)
        d_body = np.zeros((*x.shape, SIZE), dtype=np.float32)
        for i in range(WIDTH):
            d_body[:, i : i + spread.shape[1]] += spread[:, :, i]
        d_body[seg == 0] = 0
        d_letters, d_segments = np.zeros_like(self.letters), np.zeros_like(self.segments)
        np.add.at(d_letters, x.reshape(-1), d_body.reshape(-1, SIZE))
        np.add.at(d_segments, seg.reshape(-1), d_body.reshape(-1, SIZE))
        return [d_letters, d_segments, d_filters, d_shift, hidden.T @ d_logit, d_logit.sum(keepdims=True)]

    def train(
        self, x: np.ndarray, seg: np.ndarray, y: np.ndarray, epochs: int, rng: np.random.Generator,
        weight: np.ndarray | None = None,
    ) -> None:
        """Adam on shuffled batches; rows count by their ``weight``."""
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                step += 1
                slopes = self._slopes(x[rows], seg[rows], y[rows], None if weight is None else weight[rows])
                for p, g, m, v in zip(self.parameters(), slopes, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def keeping(found: np.ndarray, recall: float) -> float:
    """The largest threshold that keeps ``recall`` of the findings with these probabilities."""
    return just_below(np.sort(found)[lost(len(found), recall)])


def lost(n: int, recall: float) -> int:
    """How many of ``n`` findings may be lost."""
    # The product may lie a little below the whole number that it stands for, or above it.
    return int(np.floor(round((1 - recall) * n, 6)))


def just_below(score: float) -> float:
    return float(score) * (1 - 1e-6)


def calibrated(logits: np.ndarray, y: np.ndarray, recall: float, least: float = 0.5) -> tuple[float, float, float]:
    """Slope and shift of the probability, and the largest threshold that keeps ``recall``.

    The threshold is at least ``least``, which goes before the recall.
    """
    slope, shift = platt(logits, np.where(y > 0, 1.0, -1.0))
    found = logistic(slope * logits[y > 0] + shift)
    return slope, shift, max(least, keeping(found, recall) if len(found) else 1.0)
