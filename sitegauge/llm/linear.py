"""Small linear models fitted on bounded samples with numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 120) -> np.ndarray:
    """Weights, the last one the constant, of a linear support vector machine (squared hinge).

    Rows of ``x`` have length at most 1, ``y`` is -1 or 1. Both classes weigh the same.
    Accelerated gradient steps of fixed size.
    """
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead, size = w.copy(), 1.0
    step = np.float32(1 / (penalty + 2 * 2.0))
    penalty = np.float32(penalty)
    for _ in range(steps):
        gap = np.maximum(0, 1 - y * (x @ ahead))
        slope = penalty * ahead - np.float32(2) * ((weight * y * gap) @ x)
        new = ahead - step * slope
        grown = (1 + np.sqrt(1 + 4 * size * size)) / 2
        ahead = new + np.float32((size - 1) / grown) * (new - w)
        w, size = new, grown
    return w


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities; targets are smoothed by class size."""
    target = platt_targets(len(y) - (y > 0).sum(), (y > 0).sum())[(y > 0).astype(np.int64)]
    size = float(np.std(margin)) or 1.0
    scaled = margin / size
    slope, shift = platt_by(lambda at: platt_sums(scaled, target, at), steps)
    return slope / size, shift


def platt_targets(low: int, high: int) -> np.ndarray:
    """Probabilities that rows of either class, of these sizes, are fitted to."""
    return np.array([1 / (low + 2), (high + 1) / (high + 2)])


def platt_sums(scaled: np.ndarray, target: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Loss at slope and shift ``at``, its two slopes and its three bends; sums of rows add up."""
    z = scaled * at[0] + at[1]
    p = logistic(z)
    r, v = p - target, np.maximum(p * (1 - p), 1e-9)
    vs = v * scaled
    return np.array(
        [(np.logaddexp(0, z) - target * z).sum(), (r * scaled).sum(), r.sum(), (vs * scaled).sum(), vs.sum(), v.sum()]
    )


def platt_by(sums: Callable[[np.ndarray], np.ndarray], steps: int = 100) -> tuple[float, float]:
    """Slope and shift of scaled margins, from the ``platt_sums`` of all rows at any place."""
    at = np.array([1.0, 0.0])
    now = sums(at)
    for _ in range(steps):
        move = np.linalg.solve(np.array([now[3:5], now[4:6]]) + 1e-6 * np.eye(2), now[1:3])
        part, then = 1.0, sums(at - move)
        while part > 1e-6 and then[0] > now[0]:
            part /= 2
            then = sums(at - part * move)
        at, now = at - part * move, then
        if np.abs(part * move).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def lasso_logistic(
    x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Sparse weights and constant: logistic loss plus ``penalty`` times the sum of weights' sizes."""
    n, d = x.shape
    x = x.astype(np.float32)
    y = y.astype(np.float32)
    w, b = np.zeros(d, dtype=np.float32), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_b, size = w.copy(), b, 1.0
    # The loss bends by no more than a quarter of the largest eigenvalue, the constant included.
    step = np.float32(4 / (float(np.linalg.eigvalsh((x.T @ x).astype(float) / n)[-1]) + 1))
    shrink = step * np.float32(penalty)
    for _ in range(steps):
        r = logistic(x @ ahead + np.float32(ahead_b)) - y
        new = ahead - step * (r @ x) / np.float32(n)
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        new_b = ahead_b - float(step) * float(r.mean())
        grown = (1 + np.sqrt(1 + 4 * size * size)) / 2
        ahead = new + np.float32((size - 1) / grown) * (new - w)
        ahead_b = new_b + (size - 1) / grown * (new_b - b)
        w, b, size = new, new_b, grown
    return w, b
