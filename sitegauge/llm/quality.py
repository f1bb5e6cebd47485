"""Quality of a text by a sparse ensemble of rules.

Statistics of the whole text are Spark expressions. Shallow trees, fitted on a bounded sample
of labelled rows, give conjunctions of comparisons as rules; a lasso logistic regression picks
a few and weighs them; the ones left become one Spark expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import remainder
from sitegauge.llm.linear import lasso_logistic

#: Labelled rows that are brought to the driver, as statistics.
SAMPLE = 8_000
TREES = 40
DEPTH = 3
CUTS = 24
PENALTY = 2e-3
THRESHOLD = 0.7

Test = tuple[int, bool, float]  # statistic, whether above, value
Rule = tuple[Test, ...]


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; NULL and empty texts have 0 everywhere."""
    body = F.coalesce(text, F.lit(""))
    length = F.length(body)
    words = F.filter(F.split(body, r"[ \t\n\r]+"), lambda w: w != "")
    n_words = F.size(words)
    lines = F.split(body, "\n")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    def without(signs: str) -> Column:
        return length - F.length(F.translate(body, signs, ""))

    return {
        "n_words": n_words.cast("double"),
        "word_length": share(length, n_words),
        "distinct": share(F.size(F.array_distinct(words)), n_words),
        "upper": share(without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), length),
        "digits": share(without("0123456789"), length),
        "stops": share(without(".,;:?"), length),
        "marks": share(without("!#$%&*@^~+=<>|\\/_{}[]"), length),
        "lines": share(F.size(lines), n_words),
        "line_copies": share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "quotes": share(without("\"'()"), length),
    }


@dataclass
class RuleModel:
    rules: list[Rule]
    weights: list[float]
    constant: float

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as a Spark expression over statistics."""
        names = list(stats)
        total = F.lit(self.constant)
        for rule, weight in zip(self.rules, self.weights):
            holds = F.lit(True)
            for at, above, value in rule:
                holds = holds & ((stats[names[at]] > value) if above else (stats[names[at]] <= value))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _tree(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], columns: np.ndarray, depth: int, path: Rule, out: set) -> None:
    """Adds the paths of a regression tree, from the root to every node, to ``out``."""
    if path:
        out.add(tuple(sorted(set(path))))
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return
    best = (1e-9, -1, 0.0)
    total, n = y.sum(), len(y)
    for c in columns:
        for value in cuts[c]:
            low = x[:, c] <= value
            k = int(low.sum())
            if 5 <= k <= n - 5:
                s = y[low].sum()
                gain = s * s / k + (total - s) ** 2 / (n - k) - total * total / n
                if gain > best[0]:
                    best = (gain, int(c), float(value))
    if best[1] < 0:
        return
    low = x[:, best[1]] <= best[2]
    for side, above in ((low, False), (~low, True)):
        _tree(x[side], y[side], cuts, columns, depth - 1, (*path, (best[1], above, best[2])), out)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 7) -> RuleModel:
    """Rules from trees on random halves of rows and statistics, weighed by the lasso."""
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    prior = float(np.log(rate / (1 - rate)))
    if len(y) < 20 or y.min() == y.max():
        return RuleModel([], [], prior)
    rng = np.random.default_rng(seed)
    quantiles = np.linspace(0, 1, CUTS + 2)[1:-1]
    cuts = [np.unique(np.round(np.quantile(x[:, c], quantiles), 6)) for c in range(x.shape[1])]
    paths: set[Rule] = set()
    for _ in range(TREES):
        rows = rng.choice(len(y), size=min(len(y), 2000), replace=False)
        columns = rng.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False)
        _tree(x[rows], y[rows], cuts, np.sort(columns), DEPTH, (), paths)
    rules = sorted(paths)
    holds = np.ones((len(y), len(rules)), dtype=np.float32)
    for j, rule in enumerate(rules):
        for c, above, value in rule:
            holds[:, j] *= (x[:, c] > value) if above else (x[:, c] <= value)
    if not rules:
        return RuleModel([], [], prior)
    weights, constant = lasso_logistic(holds, y, PENALTY)
    kept = np.flatnonzero(np.abs(weights) > 1e-3)
    return RuleModel([rules[j] for j in kept], [float(weights[j]) for j in kept], constant)


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> RuleModel:
    """Model from at most ``sample`` labelled rows, chosen by hash, for which ``learnable`` holds."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(learnable)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    n = marked.count()
    some = marked.where(draw < min(1.0, 0.9 * sample / max(n, 1))).select("doc_id", "quality").limit(sample)
    stats = statistics(F.col("text"))
    # At most ``sample`` rows are sent, so only their texts are looked at.
    body = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").limit(sample)
    rows = body.select("doc_id", "quality", *[c.alias(n) for n, c in stats.items()]).collect()
    rows.sort(key=lambda r: tuple(r))
    x = np.array([[r[n] for n in stats] for r in rows], dtype=float).reshape(-1, len(stats))
    return fit(x, np.array([float(r["quality"] > 0) for r in rows]))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row.

    Learns from labels of ids whose crc32 mod 4 is not 2; those with 2 are held out. Scores
    come from the text alone: NULL is scored as empty text. A label that is NULL is left out,
    repeated labels count as often as they stand there, and without labels every score is 0.5.
    """
    model = learn(docs, labels, remainder("doc_id", 4) != 2, sample)
    stats = statistics(F.col("text"))
    # The statistics are columns of their own first, so that each is computed once per row.
    wide = docs.select("doc_id", *[c.alias(n) for n, c in stats.items()])
    value = model.column({n: F.col(n) for n in stats})
    return (
        wide.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), value.alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )
