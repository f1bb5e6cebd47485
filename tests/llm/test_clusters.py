"""Clusters by the threshold algorithm against all distances."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from oracle import difference

from sitegauge.llm import threshold_clusters as tc


def brute(rows, k, dim, rounds):
    """Rows of (id, list of whole components or None)."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in kept]
    name = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=name)[:k]]

    def own(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), number) for number, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(own(v)[1], []).append(v)
        for number, vs in groups.items():
            centroids[number] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, *own(v)) for i, v in kept]
    sums = {}
    for _, d, number in out:
        sums[number] = sums.get(number, 0) + d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), n, d, sums[n], sum(sums.values()), shas[n]) for i, d, n in out)


def got(df):
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((str(r["vec_id"]), *[r[c] for c in names]) for r in df.collect())


def table(spark, rows):
    out = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return out.selectExpr("*", "1 AS cluster", "'x' AS v", "2.5 AS distance", "map(1, 2) AS n")


@pytest.mark.parametrize("k,dim,seed", [(5, 3, 1), (40, 4, 2), (3, 1, 3)])
def test_clusters_against_all_distances(spark, k, dim, seed):
    rng = np.random.default_rng(seed)
    # Few different values: many ties between centroids, and negative ones for the floors.
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, dim) / 256]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, [0.5] * dim), (None, [0.25] * dim), (None, [-0.25] * dim)]
    rows += [(900, None), (901, []), (902, [0.0] * (dim + 1)), (903, [None] + [0.0] * (dim - 1))]
    rows += [(904, [float("nan")] * dim), (905, [float("inf")] + [0.0] * (dim - 1))]
    assert got(tc.cluster(table(spark, rows), k, dim, 5)) == brute(rows, k, dim, 5)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.1, 0.2]), (3, [5.0, -5.0])]
    assert got(tc.cluster(table(spark, rows), 40, 2, 5)) == brute(rows, 40, 2, 5)
    none = tc.cluster(table(spark, rows), 40, 64)
    assert none.collect() == [] and none.columns == tc.cluster(table(spark, rows), 40, 2).columns


def test_large_components_are_exact_or_refused(spark):
    most = tc.largest_component(2)
    edge = [(i, [(most / 256 - 1) * sign, (most / 256 - 1) * -sign]) for i, sign in enumerate((1, -1, 0.5, -0.25))]
    assert got(tc.cluster(table(spark, edge), 2, 2, 5)) == brute(edge, 2, 2, 5)
    with pytest.raises(Exception, match="a component beyond"):
        tc.cluster(table(spark, [*edge, (9, [most / 256 + 1, 0.0])]), 2, 2).collect()


def test_walk_stops_early_without_missing_ties():
    rng = np.random.default_rng(4)
    centroids = rng.integers(0, 8, (200, 2))
    x = rng.integers(-1, 9, (500, 2))
    number, distance, computed = tc.nearest(x, centroids)
    every = ((x[:, None] - centroids[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()
    # Centroids far apart in both dimensions: most are never measured.
    spread = np.arange(200)[:, None] * np.array([1000, 1000])
    _, _, few = tc.nearest(spread + 1, spread)
    assert few <= 3 * len(spread) and computed < x.shape[0] * 200


def test_sql_agrees(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=64)]) for i in range(120)] + [(500, None), (501, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    con = duckdb.connect()
    con.register("frame", df.toPandas())
    con.execute("CREATE VIEW embeddings AS SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM frame")
    assert difference(tc.cluster(df), con, tc.oracle()) == ""
