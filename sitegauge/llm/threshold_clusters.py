"""Clusters of vectors around centroids, each vector's nearest one found by the threshold algorithm.

For every dimension the centroids stand in a list sorted by their component. From a vector's own
component each list is walked outward, the nearer neighbour first, in all dimensions at once. A
centroid met for the first time gets its exact distance. One that no list has shown yet is at
least as far away, in every dimension, as that list's next entry (the frontier), so the squares
of the frontier's gaps bound its distance from below. The walk stops when that sum strictly
exceeds the best exact distance, so that a centroid at equal distance with a smaller number is
never missed, or when the lists have shown all centroids.

Components are whole numbers, floor(256 * x), and all arithmetic is exact. What the driver sees
is k centroids and their sums, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import frugal, shipped
from sitegauge.sources.workdir import stored

CENTROIDS, DIM, ROUNDS, SEED = 40, 64, 5, 2
# Vectors that walk their lists together.
BLOCK = 256


def largest_component(dim: int) -> int:
    """Whole components up to this give squared distances below 2^62; no more than an int holds."""
    return min(isqrt((1 << 62) // (4 * dim)), (1 << 31) - 1)


def whole_vectors(table: DataFrame, dim: int = DIM) -> DataFrame:
    """``vec_id`` and ``v`` of the vectors with ``dim`` components, none NULL or not finite.

    A component beyond ``largest_component`` stops the job with a message that says so: distances
    would not fit in 64 bits.
    """
    # x - x is 0 unless x is infinite or NaN.
    finite = F.forall("embedding", lambda x: F.coalesce(x.cast("double") - x.cast("double") == 0, F.lit(False)))
    most = largest_component(dim)

    def whole(x):
        scaled = x.cast("double") * 256
        fits = (scaled >= -most) & (scaled < most)
        refused = F.raise_error(F.lit(f"a component beyond {most / 256} in absolute value")).cast("int")
        return F.when(fits, F.floor(scaled).cast("int")).otherwise(refused)

    kept = table.where(F.col("embedding").isNotNull() & (F.size("embedding") == dim) & finite)
    return kept.select("vec_id", F.transform("embedding", whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest hash of their id; those with equal ids by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(name, 256), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and distances computed."""
    n, k = len(x), len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(x.shape[1])
    far = np.iinfo(np.int64).max
    distance = np.full((n, k), far)
    left = np.stack([np.searchsorted(lists[:, d], x[:, d]) for d in dims], axis=1) - 1
    right = left + 1
    live, computed = np.arange(n), 0

    def gaps(rows):
        own, lo, hi = x[rows], left[rows], right[rows]
        below = np.where(lo >= 0, own - lists[np.maximum(lo, 0), dims], far)
        above = np.where(hi < k, lists[np.minimum(hi, k - 1), dims] - own, far)
        return below, above

    below, above = gaps(live)
    while len(live):
        # Each list gives its nearer next entry.
        down = below <= above
        entry = np.where(down, left[live], right[live])
        shown = np.zeros((len(live), k), dtype=bool)
        np.put_along_axis(shown, order[entry, dims], True, axis=1)
        row, number = np.nonzero(shown & (distance[live] == far))
        gap = x[live[row]] - centroids[number]
        distance[live[row], number] = np.einsum("ij,ij->i", gap, gap)
        computed += len(row)
        left[live] -= down
        right[live] += ~down
        below, above = gaps(live)
        frontier = np.minimum(below, above)
        # A list at its end has shown every centroid.
        ended = (frontier == far).any(axis=1)
        frontier[ended] = 0
        bound = np.einsum("ij,ij->i", frontier, frontier)
        known = distance[live]
        going = ~ended & (bound <= known.min(axis=1)) & (known == far).any(axis=1)
        live, below, above = live[going], below[going], above[going]
    # The first of equal distances has the smallest number.
    number = distance.argmin(axis=1)
    return number, distance[np.arange(n), number], computed


def _matrices(batch: pa.RecordBatch, at: int, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    lists = batch.column(at)
    for first in range(0, batch.num_rows, BLOCK):
        part = lists.slice(first, BLOCK)
        yield first, part.flatten().to_numpy().astype(np.int64).reshape(-1, dim)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means; those without vectors stay."""
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for _, x in _matrices(batch, 0, dim):
                number, _, _ = nearest(x, centroids)
                np.add.at(sums, number, x)
                counts += np.bincount(number, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array(counts[some], pa.int64()),
                pa.FixedSizeListArray.from_arrays(pa.array(sums[some].reshape(-1)), dim).cast(pa.list_(pa.int64())),
            ],
            names=["cluster", "n", "sums"],
        )

    parts = shipped(vectors).select("v").mapInArrow(frugal(add), "cluster int, n long, sums array<long>")
    every = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dim)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *every).collect():
        out[row["cluster"]] = [row[f"s{d}"] // row["n"] for d in range(dim)]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of every vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    dim = centroids.shape[1]

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in _matrices(batch, 1, dim):
                number, distance, _ = nearest(x, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(x)), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    schema = f"vec_id {kind}, cluster int, distance long"
    return shipped(vectors).select("vec_id", "v").mapInArrow(frugal(name), schema)


def cluster(
    table: DataFrame, k: int = CENTROIDS, dim: int = DIM, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """One row per kept row of ``table`` (``vec_id``, ``embedding``): cluster, distances, sums.

    Kept are vectors with exactly ``dim`` components, none NULL or not finite; others, NULL and
    empty ones too, give no row. Rows that repeat an id or a vector are rows of their own; an id
    that is NULL hashes as empty text. Fewer than k vectors are as many centroids, and an empty
    table gives no rows. Ties go to the smaller number. Other columns are not looked at. A sum of
    distances that 64 bits cannot hold stops the job.
    """
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, dim), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in SUMS])
        return empty.withColumn("centroid_sha256", F.lit(""))
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    rows = stored(assigned(vectors, centroids), "clusters")
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    # At most k rows: one per centroid.
    ends = [
        (number, sums[number], sum(sums.values()), sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
        for number in sorted(sums)
    ]
    named = spark.createDataFrame(ends, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(named), "cluster").select("vec_id", "cluster", *SUMS, "centroid_sha256")


SUMS = ("distance", "cluster_inertia", "inertia")


def oracle(k: int = CENTROIDS, dim: int = DIM, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same by all distances, in DuckDB's SQL."""
    steps = [
        f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v
  FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, c, d FROM (
    SELECT r, vec_id, v, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
      SELECT p.r, p.vec_id, p.v, q.c, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.v, q.v)]) AS BIGINT) AS d
      FROM kept p, c{i} q)) WHERE place = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n
      FROM (SELECT c, unnest(range(1, {dim} + 1)) AS i, unnest(v) AS x FROM a{i}) GROUP BY c, i) GROUP BY c) n ON n.c = o.c)"""
            )
    return ",\n".join(steps) + f"""
SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(q.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} q ON q.c = a.c"""
