"""Exact top-k search by inner product with a table of distances to pivots.

Components are whole numbers, floor(256 * x). For a query q and a row x, every pivot p gives
|d(q, p) - d(x, p)| <= d(q, x); the largest of these bounds d from below and so, by
2 q.x = |q|^2 + |x|^2 - d(q, x)^2, the score from above. Rows are evaluated in the order of
this bound until it falls below the k-th best score found, so that the result is exact.

Rows and queries travel in blocks of fixed size; every block of queries meets every block of
rows once. Before that all queries meet one block, whose k-th best score is what every other
block starts from. Vectors of different lengths are compared with missing components as 0.

Doubles hold all sums of vectors with |x|^2 < 2^53. Rows beyond that are in blocks of their own,
and whatever meets one of them is computed in whole numbers of any size; a score that a bigint
cannot hold stops the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import frugal, shipped
from sitegauge.sources.workdir import stored

PIVOTS = 32
ROW_BLOCK = 2048
QUERY_BLOCK = 512
FIRST_LOOK = 64

#: Squared lengths below this are exact in doubles, and so are all products of two such rows.
EXACT = float(1 << 53)

_BLOCK = "block long, exact boolean, dim int, n int, ids binary, vectors binary, distances binary"


def whole_vectors(table: DataFrame) -> DataFrame:
    """``vec_id``, ``v``, the floors as an array, and ``exact``, whether doubles hold its products.

    NULL or not finite components leave a row out, and so does a NULL ``vec_id``: such a row could
    neither be asked nor named.
    """

    def whole(x):
        scaled = x.cast("double") * 256
        # Beyond 2^53 every double is whole.
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    # A double's bits of infinity and NaN: x - x is 0 for all others.
    finite = F.forall(
        "embedding", lambda x: F.coalesce(x.cast("double") - x.cast("double") == 0, F.lit(False))
    )
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    return rows.withColumn("exact", square < EXACT)


def _padded(rows: list[np.ndarray], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    dim = max(vectors.shape[1], pivots.shape[1])
    a = np.pad(vectors, ((0, 0), (0, dim - vectors.shape[1])))
    b = np.pad(pivots, ((0, 0), (0, dim - pivots.shape[1])))
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def blocks(vectors: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """Vectors in blocks of up to ``size``, with their distances to the pivots.

    Rows that are not ``exact`` are in blocks of their own, without distances.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, exact in ((b, e) for b in batches for e in (True, False)):
            batch = whole.filter(pc.equal(whole.column(2), exact))
            ids = batch.column(0).to_numpy()
            lists = batch.column(1)
            for at in range(0, len(ids), size):
                rows = [np.asarray(x.values, dtype=float) for x in lists.slice(at, size)]
                dim = max(map(len, rows))
                matrix = _padded(rows, dim)
                part = ids[at : at + size]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([int(part[0])], pa.int64()),
                        "exact": pa.array([exact]),
                        "dim": pa.array([dim], pa.int32()),
                        "n": pa.array([len(part)], pa.int32()),
                        "ids": pa.array([part.astype(np.int64).tobytes()], pa.binary()),
                        "vectors": pa.array([matrix.astype(np.float64).tobytes()], pa.binary()),
                        "distances": pa.array([_distances(matrix, pivots).tobytes() if exact else b""], pa.binary()),
                    }
                )

    return shipped(vectors).select("vec_id", "v", "exact").mapInArrow(frugal(build), _BLOCK)


def best_of_block(
    q: np.ndarray, dq: np.ndarray, x: np.ndarray, dx: np.ndarray, ids: np.ndarray, own: int, k: int,
    start: float = -np.inf, squares: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best rows for one query, ties to smaller ids, and rows evaluated.

    ``start`` is the k-th best score known from elsewhere; rows below it are left out. ``squares``
    are the rows' squared lengths, if they are known.
    """
    squares = (x * x).sum(1) if squares is None else squares
    bound = np.abs(dx - dq).max(1) if dx.shape[1] else np.zeros(len(x))
    slack = 1e-9 * (1 + dq.max(initial=0) + dx.max(initial=0))
    low = np.maximum(bound - slack, 0)
    upper = ((q * q).sum() + squares - low * low) / 2
    # What the sums of doubles in the bound itself may be off by.
    upper += 1e-6 + 1e-12 * np.abs(upper)
    order = np.flatnonzero((upper >= start) & (ids != own))
    order = order[np.argsort(-upper[order], kind="stable")]
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    at, step = 0, FIRST_LOOK
    while at < len(order):
        least = max(start, best[-1] if len(best) == k else -np.inf)
        if upper[order[at]] < least:
            break
        # Of the next rows only those that can still be among the best.
        look = order[at : at + step]
        look = look[: np.searchsorted(-upper[look], -least, side="right")]
        best = np.concatenate([best, x[look] @ q])
        best_ids = np.concatenate([best_ids, ids[look]])
        top = np.lexsort((best_ids, -best))[:k]
        best, best_ids = best[top], best_ids[top]
        at, step = at + len(look), step * 2
    return best_ids, best, at


def best_in_whole_numbers(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows, every product computed in whole numbers of any size."""
    mine = [int(v) for v in q]
    scored = sorted((-sum(int(a) * b for a, b in zip(row, mine)), int(i)) for row, i in zip(x, ids) if i != own)[:k]
    if any(not -(1 << 63) <= -s < 1 << 63 for s, _ in scored):
        raise OverflowError("a score of the search is beyond 64 bits")
    return np.array([i for _, i in scored], dtype=np.int64), np.array([-s for s, _ in scored], dtype=np.int64)


def _side(row: dict, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, dim = row[f"{name}_n"], row[f"{name}_dim"]
    ids, vectors = np.frombuffer(row[f"{name}_ids"], dtype=np.int64), np.frombuffer(row[f"{name}_vectors"])
    distances = np.frombuffer(row[f"{name}_distances"])
    return ids, vectors.reshape(n, dim), distances.reshape(n, -1) if row[f"{name}_exact"] else np.zeros((n, 0))


def _pair(row: dict, k: int) -> tuple[np.ndarray, list[tuple], int]:
    """Ids of the queries, the best rows of the block for each, and rows evaluated."""
    (q_ids, q, dq), (x_ids, x, dx) = _side(row, "q"), _side(row, "x")
    dim = max(q.shape[1], x.shape[1])
    q = np.pad(q, ((0, 0), (0, dim - q.shape[1])))
    x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    if not (row["q_exact"] and row["x_exact"]):
        found = [best_in_whole_numbers(q[i], x, x_ids, q_ids[i], k) for i in range(len(q))]
        return q_ids, found, len(q) * len(x)
    starts = row.get("q_starts")
    starts = np.frombuffer(starts) if starts else np.full(len(q), -np.inf)
    squares = (x * x).sum(1)
    found = [best_of_block(q[i], dq[i], x, dx, x_ids, q_ids[i], k, starts[i], squares) for i in range(len(q))]
    return q_ids, [f[:2] for f in found], sum(f[2] for f in found)


NAMES = ["block", "exact", "dim", "n", "ids", "vectors", "distances"]


def with_starts(asked: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """Blocks of queries with ``starts``, the k-th best score of each in one block of rows.

    A query that finds fewer than k rows there starts from nothing. The block, ROW_BLOCK rows at
    most, goes to every task.
    """
    found = first.limit(1).collect()
    sent = asked.sparkSession.sparkContext.broadcast({f"x_{c}": found[0][c] for c in NAMES} if found else None)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.full(row["n"], -np.inf)
                if one and row["exact"]:
                    for i, (_, best) in enumerate(_pair({**one, **{f"q_{c}": row[c] for c in NAMES}}, k)[1]):
                        if len(best) == k:
                            starts[i] = best[-1]
                out = {c: pa.array([row[c]], kind) for c, kind in zip(NAMES, KINDS)}
                yield pa.RecordBatch.from_pydict({**out, "starts": pa.array([starts.tobytes()], pa.binary())})

    return shipped(asked).select(*NAMES).mapInArrow(frugal(look), f"{_BLOCK}, starts binary")


KINDS = (pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def top_k(table: DataFrame, queries: Column, k: int = 5, n_pivots: int = PIVOTS) -> DataFrame:
    """The k highest scores of every row for which ``queries`` holds, among all other rows.

    ``table`` has ``vec_id`` and ``embedding``. Columns: ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``. Ties go to the smaller ``vec_id``; rows that repeat a ``vec_id`` are
    candidates of their own, but never for a query of that id, and are asked once, with the
    smallest of their vectors. Fewer rows than k give all; an empty table gives none. Rows without a
    ``vec_id`` take no part. The pivots, ``n_pivots`` rows by hash, are all that the driver sees.
    """
    found = evaluated(table, queries, k, n_pivots).where("vec_id IS NOT NULL").drop("n_evaluated")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def evaluated(table: DataFrame, queries: Column, k: int, n_pivots: int = PIVOTS) -> DataFrame:
    """``query_id``, ``vec_id`` and ``score`` of what may be among the k best, block by block.

    A row without ``query_id`` has ``n_evaluated``, the number of products of one pair of blocks.
    """
    spark = table.sparkSession
    vectors = stored(whole_vectors(table), "vectors")
    chosen = vectors.where("exact").orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    rows = [np.asarray(r["v"], dtype=float) for r in chosen]
    pivots = _padded(rows, max(map(len, rows), default=0))
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    right = stored(blocks(vectors, pivots, ROW_BLOCK), "row_blocks")
    asked = vectors.where(queries).groupBy("vec_id").agg(F.min(F.struct("v", "exact")).alias("_q")).select("vec_id", "_q.*")
    left = with_starts(blocks(asked, pivots, QUERY_BLOCK), right.where("exact"), k)
    # Every block of queries against every block of rows: the slots only deal out the work.
    left = left.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<long>")))
    right = right.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)))
    pairs = left.select("slot", *[F.col(c).alias(f"q_{c}") for c in (*NAMES, "starts")]).join(
        right.select("slot", *[F.col(c).alias(f"x_{c}") for c in NAMES]).hint("shuffle_merge"), "slot"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, found, looked = _pair(row, k)
                n = [len(f[0]) for f in found]
                score = np.concatenate([f[1].astype(np.int64) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*np.repeat(q_ids, n).tolist(), None], pa.int64()),
                        pa.array([*np.concatenate([f[0] for f in found]).tolist(), None], pa.int64()),
                        pa.array([*score.tolist(), None], pa.int64()),
                        pa.array([None] * sum(n) + [looked], pa.int64()),
                    ],
                    names=["query_id", "vec_id", "score", "n_evaluated"],
                )

    return shipped(pairs.drop("slot")).mapInArrow(frugal(search), "query_id long, vec_id long, score long, n_evaluated long")
