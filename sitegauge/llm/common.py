"""Helpers of the operators on texts: tables, words as hashes, whole documents in Arrow batches.

Words are found on the UTF-8 bytes of many documents at once. A word's identity is a 64-bit
hash of its bytes; two of n different words share one with a chance of about n * n / 2^65.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.session import ship

# Bytes of text worked on at once by the numpy helpers; one longer document is still whole.
CHUNK_BYTES = 1 << 20

#: Rows, and bytes, that Spark hands to a Python worker at once within ``small_batches``.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_500, "spark.sql.execution.arrow.maxBytesPerBatch": 2 << 20}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frugal(work):
    """``work`` on batches, after which the worker, which lives on, gives freed memory back."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return run


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounds the batches of the jobs that are run within, unless the session's own are smaller already."""
    own = {setting: spark.conf.get(setting) for setting in BATCHES}
    try:
        for setting, most in BATCHES.items():
            if not 0 < int(own[setting].rstrip("bB")) <= most:
                spark.conf.set(setting, str(most))
        yield
    finally:
        for setting, value in own.items():
            spark.conf.set(setting, value)


def shipped(df: DataFrame) -> DataFrame:
    """``df``, whose Python workers can import this package."""
    ship(df.sparkSession)
    return df


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; NULL counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 booleans, true for the bytes in the closed ranges."""
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Bytes of words between ASCII white space.
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of ASCII letters, digits and everything beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(int(_BASE), -1, 1 << 64)
            size = max(n, CHUNK_BYTES + 1)
            self.up, self.down = _powers(int(_BASE), size), _powers(inverse, size)
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit number over all."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of a run of documents: hash, first byte, end byte and the words' range per document."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of document i: bounds[i] up to bounds[i + 1]


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> Words:
    """Lower-cased (A-Z) words of documents that stand one after another in ``data``."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64))
    low = LOWER[data]
    inside = member[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _POWERS.get(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def chunks(
    texts: pa.Array, limit: int = CHUNK_BYTES, rows: int = 1 << 30
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of up to ``rows`` rows, of about ``limit`` bytes: first row, end row, their bytes, offsets.

    A NULL text counts as empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    raw = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    n = len(raw)
    if not n:
        return
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + n + 1]
    body = raw.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, row + rows, max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row i holds ``values[bounds[i]:bounds[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return x.view(np.int64)
