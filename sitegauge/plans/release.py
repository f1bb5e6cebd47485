"""Releases on a cadence: only what changed since the last one is worked out again.

The site table and all tables made of it are partitioned by a bucket of the entity. A release reads
the buckets that its rows fall into, and writes these anew; the files of all others stay.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitegauge.operators.snapshot import latest_snapshot, row_hash
from sitegauge.sources.workdir import folders, stored

SITES, BUCKET, BUCKETS = "source_data", "bucket", 64
# The bucket of rows without an entity.
NOBODY = -1


def bucket_of(entity: Column, buckets: int) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int"), F.lit(NOBODY))


def released(spark: SparkSession, target: str, name: str, schema: StructType) -> DataFrame:
    """The table ``name`` as the releases so far have left it; without rows before the first."""
    if not folders(spark, f"{target}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{target}/{name}").parquet(f"{target}/{name}")


def write_buckets(df: DataFrame, path: str) -> None:
    """The buckets of ``df`` in the place of those at ``path``; other buckets are not touched."""
    (
        df.repartition(BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def release(
    spark: SparkSession, target: str, rows: DataFrame, version: Sequence[str],
    tables: Mapping[str, Callable[[DataFrame], DataFrame]], entity: str = "domain", buckets: int = BUCKETS,
) -> dict[str, DataFrame]:
    """Add ``rows`` to the site table below ``target`` and make ``tables`` of what changed.

    The result is that of one release with the rows of all: of an entity the row with the largest
    ``version`` counts, whatever the order of the releases. ``tables`` are functions of site rows
    that work on each entity by itself and keep its column. ``buckets`` must stay the same from
    release to release. Rows without an entity are kept, equal ones once, and are in no other table.
    A release that failed half way is run again with the same rows.
    """
    new = stored(rows.withColumn(BUCKET, bucket_of(F.col(entity), buckets)), "release")
    # At most one number per bucket.
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
    old = released(spark, target, SITES, new.schema).where(F.col(BUCKET).isin(touched)).select(*new.columns)
    both = old.unionByName(new)
    named = latest_snapshot(both.where(F.col(entity).isNotNull()), entity, version)
    nameless = both.where(F.col(entity).isNull())
    nameless = latest_snapshot(nameless.withColumn("_same", row_hash(nameless)), "_same", version).drop("_same")
    # Stored before it is written where it was read.
    sites = stored(named.unionByName(nameless), "released")
    out = {SITES: sites}
    for name, build in tables.items():
        made = build(sites.where(F.col(entity).isNotNull()).drop(BUCKET))
        out[name] = made.withColumn(BUCKET, bucket_of(F.col(entity), buckets))
    frames = {}
    for name, frame in out.items():
        write_buckets(frame, f"{target}/{name}")
        frames[name] = released(spark, target, name, frame.schema)
    return frames
