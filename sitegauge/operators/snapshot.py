"""One row per entity out of many: the latest scrape, or several sources put together.

Which row of an entity wins is found on a few narrow columns and the row's place in its file; the
winners' whole rows are fetched by that place afterwards. Rows that lose are never shuffled or
sorted with all their columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.sources.tables import hashable
from sitegauge.sources.workdir import stored

#: A row's file and its place in it.
PLACE = ("_file", "_row_index")


def with_place(scan: DataFrame) -> DataFrame:
    """A scan of files with the columns PLACE."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1])
    )


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's values, maps left out."""
    names = [f.name for f in df.schema if f.name not in PLACE and hashable(f.dataType)]
    return F.xxhash64(*(F.col(f"`{name}`") for name in names))


def latest_by_place(rows: DataFrame, entity: str, version: Sequence[str]) -> DataFrame:
    """The row with the largest ``version`` of each entity, for rows with the columns PLACE.

    Of equal versions the row with the largest hash of its values wins. Each task keeps one
    place per entity before the shuffle, so an entity scraped a million times reaches it as one
    narrow row per task. The winners are joined back by their place: Spark sends their places to
    the tasks that read the rows if these are few, else whole rows move once. Rows without an
    entity are not versions of each other: all of them stay.
    """
    known = rows.where(F.col(entity).isNotNull())
    order = F.struct(*(F.col(c) for c in version), row_hash(rows), *PLACE)
    winners = known.groupBy(entity).agg(F.max_by(F.struct(*PLACE), order).alias("_won")).select("_won.*")
    names = {c: f"{c}_won" for c in PLACE}
    same = [F.col(c) == F.col(won) for c, won in names.items()]
    found = known.join(winners.withColumnsRenamed(names), same, "left_semi")
    return found.unionByName(rows.where(F.col(entity).isNull())).drop(*PLACE)


def latest_snapshot(df: DataFrame, entity: str, version: Sequence[str]) -> DataFrame:
    """``latest_by_place`` for any frame, whose rows are stored first.

    The columns of ``version`` should tell any two rows of an entity apart, for instance scrape
    time and address.
    """
    return latest_by_place(with_place(stored(df, "scrapes")), entity, version)


def merge_sources(
    sources: Mapping[str, DataFrame], key: str, versions: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows of all sources put together by ``key``, a gap in one filled from the next.

    Sources are given in order of trust. A source may lack a column. The result names the
    sources of a key in ``sources``. Each source first gives one whole row per key: the one with
    the largest ``versions[source]``; without a version, the largest by a hash of the row, so
    that any run takes the same one. These few rows are joined by their key, source by source;
    columns may be of any type. Rows without a key belong to no other row: each stays as it is.
    """
    merged = alone = None
    names = list(sources)
    columns: list[str] = []
    for number, (name, source) in enumerate(sources.items()):
        version = list((versions or {}).get(name, ()))
        placed = with_place(stored(source, "source"))
        if not version:
            whole = F.xxhash64(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
            placed = placed.withColumn("_whole", whole)
        known = placed.where(F.col(key).isNotNull())
        one = latest_by_place(known, key, version or ["_whole"]).drop("_whole")
        own = {c: f"{number}_{c}" for c in one.columns if c != key}
        columns += [c for c in own if c not in columns]
        one = one.withColumnsRenamed(own).withColumn(f"{number}_", F.lit(name))
        merged = one if merged is None else merged.join(one, key, "full")
        lost = placed.where(F.col(key).isNull()).drop(*PLACE, "_whole").withColumn("sources", F.lit(name))
        alone = lost if alone is None else alone.unionByName(lost, allowMissingColumns=True)

    def first(column: str) -> Column:
        every = [f"{number}_{column}" for number in range(len(names))]
        return F.coalesce(*(F.col(c) for c in every if c in merged.columns)).alias(column)

    present = F.concat_ws("+", *(F.col(f"{number}_") for number in range(len(names))))
    return merged.select(key, *(first(c) for c in columns), present.alias("sources")).unionByName(alone)
