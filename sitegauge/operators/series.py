"""Growth and rank change from one period of a series to the next.

A series has one row per entity and period. With a calendar period an entity then has at most
as many rows as the calendar has periods, however much data lies below the series, and one
window per entity stays small. For finer periods ``rows_per_task`` cuts the rows, in order, into
ranges of about that size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.functions.numeric import percent_step
from sitegauge.sources.workdir import stored


def previous_value(
    df: DataFrame, entity: str, period: str, value: str, out: str, rows_per_task: int | None = None
) -> DataFrame:
    """Value of the entity's row before this one, by position and not by calendar.

    With ``rows_per_task`` the rows are dealt to ranges in the order of entity and period and
    stored with the number of their range, so an entity of any length is spread over as many
    tasks as its rows need. Windows run within a range; the first row of an entity in a range
    takes the last value of the entity's range before, out of a table with one row per entity
    and range.
    """
    if rows_per_task is None:
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(entity).orderBy(period)))
    base = stored(df, "series")
    ranges = -(-max(1, base.count()) // rows_per_task)
    placed = stored(
        base.repartitionByRange(ranges, entity, period).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    across = Window.partitionBy("_of").orderBy("_in")
    # A struct, so that a last value of NULL is told from no row before.
    carried = (
        placed.groupBy(F.col(entity).alias("_of"), F.col("_range").alias("_in"))
        .agg(F.max_by(F.struct(F.col(value).alias("v")), period).alias("_last"))
        .select("_of", "_in", F.lag("_last").over(across).alias("_carried"))
    )
    inside = Window.partitionBy("_range", entity).orderBy(period)
    before = F.lag(F.struct(F.col(value).alias("v"))).over(inside)
    same = F.col(entity).eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in"))
    return (
        placed.withColumn("_before", before)
        .join(carried, same)
        .select(*df.columns, F.coalesce("_before", "_carried")["v"].alias(out))
    )


def visit_changes(
    series: DataFrame, entity: str = "domain", period: str = "month", value: str = "visits",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Each period's visits with those of the period before and the growth in percent."""
    prev = f"prev_{period}_{value}"
    return previous_value(series, entity, period, value, prev, rows_per_task).select(
        entity, period, value, prev,
        percent_step(F.col(value), F.col(prev)).alias("mom_growth_percent"),
    )


def rank_changes(
    series: DataFrame, entity: str = "domain", period: str = "month", value: str = "rank",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Each period's rank with the one before.

    The signs differ, as a small rank is a good one: ``rank_change`` is above zero when the
    entity got better, ``rank_change_percent`` when the number got larger.
    """
    prev = f"prev_{period}_{value}"
    return previous_value(series, entity, period, value, prev, rows_per_task).select(
        entity, period, value, prev,
        F.try_subtract(F.col(prev), F.col(value)).alias("rank_change"),
        percent_step(F.col(value), F.col(prev)).alias("rank_change_percent"),
    )
