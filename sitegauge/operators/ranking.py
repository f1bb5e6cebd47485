"""First-to-last change per entity, and ranks over all entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sitegauge.functions.numeric import percent_span
from sitegauge.sources.workdir import stored

#: Rows that one task sorts, or joins for one value.
ROWS_PER_TASK = 1_000_000
# A row's place in its file of the stored table, the number of the ranked column, and its rank.
AT, OF, RANK = "_at", "_column", "_rank"


def first_last(
    series: DataFrame, value: str, first: str, last: str, entity: str = "domain",
    period: str = "month",
) -> DataFrame:
    """Value in the first and in the last period, one row per entity; NULL values count.

    An aggregate and not a window: rows shrink before the shuffle, and a hot entity arrives as
    one row per task.
    """
    return series.groupBy(entity).agg(
        F.min_by(value, period).alias(first), F.max_by(value, period).alias(last)
    )


def visit_growth(series: DataFrame, entity: str = "domain", period: str = "month",
                 value: str = "visits") -> DataFrame:
    """Growth over the whole period in percent."""
    ends = first_last(series, value, f"first_{period}_{value}", f"last_{period}_{value}", entity, period)
    growth = percent_span(F.col(f"first_{period}_{value}"), F.col(f"last_{period}_{value}"))
    return ends.withColumn("visit_growth", growth)


def rank_delta(series: DataFrame, entity: str = "domain", period: str = "month",
               value: str = "rank") -> DataFrame:
    """Rank improvement over the whole period; above zero is better."""
    ends = first_last(series, value, f"first_{period}_{value}", f"last_{period}_{value}", entity, period)
    delta = F.try_subtract(F.col(f"first_{period}_{value}"), F.col(f"last_{period}_{value}"))
    return ends.withColumn("rank_change", delta)


def metrics_join(visits: DataFrame, ranks: DataFrame, entity: str = "domain") -> DataFrame:
    """Both measures of the entities that have both series.

    Both sides come out of an aggregate on ``entity``, so they are already partitioned for the
    join, with one row per entity.
    """
    growth = visit_growth(visits, entity).select(entity, "visit_growth")
    delta = rank_delta(ranks, entity).select(entity, "rank_change")
    return growth.join(delta, entity, "inner")


def add_ranks(
    df: DataFrame, ranks: Mapping[str, str], partition_by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``rank()`` of columns, descending with NULL last: ``{output: column}``.

    Any type that Spark orders can be ranked. ``df`` is stored first, since it is read several
    times. The same steps at every size and for all columns at once: distinct values with their
    counts, one grouping set per column, in ranges sorted apart from each other
    (``value_ranks``), joined back to the rows (``join_by_value``).
    """
    base = stored(df, "ranked")
    ranked = base.withColumn(AT, F.col("_metadata.row_index"))
    values = list(dict.fromkeys(ranks.values()))
    placed = dealt(value_counts(base, values, partition_by), values, partition_by, rows_per_task)
    table = value_ranks(placed, values, partition_by).withColumnRenamed(RANK, "_ranked")
    for out, value in ranks.items():
        keys, mine = [*partition_by, value], F.col(OF) == values.index(value)
        own = table.where(mine).select(*keys, "_n", F.col("_ranked").alias(out))
        counts = placed.where(mine).select(*keys, "_n")
        ranked = join_by_value(ranked, counts, own, out, rows_per_task)
    return ranked.drop(AT)


def value_counts(df: DataFrame, values: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows ``_n`` of each value of each column, one pass over ``df``.

    ``OF`` is the number of the column in ``values``; the other columns of ``values`` are NULL in
    its rows. Map tasks count first, so a value held by a third of the rows is a row per task.
    """
    number = F.count("*").alias("_n")
    if len(values) == 1:
        return df.groupBy(*partition_by, *values).agg(number).withColumn(OF, F.lit(0))
    sets = [[*partition_by, value] for value in values]
    counted = df.groupingSets(sets, *partition_by, *values).agg(number, F.grouping_id().alias("_set"))
    # The bits of a set's number are those of the columns left out, the last column's lowest.
    every = (1 << len(values)) - 1
    bits = [every ^ (1 << (len(values) - 1 - at)) for at in range(len(values))]
    column = reduce(lambda rest, at: F.when(F.col("_set") == bits[at], at).otherwise(rest), range(1, len(values)), F.lit(0))
    return counted.withColumn(OF, column).drop("_set")


def dealt(
    counts: DataFrame, values: Sequence[str], partition_by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``value_counts`` with the number ``_range`` of the range that a value lies in.

    The values are dealt to ranges of about ``rows_per_task`` in the order of the columns and
    their ranks. The table is stored, so a task that runs again finds the same ranges.
    """
    seen = Observation()
    counts = stored(counts.observe(seen, F.count(F.lit(1)).alias("rows")), "counts")
    ranges = -(-max(1, seen.get["rows"]) // rows_per_task)
    if ranges == 1:
        return counts.withColumn("_range", F.lit(0))
    # Within the rows of a column only its own values differ.
    down = [F.col(value).desc_nulls_last() for value in values]
    ranged = counts.repartitionByRange(ranges, OF, *partition_by, *down)
    return stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")


def value_ranks(placed: DataFrame, values: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """``RANK`` beside the values of ``dealt``: ``rank()``, descending with NULL last.

    Equal values share a rank, so a value held by a third of the rows is one row here. Rank =
    rows in earlier ranges + rows above within the range + 1. What is summed over all ranges has
    one row per range, and one more per column and key of ``partition_by``.
    """
    keys = [OF, *partition_by]
    down = [F.col(value).desc_nulls_last() for value in values]
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    of = {key: f"_of_{key}" for key in (*keys, "_range")}
    above = (
        placed.groupBy(*of)
        .agg(F.sum("_n").alias("_rows"))
        .select(*of, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_above"))
        .withColumnsRenamed(of)
    )
    same = [F.col("_range") == F.col("_of__range")]
    same += [F.col(key).eqNullSafe(F.col(of[key])) for key in keys]
    inside = Window.partitionBy(*of).orderBy(*down).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(above, same)
        .select(*keys, *values, "_n", (F.col("_above") + F.col("_inside") + 1).cast("bigint").alias(RANK))
    )


def join_by_value(
    df: DataFrame, counts: DataFrame, table: DataFrame, out: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows of ``df`` with ``out`` of their keys in ``table``, NULL keys included.

    ``counts`` and ``table`` have the rows ``_n`` of each key in ``df``. A key with more than ``rows_per_task``
    is dealt to ``_n / rows_per_task`` tasks by the row's place ``AT`` in its file, which tells
    equal rows apart and stays the same when a task runs again; its entry of ``table`` goes to
    each of them. Fewer than rows / ``rows_per_task`` keys are that large, and their names and
    numbers of tasks are what is broadcast.
    """
    keys = [c for c in counts.columns if c != "_n"]
    names = {key: f"_key_{key}" for key in keys}
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
    tasks = F.ceil(F.col("_n") / rows_per_task).cast("int")
    hot = counts.where(F.col("_n") > rows_per_task).withColumnsRenamed(names)
    hot = hot.select(*names.values(), tasks.alias("_tasks"))
    salted = df.join(F.broadcast(hot), same, "left").select(
        *df.columns,
        F.coalesce(F.pmod(F.col(AT), F.col("_tasks")).cast("int"), F.lit(0)).alias("_salt"),
    )
    copies = table.withColumnsRenamed(names).select(*names.values(), out, F.explode(F.sequence(F.lit(0), tasks - 1)).alias("_copy"))
    return salted.join(copies, [*same, F.col("_salt") == F.col("_copy")]).select(*df.columns, out)


def relative_ranking(visits: DataFrame, ranks: DataFrame, entity: str = "domain",
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Entities ranked by growth and by rank improvement; the two ranks add up to the score.

    A NULL growth ranks last and counts in the score.
    """
    ranked = add_ranks(
        metrics_join(visits, ranks, entity),
        {"visits_rank": "visit_growth", "rank_improvement_rank": "rank_change"},
        rows_per_task=rows_per_task,
    )
    score: Column = F.col("visits_rank") + F.col("rank_improvement_rank")
    return ranked.withColumn("combined_rank", score)
