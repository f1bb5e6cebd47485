"""Changes from period to period."""

import pytest
from pyspark.sql import functions as F

from sitegauge.operators import series


def rows(df):
    return sorted(map(str, df.collect()))


def one_hot_entity(spark):
    """One entity with a third of all rows, days apart, some values and one entity NULL."""
    key = F.col("id")
    return spark.range(3_000).select(
        F.when(key % 3 == 0, "hot").when(key % 50 == 1, None).otherwise((key % 20).cast("string")).alias("domain"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key * 2).cast("int")).alias("month"),
        F.when(key % 4 != 0, key % 97).alias("visits"),
    )


@pytest.mark.parametrize("rows_per_task", [100, 999, 10_000])
def test_ranges_do_not_change_the_result(spark, rows_per_task):
    df = one_hot_entity(spark)
    cut = series.visit_changes(df, rows_per_task=rows_per_task)
    assert rows(cut) == rows(series.visit_changes(df))


def test_one_entity_and_day_is_spread_over_tasks(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    key = F.col("id")
    df = spark.range(4_000).select(
        F.lit("hot").alias("domain"), F.timestamp_seconds(key * 7).alias("month"), (key % 97).alias("visits")
    )
    changes = series.visit_changes(df, rows_per_task=250)
    assert df.select(F.to_date("month")).distinct().count() == 1
    sizes = [r["count"] for r in changes.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4_000 and max(sizes) < 1_500
    assert rows(changes) == rows(series.visit_changes(df))


def test_extreme_numbers_do_not_stop_the_job(spark):
    low, high = -(2**63), 2**63 - 1
    df = spark.createDataFrame(
        [("a", "2022-01-01", low, low), ("a", "2022-02-01", high, high)],
        "domain string, month string, visits bigint, rank bigint",
    )
    last = series.visit_changes(df.drop("rank")).orderBy("month").collect()[1]
    assert last["mom_growth_percent"] == pytest.approx(-200.0)
    assert series.rank_changes(df.drop("visits")).orderBy("month").collect()[1]["rank_change"] is None


def test_gaps_nulls_and_zero(spark):
    df = spark.createDataFrame(
        [("a", "2022-01-01", 10), ("a", "2022-03-01", None), ("a", "2022-04-01", 0), ("a", "2022-05-01", 4)],
        "domain string, month string, visits bigint",
    )
    got = [tuple(r)[2:] for r in series.visit_changes(df).orderBy("month").collect()]
    assert got == [(10, None, None), (None, 10, None), (0, None, None), (4, 0, None)]


def test_signs_of_rank_change(spark):
    df = spark.createDataFrame(
        [("a", "2022-01-01", 10), ("a", "2022-02-01", 15)], "domain string, month string, rank bigint"
    )
    assert tuple(series.rank_changes(df).orderBy("month").collect()[1])[2:] == (15, 10, -5, 50.0)


def test_filter_on_the_entity_reaches_the_scan(spark, plan_of, tmp_path):
    one_hot_entity(spark).write.parquet(str(tmp_path / "s"))
    changes = series.visit_changes(spark.read.parquet(str(tmp_path / "s")))
    plan = plan_of(changes.where("domain in ('hot', '3')"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "In(domain" in pushed
    plan = plan_of(changes.where("visits is not null"))
    assert "IsNotNull(visits)" not in plan
