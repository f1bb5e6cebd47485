"""Ranks by value ranges against ``rank()``, and first/last against windows."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitegauge.operators import ranking


def figures(spark, rows=20_000):
    """A third of the rows share one value, a seventh is NULL, the rest is heavy tailed."""
    key = F.col("id")
    wide = F.round((F.rand(3) - 0.5) * F.pow(F.lit(10.0), F.rand(4) * 7), 2)
    return spark.range(rows).select(
        key.cast("string").alias("domain"),
        F.when(key % 3 == 0, 1.5).when(key % 7 == 0, None).otherwise(wide).alias("growth"),
        F.when(key % 5 == 0, None).otherwise((F.rand(5) * 200).cast("bigint")).alias("change"),
        F.when(key % 4 == 0, None).otherwise(key % 3).alias("month"),
    )


def expected(df, value, partition_by=()):
    window = Window.partitionBy(*partition_by).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn("rank", F.rank().over(window).cast("bigint"))


def same_rows(left, right):
    assert left.columns == right.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("value", ["growth", "change"])
@pytest.mark.parametrize("partition_by", [(), ("month",)])
@pytest.mark.parametrize("limits", [{"rows_per_task": 500}, {}])
def test_equals_rank(spark, value, partition_by, limits):
    df = figures(spark)
    got = ranking.add_ranks(df, {"rank": value}, partition_by, **limits)
    same_rows(got, expected(df, value, partition_by))


def test_two_ranks_without_broadcasts_by_size(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    df = figures(spark, 3_000)
    got = ranking.add_ranks(
        df, {"a": "growth", "b": "change"}, rows_per_task=100
    )
    want = expected(expected(df, "growth").withColumnRenamed("rank", "a"), "change")
    same_rows(got, want.withColumnRenamed("rank", "b"))


@pytest.mark.parametrize("rows_per_task", [1, 7, 10_000])
def test_any_ranges_give_the_ranks(spark, rows_per_task):
    df = figures(spark, 2_000)
    counts = ranking.value_counts(df, ["growth", "change"])
    every = ranking.value_ranks(ranking.dealt(counts, ["growth", "change"], (), rows_per_task), ["growth", "change"])
    for number, name in enumerate(("growth", "change")):
        got = every.where(F.col(ranking.OF) == number).select(name, F.col(ranking.RANK).alias("rank"))
        same_rows(got, expected(df, name).select(name, "rank").distinct())


@pytest.mark.parametrize("kind", ["string", "boolean", "date", "decimal(9,2)", "struct<a:int,b:string>", "binary"])
def test_any_type_that_has_an_order(spark, kind):
    number = F.col("id") % 5
    value = {
        "string": F.concat(F.lit("v"), number), "boolean": number > 2,
        "date": F.date_add(F.lit("2020-01-01").cast("date"), number.cast("int")),
        "decimal(9,2)": (number / 4).cast(kind), "binary": F.encode(number.cast("string"), "utf-8"),
    }.get(kind, F.struct(number.cast("int").alias("a"), F.lit("x").alias("b")))
    df = spark.range(600).select("id", F.when(number != 3, value).alias("value"))
    got = ranking.add_ranks(df, {"rank": "value"}, rows_per_task=100)
    assert dict(got.dtypes)["value"] == dict(df.dtypes)["value"]
    same_rows(got, expected(df, "value"))


@pytest.mark.parametrize("values", [[], [None, None], [2.0, 2.0, 2.0], [float("nan"), 1.0, None, -0.0, 0.0]])
def test_odd_columns(spark, values):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "domain string, growth double")
    got = ranking.add_ranks(df, {"rank": "growth"}, rows_per_task=1)
    want = {r["domain"]: r["rank"] for r in expected(df, "growth").collect()}
    assert {r["domain"]: r["rank"] for r in got.collect()} == want


@pytest.mark.parametrize("columns", [["domain", "growth"], ["growth"]])
def test_hot_values_are_spread(spark, conf, columns):
    """A third of the rows on one value, equal rows too, go to tasks of a bounded size."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = figures(spark).select(*columns).count()
    joined = ranking.add_ranks(figures(spark).select(*columns), {"rank": "growth"}, rows_per_task=200)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == rows and max(sizes) < rows / 10


def test_no_task_sees_all_rows(spark, plan_of):
    df = figures(spark)
    counts = ranking.value_counts(df, ["growth", "change"])
    placed = ranking.dealt(counts, ["growth", "change"], (), 1000)
    assert placed.select("_range").distinct().count() > 5
    plan = plan_of(ranking.value_ranks(placed, ["growth", "change"]))
    # What is brought together by column alone are the sums of the ranges.
    by_column = [part for part in plan.split("\n\n") if re.search(r"hashpartitioning\(_column#\d+, \d+\)", part)]
    assert by_column and all("_rows" in part and "growth" not in part for part in by_column)
    plan += plan_of(ranking.add_ranks(df, {"rank": "growth", "other": "change"}, rows_per_task=1000))
    assert "SinglePartition" not in plan and "Nested" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("partition_by", [(), ("month",)])
def test_several_columns_in_one_pass(spark, partition_by):
    df = figures(spark, 3_000)
    ranks = {"a": "growth", "b": "change", "c": "domain", "d": "growth"}
    want = df
    for out, value in ranks.items():
        want = expected(want, value, partition_by).withColumnRenamed("rank", out)
    same_rows(ranking.add_ranks(df, ranks, partition_by, rows_per_task=200), want)


def test_first_last_equals_windows(spark):
    series = spark.range(5_000).select(
        (F.col("id") % 50).cast("string").alias("domain"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("month"),
        F.when(F.rand(1) > 0.3, (F.rand(2) * 100).cast("bigint")).alias("visits"),
    )
    window = Window.partitionBy("domain").orderBy("month")
    down = Window.partitionBy("domain").orderBy(F.desc("month"))
    want = series.select(
        "domain", F.first("visits").over(window).alias("first"), F.first("visits").over(down).alias("last")
    ).distinct()
    same_rows(ranking.first_last(series, "visits", "first", "last"), want)


def test_first_last_is_a_hash_aggregate_with_one_shuffle(spark, plan_of):
    key = F.col("id")
    series = spark.range(100).select(
        key.cast("string").alias("domain"),
        F.date_add(F.lit("2020-01-01").cast("date"), key.cast("int")).alias("month"),
        key.alias("visits"),
    )
    plan = plan_of(ranking.visit_growth(series))
    assert "SortAggregate" not in plan and "Window" not in plan
    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 1


def test_domain_without_both_series_is_left_out(spark):
    visits = spark.createDataFrame(
        [("a", "2022-10-01", 0), ("a", "2022-11-01", 5), ("b", "2022-10-01", 5)],
        "domain string, month string, visits bigint",
    )
    ranks = spark.createDataFrame([("a", "2022-10-01", 3)], "domain string, month string, rank bigint")
    rows = ranking.relative_ranking(visits, ranks).collect()
    assert [tuple(r) for r in rows] == [("a", None, 0, 1, 1, 2)]


def test_the_metrics_join_needs_no_shuffle_of_its_own(spark, conf, plan_of):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    key = F.col("id")
    series = spark.range(100).select(
        (key % 9).cast("string").alias("domain"),
        F.date_add(F.lit("2020-01-01").cast("date"), key.cast("int")).alias("month"),
        key.alias("visits"),
        (key % 5).alias("rank"),
    )
    plan = plan_of(ranking.metrics_join(series.drop("rank"), series.drop("visits")))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, flags=re.M)) == 2
