"""Completeness, classes of missing values, volumes."""

from pyspark.sql import functions as F

from sitegauge.operators import quality


def test_completeness(spark):
    df = spark.createDataFrame([("s", 1, None), ("s", None, None), ("t", 2, "x")], "source string, a int, b string")
    rows = quality.completeness_report(df, "source", ["a", "b"]).orderBy("source").collect()
    assert [tuple(r) for r in rows] == [("s", 2, 0.5, 0.0), ("t", 1, 1.0, 1.0)]


def test_missing_report(spark):
    df = spark.createDataFrame(
        [("s", 0, "", True), ("s", None, None, True), ("s", None, "x", False), ("s", 5, None, False)],
        "source string, visits int, bounce string, small boolean",
    )
    report = quality.missing_report(
        df, "source", {"visits": "number", "bounce": "text"}, {"visits": F.col("small")}
    )
    assert {(r.field, r["class"]): r.n_rows for r in report.collect()} == {
        ("visits", "implicitly_missing"): 1, ("visits", "expectedly_missing"): 1,
        ("visits", "truly_missing"): 1, ("visits", "present"): 1,
        ("bounce", "implicitly_missing"): 1, ("bounce", "truly_missing"): 2, ("bounce", "present"): 1,
    }


def test_volume_check(spark):
    actual = spark.createDataFrame([("a", 10), ("b", 5), ("d", 2)], "k string, n_actual bigint")
    expected = spark.createDataFrame([("a", 10), ("b", 10), ("c", 4), ("e", 0)], "k string, n_expected bigint")
    rows = quality.volume_check(actual, expected, ["k"], 0.2).orderBy("k").collect()
    assert [(r.k, r.n_actual, r.n_expected, r.deviation, r.alert) for r in rows] == [
        ("a", 10, 10, 0.0, False), ("b", 5, 10, -0.5, True), ("c", 0, 4, -1.0, True),
        ("d", 2, 0, None, True), ("e", 0, 0, None, True),
    ]


def test_a_column_with_a_colon_in_its_name(spark):
    df = spark.createDataFrame([("s", None), ("s", "x")], "source string, `a:b` string")
    rows = quality.missing_report(df, "source", {"a:b": "text"}).collect()
    assert {tuple(r) for r in rows} == {("s", "a:b", "truly_missing", 1), ("s", "a:b", "present", 1)}
