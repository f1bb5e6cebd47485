"""Releases, rules and counters of missing values, checks of a write, bounded frames, variants."""

import datetime as dt
import glob
import json
import os

import golden
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sitegauge.operators import quality
from sitegauge.operators.project import PathSpec, parse_spec, project_variants, variant_path
from sitegauge.operators.reshape import history_series
from sitegauge.operators.series import visit_changes
from sitegauge.plans import report
from sitegauge.plans.feeds import local_frame
from sitegauge.plans.release import release

ROWS = "domain string, visits_history map<string,bigint>, week int"
TABLES = {
    "series": lambda s: history_series(s, "visits_history", "visits"),
    "changes": lambda s: visit_changes(history_series(s, "visits_history", "visits")),
}


def weeks(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def plain(frames):
    return {name: sorted(map(str, f.drop("bucket").collect())) for name, f in frames.items()}


def test_a_release_equals_a_run_from_scratch(spark, tmp_path):
    first = [(f"d{i}", {"2022-10-01": i, "2022-11-01": 2 * i}, 1) for i in range(40)] + [(None, {"2022-10-01": 1}, 1)]
    second = [("d3", {"2022-10-01": 5, "2022-12-01": 50}, 2), ("new", {"2022-12-01": 1}, 2), (None, {"2022-10-01": 1}, 1)]
    late = [("d3", {"2022-01-01": 9}, 0), (None, None, 3)]
    target = str(tmp_path / "step")
    release(spark, target, weeks(spark, first), ["week"], TABLES)
    before = files(target)
    release(spark, target, weeks(spark, second), ["week"], TABLES)
    after = files(target)
    buckets = {os.path.dirname(f).rpartition("bucket=")[2] for f in set(after) - set(before)}
    # At most the buckets of three names; all other files are the same ones.
    assert buckets <= {os.path.dirname(f).rpartition("bucket=")[2] for f in after} and len(buckets) <= 3
    kept = {f for f in before if os.path.dirname(f).rpartition("bucket=")[2] not in buckets}
    assert len(kept) > 30 and all(after.get(f) == before[f] for f in kept)
    frames = release(spark, target, weeks(spark, late), ["week"], TABLES)
    whole = release(spark, str(tmp_path / "whole"), weeks(spark, first + second + late), ["week"], TABLES)
    assert plain(frames) == plain(whole)
    sites = {r.domain: r.week for r in frames["source_data"].where("domain IS NOT NULL").collect()}
    assert sites["d3"] == 2 and sites["d4"] == 1 and len(sites) == 41
    assert frames["source_data"].where("domain IS NULL").count() == 2


def test_a_release_without_rows_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    release(spark, target, weeks(spark, [("a", {"2022-10-01": 1}, 1)]), ["week"], TABLES)
    before = files(target)
    frames = release(spark, target, weeks(spark, []), ["week"], TABLES)
    assert files(target) == before and frames["series"].count() == 1


def test_pages_without_a_domain_all_stay(spark, tmp_path):
    text = golden.page("stripe.com").replace('"domain": "stripe.com"', '"domain": null')
    assert text != golden.page("stripe.com")
    moment = dt.datetime(2023, 1, 1)
    pages = [("a", text, moment), ("b", text, moment), ("c", golden.page("google.com"), moment), ("d", golden.page("google.com"), moment)]
    frames, status = report.run(
        spark, spark.createDataFrame(pages, "url string, html string, scraped_at timestamp"), str(tmp_path / "r"),
        more={"x": lambda f: f["nope"], "y": lambda f: 1 / 0},
    )
    assert sorted(str(r.domain) for r in frames["source_data"].collect()) == ["None", "None", "google.com"]
    assert status["x"] == "failed: KeyError: 'nope'" and status["y"].startswith("failed: ZeroDivisionError")
    assert status["relative_ranking"] == "created"


def test_rules_of_a_table(spark, conf):
    df = spark.createDataFrame(
        [("s", None, "a", 5.0), ("s", None, "a", 50.0), ("s", 0, "b", None), ("s", None, "b", None), ("s", 3, None, 1.0), ("t", None, None, 7.0)],
        "source string, visits int, kind string, size double",
    )
    schema = "priority int, field string, state string, other string, low double, high double, text string, class string"
    rules = spark.createDataFrame(
        [
            (2, "visits", "null", "size", None, 10.0, None, "small"), (1, "visits", None, "kind", None, None, "b", "b_site"),
            (3, "visits", "null", "size", 7.0, None, None, "large"), (1, "elsewhere", None, "no_such", None, None, None, "x"),
        ],
        schema,
    )
    want = {
        ("s", "visits", "small", 1), ("s", "visits", "large", 1), ("s", "visits", "b_site", 2), ("s", "visits", "present", 1),
        ("t", "visits", "small", 1), ("s", "kind", "present", 4), ("s", "kind", "truly_missing", 1), ("t", "kind", "truly_missing", 1),
    }
    kinds = {"visits": "number", "kind": "text"}
    assert {tuple(r) for r in quality.missing_by_rules(df, "source", kinds, rules).collect()} == want
    without = quality.missing_by_rules(df, "source", kinds, rules.limit(0))
    plain = quality.missing_report(df, "source", kinds)
    assert {tuple(r) for r in without.collect()} == {tuple(r) for r in plain.collect()}
    quality_limit, quality.SENT_RULES = quality.SENT_RULES, 0
    try:
        assert {tuple(r) for r in quality.missing_by_rules(df, "source", kinds, rules).collect()} == want
    finally:
        quality.SENT_RULES = quality_limit
    bad = spark.createDataFrame([(1, "visits", None, "no_such", None, None, "x", "y")], schema)
    with pytest.raises(ValueError, match="no_such"):
        quality.missing_by_rules(df, "source", kinds, bad)


def test_counters_over_batches(spark, tmp_path):
    store = str(tmp_path / "counters")
    assert quality.completeness_so_far(spark, store).collect() == []
    for batch in range(4):
        rows = spark.range(batch * 5000, batch * 5000 + 10_000).select(
            F.lit("s").alias("source"), F.when(F.col("id") % 4 != 0, F.col("id")).alias("value")
        )
        quality.add_counters(rows, store, str(batch), "source", ["value"])
    quality.add_counters(rows, store, "3", "source", ["value"])  # once more
    one = quality.completeness_so_far(spark, store).head()
    assert (one.n_rows, one.n_values, one.complete) == (40_000, 30_000, 0.75)
    # 25,000 ids, three quarters of which have a value; the sketch is good for some two per cent.
    assert abs(one.about_distinct - 18_750) < 0.05 * 18_750
    quality.forget_batch(spark, store, "3")
    assert quality.completeness_so_far(spark, store).head().n_rows == 30_000


def test_checks_of_a_write(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.when(F.col("id") % 10 != 0, F.col("id")))
    path = str(tmp_path / "t")
    checks = quality.watched_write(
        df, path, {"rows": F.count(F.lit(1)), "missing": F.count_if(F.col("x").isNull()), "none": F.max(F.lit(None).cast("int"))},
        {"rows": (100, 100), "missing": (None, 9), "none": (0, None), "absent": (1, None)},
    )
    got = {r.metric: (r.value, r.alert) for r in checks.collect()}
    assert got == {"rows": (100.0, False), "missing": (10.0, True), "none": (None, True), "absent": (None, True)}
    assert spark.read.parquet(path).count() == 100


def test_a_bounded_frame(spark):
    feed = spark.range(10).orderBy("id")
    for limit, more in ((0, True), (9, True), (10, False), (11, False)):
        found, left = local_frame(feed, limit)
        assert found.column("id").to_pylist() == list(range(min(limit, 10))) and left is more
    with pytest.raises(ValueError):
        local_frame(feed, -1)


def test_variants(spark):
    text = {"layout": {"data": {"domain": "a", "odd key": [1, {"x": [True, 2.5, None]}], "overview": {"pagesPerVisit": "no number"}}}}
    rows = [(json.dumps(text),), ("{",), (None,), ('{"layout": {"data": [5]}}',)]
    df = spark.createDataFrame(rows, "json string").withColumn("n", F.monotonically_increasing_id())
    specs = parse_spec(
        '[{"alias": "domain", "path": ["domain"]}, {"alias": "deep", "path": ["odd key", 1, "x", 1]},'
        ' {"alias": "own", "path": ["odd key", 1, "x"]}, {"alias": "pages", "path": ["overview", "pagesPerVisit"]}]',
        positions=True,
    )
    got = project_variants(df, "json", specs, types={"deep": DoubleType()}, keep=["n"])
    rows = got.select("domain", "deep", F.schema_of_variant("own").alias("kind"), "pages").collect()
    assert tuple(rows[0]) == ("a", 2.5, "ARRAY<VARIANT>", None)
    assert all(tuple(r) == (None,) * 4 for r in rows[1:])
    with pytest.raises(ValueError):
        parse_spec('[{"alias": "a", "path": ["b", 1]}]')
    with pytest.raises(ValueError):
        parse_spec('[{"alias": "a", "path": ["b", -1]}]', positions=True)
    with pytest.raises(ValueError):
        variant_path(["a'\""])
    odd = spark.createDataFrame([('{"it\'s": {"a.b": 1}}',)], "json string")
    one = project_variants(odd, "json", [PathSpec("v", ("it's", "a.b"))], root=(), types={"v": DoubleType()})
    assert one.head()[0] == 1.0
