"""One query per operator over the given tables. ``oracles.py`` has the same in plain SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.functions.cleaning import abbreviated_number, clock_seconds, percent_text
from sitegauge.functions.html import first_capture, script_bodies
from sitegauge.functions.nested import json_objects, list_rows, map_rows, utc_date, whole_number
from sitegauge.operators import quality, ranking, series, snapshot
from sitegauge.operators.extract import documents, parse_pages
from sitegauge.operators.project import (
    DOCUMENT,
    SITE_SPEC,
    PathSpec,
    clean,
    document_type,
    flat_schema,
    flatten_nested,
    load_spec,
    project,
    project_variants,
    restore_nested,
    typed_sites,
)
from sitegauge.operators.reshape import (
    age_shares,
    country_shares,
    history_series,
    own_entries,
    own_rank_history,
)
from sitegauge.plans import feeds, report, testbed
from sitegauge.plans.release import release
from sitegauge.plans.testbed import table
from sitegauge.sources.pages import stored_pages, write_page_files
from sitegauge.sources.tables import read_csv, replace_table, write_csv
from sitegauge.sources.workdir import fresh_path, stored
from sitegauge.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

GROUP = ("Customer#000000001", "Customer#000000004", "Customer#000000007")
SINGLE = "Customer#000000010"
EXTREME = 100


def month_text(df: DataFrame, name: str = "month") -> DataFrame:
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd"))


# Pages and documents


def script_token_extract(spark: SparkSession, sf: str) -> DataFrame:
    """The scripts are found once, and both their number and the token are taken from them."""
    bodies = table(spark, sf, "pages").select("page_id", script_bodies(F.col("html")).alias("bodies"))
    return bodies.select(
        "page_id",
        F.size("bodies").alias("n_scripts"),
        first_capture(F.col("bodies"), "track(", r"track\((\d+)\)").alias("token"),
    )


def parsed_pages(spark: SparkSession, sf: str, ranked: bool = True) -> DataFrame:
    return parse_pages(testbed.site_pages(spark, sf, ranked), DOCUMENT, "content")


def embedded_json_extract(spark: SparkSession, sf: str) -> DataFrame:
    return report.site_rows(parsed_pages(spark, sf), keep=["page_id"]).select(
        "page_id",
        "domain",
        "global_rank",
        "total_visits",
        "bounce_rate_raw",
        "pages_per_visit",
        "avg_visit_duration_raw",
        "last_month_change",
        "bounce_rate_percent",
        "avg_visit_duration_seconds",
        sizes("visits_history_raw", "n_months"),
        sizes("rank_history_raw", "n_rivals"),
        sizes("top_countries_raw", "n_countries"),
        sizes("age_distribution_raw", "n_brackets"),
    )


def sizes(name: str, out: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.size(name)).cast("bigint").alias(out)


def bad_record_split(spark: SparkSession, sf: str) -> DataFrame:
    return parsed_pages(spark, sf, ranked=False).select(
        "page_id", F.coalesce("reason", F.lit("good")).alias("outcome")
    )


def specs(*aliases: str) -> list[PathSpec]:
    return [spec for spec in SITE_SPEC if not aliases or spec.alias in aliases]


def sites(spark: SparkSession, sf: str, *aliases: str) -> DataFrame:
    """Site rows of the JSON documents, or only some of their columns."""
    chosen = specs(*aliases)
    ranked = bool({s.alias for s in chosen} & {"global_rank", "rank_history_raw"})
    parsed = testbed.site_documents(spark, sf, ranked=ranked).select(
        json_objects(F.col("json"), document_type(chosen)).alias("parsed"),
        F.lit(None).cast("string").alias("reason"),
    )
    return clean(project(documents(parsed), chosen))


def project_paths(spark: SparkSession, sf: str) -> DataFrame:
    flat = ("domain", "global_rank", "total_visits", "bounce_rate_raw", "pages_per_visit",
            "avg_visit_duration_raw", "last_month_change")
    return sites(spark, sf, *flat).select(*flat)


def projection_file(spark: SparkSession, sf: str) -> DataFrame:
    """The list of columns comes from a file: declared paths, an undeclared one and its parent."""
    listed = [
        {"alias": "site", "path": ["domain"]},
        {"alias": "bounce", "path": ["overview", "bounceRateFormatted"]},
        {"alias": "pages", "path": ["overview", "pagesPerVisit"]},
        {"alias": "change", "path": ["traffic", "visitsTotalCountChange"]},
        {"alias": "nothing", "path": ["overview", "notThere"]},
        {"alias": "people", "path": ["demographics"]},
    ]
    path = fresh_path(spark, "projection")
    text = spark.createDataFrame([(json.dumps(listed, indent=1),)], "value string")
    text.coalesce(1).write.text(path)
    chosen = load_spec(spark, path)
    parsed = testbed.site_documents(spark, sf, ranked=False).select(
        json_objects(F.col("json"), document_type(chosen)).alias("parsed"),
        F.lit(None).cast("string").alias("reason"),
    )
    rows = project(documents(parsed), chosen)
    return rows.withColumn("people", F.size("people.ageDistribution").cast("bigint"))


def count_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that write their two counts as a number, in quotes, with .0 or abbreviated."""
    key = F.col("o_orderkey")
    whole = F.floor(F.col("o_totalprice")).cast("string")
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    spelled = (
        F.when(key % 4 == 0, whole)
        .when(key % 4 == 1, quoted(whole))
        .when(key % 4 == 2, F.concat(whole, F.lit(".0")))
        .otherwise(quoted(F.concat((key % 1000).cast("string"), F.lit(".5B"))))
    )
    text = F.concat(
        F.lit('{"layout":{"data":{"domain":"'), key.cast("string"),
        F.lit('","overview":{"globalRank":'), spelled, F.lit(',"visitsTotalCount":'), spelled, F.lit("}}}}"),
    )
    chosen = specs("domain", "global_rank", "total_visits")
    parsed = table(spark, sf, "orders").select(
        json_objects(text, document_type(chosen)).alias("parsed"),
        F.lit(None).cast("string").alias("reason"),
    )
    return clean(project(documents(parsed), chosen))


def country_fields(spark: SparkSession, sf: str) -> DataFrame:
    """All four fields of the countries, through the flat file's JSON text and back."""
    flat = flatten_nested(sites(spark, sf, "domain", "top_countries_raw"))
    kind = (
        "array<struct<countryAlpha2Code:string,countryUrlCode:string,"
        "visitsShare:double,visitsShareChange:double>>"
    )
    back = restore_nested(flat, {"top_countries_raw": kind})
    return list_rows(back, ["domain"], F.col("top_countries_raw")).select(
        "domain",
        F.col("countryAlpha2Code").alias("country"),
        F.col("countryUrlCode").alias("url_code"),
        F.col("visitsShare").alias("share"),
        F.col("visitsShareChange").alias("share_change"),
    )


def variant_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The list of columns comes from a file with positions of lists in its paths."""
    country = ["geography", "topCountriesTraffics"]
    listed = [
        {"alias": "site", "path": ["domain"]},
        {"alias": "first_country", "path": [*country, 0, "countryAlpha2Code"]},
        {"alias": "first_share", "path": [*country, 0, "visitsShare"]},
        {"alias": "third_country", "path": [*country, 2, "countryAlpha2Code"]},
        {"alias": "pages", "path": ["overview", "pagesPerVisit"]},
        {"alias": "oldest_from", "path": ["demographics", "ageDistribution", 5, "minAge"]},
        {"alias": "nothing", "path": ["overview", "notThere", 1]},
    ]
    path = fresh_path(spark, "variants")
    spark.createDataFrame([(json.dumps(listed, indent=1),)], "value string").coalesce(1).write.text(path)
    documents_of = testbed.site_documents(spark, sf, ranked=False)
    rows = project_variants(documents_of, "json", load_spec(spark, path, positions=True))
    return rows.withColumn("nothing", F.try_variant_get("nothing", "$", "string"))


def variant_own_types(spark: SparkSession, sf: str) -> DataFrame:
    """A path that nothing declares, with the type that each document gives it."""
    key = F.col("event_id") % 4
    props = F.when(key == 1, F.lit('{"k": "text"}')).when(key == 2, F.lit('{"k": [true, 7]}')).otherwise(F.col("props"))
    events = table(spark, sf, "events").select("event_id", F.when(key == 3, F.lit("{")).otherwise(props).alias("props"))
    specs_of = [PathSpec("k", ("k",)), PathSpec("second", ("k", 1))]
    found = project_variants(events, "props", specs_of, root=(), keep=["event_id"])
    return found.select(
        "event_id",
        F.schema_of_variant("k").alias("kind"),
        F.try_variant_get("k", "$", "bigint").alias("k"),
        F.try_variant_get("second", "$", "bigint").alias("second"),
    )


def json_scalar(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.array_join(F.json_object_keys("props"), ",").alias("keys"),
    )


# Cleaning


def percent_clean(spark: SparkSession, sf: str) -> DataFrame:
    percent = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    text = F.when(F.col("l_linenumber") == 4, "").otherwise(percent)
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber", text.alias("discount_raw"))
        .withColumn("discount_percent", percent_text(F.col("discount_raw")))
    )


def duration_to_seconds(spark: SparkSession, sf: str) -> DataFrame:
    event = F.col("event_id")
    text = (
        F.when(event % 7 == 0, "")
        .when(event % 11 == 0, "24:00:00")
        .when(event % 13 == 0, "n/a")
        .otherwise(F.date_format("ts", "HH:mm:ss"))
    )
    return (
        table(spark, sf, "events")
        .select("event_id", text.alias("clock"))
        .withColumn("seconds", clock_seconds(F.col("clock")))
    )


def abbrev_number(spark: SparkSession, sf: str) -> DataFrame:
    tenths = F.floor(F.col("o_totalprice") / 100)
    short = F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("K")
    )
    text = F.when(F.col("o_orderstatus") == "P", F.floor("o_totalprice").cast("string"))
    text = text.when(F.col("o_orderstatus") == "F", F.concat(short, F.lit("M"))).otherwise(short)
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", text.alias("short_price"))
        .withColumn("price", abbreviated_number(F.col("short_price")))
    )


# Nested fields


def nested_to_json(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten_nested(sites(spark, sf, "domain", "age_distribution_raw"))
    back = restore_nested(
        flat, {"age_distribution_raw": "array<struct<minAge:int,maxAge:int,value:double>>"}
    )
    return list_rows(back, ["domain"], F.col("age_distribution_raw")).select(
        "domain",
        F.col("minAge").alias("min_age"),
        F.col("maxAge").alias("max_age"),
        F.col("value").alias("share"),
    )


def share_map(spark: SparkSession, sf: str) -> DataFrame:
    shares = country_shares(F.col("top_countries_raw"))
    rows = sites(spark, sf, "domain", "top_countries_raw")
    return map_rows(rows, ["domain"], shares, "country", "share_percent")


def bracket_map(spark: SparkSession, sf: str) -> DataFrame:
    shares = age_shares(F.col("age_distribution_raw"))
    rows = sites(spark, sf, "domain", "age_distribution_raw")
    return map_rows(rows, ["domain"], shares, "bracket", "share_percent")


def own_history(spark: SparkSession, sf: str) -> DataFrame:
    history = own_rank_history(F.col("rank_history_raw"), F.col("domain"))
    rows = sites(spark, sf, "domain", "rank_history_raw")
    return map_rows(rows, ["domain"], history, "month", "rank")


def visits_history_explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = sites(spark, sf, "domain", "visits_history_raw")
    return month_text(history_series(rows, "visits_history_raw", "visits"))


def rank_history_explode(spark: SparkSession, sf: str) -> DataFrame:
    own = own_entries(F.col("rank_history_raw"), F.col("domain"))
    entries = list_rows(sites(spark, sf, "domain", "rank_history_raw"), ["domain"], own)
    return month_text(
        entries.select(
            "domain", utc_date(F.col("date")).alias("month"), whole_number(F.col("rank")).alias("rank")
        )
    )


# Series


def monthly_visit_changes(spark: SparkSession, sf: str) -> DataFrame:
    return month_text(series.visit_changes(testbed.visits_series(spark, sf)))


def monthly_rank_changes(spark: SparkSession, sf: str) -> DataFrame:
    return month_text(series.rank_changes(testbed.rank_series(spark, sf)))


def nation_visit_changes(spark: SparkSession, sf: str) -> DataFrame:
    return month_text(series.visit_changes(testbed.nation_visits(spark, sf)))


def nation_rank_changes(spark: SparkSession, sf: str) -> DataFrame:
    return month_text(series.rank_changes(testbed.nation_ranks(spark, sf)))


def long_series_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Five entities share all events, so each one's series is spread over ranges of rows."""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("domain"),
        F.struct("ts", "event_id").alias("moment"),
        F.floor(F.col("value") * 100).alias("visits"),
    )
    changes = series.visit_changes(events, period="moment", rows_per_task=ranking.ROWS_PER_TASK)
    return changes.select(
        "domain", F.col("moment.event_id").alias("event_id"), "visits",
        F.col("prev_moment_visits").alias("prev_visits"), "mom_growth_percent",
    )


# First to last, joins and ranks


def first_last_growth(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.visit_growth(testbed.visits_series(spark, sf))


def rank_delta(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.rank_delta(testbed.rank_series(spark, sf))


def both_series(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return testbed.visits_series(spark, sf), testbed.rank_series(spark, sf)


def metrics_join(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.metrics_join(*both_series(spark, sf))


def rank_desc_nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    """By value ranges, as at any size."""
    growth = first_last_growth(spark, sf).select("domain", "visit_growth")
    return ranking.add_ranks(growth, {"visits_rank": "visit_growth"})


def rank_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """By value ranges within each month, over all customers."""
    visits = testbed.visits_series(spark, sf).select("domain", "month", "visits")
    return month_text(ranking.add_ranks(visits, {"visits_rank": "visits"}, ["month"]))


def rank_text(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks of a text column and of a yes or no, the second with a few values for all rows."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_totalprice") > 100_000).alias("large")
    )
    ranks = {"priority_rank": "o_orderpriority", "large_rank": "large"}
    return ranking.add_ranks(orders, ranks)


def rank_one_column(spark: SparkSession, sf: str) -> DataFrame:
    """A frame of one column, most of its rows equal to many others."""
    flags = table(spark, sf, "lineitem").select(F.nullif("l_returnflag", F.lit("R")).alias("flag"))
    return ranking.add_ranks(flags, {"flag_rank": "flag"})


def relative_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.relative_ranking(*both_series(spark, sf)).orderBy("combined_rank", "domain")


def nation_relative_ranking(spark: SparkSession, sf: str) -> DataFrame:
    visits, ranks = testbed.nation_visits(spark, sf), testbed.nation_ranks(spark, sf)
    return ranking.relative_ranking(visits, ranks).orderBy("combined_rank", "domain")


# Feeds


def feed_visits_group(spark: SparkSession, sf: str) -> DataFrame:
    changes = series.visit_changes(testbed.visits_series(spark, sf))
    return month_text(feeds.series_feed(changes, GROUP, present="visits"))


def feed_visits_single(spark: SparkSession, sf: str) -> DataFrame:
    changes = series.visit_changes(testbed.visits_series(spark, sf))
    return month_text(feeds.series_feed(changes, [SINGLE], present="visits"))


def feed_rank_group(spark: SparkSession, sf: str) -> DataFrame:
    changes = series.rank_changes(testbed.rank_series(spark, sf))
    return month_text(feeds.series_feed(changes, GROUP))


def feed_rank_single(spark: SparkSession, sf: str) -> DataFrame:
    changes = series.rank_changes(testbed.rank_series(spark, sf))
    return month_text(feeds.series_feed(changes, [SINGLE]))


def feed_growth_sign(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.growth_feed(metrics_join(spark, sf))


def feed_rank_split(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.rank_change_feed(metrics_join(spark, sf), EXTREME)


def feed_combined(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.combined_feed(ranking.relative_ranking(*both_series(spark, sf)))


def feeds_of_report(spark: SparkSession, sf: str) -> DataFrame:
    """All feeds that have rows, one after another; the one of an unknown site is left out."""
    visits, ranks = both_series(spark, sf)
    made = {
        "monthly_visit_changes": series.visit_changes(visits),
        "monthly_rank_changes": series.rank_changes(ranks),
        "relative_ranking": ranking.relative_ranking(visits, ranks),
    }
    # Several feeds read each of them, once to see whether there is anything to draw.
    frames = {name: stored(frame, name) for name, frame in made.items()}
    groups = {"group": GROUP, "single": [SINGLE], "nobody": ["no such site"]}
    shown = {"growth": "visit_growth", "rank_change": "rank_change", "combined": "combined_rank"}
    every = None
    for name, feed in feeds.site_feeds(frames, groups, EXTREME).items():
        if not feeds.is_worth_drawing(feed):
            continue
        value = F.col(shown.get(name, name.partition("_")[0])).cast("double")
        one = feed.select(F.lit(name).alias("feed"), "domain", value.alias("value"))
        every = one if every is None else every.unionAll(one)
    return every


# Sinks and views


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All thirteen columns; the nested ones by their sizes and the sum of what is in them."""
    path = fresh_path(spark, "flat-csv")
    # Some names go over two lines.
    longer = F.concat("domain", F.lit('\nthe "second", line\r'))
    rows = sites(spark, sf).withColumn("domain", F.when(F.endswith("domain", F.lit("0")), longer).otherwise(F.col("domain")))
    write_csv(flatten_nested(rows), path)
    back = typed_sites(read_csv(spark, path, flat_schema()))
    add = lambda total, x: total + F.coalesce(x.cast("bigint"), F.lit(0))
    visits = F.aggregate(F.map_values("visits_history_raw"), F.lit(0).cast("bigint"), add)
    return back.select(
        "domain", "global_rank", "total_visits", "bounce_rate_raw", "bounce_rate_percent",
        "pages_per_visit", "avg_visit_duration_raw", "avg_visit_duration_seconds", "last_month_change",
        sizes("visits_history_raw", "n_months"),
        sizes("rank_history_raw", "n_rivals"),
        sizes("top_countries_raw", "n_countries"),
        sizes("age_distribution_raw", "n_brackets"),
        visits.alias("sum_visits"),
    )


def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A table by path, then one by name, which a replace that fails leaves as it was."""
    visits = testbed.visits_series(spark, sf)
    path = fresh_path(spark, "visits-series")
    by_path = replace_table(visits, path, cluster_by="domain")
    name = f"visits_series_{path[-32:]}"
    replace_table(by_path.where("visits > 0"), f"{path}-named", name)
    replace_table(by_path, f"{path}-named", name)
    broken = by_path.withColumn("visits", F.raise_error(F.lit("no good")).cast("bigint"))
    try:
        replace_table(broken, f"{path}-named", name)
    except PySparkException:
        return month_text(spark.table(name))
    raise ValueError("the broken table was made")


def page_file_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All pages as files of their own, scanned by their prefix into one table; none by another."""
    folder = fresh_path(spark, "page-files")
    html = table(spark, sf, "pages").select("html")
    # A line break within a page stays: each file is one page and the line break after it.
    write_page_files(html, folder)
    if not stored_pages(spark, folder, fresh_path(spark, "no-pages"), prefix="none", suffix=".txt").isEmpty():
        raise ValueError("files of another name were read")
    pages = stored_pages(spark, folder, fresh_path(spark, "pages"), prefix="part-", suffix=".txt")
    return pages.select(F.md5("content").alias("digest"), F.octet_length("content").cast("bigint").alias("n_bytes"))


def view_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to tables to views, then the rows of each view."""
    pages = testbed.site_pages(spark, sf)
    target = fresh_path(spark, "report")
    names, _ = report.run(spark, pages, target, content="content", version=["page_id"])
    counts = None
    for name in names:
        one = spark.table(name).agg(F.count("*").alias("n_rows"))
        one = one.select(F.lit(name).alias("view"), "n_rows")
        counts = one if counts is None else counts.unionAll(one)
    return counts


def report_contents(spark: SparkSession, sf: str) -> DataFrame:
    """The view of visit changes over pages that were scraped twice, the older ones without a
    history; an analysis that fails leaves it as it is."""
    pages = testbed.site_pages(spark, sf)
    text = F.replace(F.col("content").cast("string"), F.lit("visitsHistory"), F.lit("other"))
    # Pages that are no UTF-8 stay as they are.
    older = F.when(F.col("page_id") % 10 == 2, F.col("content")).otherwise(F.encode(text, "utf-8"))
    scrapes = [(F.col("content"), "2024-01-10"), (older, "2024-01-09")]
    bodies = pages.select(
        "page_id",
        F.explode(
            F.array(
                *(
                    F.struct(body.alias("content"), F.lit(day).cast("timestamp").alias("scraped_at"))
                    for body, day in scrapes
                )
            )
        ).alias("s"),
    ).select("page_id", "s.*")
    broken = {
        "broken": lambda frames: frames["source_data"].select("no_such_column"),
        "lost": lambda frames: frames["no_such_frame"],
    }
    _, status = report.run(spark, bodies, fresh_path(spark, "contents"), content="content", more=broken)
    if any(not status[name].startswith("failed") for name in broken):
        raise ValueError("a broken analysis was made")
    return month_text(spark.table("monthly_visit_changes"))


def stream_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """All pages through the stream: the sites in its log, and the pages it rejected."""
    pages = testbed.site_pages(spark, sf).select(
        F.col("page_id").cast("string").alias("url"),
        "content",
        F.lit("2024-01-10").cast("timestamp").alias("scraped_at"),
    )
    source, log = fresh_path(spark, "stream-in"), fresh_path(spark, "stream-log")
    pages.write.parquet(source)
    waiting = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 4).parquet(source)
    ingest.ingest(waiting, log, fresh_path(spark, "stream-state")).awaitTermination()
    good = ingest.current_sites(spark, log).select(
        "url", F.lit("good").alias("outcome"), "domain", "total_visits"
    )
    bad = ingest.rejected_pages(spark, log).select("url", F.col("reason").alias("outcome"))
    return good.unionByName(bad, allowMissingColumns=True)


def stream_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that a stream delivers twice, within a run and in a second one: how often each was parsed.

    The pages, without the ranks that no one reads here, are built once and delivered three times.
    """
    pages = testbed.site_pages(spark, sf, ranked=False).select(
        F.col("page_id").cast("string").alias("url"),
        "content",
        F.lit("2024-01-10").cast("timestamp").alias("scraped_at"),
    )
    pages = stored(pages, "repeats-pages")
    source, log, state = (fresh_path(spark, f"repeats-{x}") for x in ("in", "log", "state"))
    pages.write.parquet(source)
    for more in (pages.where("url % 3 = 0"), pages):
        more.write.mode("append").parquet(source)
        waiting = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 12).parquet(source)
        ingest.ingest(waiting, log, state, once=True).awaitTermination()
    checks = ingest.batch_checks(spark, log).where("metric = 'pages'").agg(F.sum("value")).head()[0]
    good = ingest.read_log(spark, ingest.site_log(log), ingest.log_schema(spark))
    bad = ingest.rejected_pages(spark, log)
    every = good.select("url", F.lit("good").alias("outcome")).unionByName(bad.select("url", F.col("reason").alias("outcome")))
    parsed = every.groupBy("url", "outcome").agg(F.count(F.lit(1)).alias("n_parsed"))
    # The batches counted as many pages as the logs hold.
    return parsed.withColumn("n_counted", F.lit(int(checks)).cast("bigint"))


def weekly_release(spark: SparkSession, sf: str) -> DataFrame:
    """Two releases, the second with new sites and newer rows of known ones."""
    rows = sites(spark, sf, "domain", "visits_history_raw")
    number = F.substring("domain", -9, 9).cast("bigint")
    empty = F.create_map().cast(rows.schema["visits_history_raw"].dataType)
    old = rows.where(number % 3 != 0).select(
        "domain", F.when(number % 5 == 0, empty).otherwise(F.col("visits_history_raw")).alias("visits_history_raw"), F.lit(1).alias("week")
    )
    new = rows.where((number % 3 == 0) | (number % 5 == 0)).withColumn("week", F.lit(2))
    target = fresh_path(spark, "releases")
    made = {
        "visits_series": lambda s: history_series(s, "visits_history_raw", "visits"),
        "monthly_visit_changes": lambda s: series.visit_changes(history_series(s, "visits_history_raw", "visits")),
    }
    for one in (old, new):
        frames = release(spark, target, one, ["week"], made)
    return month_text(frames["monthly_visit_changes"].drop("bucket"))


# Data quality, snapshots, sources


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


def completeness_report(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf)
    return quality.completeness_report(docs, "source", ["lang", "quality", "toxic"])


def missing_class(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled_documents(spark, sf).withColumn(
        "lang", F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    )
    return quality.missing_report(
        docs,
        "source",
        {"lang": "text", "quality": "number", "toxic": "number"},
        expected={"quality": F.col("n_chars") < 500},
    )


def missing_by_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The classes of missing values come from rows of a table."""
    docs = labelled_documents(spark, sf).withColumn(
        "lang", F.when(F.col("lang") == "en", "").otherwise(F.nullif("lang", F.lit("fr")))
    )
    kind = "priority int, field string, state string, other string, low double, high double, text string, class string"
    path = fresh_path(spark, "rules")
    spark.createDataFrame(
        [
            (1, "quality", "null", "n_chars", None, 499.0, None, "expectedly_missing"),
            (2, "quality", "null", "source", None, None, "src3", "not_asked"),
            (1, "lang", None, "n_chars", 5000.0, None, None, "mixed"),
            (2, "lang", "null", None, None, None, None, "expectedly_missing"),
            (1, "other", None, None, None, None, None, "never"),
        ],
        kind,
    ).write.parquet(path)
    rules = spark.read.schema(kind).parquet(path)
    kinds = {"lang": "text", "quality": "number", "toxic": "number"}
    return quality.missing_by_rules(docs, "source", kinds, rules)


def observed_volumes(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a write by the writing job, against limits."""
    orders = table(spark, sf, "orders")
    metrics = {
        "rows": F.count(F.lit(1)),
        "finished": F.count_if(F.col("o_orderstatus") == "F"),
        "cheap": F.count_if(F.col("o_totalprice") < 60000),
        "without_customer": F.count_if(F.col("o_custkey").isNull()),
        "first_key": F.min("o_orderkey"),
    }
    limits = {"rows": (1, None), "finished": (None, 10), "without_customer": (0, 0), "unknown": (1, None)}
    return quality.watched_write(orders, fresh_path(spark, "orders"), metrics, limits)


def completeness_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Completeness over three batches from their counters, one of which is delivered twice."""
    docs = labelled_documents(spark, sf)
    store = fresh_path(spark, "counters")
    for batch in (0, 1, 2, 1):
        part = docs.where(F.pmod("doc_id", F.lit(3)) == batch)
        quality.add_counters(part, store, str(batch), "source", ["lang", "quality", "toxic"])
    return quality.completeness_so_far(spark, store).drop("about_distinct")


def volume_check(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.dayofmonth(F.col("ts").cast("date")))
    keys = ["user_id", "event_type"]
    first = events.where("day <= 15").groupBy(*keys).agg(F.count("*").alias("n_expected"))
    second = events.where("day > 15").groupBy(*keys).agg(F.count("*").alias("n_actual"))
    return quality.volume_check(second, first, keys, tolerance=0.5)


def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Every twentieth event has no user, and many of these are of one second."""
    user = F.when(F.col("event_id") % 20 != 3, F.col("user_id"))
    events = table(spark, sf, "events").withColumn("user_id", user).withColumn("ts", F.date_trunc("day", "ts"))
    return snapshot.latest_snapshot(events, "user_id", ["ts", "event_id"]).drop("ts")


def merge_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Some documents have no key, and each carries a map."""
    known = F.when(F.col("doc_id") % 50 != 7, F.col("doc_id"))
    docs = table(spark, sf, "documents").select(
        known.alias("doc_id"),
        F.nullif(F.col("lang"), F.lit("fr")).alias("lang"),
        "n_chars",
        F.create_map(F.lit("id"), F.col("doc_id")).alias("tags"),
    )
    labels = table(spark, sf, "labels").select(
        "doc_id", F.lit("labelled").alias("lang"), "quality", "toxic"
    )
    merged = snapshot.merge_sources(
        {"documents": docs, "labels": labels}, "doc_id", {"documents": ["n_chars"], "labels": ["quality"]}
    )
    return merged.withColumn("tags", F.try_element_at("tags", F.lit("id")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        script_token_extract,
        embedded_json_extract,
        bad_record_split,
        project_paths,
        projection_file,
        count_spellings,
        country_fields,
        variant_paths,
        variant_own_types,
        json_scalar,
        percent_clean,
        duration_to_seconds,
        abbrev_number,
        nested_to_json,
        share_map,
        bracket_map,
        own_history,
        visits_history_explode,
        rank_history_explode,
        monthly_visit_changes,
        monthly_rank_changes,
        nation_visit_changes,
        nation_rank_changes,
        long_series_changes,
        first_last_growth,
        rank_delta,
        metrics_join,
        rank_desc_nulls_last,
        rank_by_month,
        rank_text,
        rank_one_column,
        relative_ranking,
        nation_relative_ranking,
        feed_visits_group,
        feed_visits_single,
        feed_rank_group,
        feed_rank_single,
        feed_growth_sign,
        feed_rank_split,
        feed_combined,
        feeds_of_report,
        csv_roundtrip,
        table_roundtrip,
        page_file_scan,
        view_registry,
        report_contents,
        stream_outcomes,
        stream_repeats,
        weekly_release,
        completeness_report,
        missing_class,
        missing_by_rules,
        observed_volumes,
        completeness_batches,
        volume_check,
        latest_snapshot,
        merge_sources,
    )
}
