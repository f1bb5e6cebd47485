"""Micro-batches of new pages."""

import datetime as dt
import os
import random

import golden
from pyspark.sql import functions as F

from sitegauge.operators.reshape import history_series, transform_metrics
from sitegauge.plans import testbed
from sitegauge.plans.queries import stream_repeats
from sitegauge.streaming.ingest import (
    batch_checks,
    batch_folders,
    compact,
    current_sites,
    ingest,
    page_stream,
    rejected_pages,
    site_log,
)


def put(folder, name, text, second):
    path = folder / name
    path.write_text(text)
    os.utime(path, (second, second))


def read(spark, folder, work, checkpoint="checkpoint", **options):
    pages = page_stream(spark, str(folder), prefix="scrape", files_per_batch=2)
    query = ingest(pages, f"{work}/log", f"{work}/{checkpoint}", **options)
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive
    return query


def test_ingest(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    start = 1_700_000_000
    for i, domain in enumerate(golden.SITES):
        put(folder, f"scrape-{i}.html", golden.page(domain), start + i)
    put(folder, "scrape-bad.html", "<p>nothing</p>", start + 10)
    put(folder, "other.html", golden.page("google.com"), start)
    read(spark, folder, work)
    sites = current_sites(spark, f"{work}/log")
    assert {r.domain for r in sites.select("domain").collect()} == set(golden.SITES)
    assert len(batch_folders(spark, site_log(f"{work}/log"))) >= 3
    bad = rejected_pages(spark, f"{work}/log").collect()
    assert [(r.url.rsplit("/", 1)[-1], r.reason) for r in bad] == [("scrape-bad.html", "no_object")]
    assert not os.path.exists(work / "log" / "parsed") or not any(
        files for _, _, files in os.walk(work / "log" / "parsed")
    )

    # A later scrape of one site, and an older one of another, in a second run.
    newer = golden.page("stripe.com").replace('"globalRank": 1062', '"globalRank": 999')
    older = golden.page("google.com").replace('"globalRank": 1,', '"globalRank": 7,')
    put(folder, "scrape-new.html", newer, start + 1000)
    put(folder, "scrape-old.html", older, start - 1000)
    read(spark, folder, work)
    table = compact(spark, f"{work}/log", f"{work}/sites")
    ranks = {r.domain: r.global_rank for r in table.collect()}
    assert len(ranks) == 5 and ranks["stripe.com"] == 999 and ranks["google.com"] == 1
    assert history_series(transform_metrics(table), "visits_history", "visits").count() == 15
    # The batches are retired; the log has one, and later ones add to it.
    assert len(batch_folders(spark, site_log(f"{work}/log"))) == 1
    newest = golden.page("stripe.com").replace('"globalRank": 1062', '"globalRank": 5')
    put(folder, "scrape-newest.html", newest, start + 2000)
    read(spark, folder, work)
    assert {r.domain: r.global_rank for r in current_sites(spark, f"{work}/log").collect()} == {**ranks, "stripe.com": 5}
    assert rejected_pages(spark, f"{work}/log").count() == 1


def test_batches_that_run_twice_leave_the_same_rows(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    folder.mkdir()
    for i, domain in enumerate(golden.SITES):
        put(folder, f"scrape-{i}.html", golden.page(domain), 1_700_000_000 + i)
    read(spark, folder, work)
    before = sorted(map(str, current_sites(spark, f"{work}/log").collect()))
    folders = batch_folders(spark, site_log(f"{work}/log"))
    # Without the commit of its last batch the stream runs that batch again.
    commits = work / "checkpoint" / "commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if (commits / name).exists():
            (commits / name).unlink()
    read(spark, folder, work)
    assert batch_folders(spark, site_log(f"{work}/log")) == folders
    assert sorted(map(str, current_sites(spark, f"{work}/log").collect())) == before


def test_a_fresh_checkpoint_and_a_second_stream_lose_nothing(spark, tmp_path):
    work = tmp_path / "work"
    for number, domain in enumerate(golden.SITES):
        folder = tmp_path / f"in-{number}"
        folder.mkdir()
        put(folder, "scrape.html", golden.page(domain), 1_700_000_000)
        put(folder, "scrape-bad.html", "<p>nothing</p>", 1_700_000_000)
        read(spark, folder, work, checkpoint=f"checkpoint-{number}")
    assert {r.domain for r in current_sites(spark, f"{work}/log").collect()} == set(golden.SITES)
    assert rejected_pages(spark, f"{work}/log").count() == len(golden.SITES)


def test_repeats_are_left_out_and_late_pages_are_not(spark, tmp_path):
    work = tmp_path / "work"
    schema = "url string, content binary, scraped_at timestamp"
    source = str(tmp_path / "pages")
    rows = [
        ("u", golden.page("stripe.com"), dt.datetime(2022, 12, 1)),
        ("u", golden.page("stripe.com"), dt.datetime(2022, 12, 1)),
        ("late", golden.page("google.com"), dt.datetime(2012, 12, 1)),
    ]
    for url, text, moment in rows:
        row = (url, bytearray(text.encode()), moment)
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(source)
    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = ingest(pages, f"{work}/log", f"{work}/checkpoint", once=True)
    query.awaitTermination(120)
    assert query.exception() is None
    every = spark.read.parquet(*batch_folders(spark, site_log(f"{work}/log")))
    assert sorted(r.domain for r in every.collect()) == ["google.com", "stripe.com"]


def test_pages_of_an_earlier_run_are_not_parsed_again(spark, tmp_path):
    work, source = tmp_path / "work", str(tmp_path / "pages")
    schema = "url string, content binary, scraped_at timestamp"
    moment = dt.datetime(2022, 12, 1)

    def deliver(*rows):
        body = [(url, bytearray(text.encode()), moment) for url, text in rows]
        spark.createDataFrame(body, schema).coalesce(1).write.mode("append").parquet(source)
        pages = spark.readStream.schema(schema).parquet(source)
        query = ingest(pages, f"{work}/log", f"{work}/checkpoint", once=True, limits={"rejected": (None, 0), "pages": (1, None)})
        query.awaitTermination(120)
        assert query.exception() is None

    good, bad = ("u", golden.page("stripe.com")), ("v", "<p>nothing</p>")
    deliver(good, bad)
    deliver(bad, good, ("w", golden.page("google.com")))
    assert rejected_pages(spark, f"{work}/log").count() == 1
    every = spark.read.parquet(*batch_folders(spark, site_log(f"{work}/log")))
    assert sorted(r.domain for r in every.collect()) == ["google.com", "stripe.com"]
    checks = batch_checks(spark, f"{work}/log").collect()
    pages = [r.value for r in checks if r.metric == "pages" and r.value]
    assert sorted(pages) == [1.0, 2.0]
    assert [r.metric for r in checks if r.alert and r.value] == ["rejected"]
    assert {r.metric: r.value for r in checks if r.alert and r.metric == "rejected"} == {"rejected": 1.0}
    compact(spark, f"{work}/log", f"{work}/sites")
    assert rejected_pages(spark, f"{work}/log").count() == 1
    assert batch_checks(spark, f"{tmp_path}/none").collect() == []


def test_repeated_pages_are_built_once_for_all_deliveries(spark, monkeypatch):
    # Keys that another evaluation of the pages would draw anew.
    drawn = F.udf(lambda i: random.randrange(10**12), "long").asNondeterministic()

    def pages(spark, sf, ranked=True):
        return spark.range(0, 30, 1, 2).select(drawn("id").alias("page_id"), F.encode(F.lit("no object"), "utf-8").alias("content"))

    monkeypatch.setattr(testbed, "site_pages", pages)
    rows = stream_repeats(spark, "nowhere").collect()
    assert len(rows) == 30
    assert {(r["outcome"], r["n_parsed"], r["n_counted"]) for r in rows} == {("no_object", 1, 30)}
