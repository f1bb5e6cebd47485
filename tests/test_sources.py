"""Files, tables, views and the shared folder."""

import os

import golden
import pytest
from pyspark.sql import functions as F

from sitegauge.functions.nested import json_text
from sitegauge.operators.extract import documents, parse_pages, rejects
from sitegauge.operators.project import (
    DOCUMENT,
    flat_schema,
    flatten_nested,
    nested_columns,
    restore_nested,
    typed_sites,
)
from sitegauge.operators.ranking import metrics_join
from sitegauge.operators.reshape import transform_metrics
from sitegauge.operators.snapshot import latest_snapshot, merge_sources
from sitegauge.plans import report
from sitegauge.sources import workdir
from sitegauge.sources.pages import page_files, stored_pages, write_page_files
from sitegauge.sources.tables import read_csv, register_views, replace_bucketed, replace_table, write_csv


def test_page_files(spark, tmp_path):
    for domain in golden.SITES:
        (tmp_path / f"scrape-{domain}.html").write_text(golden.page(domain))
    (tmp_path / "scrape-bytes.html").write_bytes(b"\xff\xfe")
    (tmp_path / "other.html").write_text(golden.page("google.com"))
    (tmp_path / "scrape.txt").write_text("x")
    pages = page_files(spark, str(tmp_path), prefix="scrape")
    assert pages.columns == ["url", "content", "scraped_at"] and pages.count() == 6
    parsed = parse_pages(pages, DOCUMENT, "content")
    found = documents(parsed).select("layout.data.domain").collect()
    assert {r.domain for r in found} == set(golden.SITES)
    assert [(r.url[-17:], r.reason) for r in rejects(parsed).collect()] == [
        ("scrape-bytes.html", "invalid_utf8")
    ]


def test_no_files(spark, tmp_path):
    pages = page_files(spark, str(tmp_path), prefix="scrape")
    assert pages.isEmpty()
    frames, _ = report.run(spark, pages, str(tmp_path / "out"), content="content")
    assert all(frame.isEmpty() for frame in frames.values())


def test_csv(spark, tmp_path):
    path = str(tmp_path / "new" / "folder" / "flat")
    df = spark.createDataFrame(
        [
            ('say "hi", twice\nand\\again', "", {"a": 1, "b": None}, [(25, None)]),
            (None, "36.03%", None, []),
        ],
        "t string, raw string, m map<string,bigint>, l array<struct<low:int,high:int>>",
    )
    assert nested_columns(df) == ["m", "l"]
    flat = flatten_nested(df)
    write_csv(flat, path)
    write_csv(flat, path)
    back = read_csv(spark, path, flat.schema, line_breaks=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, flat.collect()))
    again = restore_nested(back, {"m": "map<string,bigint>", "l": "array<struct<low:int,high:int>>"})
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))
    # Only the wanted columns of the thirteen are parsed.
    assert read_csv(spark, path, flat.schema).select("raw").columns == ["raw"]


# Fixed value: the header is the format of the flat file. The figures are invented.
FLAT = """\
domain,global_rank,total_visits,bounce_rate_raw,pages_per_visit,avg_visit_duration_raw,\
rank_history_raw,visits_history_raw,last_month_change,top_countries_raw,age_distribution_raw,\
bounce_rate_percent,avg_visit_duration_seconds
a.com,7,52000000123,41.05%,8.25,00:10:35,\
"{""a.com"":[{""date"":""2022-10-01T00:00:00+00:00"",""rank"":7}],""b.com"":null}",\
"{""2022-10-01"":5,""2022-11-01"":null}",0.5,\
"[{""countryAlpha2Code"":""US"",""countryUrlCode"":""us"",""visitsShare"":0.125,""visitsShareChange"":1}]",\
"[{""minAge"":65,""maxAge"":null,""value"":0.5}]",41.05,123
b.com,9,0,"",0.0,"",,"{}",,[],[],,
"""


def test_flat_file_of_another_writer(spark, tmp_path):
    path = tmp_path / "flat.csv"
    path.write_text(FLAT)
    sites = typed_sites(read_csv(spark, str(path), flat_schema()))
    first, second = sites.orderBy("domain").collect()
    # The seconds come from the text again, so that a wrong figure in an old file goes away.
    assert first.avg_visit_duration_seconds == 635 and first.total_visits == 52000000123
    assert first.visits_history_raw == {"2022-10-01": 5, "2022-11-01": None}
    assert (second.bounce_rate_raw, second.bounce_rate_percent, second.rank_history_raw) == ("", None, None)
    shaped = transform_metrics(sites).orderBy("domain").head()
    assert shaped.top_countries == {"US": 12.5} and shaped.age_distribution == {"65+": 50.0}
    assert shaped.rank_history == {"2022-10-01": 7}


def test_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    got = replace_table(spark.range(100).withColumn("x", F.col("id") % 7), path, cluster_by="x")
    assert got.count() == 100
    named = replace_table(spark.range(3), str(tmp_path / "n"), name="three")
    assert named.count() == 3 and spark.table("three").count() == 3
    spark.sql("drop table three")


def test_bucketed_series_need_no_shuffle(spark, conf, plan_of, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    pages = spark.createDataFrame([(d, golden.page(d)) for d in golden.SITES], "url string, html string")
    frames, _ = report.run(spark, pages, str(tmp_path / "r"), version=["url"], buckets=4)
    other, _ = report.run(spark, pages.limit(1), str(tmp_path / "other"), version=["url"], buckets=4)
    assert other["visits_series"].count() < frames["visits_series"].count()
    visits, ranks = frames["visits_series"], frames["rank_series"]
    for df in (frames["monthly_visit_changes"], frames["monthly_rank_changes"], metrics_join(visits, ranks)):
        assert "Exchange" not in plan_of(df)
    rows = frames["relative_ranking"].orderBy("combined_rank", "domain").collect()
    assert [tuple(r) for r in rows] == golden.RANKING
    for name in spark.catalog.listTables():
        if "_series_by_domain_" in name.name:
            spark.sql(f"drop table {name.name}")


def test_a_failing_view_does_not_stop_the_others(spark):
    def missing():
        return spark.table("no_such_table")

    status = register_views(
        spark,
        {"first": lambda: spark.range(1), "broken": missing, "last": lambda: spark.range(2)},
    )
    assert status["first"] == status["last"] == "created"
    assert status["broken"].startswith("failed: ") and spark.table("last").count() == 2
    register_views(spark, {"last": lambda: spark.range(7)})
    assert spark.table("last").count() == 7


def test_shared_folder_is_the_one_of_the_cluster(spark, conf, tmp_path):
    class Stub:
        class conf:
            get = staticmethod(lambda key, default: {"spark.checkpoint.dir": "hdfs://x/c/"}.get(key, default))

    assert workdir.shared_dir(Stub) == "hdfs://x/c"

    class Unset:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workdir.shared_dir(Unset)
    stored = workdir.stored(spark.range(3), "three")
    assert stored.inputFiles()[0].startswith(("file:", workdir.shared_dir(spark)))
    assert stored.count() == 3


def test_latest_snapshot(spark):
    rows = [("a", 1, "u1", {"k": 1}), ("a", 2, "u2", None), ("a", 2, "u1", {}), ("b", 1, None, None)]
    rows += [(None, 1, "u3", None), (None, 1, "u4", None)]
    df = spark.createDataFrame(rows, "domain string, at int, url string, m map<string,int>")
    got = latest_snapshot(df, "domain", ["at", "url"])
    assert got.columns == df.columns
    assert set(map(tuple, got.select("domain", "at", "url").collect())) == {
        ("a", 2, "u2"), ("b", 1, None), (None, 1, "u3"), (None, 1, "u4"),
    }
    assert got.count() == 4


def test_series_of_repeated_scrapes(spark, tmp_path):
    newer = golden.page("stripe.com").replace('"globalRank": 1062', '"globalRank": 999')
    rows = [
        ("scrape-2.html", golden.page("stripe.com"), "2022-12-01 00:00:00"),
        ("scrape-10.html", newer, "2022-12-02 00:00:00"),
    ]
    pages = spark.createDataFrame(rows, "url string, html string, at string")
    pages = pages.select("url", "html", F.col("at").cast("timestamp").alias("scraped_at"))
    frames, _ = report.run(spark, pages, str(tmp_path / "r"))
    assert frames["monthly_visit_changes"].count() == 3
    assert frames["source_data"].head()["global_rank"] == 999
    with pytest.raises(ValueError, match="scraped_at"):
        report.run(spark, pages.drop("scraped_at"), str(tmp_path / "r"))


def test_one_failing_analysis_leaves_the_others(spark, tmp_path):
    pages = spark.createDataFrame([(d, golden.page(d)) for d in golden.SITES], "url string, html string")

    def broken(frames):
        return frames["source_data"].select("no_such_column")

    more = {"broken": broken, "after": lambda frames: frames["source_data"].select("domain")}
    frames, status = report.run(spark, pages, str(tmp_path / "r"), version=["url"], more=more)
    assert status.pop("broken").startswith("failed: ") and "broken" not in frames
    assert set(status.values()) == {"created"} and spark.table("after").count() == 5
    assert spark.table("relative_ranking").count() == 5


def test_a_failing_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="no good"):
        replace_table(spark.range(5).select(F.raise_error(F.lit("no good")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5


def test_a_failing_write_keeps_the_named_table(spark, tmp_path):
    path = str(tmp_path / "n")
    replace_table(spark.range(5), path, name="kept")
    before = sorted(f for f in spark.table("kept").inputFiles())
    broken = spark.range(5).select(F.raise_error(F.lit("no good")).alias("id"))
    with pytest.raises(Exception, match="no good"):
        replace_table(broken, path, name="kept")
    with pytest.raises(Exception, match="no good"):
        replace_bucketed(broken.withColumn("k", F.lit(1)), path, "kept", "k", 2)
    assert spark.table("kept").count() == 5 and sorted(spark.table("kept").inputFiles()) == before
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept")] == ["kept"]
    # Another schema, and only the files of the table that is there stay.
    replace_table(spark.range(3).select("id", F.lit("x").alias("more")), path, name="kept")
    assert spark.table("kept").columns == ["id", "more"] and len(list((tmp_path / "n").iterdir())) == 1
    spark.sql("drop table kept")


def test_values_over_several_lines(spark, tmp_path):
    values = ["a\nb", "\r\n", "\x02", "\x02n", "\x02\n\x02s", 'q"\n"', "", None, "plain", "back\\n", ",\n,", "  both ends ", "\t"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    back = read_csv(spark, path, df.schema)
    assert {r.id: r.text for r in back.collect()} == dict(enumerate(values))
    lines = [line for part in (tmp_path / "csv").glob("part-*") for line in part.read_bytes().split(b"\n")[1:-1]]
    assert len(lines) == len(values)


def test_merge_sources(spark):
    first = spark.createDataFrame([("a", 1, None), ("b", None, "x")], "k string, n int, t string")
    second = spark.createDataFrame([("a", 9, "y"), ("c", 3, "z")], "k string, n int, t string")
    third = spark.createDataFrame([("b", True), ("a", None)], "k string, flag boolean")
    merged = merge_sources({"one": first, "two": second, "three": third}, "k").orderBy("k")
    assert [tuple(r) for r in merged.collect()] == [
        ("a", 1, "y", None, "one+two+three"),
        ("b", None, "x", True, "one+three"),
        ("c", 3, "z", None, "two"),
    ]


def test_merged_rows_without_a_key_maps_and_whole_rows(spark):
    schema = "k int, m map<string,int>, t string, at int"
    first = spark.createDataFrame(
        [(None, {"a": 1}, "p", 1), (None, {"a": 1}, "p", 1), (1, {"x": 1}, "z", 1), (1, {"y": 2}, "b", 2), (2, None, "b", 1)],
        schema,
    )
    second = spark.createDataFrame([(None, None, "q"), (2, {"w": 4}, "c")], "k int, m map<string,int>, t string")
    merged = merge_sources({"one": first, "two": second}, "k", {"one": ["at"]})
    assert sorted(map(str, map(tuple, merged.collect()))) == sorted(
        map(str, [
            (None, {"a": 1}, "p", 1, "one"), (None, {"a": 1}, "p", 1, "one"), (None, None, "q", None, "two"),
            (1, {"y": 2}, "b", 2, "one"), (2, {"w": 4}, "b", 1, "one+two"),
        ])
    )
    # Without a version one whole row of the source, the same one every time.
    pairs = {tuple(r)[1:3] for r in merge_sources({"one": first.select("k", "t", "at")}, "k").where("k = 1").collect()}
    assert pairs <= {("z", 1), ("b", 2)} and len(pairs) == 1


def test_json_text_of_flat_rows_has_no_line_break(spark):
    df = spark.createDataFrame([({"a\nb": "c\r"},)], "m map<string,string>")
    assert df.select(json_text(F.col("m"))).head()[0] == '{"a\\nb":"c\\r"}'


def test_page_files_are_written_one_per_row_and_read_many_at_a_time(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "1m")
    rows = [(f"page {i}\nof two lines" if i % 50 else None,) for i in range(200)]
    raw = spark.createDataFrame(rows, "html string").union(spark.sql("SELECT CAST(X'C3FF' AS STRING)")).union(spark.sql("SELECT ''"))
    folder = str(tmp_path / "files")
    write_page_files(raw.repartition(3), folder)
    names = os.listdir(folder)
    assert len(names) == 202 and all(n.startswith("part-") and n.endswith(".txt") for n in names)
    want = sorted([(t or "").encode() + b"\n" for t, in rows] + [b"\xc3\xff\n", b"\n"])
    assert sorted(open(f"{folder}/{n}", "rb").read() for n in names) == want
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    pages = stored_pages(spark, folder, str(tmp_path / "table"), prefix="part-", suffix=".txt")
    assert sorted(bytes(r["content"]) for r in pages.collect()) == want
    # With Spark's own cost of opening a file, every page would be a task and a file of the table.
    assert len(pages.inputFiles()) <= 20
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_no_pages_make_an_empty_folder(spark, tmp_path):
    folder = str(tmp_path / "none")
    write_page_files(spark.createDataFrame([], "html string"), folder)
    assert os.listdir(folder) == []
    assert stored_pages(spark, folder, str(tmp_path / "table"), prefix="part-", suffix=".txt").isEmpty()
