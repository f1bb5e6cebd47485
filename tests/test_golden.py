"""The whole way on the five sites."""

import golden
import pytest

from sitegauge.plans import feeds, report


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    rows = [(f"https://x/{d}", golden.page(d)) for d in golden.SITES]
    rows.append(("https://x/none", "<p>no script</p>"))
    rows.append(("https://x/bad", golden.page("google.com", '{"layout": }')))
    pages = spark.createDataFrame(rows, "url string, html string")
    frames, status = report.run(spark, pages, str(tmp_path_factory.mktemp("report")), version=["url"])
    assert set(status.values()) == {"created"} and set(status) == set(frames)
    return frames


def by_domain(df):
    return {r["domain"]: r for r in df.collect()}


def series_of(df, column):
    found = {}
    for r in df.orderBy("domain", "month").collect():
        found.setdefault(r["domain"], []).append(r[column])
    return {d: tuple(v) for d, v in found.items()}


def test_rejects(frames):
    assert {(r.url, r.reason) for r in frames["rejects"].collect()} == {
        ("https://x/none", "no_object"), ("https://x/bad", "bad_json"),
    }


def test_flat_columns(frames):
    rows = by_domain(frames["source_data"])
    assert set(rows) == set(golden.SITES)
    for domain, site in golden.SITES.items():
        row = rows[domain]
        assert (
            row.global_rank, row.total_visits, row.bounce_rate_raw, row.pages_per_visit,
            row.avg_visit_duration_raw,
        ) == site[:5]
        assert row.avg_visit_duration_seconds == golden.SECONDS[domain]
        assert row.bounce_rate_percent == (float(site[2].rstrip("%")) if site[2] else None)
        assert row.last_month_change == -0.5


def test_shares(frames):
    row = by_domain(frames["transformed_data"])["pitchbook.com"]
    assert row.top_countries == golden.COUNTRY_PERCENT
    assert row.age_distribution == golden.AGE_PERCENT
    assert row.rank_history == dict(zip(golden.MONTHS, golden.SITES["pitchbook.com"][6]))
    assert by_domain(frames["transformed_data"])["stripe.com"].top_countries == {}


def test_visit_changes(frames):
    changes = frames["monthly_visit_changes"]
    assert series_of(changes, "mom_growth_percent") == golden.GROWTH
    assert series_of(changes, "visits") == {d: s[5] for d, s in golden.SITES.items()}


def test_rank_changes(frames):
    changes = frames["monthly_rank_changes"]
    want = golden.RANK_CHANGE.items()
    assert series_of(changes, "rank_change") == {d: w[0] for d, w in want}
    assert series_of(changes, "rank_change_percent") == {d: w[1] for d, w in want}


def test_relative_ranking(frames):
    rows = frames["relative_ranking"].orderBy("combined_rank", "domain").collect()
    assert [tuple(r) for r in rows] == golden.RANKING


def test_views_read_the_same(spark, frames):
    assert spark.table("relative_ranking").count() == 5
    assert spark.sql("select max(mom_growth_percent) from monthly_visit_changes").head()[0] == 5.47


def test_feeds(frames):
    visits, ranks = frames["monthly_visit_changes"], frames["monthly_rank_changes"]
    group = feeds.series_feed(visits, ["stripe.com", "byte-trading.com"], present="visits")
    assert [(str(r.month), r.domain) for r in group.collect()] == [
        (m, "stripe.com") for m in golden.MONTHS
    ]
    both = feeds.series_feed(ranks, ["stripe.com", "byte-trading.com"])
    assert [r.domain for r in both.collect()] == ["byte-trading.com", "stripe.com"] * 3
    ranking = frames["relative_ranking"]
    assert [(r.domain, r.sign) for r in feeds.growth_feed(ranking).collect()] == [
        ("stripe.com", 1), ("google.com", -1), ("pitchbook.com", -1), ("crunchbase.com", -1),
    ]
    bands = [(r.domain, r.band, r.sign) for r in feeds.rank_change_feed(ranking).collect()]
    assert bands == [
        ("byte-trading.com", "extreme", -1), ("stripe.com", "normal", 1),
        ("google.com", "normal", 0), ("crunchbase.com", "normal", -1),
        ("pitchbook.com", "normal", -1),
    ]
    assert [r.domain for r in feeds.combined_feed(ranking).collect()][0] == "stripe.com"
    listed = visits.sparkSession.createDataFrame([("stripe.com",), ("byte-trading.com",)], "domain string")
    assert feeds.series_feed(visits, listed, present="visits").collect() == group.collect()
    assert feeds.is_worth_drawing(group)
    assert not feeds.is_worth_drawing(feeds.series_feed(visits, ["nobody.com"]))


def test_all_feeds(frames):
    groups = {"startups": ["stripe.com", "pitchbook.com"], "large": ["google.com"]}
    made = feeds.site_feeds(frames, groups)
    assert {name: feed.count() for name, feed in made.items()} == {
        "growth": 4, "rank_change": 5, "combined": 5, "visits_startups": 6, "rank_startups": 6,
        "visits_large": 3, "rank_large": 3,
    }
