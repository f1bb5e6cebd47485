"""Odd pages, odd fields, odd numbers."""

import json
import random
from html.parser import HTMLParser

import duckdb
import golden
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sitegauge.functions.cleaning import abbreviated_number, clock_seconds, percent_text
from sitegauge.functions.html import APP_DATA, script_bodies
from sitegauge.functions.nested import entries_map, json_text, utc_date, whole_number
from sitegauge.functions.numeric import percent_span, percent_step, round_half_away, sign_class
from sitegauge.operators.extract import documents, parse_pages, rejects
from sitegauge.operators.project import (
    DOCUMENT,
    SITE_SPEC,
    PathSpec,
    clean,
    document_type,
    load_spec,
    parse_spec,
    project,
)
from sitegauge.operators.reshape import (
    bracket_label,
    history_series,
    own_rank_history,
    transform_metrics,
)

GOOD = json.dumps({"layout": {"data": {"domain": "a.com"}}})
LONG = "x" * 2_000_000

PAGES = {
    "plain": (f"<script>{APP_DATA} = {GOOD}</script>", "a.com"),
    "semicolon": (f"<script>{APP_DATA}={GOOD};</script>", "a.com"),
    "attributes": (f"<script type=\"a>b\" async data-x='>'>{APP_DATA} = {GOOD}</script>", "a.com"),
    "upper case": (f"<SCRIPT>{APP_DATA}\n=\n{GOOD}</SCRIPT >", "a.com"),
    "not closed": (f"<script>{APP_DATA} = {GOOD}", "a.com"),
    "long script": (f"<script>var a = '{LONG}';\n{APP_DATA} = {GOOD}\n</script>", "a.com"),
    "long page": (f"<p>{LONG}</p><script>{APP_DATA} = {GOOD}</script><!-- {LONG}", "a.com"),
    "many brackets": (
        f"<title>{'<a>' * 300_000}</title><!--{'- --' * 300_000}--><script>{'<b>=' * 300_000}\n"
        f"{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "many attributes": (f"<script {'a=1 ' * 300_000}>{APP_DATA} = {GOOD}</script>", "a.com"),
    "other element": (
        f"<script-x>{APP_DATA} = {{}}</script-x><script>{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "after a comment": (
        f"<!-- <script>{APP_DATA} = {{}}</script> --><script>{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "after a title": (
        f"<title><script>{APP_DATA} = {{}}</script></title><script>{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "first without a match": (
        f"<script>use({APP_DATA})</script><script>{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "first match wins": (
        f"<script>{APP_DATA} = {GOOD}</script><script>{APP_DATA} = {{}}</script>", "a.com"
    ),
    "line separators": (
        f"<script>{APP_DATA} = {GOOD.replace('a.com', 'a' + chr(0x2028) + chr(0x85) + 'b')}</script>",
        "a" + chr(0x2028) + chr(0x85) + "b",
    ),
    "space": (f"<script>{APP_DATA} = {GOOD}</script>", "a.com"),
    "second line": (
        f"<script>{APP_DATA} = {{ {APP_DATA} = {{\n{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "many assignments": (
        f"<script>{f'{APP_DATA} = {{' * 50_000}\n{APP_DATA} = {GOOD}</script>", "a.com"
    ),
    "empty object": (f"<script>{APP_DATA} = {{}}</script>", None),
}
BAD = {
    "no script": ("<p>text</p>", "no_object"),
    "empty": ("", "no_object"),
    "outside a script": (f"<p>{APP_DATA} = {GOOD}</p>", "no_object"),
    "not an object": (f"<script>{APP_DATA} = [1]</script>", "no_object"),
    "no assignment": (f"<script>{APP_DATA};</script>", "no_object"),
    "over several lines": (f'<script>{APP_DATA} = {{\n"layout": {{}}}}</script>', "no_object"),
    "text after it": (f"<script>{APP_DATA} = {GOOD}; x = {{}}</script>", "bad_json"),
    "two objects": (f"<script>{APP_DATA} = {GOOD}, {GOOD}</script>", "bad_json"),
    "cut short": (f"<script>{APP_DATA} = {GOOD[:-1]}</script>", "bad_json"),
    "single quotes": (f"<script>{APP_DATA} = {{'layout': 1}}</script>", "bad_json"),
    "not a number": (f'<script>{APP_DATA} = {{"a": NaN}}</script>', "bad_json"),
    "comma": (f'<script>{APP_DATA} = {{"a": 1,}}</script>', "bad_json"),
}


def test_pages(spark):
    cases = {**{k: v[0].encode() for k, v in {**PAGES, **BAD}.items()}, "bytes": b"\xff<script>"}
    pages = spark.createDataFrame(list(cases.items()), "url string, content binary")
    parsed = parse_pages(pages, DOCUMENT, "content")
    found = documents(parsed).select("url", "layout.data.domain").collect()
    assert {r.url: r.domain for r in found} == {k: v[1] for k, v in PAGES.items()}
    assert {r.url: r.reason for r in rejects(parsed).collect()} == {
        **{k: v[1] for k, v in BAD.items()}, "bytes": "invalid_utf8",
    }


def test_a_page_is_searched_once(spark, plan_of):
    pages = spark.createDataFrame([], "url string, html string")
    plan = plan_of(documents(parse_pages(pages, DOCUMENT)))
    # Once for the scripts, once for the object in a script.
    assert plan.count("regexp_extract_all") == 2 and plan.count("from_json") == 1
    assert "Exchange" not in plan and "EvalPython" not in plan


def test_script_bodies(spark):
    html = "<script>1</script><script src=a></script><scripty>2</scripty><script a=b>3</script>"
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(script_bodies(F.col("html"))).head()[0] == ["1", "3"]


def sites(spark, *docs):
    pages = spark.createDataFrame(
        [(str(i), golden.page("", json.dumps(d))) for i, d in enumerate(docs)], "url string, html string"
    )
    return clean(project(documents(parse_pages(pages, DOCUMENT)), SITE_SPEC))


def data(**fields):
    return {"layout": {"data": {"domain": "a.com", **fields}}}


def test_other_shapes_become_null_and_the_rest_stays(spark):
    row = sites(
        spark,
        data(
            overview={"globalRank": "first", "pagesPerVisit": 2, "more": {}},
            traffic={"visitsHistory": {"2022-10-01": 5, "2022-11-01": 1.5, "2022-12-01": "x", "2023-01-01": None}},
        ),
    ).head()
    assert (row.domain, row.global_rank, row.pages_per_visit) == ("a.com", None, 2.0)
    assert row.visits_history_raw == {
        "2022-10-01": 5, "2022-11-01": 2, "2022-12-01": None, "2023-01-01": None,
    }
    assert row.top_countries_raw is None


def test_odd_maps(spark):
    same_key = [{"countryAlpha2Code": "US", "visitsShare": 0.1}, {"countryAlpha2Code": "US", "visitsShare": 0.2}]
    none = [{"countryAlpha2Code": None, "visitsShare": 0.3}]
    histories = {"a.com": [{"date": "2022-10-01T23:00:00-05:00", "rank": 3}, {"date": "x", "rank": 4}], "b.com": None}
    row = transform_metrics(
        sites(
            spark,
            data(geography={"topCountriesTraffics": same_key + none},
                 ranking={"globalRankCompetitorsHistory": histories}),
        )
    ).head()
    assert row.top_countries == {"US": 10.0}
    assert row.rank_history == {"2022-10-02": 3}
    assert row.age_distribution is None


def test_the_last_of_equal_keys_counts(spark):
    text = """{"layout":{"data":{"domain":"a.com",
        "traffic":{"visitsHistory":{"2022-10-01":1,"2022-11-01":5,"2022-10-01":2}},
        "ranking":{"globalRankCompetitorsHistory":{
            "a.com":[{"date":"2022-10-01","rank":1}],"a.com":[{"date":"2022-10-01","rank":2}]}}}}}"""
    pages = spark.createDataFrame([(golden.page("", text.replace("\n", "")),)], "html string")
    rows = clean(project(documents(parse_pages(pages, DOCUMENT)), SITE_SPEC))
    months = history_series(rows, "visits_history_raw", "visits").collect()
    assert sorted((str(r.month), r.visits) for r in months) == [("2022-10-01", 2), ("2022-11-01", 5)]
    assert transform_metrics(rows).head().rank_history == {"2022-10-01": 2}


def test_histories_without_entries(spark):
    df = spark.createDataFrame(
        [("a", {"2022-10-01": None, "k.e'y\"": 2}), ("b", {}), ("c", None), (None, {"2022-10-01": 1})],
        "domain string, visits_history map<string,bigint>",
    )
    rows = history_series(df, "visits_history", "visits").orderBy("visits").collect()
    assert [(r.domain, str(r.month), r.visits) for r in rows] == [("a", "2022-10-01", None), ("a", "None", 2)]


def column(spark, values, kind, use):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(use(F.col("v"))).collect()]


def test_percent(spark):
    texts = ["36.03%", "%5", "", "x%", None, "1e2%", "5d%", "0x1p3", "12%%"]
    want = [36.03, 5.0, None, None, None, 100.0, None, None, 12.0]
    assert column(spark, texts, "string", percent_text) == want


def test_clock(spark):
    texts = ["00:10:35", "00:04:08", "23:59:59", "24:00:00", "00:60:00", "1:2:3", "", None, "00:10", "00:10:35\n"]
    want = [635, 248, 86399, None, None, 3723, None, None, None, None]
    assert column(spark, texts, "string", clock_seconds) == want


def test_abbreviated(spark):
    texts = ["87.0B", "1.5k", "2M", "3T", "12", "-1.25K", "1.23456789K", "B", "", None, "1KM", "99999999999T"]
    want = [87_000_000_000, 1500, 2_000_000, 3 * 10**12, 12, -1250, 1234, None, None, None, None, None]
    assert column(spark, texts, "string", abbreviated_number) == want


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    draw = random.Random(7)
    values = [0.125, -0.125, 2.675, 1.005, 0.0, 1e300, float("inf"), None, 0.0049999999999999992]
    values += [draw.randrange(-10**7, 10**7) / 1000 for _ in range(2_000)]
    values += [draw.uniform(-1, 1) * 10 ** draw.randrange(-3, 18) for _ in range(2_000)]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]
    assert column(spark, values, "double", round_half_away) == want
    assert column(spark, [0, None, 4], "bigint", lambda v: percent_step(F.lit(5), v)) == [None, None, 25.0]
    assert column(spark, [0, None, 4], "bigint", lambda v: percent_span(v, F.lit(5))) == [None, None, 25.0]
    assert column(spark, [2.5, -1.0, 0.0, None], "double", sign_class) == [1, -1, 0, 0]
    assert column(spark, ["5", "1.5", "x", None, "86429287970"], "string", whole_number) == [
        5, 2, None, None, 86429287970,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Pacific/Auckland"])
def test_dates_are_utc(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    texts = ["2022-10-01", "2022-10-01T00:00:00+00:00", "2022-10-01T02:00:00+05:00", "x", None]
    got = column(spark, texts, "string", utc_date)
    assert [str(d) for d in got] == ["2022-10-01", "2022-10-01", "2022-09-30", "None", "None"]


def test_labels_and_text(spark):
    df = spark.createDataFrame([(25, 34), (65, None), (None, 17)], "low int, high int")
    labels = [r[0] for r in df.select(bracket_label(F.col("low"), F.col("high"))).collect()]
    assert labels == ["25-34", "65+", "-17"]
    one = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b")).alias("s"))
    assert one.select(json_text(F.col("s"))).head()[0] == '{"a":1,"b":null}'
    assert one.select(json_text(F.lit(None).cast("map<string,int>"))).head()[0] is None
    empty = spark.range(1).select(F.lit(None).cast("array<struct<k:string>>").alias("x"))
    assert empty.select(entries_map(F.col("x"), lambda x: x["k"], lambda x: x["k"])).head()[0] is None


def test_spec(spark, tmp_path):
    text = json.dumps([{"alias": s.alias, "path": list(s.path)} for s in SITE_SPEC])
    (tmp_path / "spec.json").write_text(text)
    assert load_spec(spark, str(tmp_path / "spec.json")) == SITE_SPEC
    for bad in (
        '[{"alias": "", "path": ["a"]}]', '[{"alias": "a", "path": []}]', '[{"path": ["a"]}]',
        '[{"alias": "a", "path": ["b"], "type": "c"}]', '[{"alias": "a", "path": [1]}]',
        '[{"alias": "a", "path": ["b"]}, {"alias": "A", "path": ["c"]}]', "", "{}", '["a"]',
    ):
        with pytest.raises(ValueError):
            parse_spec(bad)
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError, match="JSON list"):
        load_spec(spark, str(tmp_path / "empty.json"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_spec(spark, str(tmp_path / "none.json"))


def test_paths_that_are_not_declared(spark):
    document = data(overview={"globalRank": 3, "more": {"a": [1, None]}}, score={"x.y": "0.5"})
    specs = [
        PathSpec("domain", ("domain",)),
        PathSpec("rank", ("overview", "globalRank")),
        PathSpec("more", ("overview", "more")),
        PathSpec("score", ("score", "x.y")),
        PathSpec("number", ("score", "z")),
        PathSpec("none", ("not", "there")),
    ]
    kinds = {"number": DoubleType()}
    pages = spark.createDataFrame([(golden.page("", json.dumps(document)),)], "html string")
    parsed = parse_pages(pages, document_type(specs, types=kinds))
    df = project(documents(parsed), specs)
    assert tuple(df.head()) == ("a.com", "3", '{"a":[1,null]}', "0.5", None, None)
    assert dict(df.dtypes)["rank"] == "string" and dict(df.dtypes)["number"] == "double"


def test_a_path_beside_one_below_it(spark):
    document = data(foo={"bar": 1, "baz": {"qux": "x"}, "other": 2}, overview={"globalRank": 3})
    specs = [
        PathSpec("foo", ("foo",)), PathSpec("bar", ("foo", "bar")), PathSpec("qux", ("foo", "baz", "qux")),
        PathSpec("baz", ("foo", "baz")),
    ]
    pages = spark.createDataFrame([(golden.page("", json.dumps(document)),)], "html string")
    row = project(documents(parse_pages(pages, document_type(specs))), specs).head()
    assert (row.bar, row.qux, json.loads(row.baz)) == ("1", "x", {"qux": "x"})
    assert json.loads(row.foo) == {"bar": "1", "baz": {"qux": "x"}}
    with pytest.raises(ValueError, match="two columns"):
        document_type([PathSpec("a", ("b",)), PathSpec("a", ("c",))])


@pytest.mark.parametrize(
    "written, read",
    [("87.0B", 87 * 10**9), (2474684.0, 2474684), ("18054", 18054), (1062, 1062), ("1e3", 1000), ("n/a", None), (None, None),
     (2**63 - 1, 2**63 - 1), ("99999999999T", None)],
)
def test_counts_in_any_spelling(spark, written, read):
    document = data(overview={"globalRank": written, "visitsTotalCount": written})
    pages = spark.createDataFrame([(golden.page("", json.dumps(document)),)], "html string")
    sites = clean(project(documents(parse_pages(pages, DOCUMENT)), SITE_SPEC))
    row = sites.head()
    assert (row.global_rank, row.total_visits) == (read, read)
    assert dict(sites.dtypes)["total_visits"] == dict(sites.dtypes)["global_rank"] == "bigint"


def test_only_the_wanted_part_is_declared():
    kind = document_type([s for s in SITE_SPEC if s.alias in ("domain", "visits_history_raw")])
    assert kind.simpleString() == (
        "struct<layout:struct<data:struct<domain:string,"
        "traffic:struct<visitsHistory:map<string,string>>>>>"
    )
    assert document_type(SITE_SPEC) == DOCUMENT


class Scripts(HTMLParser):
    """Script texts by the parser of the standard library."""

    def __init__(self):
        super().__init__()
        self.inside, self.found = False, []

    def handle_starttag(self, tag, attrs):
        if tag == "script":
            self.inside = True
            self.found.append("")

    def handle_endtag(self, tag):
        self.inside = False

    def handle_data(self, text):
        if self.inside:
            self.found[-1] += text


PARTS = [
    "<script>", "<script a='>'>", '<SCRIPT b="</script>" c>', "<script\nsrc=x>", "</script>", "</SCRIPT >",
    "<!-- ", " -->", "-", "--", "<style>", "</style>", "<p>", "</p>", "<b title='<script>'>", "x = 1;", "a<b",
    "'", '"', "=", " ", "\n", "<scripts>", "</scripts>", "{}", "é ",
]


def test_scripts_as_a_parser_finds_them(spark):
    draw = random.Random(11)
    pages, want = [], []
    while len(pages) < 1_500:
        # Quotes and "=" only inside whole tags: what they mean in a broken tag is not compared.
        page = "".join(draw.choice(PARTS) for _ in range(draw.randrange(1, 14))) + "</script>-->"
        parser = Scripts()
        parser.feed(page)
        parser.close()
        pages.append(page)
        want.append([text for text in parser.found if text])
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(script_bodies(F.col("html"))).collect()]
    wrong = [(p, g, w) for p, g, w in zip(pages, got, want) if g != w]
    assert not wrong, (len(wrong), wrong[:5])


def test_a_history_is_worked_out_once(spark, plan_of):
    df = spark.createDataFrame([], "domain string, raw map<string,array<struct<date:string,rank:string>>>")
    shaped = df.select("domain", own_rank_history(F.col("raw"), F.col("domain")).alias("h"))
    plan = plan_of(history_series(shaped, "h", "rank"))
    assert plan.count("map_from_entries") <= 2 and "size(map_from_entries" not in plan.lower()
