"""Site metrics derived from the given tables, in the shapes the operators expect.

A customer stands for a site and its orders for the visits: orders of status F are months
without a figure (NULL), orders under 60,000 count as 0, the others as their price. The site's
global rank is its rank among all customers of the month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegauge.operators.ranking import add_ranks

RIVALS = 5
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
BRACKETS = ((18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, None))
BRACKET_WIDTH = 90_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_of(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")


def order_visits() -> Column:
    price = F.col("o_totalprice")
    return F.when(
        F.col("o_orderstatus") != "F",
        F.when(price < 60000, F.lit(0)).otherwise(F.floor(price)).cast("bigint"),
    )


def customer_months(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """(custkey, month, visits): orders are summed before anything is joined, so that a
    customer with a third of them goes on as one row per month. The join drops orders without
    a customer in any case; said here, both series start alike and share one shuffle."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_custkey").isNotNull())
    return orders.groupBy(
        F.col("o_custkey").alias("custkey"), month_of(F.col("o_orderdate")).alias("month")
    ).agg(F.sum(order_visits()).alias("visits"), *extra)


def ranked_months(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """The months of all customers with the rank within the month, by the library's own operator."""
    return add_ranks(customer_months(spark, sf_dir, *extra), {"rank": "visits"}, ["month"])


def named(spark: SparkSession, sf_dir: str, months: DataFrame) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("domain")
    )
    return months.join(customer, "custkey").drop("custkey")


def visits_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, visits, domain) per customer."""
    return named(spark, sf_dir, customer_months(spark, sf_dir))


def rank_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, rank, domain) per customer."""
    return named(spark, sf_dir, ranked_months(spark, sf_dir).drop("visits"))


def nation_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, month, visits): number of orders per nation, 25 rows a month at any scale."""
    orders = table(spark, sf_dir, "orders")
    per_customer = orders.groupBy(
        "o_custkey", month_of(F.col("o_orderdate")).alias("month")
    ).agg(F.count("*").alias("_n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "month")
        .agg(F.sum("_n").alias("visits"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("domain"), "month", "visits")
    )


def nation_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, month, rank) of the nations; a window holds 25 rows."""
    window = Window.partitionBy("month").orderBy(F.col("visits").desc_nulls_last())
    return nation_visits(spark, sf_dir).select(
        "domain", "month", F.rank().over(window).cast("bigint").alias("rank")
    )


def bounce_text(key: Column, balance: Column) -> Column:
    whole = F.pmod(F.floor(F.abs(balance)), F.lit(100)).cast("string")
    cents = F.lpad(F.pmod(key, F.lit(100)).cast("string"), 2, "0")
    return F.when(key % 7 == 0, "").otherwise(F.concat(whole, F.lit("."), cents, F.lit("%")))


def clock_text(seconds: Column) -> Column:
    parts = (F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)
    return F.concat_ws(":", *(F.lpad(part.cast("string"), 2, "0") for part in parts))


def duration_text(key: Column) -> Column:
    return (
        F.when(key % 11 == 0, "")
        .when(key % 13 == 0, "25:61:00")
        .otherwise(clock_text((key * 7919) % 86400))
    )


def block_of(key: Column) -> Column:
    return F.floor(key / RIVALS)


def site_documents(
    spark: SparkSession, sf_dir: str, wanted: DataFrame | None = None, ranked: bool = True
) -> DataFrame:
    """(custkey, json): one document per customer, with the rank history of its RIVALS block.

    ``wanted`` has one column of customer keys: only documents of their blocks are built. Without
    ``ranked`` the ranks in them are null, for readers that do not want them.
    Built text is joined by merging, never broadcast: Spark takes it for far smaller than it is.

    The lists collected here are bounded: months of the calendar, fixed priorities and
    brackets, RIVALS customers per block.
    """
    status = F.col("o_orderpriority")
    band = F.floor(F.col("o_totalprice") / BRACKET_WIDTH)
    tallies = [F.count_if(status == p).alias(f"p{i}") for i, p in enumerate(PRIORITIES)]
    tallies += [F.count_if(band == i).alias(f"b{i}") for i in range(len(BRACKETS))]
    if ranked:
        months = ranked_months(spark, sf_dir, *tallies)
    else:
        months = customer_months(spark, sf_dir, *tallies).withColumn("rank", F.lit(None).cast("bigint"))
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    if wanted is not None:
        blocks = wanted.select(block_of(F.col(wanted.columns[0])).alias("_block")).distinct()

        def only(df: DataFrame) -> DataFrame:
            return df.join(blocks, block_of(F.col("custkey")) == F.col("_block"), "left_semi")

        months, customer = only(months), only(customer)
    counted = [f"p{i}" for i in range(len(PRIORITIES))] + [f"b{i}" for i in range(len(BRACKETS))]
    per_customer = months.groupBy("custkey").agg(
        F.array_sort(F.collect_list(F.struct("month", "visits", "rank"))).alias("history"),
        *(F.sum(c).alias(c) for c in counted),
    )
    joined = customer.join(per_customer.hint("merge"), "custkey", "left")

    day = lambda h: F.date_format(h["month"], "yyyy-MM-dd")
    ranks = F.transform(
        "history",
        lambda h: F.struct(
            F.concat(day(h), F.lit("T00:00:00+00:00")).alias("date"), h["rank"].alias("rank")
        ),
    )
    block = Window.partitionBy(block_of(F.col("custkey")))
    rivals = F.collect_list(F.struct(F.col("c_name"), ranks)).over(block)
    visits = F.map_from_entries(
        F.transform("history", lambda h: F.struct(day(h).alias("key"), h["visits"].alias("value")))
    )
    orders = sum((F.col(f"p{i}") for i in range(1, len(PRIORITIES))), F.col("p0"))
    countries = F.filter(
        F.array(
            *(
                F.struct(
                    F.lit(p).alias("countryAlpha2Code"),
                    F.lit(p.lower()).alias("countryUrlCode"),
                    (F.col(f"p{i}") / orders).alias("visitsShare"),
                    F.lit(i / 8).alias("visitsShareChange"),
                )
                for i, p in enumerate(PRIORITIES)
            )
        ),
        lambda c: c["visitsShare"] > 0,
    )
    ages = F.array(
        *(
            F.struct(
                F.lit(low).alias("minAge"),
                F.lit(high).cast("int").alias("maxAge"),
                (F.col(f"b{i}") / orders).alias("value"),
            )
            for i, (low, high) in enumerate(BRACKETS)
        )
    )
    last = F.try_element_at("history", F.lit(-1))
    key, balance = F.col("custkey"), F.col("c_acctbal")
    data = F.struct(
        F.col("c_name").alias("domain"),
        F.struct(
            last["rank"].alias("globalRank"),
            last["visits"].alias("visitsTotalCount"),
            bounce_text(key, balance).alias("bounceRateFormatted"),
            (balance / 1000).alias("pagesPerVisit"),
            duration_text(key).alias("visitsAvgDurationFormatted"),
        ).alias("overview"),
        F.struct(F.map_from_entries("rivals").alias("globalRankCompetitorsHistory")).alias("ranking"),
        F.struct(
            visits.alias("visitsHistory"), (balance / 7).alias("visitsTotalCountChange")
        ).alias("traffic"),
        F.struct(countries.alias("topCountriesTraffics")).alias("geography"),
        F.struct(ages.alias("ageDistribution")).alias("demographics"),
    )
    layout = F.struct(F.struct(data.alias("data")).alias("layout"))
    return joined.withColumn("rivals", rivals).select(
        "custkey", F.to_json(layout, {"ignoreNullFields": "false"}).alias("json")
    )


def site_pages(spark: SparkSession, sf_dir: str, ranked: bool = True) -> DataFrame:
    """(page_id, content): every real page, with the document of the customer of the same key
    in a script before it. The last digit of page_id says what is special about the page:

    0 no document, 1 document cut short, 2 a byte that is not UTF-8, 3 a decoy in a comment,
    4 a script that only names the variable, 5 text after the object.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    docs = site_documents(spark, sf_dir, pages.select("page_id"), ranked)
    digit = F.pmod(F.col("page_id"), F.lit(10))
    script = lambda body: F.concat(F.lit("<script>"), body, F.lit("</script>"))
    assign = F.concat(F.lit("window.__APP_DATA__ = "), F.col("json"))
    head = (
        F.when((digit == 0) | F.col("json").isNull(), "")
        .when(digit == 1, script(F.expr("concat('window.__APP_DATA__ = ', left(json, length(json) - 1))")))
        .when(
            digit == 3,
            F.concat(
                F.lit('<!-- <script>window.__APP_DATA__ = {"layout":{}}</script> -->'), script(assign)
            ),
        )
        .when(digit == 4, F.concat(script(F.lit("use(window.__APP_DATA__);")), script(assign)))
        .when(digit == 5, script(F.concat(assign, F.lit("; window.more = {};"))))
        .otherwise(script(assign))
    )
    page = F.encode(F.concat(head, F.col("html")), "utf-8")
    broken = F.concat(page, F.unhex(F.lit("FF")))
    return pages.join(docs.hint("merge"), F.col("page_id") == F.col("custkey"), "left").select(
        "page_id", F.when(digit == 2, broken).otherwise(page).alias("content")
    )
