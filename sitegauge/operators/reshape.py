"""Nested fields of a site as maps, and its histories as series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.functions.nested import entries_map, map_rows, utc_date, whole_number
from sitegauge.functions.numeric import share_percent


def country_shares(countries: Column) -> Column:
    """Country code -> share in percent."""
    return entries_map(
        countries, lambda c: c["countryAlpha2Code"], lambda c: share_percent(c["visitsShare"])
    )


def bracket_label(low: Column, high: Column) -> Column:
    """``25-34``, or ``65+`` for the bracket without an upper end."""
    closed = F.concat_ws("", low.cast("string"), F.lit("-"), high.cast("string"))
    return F.when(high.isNull(), F.concat_ws("", low.cast("string"), F.lit("+"))).otherwise(closed)


def age_shares(brackets: Column) -> Column:
    """Age bracket -> share in percent."""
    return entries_map(
        brackets,
        lambda b: bracket_label(b["minAge"], b["maxAge"]),
        lambda b: share_percent(b["value"]),
    )


def own_entries(histories: Column, own: Column) -> Column:
    """The row's own list out of a map of lists."""
    return F.try_element_at(histories, own)


def own_rank_history(histories: Column, own: Column) -> Column:
    """Month as ``yyyy-MM-dd`` -> rank, of the row's own domain."""
    return entries_map(
        own_entries(histories, own),
        lambda e: F.date_format(utc_date(e["date"]), "yyyy-MM-dd"),
        lambda e: whole_number(e["rank"].cast("string")),
    )


def transform_metrics(sites: DataFrame) -> DataFrame:
    """Flat site rows to the reshaped view: shares and the own rank history as maps."""
    return sites.select(
        "domain",
        "global_rank",
        "total_visits",
        "pages_per_visit",
        "last_month_change",
        "bounce_rate_raw",
        "avg_visit_duration_raw",
        F.col("visits_history_raw").alias("visits_history"),
        country_shares(F.col("top_countries_raw")).alias("top_countries"),
        age_shares(F.col("age_distribution_raw")).alias("age_distribution"),
        own_rank_history(F.col("rank_history_raw"), F.col("domain")).alias("rank_history"),
    )


def history_series(df: DataFrame, history: str, value: str, entity: str = "domain") -> DataFrame:
    """(entity, month, value) of a month -> value map.

    A NULL value keeps its row; a NULL or empty map gives none, and neither does a row without
    an entity. Key and value come out of the map together, so nothing is joined back.
    """
    known = df.where(F.col(entity).isNotNull())
    entries = map_rows(known, [entity], F.col(history), "month", value)
    return entries.withColumn("month", utc_date(F.col("month")))
