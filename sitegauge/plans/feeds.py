"""Ordered frames for charts. The caller bounds them before fetching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.functions.numeric import sign_class

EXTREME_RANK_CHANGE = 1_000_000


def series_feed(
    changes: DataFrame, domains: Sequence[str] | DataFrame, present: str | None = None
) -> DataFrame:
    """Rows of the named domains by month, optionally only those where ``present`` has a value.

    Domains of like scale belong in one call and outliers in one of their own; a long list can
    come as a frame with a ``domain`` column. The filter on the domain reaches below the window;
    the one on ``present`` must not, as the previous month was taken with the gaps in.
    """
    if isinstance(domains, DataFrame):
        chosen = changes.join(domains.select("domain"), "domain", "left_semi")
    else:
        chosen = changes.where(F.col("domain").isin(list(domains)))
    if present:
        chosen = chosen.where(F.col(present).isNotNull())
    return chosen.orderBy("month", "domain")


def growth_feed(ranking: DataFrame) -> DataFrame:
    """Growth with its sign, largest first, without the domains that have none."""
    known = F.col("visit_growth").isNotNull() & ~F.isnan("visit_growth")
    return (
        ranking.where(known)
        .select("domain", "visit_growth", sign_class(F.col("visit_growth")).alias("sign"))
        .orderBy(F.desc("visit_growth"), "domain")
    )


def rank_change_feed(ranking: DataFrame, extreme_from: int = EXTREME_RANK_CHANGE) -> DataFrame:
    """Rank change with its sign and band, ``normal`` or ``extreme``, largest first.

    A NULL change belongs to neither band.
    """
    change = F.col("rank_change")
    band = F.when(F.abs(change) < extreme_from, "normal").otherwise("extreme")
    return (
        ranking.where(change.isNotNull())
        .select("domain", "rank_change", band.alias("band"), sign_class(change).alias("sign"))
        .orderBy("band", F.desc("rank_change"), "domain")
    )


def combined_feed(ranking: DataFrame) -> DataFrame:
    """Domains by combined score, best first."""
    return ranking.select("domain", "visit_growth", "rank_change", "combined_rank").orderBy(
        "combined_rank", "domain"
    )


def site_feeds(
    frames: Mapping[str, DataFrame], groups: Mapping[str, Sequence[str]],
    extreme_from: int = EXTREME_RANK_CHANGE,
) -> dict[str, DataFrame]:
    """All feeds of a report. ``groups`` names the sets of domains that share a chart."""
    ranking = frames["relative_ranking"]
    feeds = {
        "growth": growth_feed(ranking),
        "rank_change": rank_change_feed(ranking, extreme_from),
        "combined": combined_feed(ranking),
    }
    for name, domains in groups.items():
        feeds[f"visits_{name}"] = series_feed(frames["monthly_visit_changes"], domains, "visits")
        feeds[f"rank_{name}"] = series_feed(frames["monthly_rank_changes"], domains)
    return feeds


def is_worth_drawing(feed: DataFrame) -> bool:
    """False for a feed without rows; stops at the first row it finds."""
    return not feed.isEmpty()


def local_frame(feed: DataFrame, limit: int):
    """The first ``limit`` rows of a feed as an Arrow table, and whether there are more.

    One row more than the limit is asked for, so what reaches the driver is bounded whatever the
    feed's size, and a chart can say that it is not the whole.
    """
    if limit < 0:
        raise ValueError(f"a limit of {limit} rows")
    found = feed.limit(limit + 1).toArrow()
    return found.slice(0, limit), found.num_rows > limit
