"""The whole way from pages to feeds."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sitegauge.operators.extract import documents, parse_pages, rejects
from sitegauge.operators.project import SITE_SPEC, PathSpec, clean, document_type, project
from sitegauge.operators.ranking import relative_ranking
from sitegauge.operators.reshape import history_series, transform_metrics
from sitegauge.operators.series import rank_changes, visit_changes
from sitegauge.operators.snapshot import PLACE, latest_by_place, with_place
from sitegauge.sources.tables import reason, register_views, replace_bucketed, replace_table


def site_rows(
    parsed: DataFrame, keep: Sequence[str] = (), spec: Iterable[PathSpec] = SITE_SPEC
) -> DataFrame:
    """Good pages as flat, cleaned rows; ``keep`` names page columns that stay."""
    return clean(project(documents(parsed), spec, keep=keep))


def analyses(sites: DataFrame) -> dict[str, DataFrame]:
    """The reshaped view and the two series of a table with one row per domain."""
    shaped = transform_metrics(sites)
    return {
        "transformed_data": shaped,
        "visits_series": history_series(shaped, "visits_history", "visits"),
        "rank_series": history_series(shaped, "rank_history", "rank"),
    }


def attempt(status: dict[str, str], name: str, build: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``build`` gives, or None with the reason in ``status``."""
    try:
        return build()
    except Exception as error:
        status[name] = reason(error)
        return None


def run(
    spark: SparkSession, pages: DataFrame, target: str, content: str = "html",
    version: Sequence[str] = ("scraped_at",), spec: Sequence[PathSpec] = SITE_SPEC, buckets: int = 0,
    more: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Pages to tables below ``target`` and views; returns the frames and the status by name.

    The pages are read once, into a table with every outcome; the rejects need two narrow columns
    of it. All that follows reads the site table, and the analyses read the two series, each
    computed once and clustered by domain for the feeds. Of several scrapes of a domain the one
    with the largest ``version`` counts; the columns must be there. With ``buckets`` the series
    are catalog tables hashed by domain instead, named after ``target``, and the analyses need no
    shuffle of them. ``spec`` may add columns to the site table, and ``more`` analyses: functions
    of the frames made so far.

    A failing page or site table ends the run. Every analysis is made and entered as a view by
    itself: one that fails, whatever the error, has ``failed: <kind>: <reason>`` as its status,
    those that read it fail too, and the others are ``created``.
    """
    missing = [c for c in version if c not in pages.columns]
    if missing or not version:
        raise ValueError(f"pages have no version column {missing}; name those that tell scrapes apart")
    parsed = parse_pages(pages, document_type(spec), content)
    outcome = replace_table(parsed, f"{target}/parsed_pages")
    rows = site_rows(with_place(outcome).where("reason is null"), (*version, *PLACE), spec)
    sites = replace_table(latest_by_place(rows, "domain", version), f"{target}/source_data")
    frames: dict[str, DataFrame] = {"rejects": rejects(outcome), "source_data": sites}
    status: dict[str, str] = {}

    def series(name: str, history: str, value: str) -> DataFrame:
        made, path = history_series(frames["transformed_data"], history, value), f"{target}/{name}"
        if buckets:
            owner = f"{zlib.crc32(target.encode()):08x}"
            return replace_bucketed(made, path, f"{name}_by_domain_{owner}", "domain", buckets)
        return replace_table(made, path, cluster_by="domain")

    def needs(name: str) -> DataFrame:
        if name not in frames:
            raise ValueError(f"{name} could not be made")
        return frames[name]

    builders: dict[str, Callable[[], DataFrame]] = {
        "transformed_data": lambda: transform_metrics(sites),
        "visits_series": lambda: series("visits_series", "visits_history", "visits"),
        "rank_series": lambda: series("rank_series", "rank_history", "rank"),
        "monthly_visit_changes": lambda: visit_changes(needs("visits_series")),
        "monthly_rank_changes": lambda: rank_changes(needs("rank_series")),
        "relative_ranking": lambda: relative_ranking(needs("visits_series"), needs("rank_series")),
    }
    for name, build in (more or {}).items():
        builders[name] = lambda build=build: build(frames)
    for name, build in builders.items():
        frame = attempt(status, name, build)
        if frame is not None:
            frames[name] = frame
    status |= register_views(spark, {name: (lambda f=frame: f) for name, frame in frames.items()})
    return frames, status
