"""New pages as they arrive, into a log of site rows and one of rejects, and the latest row per
domain.

Every batch owns one folder in each log, named by the stream and the batch. The stream's name is
Spark's query id, which lives in the checkpoint: a batch that runs twice replaces its own rows,
and a stream with another checkpoint never touches those of this one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sitegauge.operators.extract import BAD_JSON, INVALID_UTF8, NO_OBJECT, parse_pages, rejects
from sitegauge.operators.project import DOCUMENT
from sitegauge.operators.quality import check_rows
from sitegauge.operators.snapshot import PLACE, latest_by_place, with_place
from sitegauge.plans.report import site_rows
from sitegauge.sources.pages import FILE_SCHEMA, as_pages
from sitegauge.sources.tables import replace_table
from sitegauge.sources.workdir import marked, remove

VERSION = ("scraped_at", "url")
QUERY_ID = "sql.streaming.queryId"
#: How long a page that was seen is remembered.
MEMORY = "30 days"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_stream(
    spark: SparkSession, directory: str, prefix: str = "", suffix: str = ".html",
    files_per_batch: int = 10_000,
) -> DataFrame:
    """Page files in micro-batches, as (url, content, scraped_at)."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", f"{prefix}*{suffix}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
    )
    return as_pages(files)


def site_log(log: str) -> str:
    return f"{log}/sites"


def reject_log(log: str) -> str:
    return f"{log}/rejects"


def check_log(log: str) -> str:
    return f"{log}/checks"


def volumes() -> dict[str, Column]:
    """What is counted of every batch while its pages are written."""
    by_reason = {name: F.count_if(F.col("reason") == name) for name in (INVALID_UTF8, NO_OBJECT, BAD_JSON)}
    return {"pages": F.count(F.lit(1)), "rejected": F.count("reason"), **by_reason}


def unseen(pages: DataFrame, key: Sequence[str], memory: str = MEMORY) -> DataFrame:
    """A stream without the pages whose ``key`` came before, in any batch or run of the stream.

    Keys are remembered in the state store for ``memory`` from their arrival, and not for the
    time of their scrape: no page is ever late, and one whose key has been forgotten passes
    again. The state grows with the pages of that span, on the executors' disks.
    """
    arrived = pages.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", memory)
    return arrived.dropDuplicatesWithinWatermark(list(key)).drop("_arrived")


def ingest(
    pages: DataFrame, log: str, checkpoint: str, once: bool = False,
    key: Sequence[str] = ("url", "scraped_at"),
    limits: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> StreamingQuery:
    """Append the site rows and the rejects of all waiting pages to ``log`` and stop.

    Every page of a batch ends up in one of the two logs, or is an older scrape of a domain that
    the same batch has a newer one of. A page delivered twice makes no difference to
    ``current_sites``; for a source that repeats much, ``once`` leaves out pages that came
    before (``unseen``), before they are parsed, good ones and rejects alike. However late a
    page comes, it is not dropped.

    The job that writes a batch's pages counts them on the way (``volumes``); the counts go to a log
    of checks with the lowest and highest value that ``limits`` allow, and whether one is passed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"stream={spark.sparkContext.getLocalProperty(QUERY_ID)}/batch={batch_id}"
        seen = Observation()
        counted = [column.alias(name) for name, column in volumes().items()]
        outcome = parse_pages(batch, DOCUMENT, "content").observe(seen, *counted)
        parsed = replace_table(outcome, f"{log}/parsed/{own}")
        checks = check_rows(spark, seen.get, limits or {})
        rows = site_rows(with_place(parsed), keep=(*VERSION, *PLACE))
        rejects(parsed).write.mode("overwrite").parquet(f"{reject_log(log)}/{own}")
        checks.coalesce(1).write.mode("overwrite").parquet(f"{check_log(log)}/{own}")
        latest_by_place(rows, "domain", VERSION).write.mode("overwrite").parquet(f"{site_log(log)}/{own}")
        remove(spark, f"{log}/parsed/{own}")

    spark = pages.sparkSession
    if once:
        pages = unseen(pages, key)
    before = spark.conf.get(STATE_STORE, None)
    # Keys beyond the memory of an executor; the stream takes the setting with it.
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return (
            pages.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def batch_folders(spark: SparkSession, log: str) -> list[str]:
    """Folders of the batches of ``log`` that are written to the end."""
    return marked(spark, f"{log}/stream=*/batch=*")


def read_log(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    parts = batch_folders(spark, log)
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*parts)


def current_sites(spark: SparkSession, log: str) -> DataFrame:
    """Latest row per domain over all batches of all streams."""
    schema = log_schema(spark)
    parts = batch_folders(spark, site_log(log))
    if not parts:
        return spark.createDataFrame([], schema)
    return latest_by_place(with_place(spark.read.schema(schema).parquet(*parts)), "domain", VERSION)


def batch_checks(spark: SparkSession, log: str) -> DataFrame:
    """The counts of every batch with its limits: ``stream``, ``batch``, ``metric``, ``value`` and so on."""
    parts = batch_folders(spark, check_log(log))
    empty = check_rows(spark, {}, {}).select(F.lit("").alias("stream"), F.lit("").alias("batch"), "*")
    if not parts:
        return empty
    rows = spark.read.schema(check_rows(spark, {}, {}).schema).parquet(*parts)
    place = F.col("_metadata.file_path")
    return rows.select(
        F.regexp_extract(place, "stream=([^/]+)", 1).alias("stream"), F.regexp_extract(place, "batch=([^/]+)", 1).alias("batch"), "*"
    )


def rejected_pages(spark: SparkSession, log: str) -> DataFrame:
    """Every page that could not be read, with the reason."""
    return read_log(spark, reject_log(log), rejects(no_pages(spark)).schema)


def no_pages(spark: SparkSession) -> DataFrame:
    empty = as_pages(spark.createDataFrame([], FILE_SCHEMA))
    return parse_pages(empty, DOCUMENT, "content")


def log_schema(spark: SparkSession) -> StructType:
    """Columns of the site log, from an empty run of the same steps."""
    return site_rows(no_pages(spark), keep=VERSION).schema


def compact(spark: SparkSession, log: str, path: str) -> DataFrame:
    """The latest rows as a table of their own, clustered by domain; retires the batches.

    The latest rows first go to the log as a batch of their own, then the batches that they were
    taken from are removed. Between the two steps the log has rows twice, which changes no
    result; a batch that arrives meanwhile is not among those removed. The batches of rejects
    become one as well, all rows of which stay; until the others are removed, these are there twice.
    """
    schema = log_schema(spark)
    own = f"stream=compacted/batch={uuid.uuid4().hex}"
    retired = batch_folders(spark, site_log(log))
    kept = f"{site_log(log)}/{own}"
    latest = current_sites(spark, log) if retired else spark.createDataFrame([], schema)
    latest.write.parquet(kept)
    refused = batch_folders(spark, reject_log(log))
    if len(refused) > 1:
        rows = spark.read.schema(rejects(no_pages(spark)).schema).parquet(*refused)
        rows.write.parquet(f"{reject_log(log)}/{own}")
        retired += refused
    for folder in retired:
        remove(spark, folder)
    return replace_table(spark.read.schema(schema).parquet(kept), path, cluster_by="domain")
