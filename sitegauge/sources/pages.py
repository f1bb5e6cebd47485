"""Page files, one document per file, and tables of pages."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sitegauge.sources.tables import replace_table

#: What opening a page file counts for when files are dealt to tasks. Spark's 4 MB would make a task of
#: every 32 pages, and a file of the table.
OPEN_COST = 32 << 10
OPEN_SETTING = "spark.sql.files.openCostInBytes"

FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def page_files(
    spark: SparkSession, directory: str, prefix: str = "", suffix: str = ".html"
) -> DataFrame:
    """Files named ``<prefix>*<suffix>`` as (url, content, scraped_at).

    Content stays binary, so that a file that is not UTF-8 can be told from a good one.
    A folder without a matching file gives an empty frame.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*{suffix}")
        .load(directory)
    )
    return as_pages(files)


def stored_pages(
    spark: SparkSession, directory: str, path: str, prefix: str = "", suffix: str = ".html"
) -> DataFrame:
    """``page_files`` read once into a Parquet table at ``path``.

    Spark packs small files, as OPEN_COST and their bytes, into tasks of
    ``spark.sql.files.maxPartitionBytes``; what follows reads large files of columns in place of
    very many small ones.
    """
    before = spark.conf.get(OPEN_SETTING)
    spark.conf.set(OPEN_SETTING, str(OPEN_COST))
    try:
        return replace_table(page_files(spark, directory, prefix, suffix), path)
    finally:
        spark.conf.set(OPEN_SETTING, before)


def write_page_files(pages: DataFrame, directory: str) -> None:
    """The one text column of ``pages`` as files named part-*.txt in a new folder, one per row.

    A file is the row's text, nothing for NULL, and a line break. Spark's writer does it in any store
    but a shared folder of the executors: there Hadoop starts two processes per file (to set rights,
    of the file and of its checksum), so tasks write the files themselves. A name follows from the
    task and the row, and a file gets it when it is whole: a task that runs twice replaces its own.
    """
    spark = pages.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(directory)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    full = system.makeQualified(place).toUri()
    if full.getScheme() != "file":
        # Tasks move their files themselves; one by one, the driver would move all.
        pages.write.options(**{"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}).text(directory)
        return
    folder = full.getPath()
    if not system.mkdirs(place):
        raise OSError(f"could not make {directory}")

    def write(rows: Iterator[Row]) -> None:
        task = TaskContext.get()
        for number, row in enumerate(rows):
            name = f"part-{task.partitionId():06d}-{number:08d}.txt"
            beside = os.path.join(folder, f".{name}.{task.taskAttemptId()}")
            with open(beside, "wb") as file:
                file.write(bytes(row[0] or b"") + b"\n")
            os.replace(beside, os.path.join(folder, name))

    # As bytes, which need not be UTF-8.
    pages.select(F.col(pages.columns[0]).cast("binary")).foreachPartition(write)


def as_pages(files: DataFrame) -> DataFrame:
    """Rows of the binary file source as (url, content, scraped_at)."""
    return files.select(
        F.col("path").alias("url"), "content", F.col("modificationTime").alias("scraped_at")
    )


def utf8_text(content: Column) -> Column:
    """Binary as text, NULL for a document with any byte sequence that is not UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text)
