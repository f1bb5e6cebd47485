"""CSV and table sinks with their scans, and the view registry."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from sitegauge.sources.workdir import remove

CSV_DIALECT = {"header": "true", "escape": '"'}
# The reader turns a value equal to its null text into NULL. With the default, empty text, that
# would be quoted empty values too; with this one it is only a gap between separators.
GAP = "\x00"


# Line breaks within a value, and the sign that starts their stand-ins, as they are written.
STAND_INS = {"\x02": "\x02s", "\n": "\x02n", "\r": "\x02r"}


def one_line(df: DataFrame) -> DataFrame:
    """Text columns with stand-ins for line breaks, so that a row of a file is one line of it."""
    texts = [f.name for f in df.schema if f.dataType == StringType()]
    whole: dict[str, Column] = {name: F.col(f"`{name}`") for name in texts}
    for sign, stand_in in STAND_INS.items():
        whole = {name: F.replace(c, F.lit(sign), F.lit(stand_in)) for name, c in whole.items()}
    return df.withColumns(whole)


def many_lines(df: DataFrame) -> DataFrame:
    """``one_line`` undone."""
    texts = [f.name for f in df.schema if f.dataType == StringType()]
    whole: dict[str, Column] = {name: F.col(f"`{name}`") for name in texts}
    for sign, stand_in in reversed(STAND_INS.items()):
        whole = {name: F.replace(c, F.lit(stand_in), F.lit(sign)) for name, c in whole.items()}
    return df.withColumns(whole)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Flat columns to CSV, in place of what was there.

    A line break within a text is written as a stand-in that starts with a control character, so
    that every row is one line and large files can be read by many tasks; ``read_csv`` puts it back.
    """
    (
        one_line(df)
        .write.mode("overwrite")
        .options(**CSV_DIALECT)
        # Space at the ends of a value is part of it.
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, mode: str = "FAILFAST",
    line_breaks: bool = False,
) -> DataFrame:
    """CSV with declared types. Quoted empty text stays empty, an unquoted gap is NULL.

    A row that does not fit the types stops the job; ``PERMISSIVE`` makes its bad fields NULL.
    Files of ``write_csv`` have one line per row. In others, a line break within a quoted value
    needs ``line_breaks``, with which one task reads each file.
    """
    found = (
        spark.read.schema(schema)
        .options(**CSV_DIALECT)
        .option("nullValue", GAP)
        .option("multiLine", str(line_breaks).lower())
        .option("mode", mode)
        .csv(path)
    )
    return many_lines(found)


def replace_table(
    df: DataFrame, path: str, name: str | None = None, cluster_by: str | None = None
) -> DataFrame:
    """Create or replace a Parquet table at ``path`` and scan it.

    ``cluster_by`` gathers the rows of nearby keys in the same files, so that a filter on that
    column skips row groups. A hash of the row comes second, so that the rows of a hot key can
    fall into several files. With ``name`` the table is entered in the catalog instead, and its
    files lie in a folder of their own below ``path`` (see ``point_to``).
    """
    spark = df.sparkSession
    out = df
    if cluster_by:
        row = F.xxhash64(*(f.name for f in df.schema if hashable(f.dataType)))
        out = df.repartitionByRange(cluster_by, row).sortWithinPartitions(cluster_by)
    if name:
        return point_to(spark, name, path, out.write.format("parquet"))
    # Written beside the old table first: a job that fails leaves that one as it was.
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    out.write.parquet(beside)
    swap(spark, beside, path)
    return spark.read.schema(df.schema).parquet(path)


def swap(spark: SparkSession, new: str, path: str) -> None:
    """Folder ``new`` in the place of ``path``, whose former contents go.

    Between the two renames nothing is at ``path``; a table whose readers must not see that is
    replaced by name. If the second one fails, the former contents are put back.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (new, path))
    files = target.getFileSystem(conf)
    old = jvm.org.apache.hadoop.fs.Path(f"{new}.old")
    there = files.exists(target)
    if there and not files.rename(target, old):
        raise OSError(f"could not move {path} out of the way")
    if not files.rename(source, target):
        if there:
            files.rename(old, target)
        raise OSError(f"could not move {new} to {path}")
    files.delete(old, True)


def location(spark: SparkSession, name: str) -> str | None:
    """Folder of a catalog table, None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").head()
    return found["data_type"] if found else None


def point_to(spark: SparkSession, name: str, path: str, writer: DataFrameWriter) -> DataFrame:
    """What ``writer`` writes as the catalog table ``name``, in place of a former one.

    The rows first become a table of another name in a folder of their own below ``path``. Only
    when that is whole does the name pass to it, in two steps of the catalog that move no data. A
    job that fails leaves the former table as it was, files and all. Its folder goes at the end if
    it lies below ``path``; a table of another place keeps its files.
    """
    tag = uuid.uuid4().hex
    new, former = f"{name}_{tag}", location(spark, name)
    folder = f"{path.rstrip('/')}/{tag}"
    try:
        writer.option("path", folder).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        remove(spark, folder)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    if former and f"{path.rstrip('/')}/" in former:
        remove(spark, former)
    return spark.table(name)


def replace_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> DataFrame:
    """Create or replace a catalog table hashed by ``key``, one file per bucket (see ``point_to``).

    Windows, aggregates and joins on ``key`` then read it without a shuffle. For tables with a
    bounded number of rows per key, such as a series: a key lies in one bucket.
    """
    out = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    return point_to(df.sparkSession, name, path, out)


def hashable(kind: DataType) -> bool:
    """False for a type with a map in it, which Spark does not hash."""
    if isinstance(kind, ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(hashable(f.dataType) for f in kind)
    return not isinstance(kind, MapType)


def reason(error: Exception) -> str:
    """``failed:``, the kind of the error and the first line of what it says."""
    first = next(iter(str(error).splitlines()), "")
    return f"failed: {type(error).__name__}: {first}"


def register_views(
    spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]]
) -> dict[str, str]:
    """Create or replace one temporary view per builder.

    A view that cannot be built is reported and the others are still made. The values of the
    result are ``created`` or ``failed: <kind of error>: <first line of the reason>``.
    """
    status: dict[str, str] = {}
    for name, build in builders.items():
        try:
            build().createOrReplaceTempView(name)
            status[name] = "created"
        except Exception as error:
            status[name] = reason(error)
    return status
