"""The shared folder for tables that cut lineage.

On a cluster it is the one named by ``spark.checkpoint.dir``. Only a local master without
that setting gets a folder of its own, as in tests, which goes with the Python process. The
tables of an application lie in one folder; whoever runs it calls ``clear`` when no result is
read any more.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="sitegauge-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared_dir(spark)}/sitegauge/{app}/{name}-{uuid.uuid4().hex}"


def folders(spark: SparkSession, path: str, files: bool = False) -> list[str]:
    """Folders, and with ``files`` all entries, in the folder ``path``; none if there is no such."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    return sorted(e.getPath().toString() for e in system.listStatus(place) if files or e.isDirectory())


def marked(spark: SparkSession, pattern: str, mark: str = "_SUCCESS") -> list[str]:
    """Folders that match ``pattern`` and hold the file ``mark``, by one listing of the store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/{mark}")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(e.getPath().getParent().toString() for e in found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete the folder ``path``, if there is one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has stored. What still reads them fails after."""
    app = spark.conf.get("spark.app.id", "app")
    remove(spark, f"{shared_dir(spark)}/sitegauge/{app}")


def stored(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write ``df`` once, with ``options`` of the Parquet writer, and read it back.

    What follows reads files: a lost executor costs a re-read of some of them and not the
    work above, and a second consumer does not repeat that work.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
