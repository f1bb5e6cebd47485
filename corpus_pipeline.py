"""The training-data pipeline: documents through filters to packed sequences.

Every stage works on all that its predecessor kept and returns the columns of ``documents``,
but for the last one, which returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.llm import decontaminate, languages, near_dedup, packing, secrets_scan
from sitegauge.llm.common import remainder, table
from sitegauge.sources.workdir import stored

#: A document is kept if its language is known at least this surely. The score of a text with
#: letters is the product of two mean probabilities, so only texts that fit nothing are below.
LEAST_SCORE = 0.2

#: Least similarity of near copies, in per cent of their shingles of five words.
NEAR_PERCENT = 80

#: Entries of the tokenizer's caches, which go with each task: the workers run the other stages as well.
CACHED = 150_000


#: Rows, and bytes, that Spark hands to a Python worker at once, which all stages share. Without the
#: bytes, the indexes of all shards of a file, or long texts, would be one batch.
BATCH_ROWS = 2_500
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of what follows in this session, unless they are smaller already."""
    for setting, most in ((BATCH_SETTING, BATCH_ROWS), (BYTES_SETTING, BATCH_BYTES)):
        now = int(spark.conf.get(setting).rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(setting, str(most))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language, and those that fit none; ``lang`` becomes what was found.

    A NULL or empty text, or one without a letter, has no language and goes; a NULL ``lang`` is not
    learned from. An empty table stays empty.
    """
    small_batches(spark)
    model = languages.fit(docs, remainder("doc_id", 5) != 0)
    return languages.relabelled(docs, model, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id, the first of equal rows.

    Rows that share an id and differ in their texts are documents of their own. Documents
    without an id are in no group and stay.
    """
    small_batches(spark)
    # The row travels as one column, so that no name of the input can clash.
    key = F.xxhash64("doc_id", "text")
    rows = docs.where("doc_id IS NOT NULL").select(F.struct("*").alias("_row"), key.alias("_key"))
    texts = rows.select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text"))
    found = near_dedup.near_duplicates(texts, percent=NEAR_PERCENT)
    groups = stored(found.select(F.col("doc_id").alias("_key"), "component_id").distinct(), "groups")
    nodes = rows.groupBy("_key").agg(F.min("_row.doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    least = nodes.join(groups, "_key").groupBy("component_id").agg(F.min(F.struct("id", "_key", "n")).alias("_first"))
    kept = stored(least.select("_first._key", "_first.n"), "kept")
    named = rows.join(kept.where("n = 1").select("_key").hint("merge"), "_key", "left_semi").select("_row")
    repeated = kept.where("n > 1").select("_key")
    if not repeated.isEmpty():
        same = rows.join(repeated.hint("merge"), "_key", "left_semi")
        # Of equal ids and texts the row with the smallest hash of all its values, maps too.
        whole = F.xxhash64(F.to_json("_row", {"ignoreNullFields": "false"}))
        named = named.unionByName(same.groupBy("_key").agg(F.min_by("_row", whole).alias("_row")).select("_row"))
    return named.select("_row.*").unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs.

    A NULL or empty text has none and stays, and so does everything if there is no item with words.
    """
    small_batches(spark)
    found = decontaminate.passages(docs, table(spark, sf_dir, "benchmark"))
    hit = found.where(F.size("spans") > 0).select(F.col("text_hash").alias("_h")).distinct()
    # The row travels as one column, so that no name of the input can clash.
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_h"))
    return rows.join(hit.hint("merge"), "_h", "left_anti").select("_row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; ``n_chars`` follows.

    A NULL text stays NULL, and so does its ``n_chars``; an empty one stays empty. All rows stay.
    """
    small_batches(spark)
    clean = secrets_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in as few sequences as possible.

    A NULL text counts as empty, which is one end-of-text token; an empty table gives no pieces.
    """
    small_batches(spark)
    packed = packing.packed_documents(docs, cached=CACHED, keep=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: SQL has no expression for the learned stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what its predecessor kept, written and read again in between."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
