"""Benchmark passages in documents, found by backward search in an FM-index per shard.

The documents are cut into shards of about SHARD_WORDS words; each shard's index (see
``fm_index``) is written once. The windows of the benchmark are the patterns. They go to the
shards in batches of bounded size, so a benchmark of any size passes in as many rounds over
the stored indexes as it has batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from sitegauge.llm.common import ALNUM, chunks, frugal, list_array, shipped, signed, words_of
from sitegauge.llm.fm_index import FmIndex
from sitegauge.sources.workdir import stored

WINDOW = 10
SHARD_WORDS = 1 << 19
# Windows sent to the tasks at once: some 100 bytes each.
BATCH_WINDOWS = 100_000
# An index is a row of some megabytes, and Parquet looks at a page's size every 100 rows only: a row
# is a page of its own, so that what is compressed at once is one index and not all of a task.
PAGES = {"parquet.page.row.count.limit": 1}
# Occurrences looked up at once.
LOCATE_STEP = 1 << 20


def shards(docs: DataFrame) -> DataFrame:
    """An index per shard, with the ids, text hashes and word counts of its documents.

    A shard ends with the document that fills it; a longer document is one shard.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, hashes, counts = [], [], [], []
        total = 0

        def row() -> pa.RecordBatch:
            sizes = np.concatenate(counts)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            index = FmIndex.build(np.concatenate(hashes), bounds).to_bytes()
            every = pa.concat_arrays(ids)
            one = pa.array([0, len(every)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([index], pa.binary()),
                    pa.ListArray.from_arrays(one, every),
                    pa.ListArray.from_arrays(one, pa.concat_arrays(texts)),
                    pa.ListArray.from_arrays(one, pa.array(sizes, pa.int64())),
                ],
                names=["index", "ids", "text_hashes", "counts"],
            )

        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(1)):
                words = words_of(data, offsets, ALNUM)
                ids.append(batch.column(0).slice(first, end - first))
                texts.append(batch.column(2).slice(first, end - first))
                hashes.append(words.hashes)
                counts.append(np.diff(words.bounds))
                total += len(words.hashes)
                if total >= SHARD_WORDS:
                    yield row()
                    ids, texts, hashes, counts = [], [], [], []
                    total = 0
        if ids:
            yield row()

    schema = f"index binary, ids array<{kind}>, text_hashes array<long>, counts array<long>"
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    return shipped(hashed).mapInArrow(frugal(build), schema)


def windows(benchmark: DataFrame) -> DataFrame:
    """``item_id`` and ``window``, word hashes; an item of fewer than ten words is one window."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(1)):
                words = words_of(data, offsets, ALNUM)
                rows, values, bounds = [], [], [0]
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                    width = min(WINDOW, b - a)
                    for at in range(a, b - width + 1) if width else ():
                        rows.append(first + i)
                        values.append(words.hashes[at : at + width])
                        bounds.append(bounds[-1] + width)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows, pa.int64())),
                            list_array(signed(np.concatenate(values)), np.array(bounds), pa.int64()),
                        ],
                        names=["item_id", "window"],
                    )

    return shipped(benchmark).select("item_id", "text").mapInArrow(frugal(cut), f"item_id {kind}, window array<long>").distinct()


def _spans(pos: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the merged intervals [pos, pos + length)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, pos, 1)
    np.add.at(edge, pos + lengths, -1)
    hit = np.cumsum(edge) > 0
    turn = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def search_shard(index: FmIndex, patterns: np.ndarray, lengths: np.ndarray, items: np.ndarray):
    """Document, first and end word of every merged span; document and item of every find.

    ``items[i]`` is the number of the item that pattern i belongs to.
    """
    low, high = index.find(patterns, lengths)
    counts = high - low
    found = np.flatnonzero(counts)
    pos, width, pairs = [], [], []
    many = int(items.max(initial=0)) + 1
    if len(found):
        which = np.repeat(found, counts[found])
        offset = np.arange(len(which)) - np.repeat(np.cumsum(counts[found]) - counts[found], counts[found])
        places = low[which] + offset
        for first in range(0, len(places), LOCATE_STEP):
            part = slice(first, first + LOCATE_STEP)
            where = index.locate(places[part])
            doc = np.searchsorted(index.starts, where, side="right") - 1
            pos.append(where)
            width.append(lengths[which[part]])
            pairs.append(np.unique(doc * many + items[which[part]]))
    if not pos:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    first, end = _spans(np.concatenate(pos), np.concatenate(width), int(index.starts[-1]))
    doc = np.searchsorted(index.starts, first, side="right") - 1
    pair = np.unique(np.concatenate(pairs))
    return doc, first - index.starts[doc], end - index.starts[doc], pair // many, pair % many


def _search(index_table: DataFrame, batch: list, id_kind: str, item_type: DataType) -> DataFrame:
    """All documents of all shards with what this batch of windows finds in them."""
    names: dict = {}
    items = np.array([names.setdefault(r["item_id"], len(names)) for r in batch], dtype=np.int64)
    lengths = np.array([len(r["window"]) for r in batch], dtype=np.int64)
    patterns = np.zeros((len(batch), WINDOW), dtype=np.uint64)
    for i, r in enumerate(batch):
        patterns[i, : lengths[i]] = np.array(r["window"], dtype=np.int64).view(np.uint64)
    sent = index_table.sparkSession.sparkContext.broadcast((patterns, lengths, items, list(names)))
    kept_type = to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, lengths, items, names = sent.value
        known = pa.array(names, kept_type)
        for batch in batches:
            for row in range(batch.num_rows):
                index = FmIndex.from_bytes(batch.column(0)[row].as_py())
                ids, hashes, counts = (batch.column(i)[row].values for i in (1, 2, 3))
                doc, first, end, pair_doc, pair_item = search_shard(index, patterns, lengths, items)
                n = len(ids)
                span_at = np.searchsorted(doc, np.arange(n + 1))
                item_at = np.searchsorted(pair_doc, np.arange(n + 1))
                spans = pa.StructArray.from_arrays(
                    [pa.array(first, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        hashes,
                        counts,
                        pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), spans),
                        pa.ListArray.from_arrays(pa.array(item_at, pa.int32()), known.take(pa.array(pair_item))),
                    ],
                    names=["doc_id", "text_hash", "n_words", "spans", "items"],
                )

    schema = (
        f"doc_id {id_kind}, text_hash long, n_words long, "
        f"spans array<struct<start:long,end:long>>, items array<{item_type.simpleString()}>"
    )
    return shipped(index_table).mapInArrow(frugal(run), schema)


def merged(spans: Column) -> Column:
    """Overlapping or touching spans of an array made one."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        return F.when((F.size(done) > 0) & (s["start"] <= last["end"]), grown).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.array().cast(kind), add)


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_words``, ``spans`` (of words, end exclusive) and ``items``.

    One row for every row of ``docs``, whether or not anything is found. NULL and empty texts
    have no words; items without words are never found. Rows that repeat an ``item_id`` add
    their windows to it; what an item without an id finds counts, but is not listed. Repeated
    documents and equal ids are rows of their own. Other columns are not looked at.
    """
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType
    index_table = stored(shards(docs), "index", **PAGES)
    patterns = stored(windows(benchmark), "windows")
    rounds = -(-patterns.count() // BATCH_WINDOWS)
    if rounds <= 1:
        return _search(index_table, patterns.collect(), id_kind, item_kind)
    # Every round is one batch by hash; its finds are merged with the others' per document.
    # Equal rows of id and text find the same, so merging them loses nothing but their number.
    dealt = F.pmod(F.xxhash64("window", "item_id"), F.lit(rounds))
    found = None
    for number in range(rounds):
        batch = patterns.where(dealt == number).collect()
        one = _search(index_table, batch, id_kind, item_kind)
        found = one if found is None else found.unionByName(one)
    by_row = found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count(F.lit(1)).alias("_n"),
        merged(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    copies = F.explode(F.sequence(F.lit(1), (F.col("_n") / rounds).cast("int")))
    return by_row.withColumn("_copy", copies).drop("_n", "_copy")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests per document."""
    listed = F.array_compact("items")
    names = F.array_join(F.sort_array(F.transform(listed, lambda i: i.cast("string"))), ",")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_passages(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the words of all spans cut out of ``text``, columns as they were.

    Only documents with a span are touched; of one, the bytes from a span's first word to the
    end of its last go.
    """
    hits = found.where(F.size("spans") > 0).select("doc_id", "text_hash", "spans")
    hits = hits.dropDuplicates(["doc_id", "text_hash"])
    # The row travels as one column, so that no name of the input can clash.
    rows = shipped(docs).select(F.struct("*").alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("_row.text") == F.col("text_hash"))
    marked = rows.join(hits, same, "left")

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        out = []
        for text, own in zip(texts, spans):
            if own is None or not len(own):
                out.append(text)
                continue
            raw = text.encode()
            words = words_of(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), ALNUM)
            kept, at = [], 0
            for span in own:
                kept.append(raw[at : words.starts[span["start"]]])
                at = words.ends[span["end"] - 1]
            out.append(b"".join([*kept, raw[at:]]).decode())
        return pd.Series(out, dtype=object)

    text = F.when(F.col("spans").isNotNull(), cut("_row.text", "spans")).otherwise(F.col("_row.text"))
    return marked.select(
        *[text.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns]
    )


ORACLE = f"""
WITH doc AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
pattern AS MATERIALIZED (
  SELECT DISTINCT item_id, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s, least(len(w), {WINDOW}) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
width AS (SELECT DISTINCT k FROM pattern),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, width WHERE len(w) >= k)),
hit AS MATERIALIZED (
  SELECT p.doc_id, p.i, p.k, t.item_id FROM place p JOIN pattern t ON t.s = p.s AND t.k = p.k),
word AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(coalesce(d.w, [])) AS BIGINT) AS n_words, coalesce(w.n_hit, 0) AS n_hit,
       coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.names, '')) AS items_sha256,
       coalesce(w.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word w ON w.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id"""
