"""Score of whole texts by online logistic context mixing, beside a smoothed word model.

1. Texts become blocks: words as numbers into the block's own list of word hashes.
2. The lists' training counts are summed over all blocks; each block gets the sums of its own
   words back, so no task or driver ever holds the corpus's vocabulary.
3. The predictors' counts, a table of fixed size, are gathered from every training word, summed
   in steps of bounded width.
4. The mixing weights are trained on every training word, block by block, and averaged.
5. Passages after the same words are counted over all blocks, and each block gets the counts of
   its own ones back, as in 2; how often such a passage comes again is counted by gate.
6. Every block is scored with the table, the weights and its passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm import context_mixing as cm
from sitegauge.llm import recall
from sitegauge.llm.common import SPACED, chunks, frugal, remainder, shipped, words_of
from sitegauge.sources.workdir import stored

#: Tokens of a block; a longer document is one block.
BLOCK_TOKENS = 1 << 21
END_HASH = np.uint64(0x1D8E4E27C47D124F)
# Words whose bits are worked out at once.
STEP_WORDS = 3 << 16
# Parts of the table, and tables summed at once.
PARTS, FAN = 64, 32
# Weights are summed as whole numbers of this part of one, so that the order decides nothing.
WEIGHT_UNIT = 1 << 24
# Cells of a count by ranges, and words that one task may sort to choose the most frequent.
CELLS, SORTED_WORDS = 1024, 1 << 16
LN10 = float(np.log(10))


def _packed(array: np.ndarray) -> bytes:
    return pa.compress(array.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str, n: int) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), dtype=kind)


BLOCK = (
    "block long, n_words long, n_tokens long, n_bytes array<long>, train array<boolean>, bounds array<long>, "
    "hashes binary, tokens binary, trained binary, n_anchors long, places binary, contexts binary, pairs binary"
)


def blocks(docs: DataFrame, learn: Column) -> DataFrame:
    """Documents in blocks: ``ids``, ``train``, token ``bounds``, the block's words and its tokens.

    ``trained`` counts each of the block's words in its training documents; ``places``,
    ``contexts`` and ``pairs`` are its anchors.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, train, sizes, n_bytes, hashes, anchors = [], [], [], [], [], []
        number, total = 0, 0
        # Spark numbers the task's part of the table; the block's number is unique with it.
        part = TaskContext.get().partitionId()

        def row() -> pa.RecordBatch:
            every = np.concatenate(hashes)
            words, tokens, counts = np.unique(every, return_inverse=True, return_counts=True)
            # Frequent words get small numbers, which pack well.
            order = np.argsort(-counts, kind="stable")
            new = np.empty(len(words), dtype=np.uint32)
            new[order] = np.arange(len(words), dtype=np.uint32)
            words, tokens = words[order], new[tokens]
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            flags = pa.concat_arrays(train)
            learned = np.repeat(flags.to_numpy(zero_copy_only=False), np.diff(bounds))
            trained = np.bincount(tokens[learned], minlength=len(words))
            whole = pa.concat_arrays(ids)
            one = pa.array([0, len(whole)], pa.int32())
            places, contexts, pairs = (np.concatenate(parts) for parts in zip(*anchors))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 24) + number], pa.int64()),
                    pa.array([len(words)], pa.int64()),
                    pa.array([len(tokens)], pa.int64()),
                    pa.ListArray.from_arrays(one, pa.array(np.concatenate(n_bytes), pa.int64())),
                    pa.ListArray.from_arrays(one, flags),
                    pa.array([bounds], pa.list_(pa.int64())),
                    pa.array([_packed(words)], pa.binary()),
                    pa.array([_packed(tokens)], pa.binary()),
                    pa.array([_packed(trained.astype(np.int64))], pa.binary()),
                    pa.array([len(places)], pa.int64()),
                    *(pa.array([_packed(a)], pa.binary()) for a in (places.astype(np.uint32), contexts, pairs)),
                    pa.ListArray.from_arrays(one, whole),
                ],
                names=[
                    "block", "n_words", "n_tokens", "n_bytes", "train", "bounds", "hashes", "tokens", "trained",
                    "n_anchors", "places", "contexts", "pairs", "ids",
                ],
            )

        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(1)):
                words = words_of(data, offsets, SPACED)
                hashes.append(np.insert(words.hashes, words.bounds[1:], END_HASH))
                sizes.append(np.diff(words.bounds) + 1)
                at, context, pair = recall.anchors(hashes[-1], np.concatenate([[0], np.cumsum(sizes[-1])]))
                anchors.append((at + total, context, pair))
                n_bytes.append(np.diff(offsets))
                ids.append(batch.column(0).slice(first, end - first))
                train.append(batch.column(2).slice(first, end - first))
                total += len(hashes[-1])
                if total >= BLOCK_TOKENS:
                    yield row()
                    ids, train, sizes, n_bytes, hashes, anchors = [], [], [], [], [], []
                    number, total = number + 1, 0
        if ids:
            yield row()

    return shipped(docs).select("doc_id", "text", learn.alias("learn")).mapInArrow(frugal(build), f"{BLOCK}, ids array<{kind}>")


def word_counts(table: DataFrame) -> DataFrame:
    """``block``, ``at`` and ``n``: how often training has the block's word number ``at``.

    ``hash`` is set on one of a word's rows, and NULL on the others, so that sums over words
    need no other shuffle. A word has one row per block, however often it stands there.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_words"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["block"]), pa.int64()),
                        pa.array(np.arange(n, dtype=np.int32), pa.int32()),
                        pa.array(_unpacked(row["hashes"], "<i8", n), pa.int64()),
                        pa.array(_unpacked(row["trained"], "<i8", n), pa.int64()),
                    ],
                    names=["block", "at", "hash", "own"],
                )

    rows = shipped(table).select("block", "n_words", "hashes", "trained").mapInArrow(frugal(each), "block long, at int, hash long, own long")
    word = Window.partitionBy("hash")
    return rows.select(
        "block",
        "at",
        F.sum("own").over(word).alias("n"),
        F.when(F.col("block") == F.min("block").over(word), F.col("hash")).alias("hash"),
    )


def by_block(counts: DataFrame) -> DataFrame:
    """``block`` and ``counts``, its words' counts in order; no more than the block has words."""

    def pack(rows: pa.Table) -> pa.Table:
        at, n = rows.column("at").to_numpy(), rows.column("n").to_numpy()
        out = np.zeros(len(at), dtype=np.int64)
        out[at] = n
        return pa.table({"block": rows.column("block")[:1], "counts": pa.array([_packed(out)], pa.binary())})

    return shipped(counts).select("block", "at", "n").groupBy("block").applyInArrow(pack, "block long, counts binary")


def passage_counts(table: DataFrame) -> DataFrame:
    """``block``, ``n`` and ``seen``: the passages of a block whose words before stand elsewhere too.

    ``seen`` has their numbers among the block's different passages, the passage's count and that
    of the words before, over all training documents. A passage has one row per block; those
    of one context meet only as partial sums and in a join, which Spark splits where it is skewed.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_anchors"]
                if not n:
                    continue
                places, contexts = _unpacked(row["places"], "<u4", n), _unpacked(row["contexts"], "<i8", n)
                pairs, index, inverse = np.unique(_unpacked(row["pairs"], "<u8", n), return_index=True, return_inverse=True)
                learned = np.array(row["train"])[np.searchsorted(row["bounds"], places, side="right") - 1]
                own = np.bincount(inverse[learned], minlength=len(pairs))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(pairs), row["block"]), pa.int64()),
                        pa.array(np.arange(len(pairs), dtype=np.int32), pa.int32()),
                        pa.array(contexts[index], pa.int64()),
                        pa.array(pairs.view(np.int64), pa.int64()),
                        pa.array(own, pa.int64()),
                        pa.array(np.bincount(inverse) > own),
                    ],
                    names=["block", "at", "context", "pair", "own", "held"],
                )

    def pack(rows: pa.Table) -> pa.Table:
        seen = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("at", "n", "total")])
        return pa.table(
            {"block": rows.column("block")[:1], "n": pa.array([seen.shape[1]], pa.int64()), "seen": pa.array([_packed(seen)], pa.binary())}
        )

    wanted = shipped(table).select("block", "train", "bounds", "n_anchors", "places", "contexts", "pairs")
    rows = stored(wanted.mapInArrow(frugal(each), "block long, at int, context long, pair long, own long, held boolean"), "passages")
    totals = rows.groupBy("context").agg(F.sum("own").alias("total"), F.max("held").alias("held"))
    # What one training document alone holds predicts nothing in itself, nor does what none holds.
    totals = totals.where("total > 1 OR (total = 1 AND held)").drop("held")
    useful = rows.drop("held").join(totals.hint("merge"), "context")
    counted = useful.select("block", "at", "total", F.sum("own").over(Window.partitionBy("pair")).alias("n"))
    return counted.groupBy("block").applyInArrow(pack, "block long, n long, seen binary")


def _chances(row: dict, seen: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors' places and passages' ends in a block, and ``recall.chances`` of them."""
    n, bounds = row["n_anchors"], np.asarray(row["bounds"])
    places = _unpacked(row["places"], "<u4", n).astype(np.int64)
    pairs = _unpacked(row["pairs"], "<u8", n)
    known, gate, share = recall.chances(places, pairs, bounds, np.asarray(row["train"]), seen)
    return places[known], recall.ends(places, bounds)[known], gate, share


def recall_chances(table: DataFrame, seen: DataFrame) -> np.ndarray:
    """By gate, the chance that a passage is one that training held elsewhere after the same words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, _, gate, share = _chances(row, _unpacked(row["seen"], "<i8", 3 * row["n"]).reshape(3, -1))
                learned = np.array(row["train"])[np.searchsorted(row["bounds"], places, side="right") - 1]
                every = np.bincount(gate[learned], minlength=recall.GATES)
                again = np.bincount(gate[learned & (share > 0)], minlength=recall.GATES)
                yield pa.RecordBatch.from_arrays([pa.array([[*every, *again]], pa.list_(pa.int64()))], names=["counts"])

    wanted = table.select("block", "train", "bounds", "n_anchors", "places", "pairs").join(seen.hint("merge"), "block")
    rows = shipped(wanted).mapInArrow(frugal(count), "counts array<long>")
    cells = [F.coalesce(F.sum(F.col("counts")[i]), F.lit(0)) for i in range(2 * recall.GATES)]
    every, again = np.array(rows.agg(*cells).collect()[0], dtype=float).reshape(2, -1)
    return (again + 0.5) / (every + 1)


def symbols_of(hashes: np.ndarray, coded: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Symbol of each word: its place among the coded ones from 1, or 0."""
    known, symbol = coded
    if not len(known):
        return np.zeros(len(hashes), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, symbol[at], 0)


def document_runs(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about STEP_WORDS tokens."""
    first = 0
    while first < len(bounds) - 1:
        end = int(np.searchsorted(bounds, bounds[first] + STEP_WORDS, side="right")) - 1
        end = max(end, first + 1)
        yield first, end
        first = end


def predictor_counts(table: DataFrame, coded: tuple, code: cm.Code) -> np.ndarray:
    """Zeros and ones by slot over all training words. The result's size is fixed.

    Every task sums its blocks; the tasks' tables, in parts, are summed FAN at a time.
    """
    sent = table.sparkSession.sparkContext.broadcast((coded, code))
    size = -(-cm.TOTAL // PARTS)
    schema = "part int, source long, counts binary"

    def rows_of(counts: np.ndarray, source: int) -> pa.RecordBatch:
        packed = [_packed(counts[i * size : (i + 1) * size].astype(np.int64)) for i in range(PARTS)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(range(PARTS), pa.int32()),
                pa.array([source] * PARTS, pa.int64()),
                pa.array(packed, pa.binary()),
            ],
            names=["part", "source", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, code = sent.value
        counts = np.zeros((cm.TOTAL, 2), dtype=np.int64)
        any_row = False
        for batch in batches:
            for row in batch.to_pylist():
                any_row = True
                hashes = _unpacked(row["hashes"], "<u8", row["n_words"])
                tokens = _unpacked(row["tokens"], "<u4", row["n_tokens"])
                symbols = symbols_of(hashes, coded)
                bounds, train = np.array(row["bounds"]), np.array(row["train"])
                for first, end in document_runs(bounds):
                    own = train[first:end]
                    keep = np.repeat(own, np.diff(bounds[first : end + 1]))
                    part = tokens[bounds[first] : bounds[end]][keep]
                    starts = np.concatenate([[0], np.cumsum(np.diff(bounds[first : end + 1])[own])])[:-1]
                    if len(part):
                        cm.count_into(counts, cm.events(hashes[part], symbols[part], starts, code))
        if any_row:
            yield rows_of(counts, TaskContext.get().partitionId())

    def add(rows: pa.Table) -> pa.Table:
        low = rows.column("part")[0].as_py() * size
        n = 2 * min(size, cm.TOTAL - low)
        parts = [_unpacked(r.as_py(), "<i8", n) for r in rows.column("counts")]
        total = _packed(np.sum(parts, axis=0))
        source = rows.column("source")[0].as_py() // FAN
        return pa.table(
            {"part": rows.column("part")[:1], "source": pa.array([source], pa.int64()), "counts": pa.array([total], pa.binary())}
        )

    wanted = shipped(table).select("n_words", "n_tokens", "train", "bounds", "hashes", "tokens")
    summed = stored(wanted.mapInArrow(frugal(count), schema), "predictors")
    most = summed.agg(F.max("source").alias("m")).collect()[0]["m"]
    while most is not None and most > 0:
        group = F.floor(F.col("source") / FAN)
        summed = stored(summed.groupBy("part", group.alias("_group")).applyInArrow(add, schema), "predictors")
        most //= FAN
    out = np.zeros((cm.TOTAL, 2), dtype=np.int64)
    for row in summed.collect():
        low = row["part"] * size
        n = min(size, cm.TOTAL - low)
        out[low : low + n] = _unpacked(bytes(row["counts"]), "<i8", 2 * n).reshape(n, 2)
    return out


def trained_weights(table: DataFrame, coded: tuple, code: cm.Code, counts: np.ndarray) -> np.ndarray:
    """Mean last weights over the lanes of all training documents, their own bits not counted.

    A lane counts as often as it has bits. Every task sums the weights of its blocks; Spark sums
    those, so one row comes back.
    """
    context = table.sparkSession.sparkContext
    sent = context.broadcast((coded, code, cm.logits_left_out(counts)))
    wanted = shipped(table).select("n_words", "n_tokens", "train", "bounds", "hashes", "tokens")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, code, logits = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                hashes = _unpacked(row["hashes"], "<u8", row["n_words"])
                tokens = _unpacked(row["tokens"], "<u4", row["n_tokens"])
                symbols = symbols_of(hashes, coded)
                bounds, train = np.array(row["bounds"]), np.array(row["train"])
                bits, summed = 0, np.zeros((cm.GATES, cm.INPUTS))
                for begin, end in document_runs(bounds):
                    sizes, chosen = np.diff(bounds[begin : end + 1]), train[begin:end]
                    part = tokens[bounds[begin] : bounds[end]][np.repeat(chosen, sizes)]
                    if not len(part):
                        continue
                    docs = np.concatenate([[0], np.cumsum(sizes[chosen])])
                    found = cm.events(hashes[part], symbols[part], docs[:-1], code)
                    first, length, _ = cm.lanes_of(found.sizes, docs)
                    if not len(first):
                        continue
                    last = cm.run_lanes(
                        cm.left_out(logits, found), found.bits, found.depth, first, length, cm.first_weights()
                    )
                    bits += int(length.sum())
                    summed += last
                if bits:
                    units = np.rint(summed * WEIGHT_UNIT).astype(np.int64).reshape(-1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bits], pa.int64()), pa.array([units], pa.list_(pa.int64()))], names=["n", "weights"]
                    )

    rows = wanted.mapInArrow(frugal(learn), "n long, weights array<long>")
    cells = [F.sum(F.col("weights")[i].cast("decimal(20,0)")).alias(f"w{i}") for i in range(cm.GATES * cm.INPUTS)]
    total = rows.agg(F.sum("n").alias("n"), *cells).collect()[0]
    if not total["n"]:
        return cm.first_weights()
    return np.array(total[1:], dtype=float).reshape(cm.GATES, cm.INPUTS) / WEIGHT_UNIT / total["n"]


def _cut(rows: DataFrame, key: Column, low: int, high: int, k: int, enough: int) -> tuple[int, int, int]:
    """The range of ``key`` that the k-th smallest row lies in, and the number of rows below it.

    ``low`` up to ``high`` holds all keys. The range is narrowed by counts over CELLS parts of it
    until the rows up to its end are no more than ``enough``, or it is one key.
    """
    before = 0
    while True:
        width = -(-(high - low) // CELLS)
        within = rows.where((key >= low) & (key < high))
        cell = F.floor((key - low) / width).cast("long").alias("cell")
        counts = sorted(tuple(r) for r in within.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).collect())
        for at, n in counts:
            if before + n >= k:
                break
            before += n
        low, high = low + at * width, min(high, low + (at + 1) * width)
        if before + n <= enough or width == 1:
            return low, high, before


def most_frequent(words: DataFrame, k: int) -> list:
    """The k words (``hash``, ``n``) with the largest counts, ties by hash; all if there are fewer.

    The least count that is still among them is found by counts over ranges, and so, among words
    of that same count, is a bound of the hash. At most SORTED_WORDS or k words are sorted,
    whatever the number of words, also if they all have the same count.
    """
    enough = max(k, SORTED_WORDS)
    total = words.agg(F.count(F.lit(1)).alias("v"), F.max("n").alias("most")).collect()[0]
    if total["v"] > enough:
        most = total["most"]
        down = F.lit(most) - F.col("n")
        low, high, before = _cut(words, down, 0, most + 1, k, enough)
        chosen = down < high
        if high - low == 1:
            spread = F.shiftrightunsigned("hash", 32)
            tied = words.where(down == low)
            _, bound, _ = _cut(tied, spread, 0, 1 << 32, k - before, enough)
            chosen = (down < low) | ((down == low) & (spread < bound))
        words = words.where(chosen)
    return words.orderBy(F.desc("n"), F.shiftrightunsigned("hash", 32), "hash").limit(k).select("hash", "n").collect()


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, counts, ``base_score``, ``score``.

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end; NULL is an
    empty text, one end alone. Learns from rows whose crc32(doc_id) mod 5 is not 1; a NULL id
    counts as empty text there. ``base_score`` is the smoothed word model's, ``score`` the
    mixing's log10 of the text's probability, ``bits_per_byte`` the same per byte of text and
    end. Without training words all counts are 0 and every word is the one unknown one.
    Repeated rows and ids are learned and scored one by one.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = stored(blocks(docs, remainder("doc_id", 5) != 1), "blocks")
    counts = stored(word_counts(table), "counts")
    words = counts.where(F.col("hash").isNotNull() & (F.col("n") > 0))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).collect()[0]
    n_all, n_words = total["n"], total["v"]
    top = most_frequent(words, cm.CODED)
    known = np.array([r["hash"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(known)
    coded = (known[order], (order + 1).astype(np.int64))
    rest = n_all - sum(r["n"] for r in top)
    code = cm.Code.build(np.array([rest, *[r["n"] for r in top]]))
    tables = predictor_counts(table, coded, code)
    weights = trained_weights(table, coded, code, tables)
    seen = stored(passage_counts(table), "recall")
    sent = spark.sparkContext.broadcast((coded, code, cm.logits_of(tables), weights, recall_chances(table, seen)))
    base_all = float(np.log10(n_all + 0.5 * (n_words + 1)))
    rest_all = float(np.log10(rest + 0.5 * (n_words - len(top) + 1)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, code, logits, weights, again = sent.value
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at] for n in batch.schema.names}
                n_words, n_tokens = row["n_words"].as_py(), row["n_tokens"].as_py()
                hashes = _unpacked(row["hashes"].as_py(), "<u8", n_words)
                tokens = _unpacked(row["tokens"].as_py(), "<u4", n_tokens)
                known = _unpacked(row["counts"].as_py(), "<i8", n_words)
                bounds = row["bounds"].values.to_numpy()
                symbols = symbols_of(hashes, coded)
                log = np.log10(known + 0.5)
                plain = np.where(symbols == 0, log - rest_all, 0.0)
                anchors = {c: row[c].as_py() for c in ("n_anchors", "places", "pairs")}
                anchors.update(bounds=bounds, train=row["train"].values.to_numpy(zero_copy_only=False))
                n_seen = row["n"].as_py() or 0
                seen = _unpacked(row["seen"].as_py(), "<i8", 3 * n_seen) if n_seen else np.zeros(0, np.int64)
                places, ends, gate, share = _chances(anchors, seen.reshape(3, -1))
                mixed = np.zeros(len(bounds) - 1)
                for first, end in document_runs(bounds):
                    part = tokens[bounds[first] : bounds[end]]
                    local = bounds[first : end + 1] - bounds[first]
                    found = cm.events(hashes[part], symbols[part], local[:-1], code)
                    lane, length, _ = cm.lanes_of(found.sizes, local)
                    logs = np.zeros(len(found.bits), dtype=np.float32)
                    inputs = (logits.take(s, mode="clip") for s in found.slots)
                    cm.run_lanes(inputs, found.bits, found.depth, lane, length, weights, logs)
                    # Natural logs of all that stands before a word, by its bits and behind the escape.
                    upto = np.concatenate([[0], np.cumsum(logs, dtype=float)])[np.concatenate([[0], np.cumsum(found.sizes)])]
                    mixed[first:end] = np.diff(upto[local])
                    upto[1:] += np.cumsum(plain[part]) * LN10
                    low, high = np.searchsorted(places, bounds[[first, end]])
                    start, stop = places[low:high] - bounds[first], ends[low:high] - bounds[first]
                    more = recall.gain(upto[stop] - upto[start], share[low:high], again[gate[low:high]])
                    doc = np.searchsorted(local, start, side="right") - 1
                    mixed[first:end] += np.bincount(doc, weights=more, minlength=end - first)
                mixed /= LN10
                sums = [np.add.reduceat(v[tokens], bounds[:-1]) for v in (log, plain, (known > 0).astype(np.int64))]
                sizes = np.diff(bounds)
                result = mixed + sums[1]
                n_bytes = row["n_bytes"].values.to_numpy() + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        row["ids"].values,
                        pa.array(~row["train"].values.to_numpy(zero_copy_only=False)),
                        pa.array(sizes, pa.int64()),
                        pa.array(sums[2], pa.int64()),
                        pa.array(np.full(len(sizes), n_all), pa.int64()),
                        pa.array(sums[0] - sizes * base_all, pa.float64()),
                        pa.array(result, pa.float64()),
                        pa.array(-result / np.log10(2) / n_bytes, pa.float64()),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                )

    joined = table.drop("trained", "contexts").join(by_block(counts).hint("merge"), "block")
    joined = joined.join(seen.hint("merge"), "block", "left")
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double"
    )
    return shipped(joined).mapInArrow(frugal(each), schema)
