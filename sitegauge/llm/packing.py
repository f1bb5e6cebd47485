"""Best-fit packing of token sequences by the sum-of-squares rule.

A piece goes to the open bin whose choice makes the sum of squares of the numbers of open bins
per residual gap smallest; a bin is opened only where no open one fits. Where a piece goes
depends on lengths alone, so the rule runs on the histogram of lengths (at most ``capacity``
rows, whatever the size of the table), in steps of up to a 64th of a length's pieces. What it
decides is a list of runs: pieces of one length by rank, bins by number. Tasks then look up
their own pieces in the runs.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import frugal, shipped
from sitegauge.operators.snapshot import PLACE, with_place
from sitegauge.sources.workdir import stored

CAPACITY = 4096
END_ID = 1
STEPS = 64

# Entries of each of the two caches of a Python worker: some 250 bytes an entry, kept from task to
# task. More of them save time, fewer memory.
CACHED = 600_000
CACHED_CHARS = 48

PIECES = "piece int, start long, length long, ids_crc32 long"

_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    If the vocabulary lower-cases and drops white space, the ids of a text are those of its
    parts between blanks, one after another; parts are kept in a cache, and a part of letters
    and signs is put together from cached words. Else each text is encoded as one.
    """

    def __init__(self, path: str, cached: int = CACHED) -> None:
        from tokenizers import Tokenizer

        self.cached = cached
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        steps = [s.get("type") for s in (form.get("normalizer") or {}).get("normalizers", [])]
        splits = [s.get("type") for s in (form.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.by_part = steps == ["NFC", "Replace", "Lowercase"] and splits == ["Split", "ByteLevel"]
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def forget(self) -> None:
        """Empties the caches."""
        self.parts, self.words = {"": b""}, {"": b""}

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        out = self.words.get(word)
        if out is None:
            shown = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            out = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
            if len(self.words) >= self.cached:
                self.words = {"": b""}
            if len(word) <= CACHED_CHARS:
                self.words[word] = out
        return out

    def _part(self, part: str) -> bytes:
        found = _PLAIN.fullmatch(part)
        out = self._word(found[1].lower()) + self._word(found[2]) if found else self._direct(part)
        if len(part) <= CACHED_CHARS:
            self.parts[part] = out
        return out

    def encode(self, text: str) -> bytes:
        if not self.by_part:
            return self._direct(text)
        if len(self.parts) >= self.cached:
            self.parts = {"": b""}
        split = text.replace("\n", " ").split(" ")
        try:
            return b"".join(map(self.parts.__getitem__, split))
        except KeyError:
            known = self.parts
            return b"".join([known[p] if p in known else self._part(p) for p in split])


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, cached: int = CACHED) -> Encoder:
    """One encoder per Python worker and file."""
    if (path, cached) not in _ENCODERS:
        _ENCODERS[path, cached] = Encoder(path, cached)
    return _ENCODERS[path, cached]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False, cached: int = CACHED, keep: bool = True
) -> DataFrame:
    """Pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is the ids of its whole text and an end id; only longer ones are cut. With
    ``ids`` the ids themselves come as an array. NULL and empty texts are one end id; rows
    with equal or NULL ``doc_id`` are documents of their own. Without ``keep`` the caches, and
    the memory that they freed, go with each task, for workers that have other work to do.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, cached).encode
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows, numbers, starts, lengths, sums, bodies = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                body = encode(text.as_py() or "") + end
                for number, at in enumerate(range(0, len(body), 4 * capacity)):
                    part = body[at : at + 4 * capacity]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if ids:
                        bodies.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns.append(pa.array(bodies, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECES}" + (", ids array<int>" if ids else "")
    def cut_and_forget(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from cut(batches)
        finally:
            encoder(path, cached).forget()

    work = cut if keep else frugal(cut_and_forget)
    return shipped(docs).select("doc_id", "text").mapInArrow(work, schema)


def sum_of_squares(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, pieces, first bin, offset in the bin) and the number of bins.

    Lengths go from long to short. Of a run, the piece of rank ``first + i`` goes to bin
    ``first bin + i``. ``histogram`` has at most ``capacity`` entries.
    """
    open_bins = np.zeros(capacity + 1, dtype=np.int64)  # by residual gap; gap 0 is closed
    where: list[deque] = [deque() for _ in range(capacity + 1)]
    runs: list[tuple[int, int, int, int, int]] = []
    bins = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        step = max(1, -(-left // steps))
        while left:
            gaps = open_bins[length:]
            fits = np.flatnonzero(gaps)
            if len(fits):
                after = open_bins[fits].copy()
                after[fits == 0] = 0
                best = int(fits[np.argmin(after - gaps[fits])])
                gap = best + length
                count = min(step, left, int(open_bins[gap]))
                open_bins[gap] -= count
            else:
                # No more bins at once than these pieces fill by themselves.
                gap, count = capacity, min(step, -(-left // (capacity // length)))
                where[capacity].append((bins, count))
                bins += count
            rest = gap - length
            need = count
            while need:
                first, size = where[gap].popleft()
                take = min(size, need)
                runs.append((length, rank, take, first, capacity - gap))
                if rest:
                    where[rest].append((first, take))
                if size > take:
                    where[gap].appendleft((first + take, size - take))
                rank += take
                need -= take
            if rest:
                open_bins[rest] += count
            left -= count
    return np.array(runs, dtype=np.int64).reshape(-1, 5), bins


def ranked(parts: DataFrame) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0.

    A length that many pieces share is dealt over about sqrt(pieces) groups by a hash of the
    piece and its place in its file (PLACE), so that equal pieces are dealt as well; a piece's
    rank is its place in its group plus the sizes of the groups before.
    """
    total = parts.count()
    salts = int(total**0.5) + 1
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", PLACE[1])
    salted = parts.drop(PLACE[0]).withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32", PLACE[1])
    return (
        salted.withColumn("_place", F.row_number().over(within) - 1)
        .join(sizes, ["length", "_salt"])
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .drop("_salt", "_place", "_before", PLACE[1])
    )


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; bins have no gap between pieces.

    ``parts`` has ``doc_id``, ``piece``, ``length`` and ``ids_crc32``. It is stored first, as it
    is read three times. Equal rows are pieces of their own. An empty table gives none.
    The driver gets one row per length, at most ``capacity``, and sends the runs, whose number
    is bounded by ``capacity`` * STEPS splits, each moved once per piece in a bin.
    """
    spark = parts.sparkSession
    parts = stored(parts, "pieces")
    counted = parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    runs, _ = sum_of_squares({r["length"]: r["n"] for r in counted}, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    sent = spark.sparkContext.broadcast(runs)
    names = [*parts.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        # Ranks stay below 2^48, so length and rank make one sorted key.
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            bins = table[at, 3] + rank - table[at, 1]
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bins), pa.array(table[at, 4])], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return shipped(ranked(with_place(parts))).mapInArrow(place, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences of ids from packed pieces that carry ``ids``.

    A group is one sequence, so no more than its capacity. Columns: ``sequence_id``, ``ids``
    and ``segments``, the start of each piece, for masks that keep documents apart.
    """
    one = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(one.alias("_all")).select(
        "sequence_id",
        F.flatten(F.col("_all.ids")).alias("ids"),
        F.col("_all.offset").alias("segments"),
    )


def packed_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, ids: bool = False, cached: int = CACHED,
    keep: bool = True,
) -> DataFrame:
    """Every document cut, if longer than ``capacity``, and packed."""
    return pack(pieces(docs, path or vocabulary_path(), capacity, ids, cached, keep), capacity)
