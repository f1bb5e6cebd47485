"""Removal of long byte strings that stand in more than one place, by suffix arrays of shards.

A window is a string of WINDOW bytes within a document. A byte goes if a window that covers it
also starts anywhere else.

1. Every window names an anchor, the substring of CORE bytes in it with the smallest hash, so
   equal windows name equal anchors. Windows in a row with one anchor are a segment. Windows
   whose anchor's substring stands in one place alone stand there alone and need no more.
2. All segments of an anchor go to one shard, equal segments as one with their number. An anchor
   with more than PART_SEGMENTS different segments is dealt to several shards.
3. A shard's suffix array (see ``suffix_array``) and its common prefixes put equal windows side
   by side: neighbours that share WINDOW bytes or more.
4. Shards of one anchor are merged: each gives the hashes of its different windows in order,
   cut by binary search into ranges, and the lists of a range are merged by binary search.
5. The windows found go back to the documents.

Hashes of anchors only bring text together: what is equal is decided on the bytes in a shard.
Two segments are taken as equal if two 64-bit hashes, of anchor and segment, agree, windows of
different shards if two 64-bit hashes agree. Documents travel in blocks of about BLOCK_BYTES, so
no task holds more than a block, a shard or a range, or one document if that is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import chunks, frugal, mix, shipped, small_batches
from sitegauge.llm.suffix_array import common_prefixes, joined, suffix_array
from sitegauge.sources.workdir import fresh_path, remove, stored

#: Length of the strings that are removed.
WINDOW = 400
# Text of a block, of a shard, and positions whose anchors are found at once.
BLOCK_BYTES, SHARD_BYTES, STEP = 1 << 20, 1 << 20, 1 << 18
# A block is a row of up to a megabyte, and Spark's reader takes thousands of rows of a row group at
# once: a block is a row group of its own, so that no task writes or reads more than one at a time.
GROUPS = {"parquet.block.row.count.limit": 1}
#: Different segments of one anchor in one shard.
PART_SEGMENTS = 1024
# Windows of one anchor that are merged in one task, about.
RANGE_WINDOWS = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def core_of(window: int) -> int:
    """Bytes of an anchor: short enough for few anchors, long enough to be rare by chance."""
    return max(1, window * 2 // 5)


class _Rolling:
    """Hashes of any substrings of ``data``."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]) -> None:
        n = len(data)
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        inverse = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        with np.errstate(over="ignore"):
            np.cumprod(powers, out=powers)
            self.inverse = np.cumprod(inverse, out=inverse)
            powers[:n] *= data.astype(np.uint64) + np.uint64(1)
            self.sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(powers[:n], out=self.sums[1:])

    def of(self, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[first + length] - self.sums[first]) * self.inverse[first] + length.astype(np.uint64))

    def every(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[length:] - self.sums[:-length]) * self.inverse[: len(self.sums) - length] + np.uint64(length))


def segments(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor's place in it and anchor's hash, of all segments.

    ``data[offsets[i]:offsets[i + 1]]`` is document i. Segments are cut every STEP windows.
    """
    core = core_of(window)
    many = window - core + 1  # substrings of CORE bytes in a window
    found = []
    for begin in range(0, max(0, len(data) - window + 1), STEP):
        part = data[begin : begin + STEP + window - 1]
        hashes = _Rolling(part).every(core)
        n = len(part) - window + 1
        # Hash and place in one number: the smallest is the leftmost of the smallest hashes.
        key = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
        rows = -(-len(key) // many)
        padded = np.full(rows * many, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[: len(key)] = key
        ahead = np.minimum.accumulate(padded.reshape(rows, many), axis=1).reshape(-1)
        back = np.minimum.accumulate(padded.reshape(rows, many)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(back[:n], ahead[many - 1 : many - 1 + n]) & np.uint64(0xFFFFFF)
        # Windows that do not cross into the next document.
        at = np.arange(begin, begin + n)
        doc = np.searchsorted(offsets, at, side="right") - 1
        inside = np.flatnonzero(at + window <= offsets[doc + 1])
        if not len(inside):
            continue
        anchor, doc = least[inside].astype(np.int64), doc[inside]
        cut = np.append(True, (np.diff(anchor) != 0) | (np.diff(doc) != 0))
        at = np.flatnonzero(cut)
        first = inside[at]
        size = np.diff(np.append(at, len(inside)))
        found.append((first + begin, size, anchor[at] - first, hashes[anchor[at]]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _packed(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), dtype=kind)


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, bytes and offsets of runs of documents of about ``limit`` bytes, which go on from batch to batch."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        last = None
        for cut in chunks(batch.column(1), limit):
            if last is not None:
                yield batch.column(0).slice(last[0], last[1] - last[0]), *last[2:]
            last = cut
        rest = batch.slice(last[0]) if last is not None else None
    if rest is not None:
        yield rest.column(0), *next(chunks(rest.column(1), limit))[2:]


def blocks(docs: DataFrame, window: int) -> DataFrame:
    """Runs of documents with their text, their segments and the different anchors of these."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, (ids, data, offsets) in enumerate(_runs(batches, BLOCK_BYTES)):
            first, size, at, hashes = segments(data, offsets, window)
            anchors, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            ids = pa.concat_arrays([ids])  # a list column starts at its first row
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([offsets.tolist()], pa.list_(pa.int64())),
                    pa.array([_packed(data)], pa.binary()),
                    pa.array([len(first)], pa.int64()),
                    pa.array([_packed(np.diff(first, prepend=0))], pa.binary()),
                    pa.array([_packed(np.stack([size, at]).astype(np.int32))], pa.binary()),
                    pa.array([_packed(which.astype(np.int32))], pa.binary()),
                    pa.array([len(anchors)], pa.int64()),
                    pa.array([_packed(anchors)], pa.binary()),
                    pa.array([_packed(np.minimum(counts, 2).astype(np.int8))], pa.binary()),
                ],
                names=BLOCK_COLUMNS,
            )

    schema = (
        f"block long, ids array<{kind}>, offsets array<long>, text binary, n long, first binary, shape binary, "
        "which binary, n_anchors long, anchors binary, counts binary"
    )
    return shipped(docs).select("doc_id", "text").mapInArrow(frugal(build), schema)


BLOCK_COLUMNS = ["block", "ids", "offsets", "text", "n", "first", "shape", "which", "n_anchors", "anchors", "counts"]


def repeated_anchors(table: DataFrame) -> DataFrame:
    """``block``, ``anchor`` and its number ``at`` in the block, of anchors that stand in two places or more."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n_anchors"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["block"]), pa.int64()),
                        pa.array(np.arange(n, dtype=np.int32), pa.int32()),
                        pa.array(_unpacked(row["anchors"], "<i8", n), pa.int64()),
                        pa.array(_unpacked(row["counts"], "<i1", n), pa.int8()),
                    ],
                    names=["block", "at", "anchor", "n"],
                )

    wanted = shipped(table).select("block", "n_anchors", "anchors", "counts")
    # A block has an anchor once, however often it stands there.
    rows = wanted.mapInArrow(frugal(each), "block long, at int, anchor long, n tinyint")
    many = rows.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    return rows.join(many, "anchor", "left_semi").select("block", "anchor", "at")


def _texts(data: bytes, offsets: np.ndarray) -> np.ndarray:
    return _unpacked(data, "<u1", int(offsets[-1]))


def sifted(table: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """Blocks cut down to documents with a repeated anchor, and their segments that have one.

    ``done`` holds the outcome of the other documents, from which nothing goes. Equal segments
    of a block are one pair of anchor and hash, with their number.
    """
    kind = table.schema["ids"].dataType.elementType.simpleString()

    def sift(block: pa.Table, repeated: pa.Table) -> pa.Table:
        row = {c: block.column(c)[0] for c in block.column_names}
        ids = row["ids"].values
        offsets = np.asarray(row["offsets"].as_py(), dtype=np.int64)
        data = _texts(row["text"].as_py(), offsets)
        n = row["n"].as_py()
        first = np.cumsum(_unpacked(row["first"].as_py(), "<i8", n))
        size, at = _unpacked(row["shape"].as_py(), "<i4", 2 * n).reshape(2, n).astype(np.int64)
        which = _unpacked(row["which"].as_py(), "<i4", n)
        hashes = np.zeros(row["n_anchors"].as_py(), dtype=np.int64)
        hot = np.zeros(len(hashes), dtype=bool)
        known = repeated.column("at").to_numpy()
        hot[known], hashes[known] = True, repeated.column("anchor").to_numpy()
        keep = np.flatnonzero(hot[which])
        first, size, at, anchor = first[keep], size[keep], at[keep], hashes[which[keep]]
        doc = np.searchsorted(offsets, first, side="right") - 1
        touched = np.zeros(len(ids), dtype=bool)
        touched[doc] = True
        # The segments' hashes, over as much text at a time as in ``segments``.
        own = np.zeros(len(first), dtype=np.uint64)
        for begin in range(0, len(data), STEP):
            some = np.arange(*np.searchsorted(first, [begin, begin + STEP]))
            if len(some):
                last = int((first[some] + size[some]).max()) + window - 1
                rolling = _Rolling(data[first[some[0]] : last], BASES[1])
                own[some] = rolling.of(first[some] - first[some[0]], size[some] + window - 1)
        own = mix(own ^ (at.astype(np.uint64) + np.uint64(1))).view(np.int64)
        order = np.lexsort((own, anchor))
        new = np.append(True, (np.diff(anchor[order]) != 0) | (own[order][1:] != own[order][:-1])) if len(order) else order
        heads = np.flatnonzero(new)
        pair = np.zeros(len(order), dtype=np.int32)
        pair[order] = np.cumsum(new) - 1 if len(order) else 0
        chosen = order[heads]
        # Texts of the touched documents, closed up.
        sizes = np.diff(offsets)
        kept = np.flatnonzero(touched)
        bounds = np.concatenate([[0], np.cumsum(sizes[kept])])
        moved = np.zeros(len(ids), dtype=np.int64)
        moved[kept] = bounds[:-1] - offsets[kept]
        text = np.concatenate([data[offsets[d] : offsets[d + 1]] for d in kept]) if len(kept) else data[:0]
        rest = np.flatnonzero(~touched)
        raw = data.tobytes()
        shas = [sha256(raw[offsets[d] : offsets[d + 1]]).hexdigest() for d in rest]
        done = pa.StructArray.from_arrays(
            [ids.take(pa.array(rest)), pa.array(sizes[rest], pa.int64()), pa.array(shas, pa.string())],
            names=["doc_id", "n_bytes", "kept_sha256"],
        )
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.Table.from_arrays(
            [
                pa.array([row["block"].as_py()], pa.int64()),
                one(done),
                one(ids.take(pa.array(kept))),
                pa.array([bounds.tolist()], pa.list_(pa.int64())),
                pa.array([_packed(text)], pa.binary()),
                pa.array([len(first)], pa.int64()),
                pa.array([_packed(np.diff(first + moved[doc], prepend=0))], pa.binary()),
                pa.array([_packed(pair)], pa.binary()),
                one(pa.array(anchor[chosen], pa.int64())),
                one(pa.array(own[chosen], pa.int64())),
                one(pa.array(size[chosen], pa.int32())),
                one(pa.array(np.bincount(pair, minlength=len(chosen)), pa.int64())),
            ],
            names=["block", "done", "ids", "offsets", "text", "n", "first", "pair", "anchor", "own", "windows", "copies"],
        )

    schema = (
        f"block long, done array<struct<doc_id:{kind},n_bytes:long,kept_sha256:string>>, ids array<{kind}>, "
        "offsets array<long>, text binary, n long, first binary, pair binary, anchor array<long>, own array<long>, "
        "windows array<int>, copies array<long>"
    )
    wanted = shipped(table).select(*BLOCK_COLUMNS[:9])
    return wanted.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(sift, schema)


def shard_contents(table: DataFrame, pairs: DataFrame, window: int) -> DataFrame:
    """Every different segment once, with its bytes, its number and its shard."""
    distinct = pairs.groupBy("anchor", "own").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("block", "at", "windows")).alias("_from")
    )
    distinct = stored(distinct.select("anchor", "own", "copies", "_from.*"), "segments")
    size = distinct.agg(F.sum(F.col("windows") + F.lit(window - 1)).alias("s")).collect()[0]["s"] or 0
    shards = -(-size // SHARD_BYTES)
    # The few anchors with more segments than one shard takes.
    large = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > PART_SEGMENTS)
    parts = F.coalesce(F.ceil(F.col("_n") / PART_SEGMENTS), F.lit(1)).cast("int")
    part = F.pmod("own", F.col("parts").cast("long"))
    shard = F.when(F.col("parts") > 1, F.xxhash64("anchor", part)).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(max(1, shards))))
    wanted = (
        distinct.join(large, "anchor", "left")
        .withColumn("parts", parts)
        .select("block", "at", "anchor", "own", "copies", "parts", shard.alias("shard"))
    )

    def cut(block: pa.Table, asked: pa.Table) -> pa.Table:
        row = {c: block.column(c)[0].as_py() for c in ("offsets", "text", "n", "first", "pair", "windows")}
        data = _texts(row["text"], np.asarray(row["offsets"])).tobytes()
        first = np.cumsum(_unpacked(row["first"], "<i8", row["n"]))
        pair = _unpacked(row["pair"], "<i4", row["n"])
        place = np.zeros(len(row["windows"]), dtype=np.int64)
        place[pair] = first
        at = asked.column("at").to_numpy()
        starts = place[at]
        ends = starts + np.asarray(row["windows"])[at] + window - 1
        contents = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        return asked.drop_columns(["block", "at"]).append_column("content", pa.array(contents, pa.binary()))

    slim = shipped(table).select("block", "offsets", "text", "n", "first", "pair", "windows")
    schema = "anchor long, own long, copies long, parts int, shard long, content binary"
    return slim.join(wanted.select("block").distinct(), "block", "left_semi").groupBy("block").cogroup(
        wanted.groupBy("block")
    ).applyInArrow(cut, schema)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def search_shard(contents: list[bytes], copies: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Whether each window stands in two places or more; the windows' groups, starts and segments.

    Windows of one group are equal.
    """
    symbols, starts = joined(contents)
    sizes = np.array([len(c) for c in contents], dtype=np.int64) - window + 1
    segment = np.repeat(np.arange(len(contents)), sizes)
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    order, place = suffix_array(symbols)
    shared = common_prefixes(symbols, order, place)
    group = np.cumsum(shared < window)[place[at]]
    count = np.bincount(group, weights=np.minimum(copies, 2)[segment])
    return count[group] > 1, group, at - starts[segment], segment


_FOUND = (
    "anchor long, own long, runs array<int>, range int, f1 binary, f2 binary, owner binary, offset binary, known binary"
)


def in_shards(contents: DataFrame, window: int) -> DataFrame:
    """Runs of repeated windows of each segment, and the windows of anchors in several shards.

    The latter, one of each group, are in the order of their hash and cut into ranges.
    """

    def search(shard: pa.Table) -> pa.Table:
        texts = shard.column("content").to_pylist()
        twice, group, offset, segment = search_shard(texts, shard.column("copies").to_numpy(), window)
        anchor, own = shard.column("anchor").to_numpy(), shard.column("own").to_numpy()
        bounds = np.searchsorted(segment, np.arange(len(texts) + 1))
        out = {c: [] for c in ("anchor", "own", "runs", "range", "f1", "f2", "owner", "offset", "known")}

        def row(**values) -> None:
            for c, column in out.items():
                column.append(values.get(c))

        for i in range(len(texts)):
            a, b = runs_of(twice[bounds[i] : bounds[i + 1]])
            if len(a):
                row(anchor=int(anchor[i]), own=int(own[i]), runs=np.stack([a, b], axis=1).reshape(-1).tolist())
        parts = shard.column("parts").to_numpy()
        for name in np.unique(anchor[parts > 1]):
            mine = np.flatnonzero((anchor == name)[segment])
            _, one = np.unique(group[mine], return_index=True)
            mine = mine[one]
            symbols = np.frombuffer(b"".join(texts), dtype=np.uint8)
            starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            places, length = starts[segment[mine]] + offset[mine], np.full(len(mine), window)
            f1, f2 = (_Rolling(symbols, base).of(places, length) for base in BASES)
            by_hash = np.argsort(f1)
            f1, f2, mine = f1[by_hash], f2[by_hash], mine[by_hash]
            n = int(parts[anchor == name][0])
            ranges = -(-n * PART_SEGMENTS * (window // 4) // RANGE_WINDOWS)
            edges = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)
            cuts = np.concatenate([[0], np.searchsorted(f1, edges), [len(f1)]])
            for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    part = mine[a:b]
                    row(
                        anchor=int(name), range=number, f1=f1[a:b].tobytes(), f2=f2[a:b].tobytes(),
                        owner=own[segment[part]].tobytes(), offset=offset[part].astype(np.int64).tobytes(),
                        known=twice[part].tobytes(),
                    )
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), *[pa.binary()] * 5)
        return pa.table({c: pa.array(column, kind) for (c, column), kind in zip(out.items(), kinds)})

    return shipped(contents).groupBy("shard").applyInArrow(search, _FOUND)


def merged(one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Two ordered lists of hashes as one: first hash, second hash, whether it was in two lists."""
    at = np.searchsorted(one[0], two[0])
    near = np.minimum(at, len(one[0]) - 1)
    same = (one[0][near] == two[0]) & (one[1][near] == two[1])
    twice = one[2].copy()
    twice[near[same]] = True
    rest = ~same
    return tuple(np.insert(a, at[rest], b[rest]) for a, b in zip((one[0], one[1], twice), two))


def across_shards(found: DataFrame) -> DataFrame:
    """Windows that stand alone in their shard, but in another shard of their anchor as well."""

    def merge(rows: pa.Table) -> pa.Table:
        column = lambda c, kind: [np.frombuffer(x, dtype=kind) for x in rows.column(c).to_pylist()]
        f1, f2 = column("f1", "<u8"), column("f2", "<u8")
        lists = [(a, b, np.zeros(len(a), dtype=bool)) for a, b in zip(f1, f2)]
        while len(lists) > 1:
            odd = lists[len(lists) // 2 * 2 :]
            lists = [merged(a, b) for a, b in zip(lists[::2], lists[1::2])] + odd
        all1, all2, twice = lists[0]
        owner, offset = [], []
        for a, b, own, at, known in zip(f1, f2, column("owner", "<i8"), column("offset", "<i8"), column("known", "?")):
            place = np.searchsorted(all1, a)
            new = twice[place] & (all2[place] == b) & ~known
            owner.append(own[new])
            offset.append(at[new])
        own, at = np.concatenate(owner), np.concatenate(offset)
        runs = pa.FixedSizeListArray.from_arrays(pa.array(np.stack([at, at + 1], axis=1).reshape(-1), pa.int32()), 2)
        name = rows.column("anchor")[0].as_py()
        return pa.table(
            {"anchor": pa.array([name] * len(own), pa.int64()), "own": pa.array(own, pa.int64()), "runs": runs.cast(pa.list_(pa.int32()))}
        )

    parts = shipped(found).where("range IS NOT NULL").select("anchor", "range", "f1", "f2", "owner", "offset", "known")
    return parts.groupBy("anchor", "range").applyInArrow(merge, "anchor long, own long, runs array<int>")


def removed(table: DataFrame, results: DataFrame, window: int) -> DataFrame:
    """Documents of ``table`` with the number of bytes that go, their runs, and what stays."""
    kind = table.schema["ids"].dataType.elementType.simpleString()

    def cut(block: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: block.column(c)[0] for c in block.column_names}
        ids = row["ids"].values
        offsets = np.asarray(row["offsets"].as_py(), dtype=np.int64)
        data = _texts(row["text"].as_py(), offsets)
        n = row["n"].as_py()
        first = np.cumsum(_unpacked(row["first"].as_py(), "<i8", n))
        pair = _unpacked(row["pair"].as_py(), "<i4", n)
        by_pair = np.argsort(pair, kind="stable")
        bounds = np.searchsorted(pair[by_pair], np.arange(len(row["anchor"]) + 1))
        lists = found.column("runs").combine_chunks()
        runs = lists.flatten().to_numpy().astype(np.int64).reshape(-1, 2)
        each = np.repeat(found.column("at").to_numpy(), lists.value_lengths().to_numpy() // 2)
        # Every place of a segment has its runs.
        places = bounds[each + 1] - bounds[each]
        which = np.repeat(bounds[each] - (np.cumsum(places) - places), places) + np.arange(int(places.sum()))
        start = first[by_pair[which]]
        edge = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(edge, start + np.repeat(runs[:, 0], places), 1)
        np.add.at(edge, start + np.repeat(runs[:, 1], places) + window - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        begins[heads] = gone[heads]
        n_gone, n_runs = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begins))
        rest, kept_to = data[~gone].tobytes(), offsets - n_gone[offsets]
        shas = [sha256(rest[a:b]).hexdigest() for a, b in zip(kept_to[:-1], kept_to[1:])]
        return pa.Table.from_arrays(
            [
                pa.concat_arrays([ids]),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(np.diff(n_gone[offsets]), pa.int64()),
                pa.array(np.diff(n_runs[offsets]), pa.int64()),
                pa.array(shas, pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    slim = shipped(table).where(F.size("ids") > 0).select("block", "ids", "offsets", "text", "n", "first", "pair", "anchor")
    return slim.groupBy("block").cogroup(results.groupBy("block")).applyInArrow(cut, schema)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Texts are their UTF-8 bytes; NULL counts as empty, and a text shorter than ``window`` bytes
    stays. Repeated rows and ids are documents of their own, so all of a copy goes from each of
    them. An empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "blocks")
    whole = blocks(docs, window)
    with small_batches(spark):
        whole.write.options(**GROUPS).parquet(path)
        table = spark.read.schema(whole.schema).parquet(path)
        table = stored(sifted(table, repeated_anchors(table), window), "sifted", **GROUPS)
        # Nothing reads the blocks any more.
        remove(spark, path)
        every = F.posexplode(F.arrays_zip("anchor", "own", "windows", "copies")).alias("at", "_p")
        pairs = table.select("block", every).select("block", "at", "_p.*")
        found = stored(in_shards(shard_contents(table, pairs, window), window), "found")
    runs = found.where("range IS NULL").select("anchor", "own", "runs").unionByName(across_shards(found))
    runs = runs.groupBy("anchor", "own").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    results = pairs.select("block", "at", "anchor", "own").join(runs, ["anchor", "own"])
    # New names, as the table is on both sides of what follows.
    results = results.select("block", "at", "runs").toDF("block", "at", "runs")
    untouched = table.select(F.explode("done").alias("_d")).select(
        "_d.doc_id", "_d.n_bytes", *[F.lit(0).cast("long").alias(c) for c in ("n_removed", "n_spans")], "_d.kept_sha256"
    )
    return untouched.unionByName(removed(table, results, window))


ORACLE = f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
place AS MATERIALIZED (
  SELECT r, i, md5(array_slice(b, i + 1, i + {WINDOW})) AS h
  FROM (SELECT r, b, unnest(range(0, octet_length(b) - {WINDOW - 1})) AS i FROM doc WHERE octet_length(b) >= {WINDOW})),
again AS (SELECT h FROM place GROUP BY h HAVING count(*) > 1),
hit AS (SELECT p.r, p.i FROM place p JOIN again a ON a.h = p.h),
fresh AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {WINDOW} THEN 0 ELSE 1 END AS new FROM hit),
island AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM fresh),
span AS MATERIALIZED (SELECT r, k, min(i) AS a, max(i) + {WINDOW} AS z FROM island GROUP BY r, k),
piece AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS s, a AS e FROM span
  UNION ALL SELECT d.r, max(s.z), octet_length(any_value(d.b)) FROM doc d JOIN span s ON s.r = d.r GROUP BY d.r),
kept AS (
  SELECT p.r, sha256(unhex(string_agg(CASE WHEN p.e > p.s THEN hex(array_slice(d.b, p.s + 1, p.e)) ELSE '' END, '' ORDER BY p.s))) AS sha
  FROM piece p JOIN doc d ON d.r = p.r GROUP BY p.r),
sums AS (SELECT r, sum(z - a) AS gone, count(*) AS n FROM span GROUP BY r)
SELECT d.doc_id, CAST(octet_length(d.b) AS BIGINT) AS n_bytes, CAST(coalesce(s.gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s.n, 0) AS BIGINT) AS n_spans, coalesce(k.sha, sha256(d.b)) AS kept_sha256
FROM doc d LEFT JOIN sums s ON s.r = d.r LEFT JOIN kept k ON k.r = d.r"""
