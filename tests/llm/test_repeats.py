"""Suffix arrays against sorting, removal of repeated strings against all windows."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sitegauge.llm import repeats as rp
from sitegauge.llm.common import BATCHES, small_batches
from sitegauge.llm.suffix_array import common_prefixes, joined, suffix_array


def brute(rows, window):
    """Rows of (id, text)."""
    raw = [(text or "").encode() for _, text in rows]
    seen = collections.Counter(b[i : i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for (doc, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(doc), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((str(r["doc_id"]), *[r[c] for c in names]) for r in df.collect())


def table(spark, rows):
    out = spark.createDataFrame(rows, "doc_id long, text string")
    return out.selectExpr(
        "*", "1 AS block", "'i' AS ids", "2 AS n_bytes", "map(1, 2) AS own", "3 AS first", "4 AS offsets", "5 AS at", "6 AS shard"
    )


def texts(seed, count, letters="abc d", longest=160):
    """Texts with planted passages, copies and near copies."""
    rng = np.random.default_rng(seed)
    draw = lambda n: "".join(rng.choice(list(letters), n))
    passages = [draw(int(n)) for n in rng.integers(10, 90, 6)]
    rows = []
    for i in range(count):
        text = draw(int(rng.integers(0, longest)))
        if rng.random() < 0.5:
            at = int(rng.integers(0, len(text) + 1))
            text = text[:at] + str(rng.choice(passages)) + text[at:]
        rows.append((i, text))
    rows += [(1000 + i, rows[i][1]) for i in range(0, count, 7)]
    rows += [(2000 + i, rows[i][1][: len(rows[i][1]) // 2] + "!" + rows[i][1][len(rows[i][1]) // 2 :]) for i in range(0, count, 5)]
    return rows


ODD = [
    (1, None), (2, ""), (None, "no id"), (3, "z" * 500), (4, "xy" * 300), (5, "short"), (6, "日本語テキスト" * 12),
    (7, "\0\0\0" * 40), (8, "\0" * 30 + "é" * 30), (9, "ab" * 9 + "z" * 30), (10, "twin of a row that stands twice"),
    (10, "twin of a row that stands twice"), (11, "É" * 2000 + "line\n" * 100),
]


def test_suffix_array_and_prefixes_against_sorting():
    rng = np.random.default_rng(1)
    cases = [[bytes(rng.integers(0, 3, rng.integers(0, 80)).astype(np.uint8)) for _ in range(9)] for _ in range(25)]
    cases += [c + c[:2] + [b"\0" * 40, b"\0" * 31, c[0] * 3] for c in cases[:5]] + [[b""], [b"a"], [b"\xff" * 900]]
    for case in cases:
        symbols, starts = joined(case)
        assert [bytes((symbols[s : s + len(t)] - 1).astype(np.uint8)) for s, t in zip(starts, case)] == case
        order, place = suffix_array(symbols)
        plain = symbols.tolist()
        want = sorted(range(len(plain)), key=lambda i: plain[i:])
        assert order.tolist() == want and (place[order] == np.arange(len(plain))).all()
        shared = common_prefixes(symbols, order, place)
        for r in range(1, len(want)):
            a, b = plain[want[r - 1] :], plain[want[r] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[r] == same


@pytest.mark.parametrize(
    "seed,window,sizes",
    [
        (1, 20, {}),
        (2, 20, {"BLOCK_BYTES": 900, "SHARD_BYTES": 500, "STEP": 64}),
        # Many shards per anchor, many ranges per merge.
        (3, 12, {"BLOCK_BYTES": 700, "SHARD_BYTES": 300, "PART_SEGMENTS": 2, "RANGE_WINDOWS": 4}),
        (4, 2, {"PART_SEGMENTS": 3}),
        (5, 1, {"BLOCK_BYTES": 500}),
    ],
)
def test_removal_against_all_windows(spark, monkeypatch, seed, window, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(rp, name, value)
    rows = texts(seed, 60) + ODD
    assert got(rp.without_repeats(table(spark, rows), window)) == brute(rows, window)


def test_whole_window(spark):
    rng = np.random.default_rng(6)
    draw = lambda n: "".join(rng.choice(list("abcdefg éß"), n))
    passage = draw(500)
    edge = draw(399) + "x"
    rows = [(i, draw(700) + passage[i : 450 + i] + draw(300)) for i in range(12)]
    rows += [(50, edge), (51, edge), (52, edge[1:]), (53, passage[:380]), (54, draw(40_000) + passage + draw(30_000) + passage)]
    assert got(rp.without_repeats(table(spark, rows))) == brute(rows, rp.WINDOW)


def test_boilerplate_goes_to_several_shards(spark, monkeypatch):
    """One passage in every document, with other text around it."""
    monkeypatch.setattr(rp, "PART_SEGMENTS", 16)
    monkeypatch.setattr(rp, "RANGE_WINDOWS", 2000)
    seen = []
    shards = rp.in_shards
    monkeypatch.setattr(rp, "in_shards", lambda c, w: seen.append(c) or shards(c, w))
    rng = np.random.default_rng(7)
    draw = lambda n: "".join(rng.choice(list("abcdefg "), n))
    passage = draw(70)
    rows = [(i, draw(60) + passage + draw(60)) for i in range(150)]
    assert got(rp.without_repeats(table(spark, rows), 50)) == brute(rows, 50)
    # No shard has more of an anchor's segments than its share, give or take the hash.
    counted = seen[0].groupBy("anchor", "shard").count().collect()
    assert len(counted) > len({r["anchor"] for r in counted}) and max(r["count"] for r in counted) <= 3 * 16


def test_merge_by_binary_search():
    rng = np.random.default_rng(8)
    lists = [np.unique(rng.integers(0, 60, 20)).astype(np.uint64) for _ in range(5)]
    whole = tuple(x for x in (lists[0], lists[0] + 1, np.zeros(len(lists[0]), bool)))
    for values in lists[1:]:
        whole = rp.merged(whole, (values, values + np.uint64(1), np.zeros(len(values), bool)))
    count = collections.Counter(int(v) for x in lists for v in x)
    assert whole[0].tolist() == sorted(count) and whole[2].tolist() == [count[v] > 1 for v in sorted(count)]


def test_no_rows(spark):
    rows = [(1, "a" * 10)]
    assert got(rp.without_repeats(table(spark, rows))) == brute(rows, 400)
    none = rp.without_repeats(table(spark, rows).limit(0))
    assert none.collect() == [] and none.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_blocks_go_on_over_batches():
    rng = np.random.default_rng(9)
    rows = [(i, None if i % 9 == 4 else "é" * int(rng.integers(0, 60))) for i in range(200)] + [(200, "x" * 900), (201, None)]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    for many in (1, 7, 300):
        parts = [rows[i : i + many] for i in range(0, len(rows), many)]
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in part], schema) for part in [[], *parts, []]]
        runs = list(rp._runs(iter(batches), 300))
        back = [
            (doc, data.tobytes()[a:b].decode())
            for ids, data, offsets in runs
            for doc, a, b in zip(ids.to_pylist(), offsets[:-1], offsets[1:])
        ]
        assert back == [(doc, text or "") for doc, text in rows]
        sizes = [len(data) for _, data, _ in runs]
        assert all(size <= 300 or len(ids) == 1 for size, (ids, _, _) in zip(sizes, runs))
        # A block is as full as the documents allow, however small the batches are.
        assert all(a + b > 300 for a, b in zip(sizes, sizes[1:-1]))
    assert list(rp._runs(iter(batches[:1]), 300)) == []


def test_tasks_hold_one_block_at_a_time(spark, monkeypatch):
    """Batches are bounded, a block is a row group of its own, and the session's settings come back."""
    monkeypatch.setattr(rp, "BLOCK_BYTES", 3000)
    own = {setting: spark.conf.get(setting) for setting in BATCHES}
    seen, keep = {}, rp.stored

    def stored(df, name, **options):
        out = keep(df, name, **options)
        seen[name] = out, {setting: int(spark.conf.get(setting)) for setting in BATCHES}
        return out

    monkeypatch.setattr(rp, "stored", stored)
    rows = texts(10, 120)
    assert got(rp.without_repeats(table(spark, rows).coalesce(1), 20)) == brute(rows, 20)
    assert {name: settings for name, (_, settings) in seen.items()} == dict.fromkeys(("sifted", "segments", "found"), BATCHES)
    assert {setting: spark.conf.get(setting) for setting in BATCHES} == own
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in seen["sifted"][0].inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert len(groups) > 3 and set(groups) == {1}


def test_small_batches_leave_smaller_settings(spark):
    first, second = BATCHES
    own = spark.conf.get(first), spark.conf.get(second)
    try:
        spark.conf.set(first, "7")
        spark.conf.set(second, "1000000000")
        with pytest.raises(ZeroDivisionError), small_batches(spark):
            assert spark.conf.get(first) == "7" and spark.conf.get(second) == str(BATCHES[second])
            1 / 0
        assert spark.conf.get(first) == "7" and spark.conf.get(second) == "1000000000"
    finally:
        for setting, value in zip(BATCHES, own):
            spark.conf.set(setting, value)
