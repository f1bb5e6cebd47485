"""The registered queries against their SQL, and the pipeline against its stages done by hand."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F
from test_operators import ODD, brute_duplicates, brute_passages, documents, words

import __spark_entry__
import corpus_pipeline
from sitegauge.llm import decontaminate, packing, secrets_scan
from sitegauge.llm.queries import ORACLES, QUERIES
from sitegauge.llm.shingles import BAND_ROWS, BANDS, BINS, layout
from sitegauge.sources.workdir import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == ""


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(i) for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"
    ]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A table directory with copies, passages and secrets, and its rows."""
    rows = [(100 + i, " ".join(words(40, i, "word")), "en") for i in range(60)]
    rows += [(300 + i, " ".join(words(120, 3, "word")[:-i or None]), "en") for i in range(4)]
    rows += [(400 + i, "an exact copy of words in some text", "en") for i in range(5)]
    rows += [(500, " ".join(words(40, 900, "word")) + " password=abcdef123 end", "en")]
    passage = " ".join(words(20, 77, "item"))
    rows += [(600, "before " + passage + " after", "en"), (601, " ".join(passage.split()[:9]) + " alone", "en")]
    path = str(tmp_path_factory.mktemp("planted"))
    frame = spark.createDataFrame(rows + ODD, "doc_id long, text string, lang string")
    frame = frame.select("*", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    # Names that the stages use for themselves.
    frame = frame.select("*", *[F.lit(1).alias(n) for n in ("_h", "_row", "kept", "spans", "score", "component_id")])
    frame.write.parquet(f"{path}/documents.parquet")
    items = [(1, passage), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows + ODD, items


def test_stages_against_brute_force(spark, planted):
    path, rows, items = planted
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]

    docs = corpus_pipeline.identify_language(spark, docs, path).cache()
    assert docs.columns == columns
    left = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in docs.collect())
    assert left == sorted((d is None, d or 0, t) for d, t, _ in kept)

    docs = corpus_pipeline.drop_near_duplicates(spark, docs, path).cache()
    assert docs.columns == columns
    label, _ = brute_duplicates(kept)
    want = {d: t for d, t, _ in kept if d is None or label[d] == d}
    got = docs.collect()
    assert len(got) == len(want) and {r["doc_id"]: r["text"] for r in got} == want

    docs = corpus_pipeline.decontaminate_benchmark(spark, docs, path).cache()
    assert docs.columns == columns
    hits = {d for d, _, n_hit, _ in brute_passages([(d, t, None) for d, t in want.items()], items) if n_hit}
    assert hits == {600}
    want = {d: t for d, t in want.items() if d not in hits}
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == want

    docs = corpus_pipeline.mask_secrets(spark, docs, path).cache()
    assert docs.columns == columns
    want = {d: secrets_scan.masked(t, secrets_scan.base_spans(t)) for d, t in want.items()}
    assert "password" not in want[500]
    got = docs.collect()
    assert {r["doc_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)

    packed = corpus_pipeline.pack(spark, docs, path).collect()
    encode = packing.Encoder(packing.vocabulary_path()).encode
    sums = {}
    for d, t in want.items():
        body = encode(t) + np.array([1], dtype="<u4").tobytes()
        for piece, at in enumerate(range(0, len(body), 4 * 4096)):
            sums[d, piece] = zlib.crc32(body[at : at + 4 * 4096])
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in packed} == sums

    whole = corpus_pipeline.run(spark, path)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted(
        (d is None, d or 0, p, c) for (d, p), c in sums.items()
    )


def test_pipeline_without_documents(spark, planted, tmp_path):
    path, _, _ = planted
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_of_four_fifths_go(spark):
    base = [" ".join(words(300, 40 + i, "word")) for i in range(30)]
    rows, close = [], 0
    for i, text in enumerate(base):
        w = text.split()
        # Every changed word takes five shingles of 296 from both sides.
        for j, changed in enumerate((5, 6)):
            copy = list(w)
            for k in range(changed):
                copy[20 + 45 * k] = f"other{i}x{j}x{k}"
            rows.append((1000 + 10 * i + j, " ".join(copy), "en"))
        rows.append((1005 + 10 * i, text, "en"))
    label, sets = {d: d for d, _, _ in rows}, {}
    for d, t, _ in rows:
        w = t.split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    for d in sorted(sets):
        for e in sorted(sets):
            if d < e:
                s = len(sets[d] & sets[e]) / len(sets[d] | sets[e])
                close += 0.8 <= s < 0.85
                if s >= 0.8:
                    label[e] = min(label[d], label[e])
    assert close >= 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(d for d in label if label[d] == d)


def test_bands_miss_one_pair_in_a_million():
    for percent in (50, 80, 85, 90):
        n, width = layout(percent)
        assert n * width <= BINS and (1 - (percent / 100) ** width) ** n <= 1e-6
    assert layout(85) == (BANDS, BAND_ROWS)


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    one, two, three, four = (" ".join(words(60, 70 + i, "word")) for i in range(4))
    rows = [(7, one, "en"), (9, one, "en"), (7, two, "en"), (10, two, "en")]  # copies under other ids
    rows += [(11, three, "en"), (11, four, "en"), (11, four, "en"), (11, None, "en")]  # and an id alone
    docs = documents(spark, rows)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    want = [(7, one), (7, two), (11, three), (11, four), (11, None)]
    assert sorted((r["doc_id"], r["text"] or "") for r in got.collect()) == sorted((d, t or "") for d, t in want)


def test_rows_with_maps_and_repeats(spark):
    """A map column does not stop the stage; of equal rows, and of rows that differ in a map, one stays."""
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, {"a": 1}), (1, text, {"a": 1}), (1, text, {"b": 2}), (2, text, None), (3, "another text of words here", {"c": 3}), (None, "x", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    again = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(5), "")
    kept = sorted(map(str, out.collect()))
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 3] and kept == sorted(map(str, again.collect()))


def test_batches_are_bounded_in_bytes_and_a_page_holds_one_index(spark, conf, monkeypatch):
    conf(corpus_pipeline.BATCH_SETTING, "10000")
    conf(corpus_pipeline.BYTES_SETTING, str(64 << 20))
    corpus_pipeline.small_batches(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    wide = spark.range(0, 30, 1, 1).selectExpr("repeat('x', 1000000) AS text")
    assert max(r["n"] for r in wide.mapInArrow(sizes, "n long").collect()) <= 6

    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 100)
    options = []
    monkeypatch.setattr(decontaminate, "stored", lambda df, name, **more: options.append((name, more)) or stored(df, name, **more))
    docs = spark.range(0, 20, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 150) AS text")
    items = spark.createDataFrame([(1, "word3 " * 10)], "item_id long, text string")
    found = decontaminate.passages(docs, items).where("size(spans) > 0").select("doc_id").collect()
    assert [r["doc_id"] for r in found] == [3]
    assert ("index", {"parquet.page.row.count.limit": 1}) in options


def test_caches_of_the_tokenizer_can_go_with_the_task():
    own = packing.Encoder(packing.vocabulary_path(), cached=100)
    first = own.encode("some words and, more words")
    assert len(own.parts) > 1
    own.forget()
    assert len(own.parts) == len(own.words) == 1
    assert own.encode("some words and, more words") == first
