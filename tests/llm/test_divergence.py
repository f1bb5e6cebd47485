"""Divergence of sources by row accumulation against sums over all terms."""

import collections
import re

import duckdb
import numpy as np
import pytest
from oracle import difference

from sitegauge.llm import divergence as dv

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, ranks):
    """Rows of (text, lang, source)."""
    counts, docs, groups = collections.defaultdict(collections.Counter), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(UPPER))
        counts[lang, source].update(words)
        docs.update((lang, w) for w in set(words))
    kept = collections.defaultdict(list)
    for (lang, w), n in docs.items():
        if n >= least:
            kept[lang].append(w)

    def shares(own, terms):
        total = sum(own[t] for t in terms)
        return {t: 1 + 10**9 * (own[t] + 5) // (total + 5 * len(terms)) for t in terms}

    out = []
    whole = {lang: sum((counts[g] for g in groups if g[0] == lang), collections.Counter()) for lang, _ in groups}
    p = {g: shares(counts[g], kept[g[0]]) for g in groups}
    for lang, source in groups:
        q = shares(whole[lang], kept[lang])
        own = p[lang, source]
        pairs = [(-sum(abs(own[t] - p[lang, h][t]) for t in own), h.encode()) for l, h in groups if l == lang and h != source]
        terms = [(-(own[t] - q[t]), t.encode()) for t in own if counts[lang, source][t] and own[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
            out += [(lang, source, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def table(spark, rows):
    out = spark.createDataFrame(rows, "text string, lang string, source string")
    return out.selectExpr("1 AS doc_id", "*", "2 AS n", "'t' AS term", "map('a', 1) AS number", "3 AS value", "4 AS rank", "5 AS p")


def texts(count, sources, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["ÉTÉ", "日本", "ß", "Zoo", "zOO"]
    rows = []
    for _ in range(count):
        n = int(rng.integers(0, 60))
        source = int(rng.integers(0, sources)) if rng.random() > 0.35 else 0  # a hot source
        words = [vocabulary[int(i)] for i in (rng.random(n) ** 2 * len(vocabulary))]
        rows.append((" 1,".join(words), str(rng.choice(["en", "fr"])), f"s{source}"))
    return rows


ODD = [
    (None, None, None), ("", "en", "s0"), (None, "en", "empty"), ("123 -- !!", "en", "digits"), ("rare unseen", "de", "a"),
    (None, "de", "b"), ("wab " * 30000, "fr", "long"), ("wab wac", "en", None), ("wab wac", None, "s1"), ("wab", "en", "É"),
    ("wab", "en", "z"), ("wab", "en", "日"), ("wab wab", "en", "😀"), ("wab wab", "en", "�"),
]


@pytest.mark.parametrize("sources,slice_cells,block,held", [(6, 1 << 19, 64, 1 << 20), (90, 300, 16, 500), (20, 40, 7, 64)])
def test_audit_against_sums_over_all_terms(spark, monkeypatch, sources, slice_cells, block, held):
    monkeypatch.setattr(dv, "SLICE_CELLS", slice_cells)
    monkeypatch.setattr(dv, "BLOCK_ROWS", block)
    monkeypatch.setattr(dv, "HELD_CELLS", held)
    rows = texts(700, sources, sources) + ODD
    rows += rows[:40]
    assert got(dv.audit(table(spark, rows), 8, 5)) == brute(rows, 8, 5)


def test_nothing_kept_and_no_rows(spark):
    rows = [("one two", "en", "a"), ("two", "en", "b"), (None, "fr", "a")]
    assert got(dv.audit(table(spark, rows))) == brute(rows, 30, 50) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert dv.audit(table(spark, rows).limit(0)).collect() == []


def test_accumulator_against_whole_rows():
    rng = np.random.default_rng(0)
    dense = rng.integers(0, 3, (6, 40)) * rng.integers(0, 1000, (6, 40))
    absent = np.array([3, 5, 7, 11, 13, 17])
    whole = np.where(dense > 0, dense, absent[:, None])
    term, peer = np.nonzero(dense.T)
    share = dense.T[term, peer]
    _, term = np.unique(term, return_inverse=True)
    n = int(term.max()) + 1
    index = (np.searchsorted(term, np.arange(n + 1)), peer, share)
    used = np.flatnonzero((dense > 0).any(0))
    rows = [np.flatnonzero(dense[i][used]) for i in range(6)]
    out = dv.accumulate(rows, [dense[i][used][r] for i, r in enumerate(rows)], index, np.concatenate([absent, absent]), n)
    want = np.abs(whole[:, None, used] - whole[None, :, used]).sum(2)
    assert (out == want).all()


def test_sql_agrees(spark):
    rows = texts(900, 7, 9) + ODD[:9]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert difference(dv.audit(df), con, dv.ORACLE) == ""
