"""How far the word use of sources of one language lies apart, by Gustavson's row accumulation.

A group is a pair of language and source. Its smoothed share of a term is whole, so all sums are
exact. The distance of two groups is the sum over all kept terms of the difference of their
shares, most of which are those of terms that neither or only one of them has.

The counts form a sparse matrix, groups by terms. It is cut into slices of terms of bounded size,
and the groups of a language into blocks of rows. A task holds one slice with its term-major
index, the peers of each term, and takes the rows of its block one after another: each row
scatters its terms through the index into one dense accumulator, a cell per peer of the
language. No pair of postings is ever a row of a table. A slice's accumulator starts from what
the distance would be if no term of the row were shared, the zero baseline: the row's shares
against the peer's share of an absent term, the peer's shares against the row's, and the absent
terms of both. The scatter corrects it for the terms that both have. Slices add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import byte_class, chunks, frugal, shipped, words_of
from sitegauge.sources.workdir import stored

#: A term is kept in a language if that many of its documents have it.
LEAST_DOCS = 30
SCALE, PRIOR = 1_000_000_000, 5
TERM_RANKS = 50
# Cells of one slice, rows of one block of groups.
SLICE_CELLS, BLOCK_ROWS = 1 << 19, 64
# Counted cells that a task holds before it passes them on.
HELD_CELLS = 1 << 20

#: Letters of ASCII and everything beyond it.
LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))


class _Counts:
    """Counts by (group, word) of the documents seen so far, with the words' bytes."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0
        self.bytes: dict[int, bytes] = {}

    def add(self, groups: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        words = words_of(data, offsets, LETTERS)
        if not len(words.hashes):
            return
        hashes, first, symbols = np.unique(words.hashes, return_index=True, return_inverse=True)
        doc = np.repeat(np.arange(len(groups)), np.diff(words.bounds))
        # One row per document and word, then per group and word.
        own, counts = np.unique(doc * len(hashes) + symbols, return_counts=True)
        order = np.argsort(groups[own // len(hashes)] * len(hashes) + own % len(hashes), kind="stable")
        key = (groups[own // len(hashes)] * len(hashes) + own % len(hashes))[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        n, docs = np.add.reduceat(counts[order], at), np.diff(np.append(at, len(key)))
        self.parts.append((key[at] // len(hashes), hashes[key[at] % len(hashes)], n, docs))
        self.held += len(at)
        new = [i for i, h in enumerate(hashes.tolist()) if h not in self.bytes]
        low = data.copy()
        upper = (low >= 0x41) & (low <= 0x5A)
        low[upper] += 0x20
        for i in new:
            self.bytes[int(hashes[i])] = low[words.starts[first[i]] : words.ends[first[i]]].tobytes()

    def merge(self) -> None:
        """Equal cells of all parts made one."""
        group, word, n, docs = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((word, group))
        group, word, n, docs = group[order], word[order], n[order], docs[order]
        at = np.flatnonzero(np.append(True, (np.diff(group) != 0) | (word[1:] != word[:-1])))
        self.parts = [(group[at], word[at], np.add.reduceat(n, at), np.add.reduceat(docs, at))]
        self.held = len(at)


_CELL = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences and ``docs`` documents that have it.

    NULL text, language and source are empty. Every task adds up what it has read before its
    cells go to the shuffle, so a hot source reaches it as one row per task and term.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        held = _Counts()

        def rows() -> Iterator[pa.RecordBatch]:
            held.merge()
            group, word, n, docs = held.parts[0]
            groups = list(names)
            for first in range(0, len(group), 1 << 16):
                part = slice(first, first + (1 << 16))
                terms = [held.bytes[h].decode() for h in word[part].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([groups[g][0] for g in group[part].tolist()], pa.string()),
                        pa.array([groups[g][1] for g in group[part].tolist()], pa.string()),
                        pa.array(terms, pa.string()),
                        pa.array(n[part], pa.int64()),
                        pa.array(docs[part], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            groups = np.array([names.setdefault(p, len(names)) for p in pairs], dtype=np.int64)
            for first, end, data, offsets in chunks(batch.column(0)):
                held.add(groups[first:end], data, offsets)
                if held.held > HELD_CELLS:
                    held.merge()
                    if held.held > HELD_CELLS // 2:
                        yield from rows()
                        held = _Counts()
        if held.parts:
            yield from rows()

    wanted = docs.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    cells = shipped(wanted).mapInArrow(frugal(count), _CELL)
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, terms: str) -> F.Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exact; NULL without terms."""
    up = f"CAST({SCALE} AS DECIMAL(38, 0)) * CAST({n} + {PRIOR} AS DECIMAL(20, 0))"
    down = f"CAST({total} AS DECIMAL(38, 0)) + CAST({PRIOR} * {terms} AS DECIMAL(20, 0))"
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + ({up}) div ({down}) END")


def accumulate(
    rows: list[np.ndarray], shares: list[np.ndarray], peers: tuple[np.ndarray, ...], absent: np.ndarray, n_terms: int
) -> np.ndarray:
    """Distances over one slice of the block's rows to all peers.

    ``rows[i]`` are the term numbers of row i in the slice and ``shares[i]`` its shares of them.
    ``peers`` is the term-major index: bounds by term, then peer and share of each posting.
    The first entries of ``absent`` are the rows' own shares of an absent term, those from
    ``len(rows)`` on the peers'.
    """
    bounds, peer, share = peers
    own, others = absent[: len(rows)], absent[len(rows) :]
    out = np.zeros((len(rows), len(others)), dtype=np.int64)
    # What each peer has, against each row's share of an absent term.
    by_peer = np.argsort(peer, kind="stable")
    at = np.searchsorted(peer[by_peer], np.arange(len(others) + 1))
    sizes = np.diff(at)
    for h in np.flatnonzero(sizes):
        out[:, h] += _spread(share[by_peer[at[h] : at[h + 1]]], own)
    for i, (terms, p) in enumerate(zip(rows, shares)):
        apart = np.abs(own[i] - others)
        out[i] += (n_terms - len(terms) - sizes) * apart
        if not len(terms):
            continue
        out[i] += _spread(p, others)
        # The row's terms go through the index into the accumulator.
        n = bounds[terms + 1] - bounds[terms]
        post = np.repeat(bounds[terms] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        h, q, mine = peer[post], share[post], np.repeat(p, n)
        both = np.abs(mine - q) - np.abs(mine - others[h]) - np.abs(own[i] - q) + apart[h]
        np.add.at(out[i], h, both)
    return out


def _spread(values: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sum of |value - point| over all values, for each point."""
    values = np.sort(values)
    sums = np.concatenate([[0], np.cumsum(values)])
    below = np.searchsorted(values, points)
    return points * below - sums[below] + (sums[-1] - sums[below]) - points * (len(values) - below)


def _block(key, cells: pa.Table, groups: pa.Table, size: int) -> pa.Table:
    """Distances of one block's ``size`` rows over one slice.

    ``cells`` are those of the whole slice, ``groups`` all of the language.
    """
    block = key[2].as_py()
    number = groups.column("number").to_numpy()
    absent = np.empty(len(number), dtype=np.int64)
    absent[number] = groups.column("absent").to_numpy()
    mine = np.arange(block * size, min((block + 1) * size, len(number)))
    term = np.unique(cells.column("term").combine_chunks().dictionary_encode().indices.to_numpy(), return_inverse=True)[1]
    peer, share = cells.column("number").to_numpy(), cells.column("p").to_numpy()
    order = np.lexsort((peer, term))
    term, peer, share = term[order], peer[order], share[order]
    n_terms = int(term[-1]) + 1 if len(term) else 0
    bounds = np.searchsorted(term, np.arange(n_terms + 1))
    by_row = np.argsort(peer, kind="stable")
    at = np.searchsorted(peer[by_row], np.append(mine, mine[-1] + 1))
    parts = [by_row[a:b] for a, b in zip(at[:-1], at[1:])]
    got = accumulate(
        [term[i] for i in parts], [share[i] for i in parts], (bounds, peer, share), np.concatenate([absent[mine], absent]), n_terms
    )
    rest = got != 0
    rest[np.arange(len(mine)), mine] = False
    row, other = np.nonzero(rest)
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * len(row), pa.string()),
            "number": pa.array(mine[row], pa.int64()),
            "other": pa.array(other, pa.int64()),
            "value": pa.array(got[row, other], pa.int64()),
        }
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of every group.

    Part ``pair`` has every other source of the language with its distance over all kept terms, 0
    if there are none; part ``term`` the terms that the group uses more than its language, up to
    ``term_ranks``. Ranks go by value, largest first, then by item. NULL text, language and source
    count as empty; a group without terms has only absent ones. Repeated rows count again. Ids
    and other columns are not looked at; an empty table gives no rows.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    counted = stored(term_counts(docs), "terms")
    langs = Window.partitionBy("lang")
    of_lang = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(of_lang.where(F.col("docs") >= least_docs).drop("docs"), "kept_terms")
    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    cells = counted.drop("docs").join(kept, ["lang", "term"])
    # One row per group: the sources of a language, not its documents, meet in a window.
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*names).distinct().join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
    groups = groups.fillna(0, ["total", "terms", "lang_total"]).withColumns(
        {
            "number": F.row_number().over(langs.orderBy("source")).cast("long") - 1,
            "sources": F.count(F.lit(1)).over(langs),
            "absent": F.coalesce(_share("0L", "total", "terms"), F.lit(0).cast("long")),
        }
    )
    groups = stored(groups, "groups")
    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "number", "sources", "term", _share("n", "total", "terms").alias("p"),
        _share("lang_n", "lang_total", "terms").alias("q"),
    )
    shares = stored(shares, "shares")
    slices = -(-shares.count() // SLICE_CELLS)
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("sources") - 1) / BLOCK_ROWS))).alias("block")
    where = F.pmod(F.xxhash64("term"), F.lit(max(1, slices))).alias("slice")
    index = shares.select("lang", where, "number", "term", "p", "sources").select("lang", "slice", "number", "term", "p", blocks)
    every = groups.where("terms > 0").select(
        "lang", "number", "absent", "sources", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
    )
    every = every.select("lang", "slice", "number", "absent", blocks) if slices else groups.select(
        "lang", F.lit(0).cast("long").alias("slice"), "number", "absent", F.lit(0).cast("long").alias("block")
    ).where(F.lit(False))
    keys, size = ("lang", "slice", "block"), BLOCK_ROWS
    partial = (
        shipped(index)
        .groupBy(*keys)
        .cogroup(every.groupBy(*keys))
        .applyInArrow(lambda key, cells, own: _block(key, cells, own, size), "lang string, number long, other long, value long")
    )
    found = partial.groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))
    left = groups.select("lang", "source", "number")
    right = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"))
    pairs = left.join(right, "lang").where("number <> other").join(found, ["lang", "number", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    terms = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    best = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= term_ranks)
    return ranked.unionByName(best)


ORACLE = f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
word AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
per_doc AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM word GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM per_doc GROUP BY lang, term HAVING count(*) >= {LEAST_DOCS}),
cell AS MATERIALIZED (
  SELECT p.lang, p.source, p.term, CAST(sum(p.n) AS HUGEINT) AS n
  FROM per_doc p JOIN kept k ON k.lang = p.lang AND k.term = p.term GROUP BY ALL),
lang_total AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(t.v, 0) AS v, coalesce(s.total, 0) AS total, t.total AS lang_total
  FROM (SELECT DISTINCT lang, source FROM doc) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cell GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN lang_total t ON t.lang = g.lang),
full_cell AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {PRIOR})) // (g.total + {PRIOR} * g.v) AS p,
         1 + (CAST({SCALE} AS HUGEINT) * (k.n + {PRIOR})) // (g.lang_total + {PRIOR} * g.v) AS q
  FROM grp g JOIN kept k ON k.lang = g.lang
  LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM full_cell a JOIN full_cell b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pair AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(a.value, 0) AS BIGINT) AS value
  FROM grp g JOIN grp h ON h.lang = g.lang AND h.source <> g.source
  LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM full_cell WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}"""
