"""Near-duplicate documents by one-permutation hashing, banded buckets and star-shaped edges.

1. Every document's shingle set gets a signature (see ``shingles``) and one bucket key per
   band. Documents with equal sets are one class; its smallest id stands for it.
2. In every bucket all members are compared with the smallest one alone, so a bucket of m
   members gives m - 1 edges. Edges are confirmed on the full sets.
3. What a star has not settled, members of different components, is compared exactly in
   blocks of bounded size, which give back the links that join components and no pairs else.

So two documents that share a bucket are linked if their similarity asks for it, whichever
member is the star's centre. The bands follow from the least similarity: two sets that just have
it miss each other in all buckets with a probability below 1e-6, (1 - s^7)^36 at s = 0.85 and
(1 - s^5)^35 at s = 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegauge.llm.common import SPACED, chunks, frugal, list_array, shipped, signed, words_of
from sitegauge.llm.components import components
from sitegauge.llm.shingles import bands, fingerprint, layout, sets_of, signature
from sitegauge.sources.workdir import stored

#: Least similarity of linked documents, in per cent.
PERCENT = 85
# Members of a star in one part of a block; a block has two parts at most.
PART_MEMBERS = 128
#: A part has up to so many times PART_MEMBERS, as long as all their shingles are PART_SHINGLES at most.
PART_TIMES = 4
PART_SHINGLES = 1 << 17
#: Times PART_MEMBERS open members beyond which a star is split by its members' rare shingles, if
#: that sends fewer sets to blocks than the star as it is.
LARGE_PARTS = 16
# Cells of the matrix in which a block's shared shingles are counted.
BLOCK_CELLS = 1 << 20


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``f1``, ``f2`` (the set's fingerprint) and ``bands``."""
    n, width = layout(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(1)):
                sets = sets_of(words_of(data, offsets, SPACED))
                keys = [bands(signature(s), n, width) if len(s) else s for s in sets]
                marks = [fingerprint(s) for s in sets]
                bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([m[0] for m in marks], pa.int64()),
                        pa.array([m[1] for m in marks], pa.int64()),
                        list_array(signed(np.concatenate(keys)), bounds, pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_shingles long, f1 long, f2 long, bands array<long>"
    return shipped(docs).select("doc_id", "text").mapInArrow(frugal(sign), schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``shingles``, its set as sorted hashes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in chunks(batch.column(1)):
                sets = sets_of(words_of(data, offsets, SPACED))
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                ids = batch.column(0).slice(first, end - first)
                lists = list_array(signed(np.concatenate(sets)), bounds, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, lists], names=["doc_id", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return shipped(docs).select("doc_id", "text").mapInArrow(frugal(make), f"doc_id {kind}, shingles array<long>")


def stars(heads: DataFrame) -> DataFrame:
    """Edges (a, b, na, nb) from the smallest member b of a bucket to each other member a."""
    rows = stored(heads.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.explode("bands").alias("band")), "bands")
    centres = (
        rows.groupBy("band")
        .agg(F.min(F.struct("a", "na")).alias("c"), F.max("a").alias("_last"))
        .where(F.col("c.a") < F.col("_last"))
        .select("band", F.col("c.a").alias("b"), F.col("c.na").alias("nb"))
    )
    return rows.join(centres, "band").where("a <> b").select("a", "b", "na", "nb").distinct()


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges whose full sets are similar enough."""
    large = F.greatest("na", "nb")
    small = F.least("na", "nb")
    near = edges.where(small * 100 >= large * percent)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = near.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("_shared")
    return both.withColumn("_shared", shared).where(F.col("_shared") * 100 >= union * percent).select("a", "b")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Number of shared elements of every two sets of a block."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    _, column, seen = np.unique(values, return_inverse=True, return_counts=True)
    keep = seen[column] > 1
    rows, column = rows[keep], column[keep]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    step = max(1, BLOCK_CELLS // len(sets))
    for at in range(0, width, step):
        low, high = np.searchsorted(column, [at, at + step])
        part = np.zeros((len(sets), step), dtype=np.float32)
        part[rows[low:high], column[low:high] - at] = 1
        out += part @ part.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _links_of_block(percent: int):
    def find(table: pa.Table) -> pa.Table:
        ids = table.column("a").to_pylist()
        tags = table.column("component").to_pylist()
        sets = [np.asarray(x.values, dtype=np.int64) for x in table.column("shingles").combine_chunks()]
        counts = shared_counts(sets)
        sizes = np.diag(counts)
        similar = 100 * counts >= percent * (sizes[:, None] + sizes[None, :] - counts)
        # Most pairs of a hot star are within one component, which needs no more links.
        place = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        similar &= place[:, None] != place[None, :]
        owner = {t: t for t in tags}

        def top(t):
            while owner[t] != t:
                t = owner[t]
            return t

        found = []
        for i, j in zip(*np.nonzero(np.triu(similar, 1))):
            one, two = top(tags[i]), top(tags[j])
            if one != two:
                owner[max(one, two)] = min(one, two)
                found.append((ids[i], ids[j]))
        kind = table.schema.field("a").type
        return pa.table({"a": pa.array([f[0] for f in found], kind), "b": pa.array([f[1] for f in found], kind)})

    return find


def settled(edges: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between members of one star that are in different components, in blocks.

    A star's members are those in the component that most of them are in and the others, which
    are open. A star with many open ones, documents that share a passage and are otherwise unlike,
    is split first (``by_rare_shingles``). A block gives at most as many links as it joins components.
    """
    rows = block_rows(edges, sets, labels, percent)
    filled = rows.join(sets.withColumnRenamed("doc_id", "a"), "a")
    kind = edges.schema["a"].dataType.simpleString()
    return shipped(filled).groupBy("star", "block").applyInArrow(_links_of_block(percent), f"a {kind}, b {kind}").distinct()


def block_rows(edges: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``star``, ``block``, ``a`` and ``component``: a row for every set that a block compares."""
    own = edges.select("a", F.col("b").alias("star"), F.col("na").alias("n")).unionByName(
        edges.select(F.col("b").alias("a"), F.col("b").alias("star"), F.col("nb").alias("n")).distinct()
    )
    at = labels.select(F.col("node").alias("a"), "component")
    members = own.join(at, "a", "left").withColumn("component", F.coalesce("component", "a"))
    open_stars = stored(with_parts(stored(members, "stars")), "open_stars")
    large = open_stars.where(F.col("open") > LARGE_PARTS * PART_MEMBERS)
    if large.isEmpty():
        return in_blocks(open_stars)
    # A star is named by text from here on, as its parts are by their shingle as well.
    named = open_stars.where(F.col("open") <= LARGE_PARTS * PART_MEMBERS).withColumn("star", F.col("star").cast("string"))
    large = stored(large.withColumn("star", F.col("star").cast("string")), "large_stars")
    split = stored(with_parts(by_rare_shingles(large, sets, percent)), "split_stars")
    # Where the members share what is rare as well, near copies, more would be sent than without a split.
    sent = split.select("whole", "star", "sent").distinct().groupBy(F.col("whole").alias("star")).agg(F.sum("sent").alias("_split"))
    whole = large.select("star", "sent").distinct().join(sent.hint("merge"), "star").where(F.col("sent") < F.col("_split"))
    whole = stored(whole.select("star"), "whole_stars")
    large = large.join(whole.hint("merge"), "star", "left_semi")
    split = split.join(whole.withColumnRenamed("star", "whole").hint("merge"), "whole", "left_anti")
    return in_blocks(named).unionByName(in_blocks(large)).unionByName(in_blocks(split))


def with_parts(members: DataFrame) -> DataFrame:
    """Members of stars with more than one component, and how they are dealt to blocks.

    ``out`` tells the members outside the star's most frequent component, ``open`` is their number.
    ``n_out`` and ``n_in`` are the parts of these and the others, ``sent`` is what goes to blocks.
    """

    def parts(count, shingles):
        few = F.ceil(count / (PART_TIMES * PART_MEMBERS))
        return F.greatest(few, F.least(F.ceil(count / PART_MEMBERS), F.ceil(shingles / PART_SHINGLES)))

    each = members.groupBy("star", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    size = each.groupBy("star").agg(
        F.max(F.struct("c", "s", "component")).alias("_most"),
        F.sum("c").alias("c"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("_components"),
    )
    size = size.where("_components > 1").select(
        "star", "_most", (F.col("c") - F.col("_most.c")).alias("open"),
        parts(F.col("c") - F.col("_most.c"), F.col("s") - F.col("_most.s")).alias("n_out"),
        parts(F.col("_most.c"), F.col("_most.s")).alias("n_in"),
    )
    size = size.withColumn("sent", F.expr("open * (n_out + n_in) + _most.c * n_out"))
    # Joins by star are merged: Spark splits the rows of a large one over tasks.
    tagged = members.join(stored(size, "sizes").hint("merge"), "star")
    return tagged.withColumn("out", F.col("component") != F.col("_most.component")).drop("_most")


def by_rare_shingles(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Large stars, named by text, split into smaller ones, in which every two similar members still meet.

    Two sets of n and m shingles with a similarity of s share at least s * max(n, m) of them. So
    if the shingles of a star are put in one order, they share one that is among the first
    n - ceil(s * n) + 1 of the one and the first m - ceil(s * m) + 1 of the other. The order is by
    the number of the star's members that have the shingle, rarest first: a shared passage, which
    brought the members together, comes last, and what only one member has brings nobody together.
    Each shingle that is left names a star of its own (``whole`` is the one it is from); nothing is
    lost, whatever the sizes.
    """
    words = stars.select("star", "a", "component").join(sets.withColumnRenamed("doc_id", "a"), "a")
    words = words.select("star", "a", "component", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("h"))
    words = stored(words, "star_shingles")
    shared = words.groupBy("star", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    # At most a document's own shingles meet in a window.
    member = Window.partitionBy("star", "a")
    alone = F.col("n") - F.count(F.lit(1)).over(member)
    first = F.expr(f"n - (({percent} * n + 99) div 100) + 1")
    place = F.row_number().over(member.orderBy("c", "h"))
    kept = words.join(shared.hint("merge"), ["star", "h"]).withColumns({"_left": first - alone, "_place": place})
    kept = kept.where(F.col("_place") <= F.col("_left")).select(
        F.col("star").alias("whole"), F.concat_ws(":", "star", F.col("h").cast("string")).alias("star"), "a", "component", "n"
    )
    return stored(kept, "rare_stars")


def in_blocks(open_stars: DataFrame) -> DataFrame:
    """Members of open stars in the blocks that compare them.

    Open members and the others are cut in parts by hash; a block is two parts of the open ones,
    or one of them and one of the others.
    """
    mine = F.pmod(F.xxhash64("a"), F.when(F.col("out"), F.col("n_out")).otherwise(F.col("n_in")))
    open_stars = open_stars.withColumn("mine", mine)

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), n - 1)

    outs = F.transform(
        upto(F.col("n_out")),
        lambda j: F.struct(F.lit("out").alias("kind"), F.least("mine", j).alias("i"), F.greatest("mine", j).alias("j")),
    )
    # A star may have no other members: a sequence would then run backwards.
    crossed = F.when(
        F.col("n_in") > 0,
        F.transform(
            upto(F.col("n_in")),
            lambda j: F.struct(F.lit("in").alias("kind"), F.col("mine").alias("i"), j.alias("j")),
        ),
    ).otherwise(F.array().cast("array<struct<kind:string,i:bigint,j:bigint>>"))
    inner = F.transform(
        upto(F.col("n_out")),
        lambda i: F.struct(F.lit("in").alias("kind"), i.alias("i"), F.col("mine").alias("j")),
    )
    blocks = F.when(F.col("out"), F.concat(outs, crossed)).otherwise(inner)
    return open_stars.select("star", "a", "component", F.explode(blocks).alias("block"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Words are what stands between ASCII white space, A-Z lower-cased; a document with fewer
    than five words is one shingle, one without is linked with nothing. ``component_id`` is the
    smallest ``doc_id`` reachable over links, ``kept`` tells whether it is the row's own. Rows
    that repeat a ``doc_id`` are one node with the links of all. Rows with a NULL ``doc_id``
    are kept and have no component. Other columns are not looked at.
    """
    signed_docs = stored(signatures(docs, percent), "signatures")
    known = signed_docs.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(known.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("head")), "classes")
    as_id = classes.withColumnRenamed("head", "doc_id")
    heads = known.join(as_id, ["doc_id", "n_shingles", "f1", "f2"], "left_semi")
    edges = stored(stars(heads), "edges")
    members = edges.select(F.col("a").alias("doc_id")).unionByName(edges.select(F.col("b").alias("doc_id"))).distinct()
    # A shuffle of the texts at every size: a broadcast would only do while the members are few.
    wanted = docs.select("doc_id", "text").join(members.hint("merge"), "doc_id", "left_semi")
    sets = stored(shingle_sets(wanted), "sets")
    links = stored(confirmed(edges, sets, percent), "links")
    # Documents of one class that repeat an id elsewhere are links as well.
    copies = known.join(classes, ["n_shingles", "f1", "f2"]).where("doc_id <> head")
    copies = stored(copies.select(F.col("doc_id").alias("a"), F.col("head").alias("b")).distinct(), "copies")
    labels = stored(components(links), "components")
    late = settled(edges, sets, labels, percent)
    every = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late).unionByName(copies)
    final = components(every)
    reach = final.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "_reached")
    reached = signed_docs.select("doc_id", "n_shingles").join(reach, "doc_id", "left")
    component = F.coalesce("_reached", "doc_id")
    return reached.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


ORACLE = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM shingles p JOIN shingles q ON p.s = q.s AND p.doc_id <> q.doc_id
    GROUP BY p.doc_id, q.doc_id) x
  JOIN sizes m ON m.doc_id = x.a JOIN sizes n ON n.doc_id = x.b
  WHERE 100 * x.c >= {PERCENT} * (m.n + n.n - x.c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least_of l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""
