"""Language of a text: its family first, then the language within the family.

Features are hashed pairs and triples of bytes of the lower-cased whole text, with all that is
no letter as one blank; their square-rooted counts have length 1. Families, and the languages
of one family, are told apart by one linear support vector machine per pair; the class with
most votes wins. Learned from a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import byte_class, chunks, frugal, remainder, shipped
from sitegauge.llm.linear import logistic, platt, svm

#: Documents of all languages together that are brought to the driver for learning, as vectors.
SAMPLE = 2_400
BUCKETS = 4096
UNKNOWN = "und"
# Rows of a batch whose counts are held at once.
ROWS = 256

#: Family of a language code. Fixed values; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}

_LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))


def family(language: str) -> str:
    return _FAMILY.get(language.lower().split("-")[0], language)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per document: hashed counts of byte pairs and triples, square-rooted, of length 1."""
    n = len(offsets) - 1
    out = np.zeros((n, BUCKETS), dtype=np.float32)
    if len(data) < 3:
        return out
    body = np.where(_LETTERS[data], data, np.uint8(0x20)).astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.uint32), np.diff(offsets))
    pair = body[:-1] * np.uint32(256) + body[1:]
    triple = pair[:-1] * np.uint32(256) + body[2:]
    # Runs of blanks say nothing.
    for code, width in ((pair, 2), (triple, 3)):
        inside = doc[: len(code)] == doc[width - 1 :]
        inside &= code != (0x2020 if width == 2 else 0x202020)
        hashed = (code * np.uint32(0x9E3779B1 if width == 2 else 0x85EBCA6B)) >> np.uint32(20)
        at = doc[: len(code)][inside] * np.uint32(BUCKETS) + hashed[inside]
        out += np.bincount(at, minlength=n * BUCKETS).reshape(n, BUCKETS)
    np.sqrt(out, out=out)
    length = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(length, 1e-9)


@dataclass
class Vote:
    """Machines for all pairs of some classes."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # one column per pair, the last row the constants
    scale: np.ndarray  # slope and shift per pair

    @classmethod
    def fit(cls, x: np.ndarray, names: np.ndarray) -> Vote:
        classes = sorted(set(names))
        pairs = list(combinations(range(len(classes)), 2))
        weights, scale = [], []
        for a, b in pairs:
            rows = (names == classes[a]) | (names == classes[b])
            y = np.where(names[rows] == classes[a], 1.0, -1.0)
            w = svm(x[rows], y)
            weights.append(w)
            scale.append(platt(x[rows] @ w[:-1] + w[-1], y))
        shape = (x.shape[1] + 1, 0)
        return cls(classes, pairs, np.array(weights).T if pairs else np.zeros(shape), np.array(scale).reshape(-1, 2))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winning class and its mean probability against the others; ties go to the surer one."""
        n, k = len(x), len(self.classes)
        if k == 1:
            return np.zeros(n, dtype=np.int64), np.ones(n)
        p = logistic((x @ self.weights[:-1] + self.weights[-1]) * self.scale[:, 0] + self.scale[:, 1])
        votes, sure = np.zeros((n, k)), np.zeros((n, k))
        for i, (a, b) in enumerate(self.pairs):
            votes[:, a] += p[:, i] >= 0.5
            votes[:, b] += p[:, i] < 0.5
            sure[:, a] += p[:, i]
            sure[:, b] += 1 - p[:, i]
        best = np.argmax(votes + sure / (k + 1), axis=1)
        return best, sure[np.arange(n), best] / (k - 1)


@dataclass
class LanguageModel:
    families: Vote
    members: dict[str, Vote]

    @classmethod
    def fit(cls, x: np.ndarray, languages: np.ndarray) -> LanguageModel:
        of = np.array([family(x) for x in languages], dtype=object)
        members = {f: Vote.fit(x[of == f], languages[of == f]) for f in sorted(set(of))}
        return cls(Vote.fit(x, of), members)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, score = self.families.predict(x)
        names = np.empty(len(x), dtype=object)
        for i, f in enumerate(self.families.classes):
            rows = best == i
            if rows.any():
                own, sure = self.members[f].predict(x[rows])
                names[rows] = np.array(self.members[f].classes, dtype=object)[own]
                score[rows] *= sure
        return names, score


def _lettered(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in chunks(pc.utf8_lower(batch.column(1)), rows=ROWS):
            x = features(data, offsets).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, end - first), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["lang", "x"],
            )


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> LanguageModel | None:
    """Model from about ``sample`` documents for which ``learn`` holds, as many of each language.

    They are chosen by hash of id and text. None if there is no labelled document.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.where(F.col("text").rlike(r"\p{L}") & (draw < F.element_at(share, F.col("lang"))))
    rows = shipped(drawn).select("lang", "text").limit(2 * sample).mapInArrow(frugal(_vectors), "lang string, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16) for r in rows]).astype(np.float32)
    return LanguageModel.fit(x, np.array([r["lang"] for r in rows], dtype=object))


def _judged(texts: pa.Array, model: LanguageModel | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and end row of a run of rows, their languages and scores."""
    lettered = _lettered(texts).copy()
    if model is None:
        lettered[:] = False
    for first, end, data, offsets in chunks(pc.utf8_lower(texts), rows=ROWS):
        known = lettered[first:end]
        names = np.full(end - first, UNKNOWN, dtype=object)
        sure = np.zeros(end - first)
        if known.any():
            names[known], sure[known] = model.predict(features(data, offsets)[known])
        yield first, end, names, np.clip(sure, 0, 1)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every document, from the whole text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, names, sure in _judged(batch.column(1), sent.value):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(names, pa.string()), pa.array(sure)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return shipped(docs).select("doc_id", "text").mapInArrow(frugal(score), f"doc_id {kind}, lang_pred string, score double")


def relabelled(docs: DataFrame, model: LanguageModel | None, least: float) -> DataFrame:
    """``docs`` without texts that are ``und`` or score below ``least``; ``lang`` is what was found.

    The columns are those of ``docs``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, lang = (batch.schema.get_field_index(n) for n in ("text", "lang"))
            for first, end, names, sure in _judged(batch.column(text), sent.value):
                part = batch.slice(first, end - first).set_column(lang, "lang", pa.array(names, pa.string()))
                yield part.filter(pa.array((names != UNKNOWN) & (sure >= least)))

    return shipped(docs).mapInArrow(frugal(keep), docs.schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` for every row.

    Learns from rows whose crc32(doc_id) mod 5 is not 0; the others are held out. A text that
    is NULL or without letters is ``und`` with score 0, and so is every text if nothing is
    labelled. One language in the labels makes every text that language. A NULL ``doc_id``
    counts as empty text in the split. Equal rows and ids are scored one by one.
    """
    model = fit(docs, remainder("doc_id", 5) != 0, sample)
    return predict(docs, model).withColumn("held_out", remainder("doc_id", 5) == 0).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
