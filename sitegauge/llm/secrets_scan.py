"""Secrets in texts: three fixed patterns, and a character network for what they miss.

Every candidate, a long run of letters and digits, goes through the network with its
surroundings. The network is trained on all of the table's own findings, part by part: what a
pattern found is a secret, other candidates are none. Its outputs are calibrated, and its threshold
for each kind of run is the largest that keeps a stated recall, on all findings of a fourth of the
hashes, which it was not trained on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.char_cnn import CharCnn, codes, just_below, lost
from sitegauge.llm.common import frugal, shipped
from sitegauge.llm.linear import logistic, platt_by, platt_sums, platt_targets
from sitegauge.sources.workdir import stored

#: Kinds in their order; the last is what the network adds.
KINDS = ("assign", "access", "hex", "network")

#: The three patterns, fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

RUN = re.compile(r"[A-Za-z0-9+/_-]{10,}")
_DIGIT = re.compile(r"[0-9]")

#: Characters of the candidate in a window, and of context on each side.
BODY, CONTEXT = 64, 24
STRIDE = 48
LENGTH = BODY + 2 * CONTEXT

#: Examples of each label, at least: fewer findings are filled up with varied copies.
SAMPLE = 1_500
LEAST = 10
#: Passes over all examples; after every second one the parts' networks are averaged.
EPOCHS, ROUNDS = 8, 4
#: Different findings that one task trains on, some half a megabyte of windows.
PART_ROWS = 4_096
RECALL = 0.98

MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' findings, by start, then kind as listed."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(out)]


def windows(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """Codes of the candidate with its context; a long candidate gives overlapping windows.

    Segments follow from the codes' places: the candidate starts at CONTEXT, its length is
    the last number.
    """
    for at in range(start, max(end - BODY, start) + STRIDE, STRIDE):
        at = min(at, max(end - BODY, start))
        stop = min(end, at + BODY)
        row = np.zeros(LENGTH + 2, dtype=np.uint8)
        before = codes(text[max(0, at - CONTEXT) : at])
        row[CONTEXT - len(before) : CONTEXT] = before
        after = codes(text[at : stop + CONTEXT])
        row[CONTEXT : CONTEXT + len(after)] = after
        row[LENGTH] = stop - at
        row[LENGTH + 1] = len(before)
        yield row
        if stop == end:
            return


def unpacked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and segments of windows."""
    x = rows[:, :LENGTH]
    place = np.arange(LENGTH)[None, :] - CONTEXT
    inside = (place >= 0) & (place < rows[:, LENGTH : LENGTH + 1])
    return x, np.where(x == 0, 0, np.where(inside, 2, 1)).astype(np.uint8)


def group(value: str) -> str:
    """Kind of run: of one class of characters, or mixed."""
    if value.isdigit():
        return "digits"
    if re.fullmatch(r"[0-9a-f]+", value):
        return "hex"
    return "upper" if re.fullmatch(r"[0-9A-Z]+", value) else "mixed"


def candidates(text: str, base: list[tuple[int, str, int]]) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, label, group) of every run with a digit; label 1 if a pattern has it too."""
    for m in RUN.finditer(text):
        if _DIGIT.search(text, m.start(), m.end()):
            known = any(start < m.end() and m.start() < end for start, _, end in base)
            yield m.start(), m.end(), int(known), group(m.group())


def examined(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` (the patterns' spans) and ``runs`` (every candidate's windows)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])
    run = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("label", pa.int32()), ("group", pa.string()), ("window", pa.binary())]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, runs = [], []
            for text in batch.column(1):
                body = text.as_py() or ""
                base = base_spans(body)
                spans.append([dict(zip(("start", "kind", "end"), s)) for s in base])
                runs.append(
                    [
                        {"start": a, "end": b, "label": label, "group": g, "window": w.tobytes()}
                        for a, b, label, g in candidates(body, base)
                        for w in windows(body, a, b)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(span)), pa.array(runs, pa.list_(run))],
                names=["doc_id", "base", "runs"],
            )

    return shipped(docs).select("doc_id", "text").mapInArrow(
        frugal(look),
        f"doc_id {kind}, base array<struct<start:long,kind:string,end:long>>, "
        "runs array<struct<start:long,end:long,label:int,group:string,window:binary>>",
    )


@dataclass
class SecretModel:
    net: CharCnn
    slope: float
    shift: float
    thresholds: dict[str, float]
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return logistic(self.slope * self.net.logits(*unpacked(rows)) + self.shift)


def _varied(rows: np.ndarray, times: int, rng: np.random.Generator) -> np.ndarray:
    """The windows and copies of them: candidates' characters in another order, half without context."""
    out = [rows]
    for number in range(1, times):
        more = rows.copy()
        for row in more:
            body = row[CONTEXT : CONTEXT + row[LENGTH]]
            row[CONTEXT : CONTEXT + row[LENGTH]] = rng.permutation(body)
            if number % 2:
                row[:CONTEXT] = 0
                row[CONTEXT + row[LENGTH] : LENGTH] = 0
        out.append(more)
    return np.concatenate(out)


def fit(seen: DataFrame, sample: int = SAMPLE, recall: float = RECALL, seed: int = 11) -> SecretModel | None:
    """Network trained on all different findings but a fourth, by hash, on which it is calibrated.

    A finding that is copied many times is one example. A label with fewer than ``sample`` of them
    is filled up with varied copies. None if either label has fewer than LEAST different findings;
    then the patterns stand alone.
    """
    found = shipped(seen).select(F.explode("runs").alias("r")).select("r.label", "r.group", "r.window").distinct()
    found = stored(found.withColumn("held", F.crc32("window") % 4 == 0), "examples")
    counted = found.groupBy("label", "held").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {(r["label"], r["held"]): r["n"] for r in counted}
    kept = {label: sizes.get((label, False), 0) for label in (0, 1)}
    held = {label: sizes.get((label, True), 0) for label in (0, 1)}
    if min(kept[label] + held[label] for label in (0, 1)) < LEAST or min(*kept.values(), *held.values()) < 2:
        return None
    parts = -(-sum(sizes.values()) // PART_ROWS)
    # Dealt by hash, and sorted within a part, so that the order of the input changes nothing.
    dealt = found.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts)))
    net = trained(dealt.where(~F.col("held")), kept, sample, seed)
    scored = stored(scores_of(dealt.where("held"), net), "scored")
    slope, shift = calibration(scored, held)
    limits = thresholds(scored, slope, shift, recall)
    return SecretModel(net, slope, shift, limits, limits.pop(None))


def trained(rows: DataFrame, sizes: dict[int, int], sample: int, seed: int) -> CharCnn:
    """Network after ROUNDS rounds; in each every part trains a copy on all its rows, then the
    copies' parameters are averaged. Both labels weigh the same, whatever their ``sizes``."""
    net = CharCnn.new(np.random.default_rng(seed))
    times = {label: max(2, -(-sample // n)) for label, n in sizes.items()}
    weights = {label: sum(sizes[i] * times[i] for i in sizes) / (2 * n * times[label]) for label, n in sizes.items()}
    # Taken here, so that tasks train as the driver says.
    learn = CharCnn.train
    for number in range(ROUNDS):

        def work(table: pa.Table) -> pa.Table:
            part = table.column("part")[0].as_py()
            rng = np.random.default_rng([seed, number, part])
            examples = sorted(zip(table.column("label").to_pylist(), table.column("window").to_pylist()))
            sides, y = [], []
            for label in (0, 1):
                side = [np.frombuffer(w, dtype=np.uint8) for one, w in examples if one == label]
                if side:
                    sides.append(_varied(np.stack(side), times[label], rng))
                    y.append(np.full(len(sides[-1]), label))
            truth = np.concatenate(y)
            weight = np.array([weights[0], weights[1]], dtype=np.float32)[truth]
            own = net.filled(net.flat())
            learn(own, *unpacked(np.concatenate(sides)), truth.astype(np.float32), EPOCHS // ROUNDS, rng, weight)
            flat = own.flat().astype(np.float64)
            return pa.table({"part": [part], "n": [len(examples)], "sums": [flat * len(examples)]})

        made = rows.groupBy("part").applyInArrow(work, "part long, n long, sums array<double>")
        # Summed per place of the network by Spark, so that the driver gets one network.
        place = made.select("part", "n", F.posexplode("sums").alias("at", "value"))
        summed = place.groupBy("at").agg(
            F.aggregate(F.array_sort(F.collect_list(F.struct("part", "value"))), F.lit(0.0), lambda s, x: s + x["value"]).alias("v"),
            F.sum("n").alias("n"),
        )
        flat = np.array([r["v"] / r["n"] for r in summed.orderBy("at").collect()], dtype=np.float32)
        net = net.filled(flat)
    return net


def scores_of(rows: DataFrame, net: CharCnn) -> DataFrame:
    """``label``, ``group``, ``logit`` and ``key``, a whole number in the order of the logits."""

    def work(table: pa.Table) -> pa.Table:
        examples = sorted(zip(*(table.column(c).to_pylist() for c in ("label", "group", "window"))))
        windows = np.stack([np.frombuffer(w, dtype=np.uint8) for _, _, w in examples])
        logit = net.logits(*unpacked(windows)).astype(np.float32)
        label, name, _ = zip(*examples)
        return pa.table({"label": pa.array(label, pa.int32()), "group": name, "logit": logit, "key": ordered(logit.view(np.int32))})

    return rows.groupBy("part").applyInArrow(work, "label int, group string, logit float, key int")


def ordered(bits: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers as whole numbers of the same order, and back."""
    return np.where(bits >= 0, bits, bits ^ np.int32(0x7FFFFFFF)).astype(np.int32)


def calibration(scored: DataFrame, sizes: dict[int, int]) -> tuple[float, float]:
    """Slope and shift of the probability, from all rows: each step is a sum over them."""
    n = sizes[0] + sizes[1]

    def total(one) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [one(b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.float64)) for b in batches if b.num_rows]
            if sums:
                yield pa.RecordBatch.from_pydict({"sums": [np.sum(sums, axis=0)]})

        made = scored.select("label", "logit").mapInArrow(work, "sums array<double>")
        each = made.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
        return np.array([r["v"] for r in sorted(each)])

    mean = total(lambda _, logit: np.array([logit.sum()]))[0] / n
    size = float(np.sqrt(total(lambda _, logit: np.array([((logit - mean) ** 2).sum()]))[0] / n)) or 1.0
    target = platt_targets(sizes[0], sizes[1])
    slope, shift = platt_by(lambda at: total(lambda label, logit: platt_sums(logit / size, target[label], at)))
    return slope / size, shift


def thresholds(scored: DataFrame, slope: float, shift: float, recall: float) -> dict[str | None, float]:
    """The largest threshold that keeps ``recall`` of all findings (None), and of each group's.

    There is no floor, which would drop the recall wherever findings and other runs overlap.
    The logit that it falls on is found exactly, by counts of its upper and then its lower bits.
    """
    found = scored.where("label = 1")

    def counts(rows: DataFrame, value: Column) -> dict[str | None, dict[int, int]]:
        out: dict[str | None, dict[int, int]] = {None: {}}
        for r in rows.groupBy("group", value.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect():
            out.setdefault(r["group"], {})[r["v"]] = r["n"]
            out[None][r["v"]] = out[None].get(r["v"], 0) + r["n"]
        return out

    def at(held: dict[int, int], rank: int) -> tuple[int, int]:
        """The value of this rank, and the rank among those of the same value."""
        for value in sorted(held):
            if rank < held[value]:
                break
            rank -= held[value]
        return value, rank

    upper = F.shiftright("key", 16)
    places = {}
    for name, held in counts(found, upper).items():
        n = sum(held.values())
        if name is None or n >= LEAST:
            gone = lost(n, recall)
            places[name] = at(held, gone if slope >= 0 else n - 1 - gone)
    lower = counts(found.where(upper.isin({u for u, _ in places.values()})), F.col("key"))
    out = {}
    for name, (top, rank) in places.items():
        key, _ = at({k: n for k, n in lower[name].items() if k >> 16 == top}, rank)
        logit = ordered(np.array([key], dtype=np.int32)).view(np.float32)
        out[name] = just_below(logistic(slope * logit + shift)[0])
    return out


def added(model: SecretModel | None, base: list, runs: list) -> list[tuple[int, str, int]]:
    """Spans of candidates that the network takes for secrets and that no pattern has."""
    free = [r for r in runs if not r["label"]]
    if model is None or not free:
        return []
    scores = model.scores(np.stack([np.frombuffer(r["window"], dtype=np.uint8) for r in free]))
    out = {
        (r["start"], KINDS[3], r["end"])
        for r, s in zip(free, scores)
        if s >= model.thresholds.get(r["group"], model.threshold)
    }
    return sorted(out)


def spans(seen: DataFrame, model: SecretModel | None) -> DataFrame:
    """``doc_id`` and ``spans`` (start, kind, end), the patterns' and the network's, in order."""
    kind = seen.schema["doc_id"].dataType.simpleString()
    sent = seen.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            out = []
            for base, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                every = [(s["start"], s["kind"], s["end"]) for s in base] + added(sent.value, base, runs)
                every.sort(key=lambda s: (s[0], order[s[1]]))
                out.append([dict(zip(("start", "kind", "end"), s)) for s in every])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(span))], names=["doc_id", "spans"]
            )

    schema = f"doc_id {kind}, spans array<struct<start:long,kind:string,end:long>>"
    return shipped(seen).select("doc_id", "base", "runs").mapInArrow(frugal(judge), schema)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` for every row of ``docs``.

    Places are code points, end exclusive. A NULL text is empty and has no span; rows with
    equal or NULL ids are scanned one by one. Other columns are not looked at.
    """
    seen = stored(examined(docs), "findings")
    return spans(seen, fit(seen))


def digest(found: DataFrame) -> DataFrame:
    """Counts per pattern, the digest of the patterns' spans, and all spans as text."""

    def joined(part):
        def one(s):
            return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

        return F.array_join(F.transform(part, one), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def masked(text: str, found: list[tuple[int, str, int]]) -> str:
    """``text`` with every span, overlapping ones as one, replaced by MASK."""
    out, at = [], 0
    for start, _, end in sorted(found):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked, columns as they were; NULL stays NULL."""
    model = fit(stored(examined(docs), "findings"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = []
            for text in batch.column(at):
                body = text.as_py()
                if body:
                    base = base_spans(body)
                    runs = [
                        {"start": a, "end": b, "label": label, "group": g, "window": w.tobytes()}
                        for a, b, label, g in candidates(body, base)
                        if not label
                        for w in windows(body, a, b)
                    ]
                    body = masked(body, base + added(sent.value, base, runs))
                out.append(body)
            yield batch.set_column(at, "text", pa.array(out, batch.schema.field(at).type))

    return shipped(docs).mapInArrow(frugal(clean), docs.schema)
