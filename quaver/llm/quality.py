"""Quality rules: base counts and a hashed n-gram logistic regression with calibrated probabilities.

The model is a logistic regression over hashed word 1- and 2-grams and 3- and 4-grams of
characters (code points); a text's features are the mean weights of each kind, so length does not
count. It is fitted on at most TRAIN_ROWS labelled rows that have a document (those of the smallest hash of doc_id); of each
class every fourth only calibrates it (Platt's sigmoid on standardised scores), or all do if either
class has fewer than four. A text is kept if no base rule fails and its calibrated
probability of quality 1 is at least KEEP_AT.

Edge cases: a null or empty text has no words and fails the base rules; null labels and labels
without a document are ignored and take no room in the sample; of repeated labels of a document all count; without labelled
rows of both classes every probability is 1; repeated rows are scored alike; an empty table
gives an empty result; other columns pass through filter_documents() unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaver.llm.textvec import SPACE, Words, mix, rolled, slices, text_bytes
from quaver.session import discard, materialize, ship, unused

#: The documented bound of the training sample.
TRAIN_ROWS = 2000
#: Labels (8 bytes each) that one broadcast may hold.
BROADCAST_LABELS = 2_000_000
KEEP_AT = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BITS = 16
SIZE = 1 << BITS
STEPS, RATE, L2 = 60, 0.5, 1e-4

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _again(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the distinct value per element, its count) of values within their rows."""
    _, where, count = np.unique(mix(h ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
    return where, count


def base_counts(data: np.ndarray, offsets: np.ndarray, words: Words, h: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    lines = Words(data, offsets, _NEWLINE)
    wordy = np.concatenate(([0], np.cumsum(~SPACE[data])))
    full = wordy[lines.end] > wordy[lines.start]
    doc = lines.doc[full]
    where, count = _again(lines.hashes()[full], doc)
    distinct = np.zeros(len(count), np.int64)
    distinct[where] = doc
    dup = np.bincount(doc, minlength=rows) - np.bincount(distinct, minlength=rows)
    at = words.windows(3)
    where, count = _again(rolled(h, 3)[at], words.doc[at])
    twice = np.zeros(len(h) + 3, bool)
    hit = at[count[where] >= 2] if len(at) else at
    for k in range(3):
        twice[hit + k] = True
    return {
        "n_words": words.count,
        "word_chars": _per_row(~SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": np.bincount(words.doc[twice[: len(h)]], minlength=rows),
    }


def _slots(data: np.ndarray, offsets: np.ndarray, words: Words, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slot of each n-gram, bounds of each row's n-grams) for the four kinds of n-gram."""
    shift = np.uint64(64 - BITS)
    yield (h >> shift).astype(np.int32), np.append(words.first, len(h))
    at = words.windows(2)
    yield (rolled(h, 2)[at] >> shift).astype(np.int32), np.searchsorted(at, np.append(words.first, len(h)))
    symbol, bounds = _symbols(data, offsets)
    rows = np.repeat(bounds[1:], np.diff(bounds))  # where the row of each character ends
    for n in (3, 4):
        m = max(0, len(symbol) - n + 1)
        code = np.zeros(m, np.uint32)
        for k in range(n):
            code = (code ^ symbol[k : k + m]) * np.uint32(0x9E3779B1 if n == 3 else 0x85EBCA77)
            code ^= code >> np.uint32(15)
        inside = np.arange(m) + n <= rows[:m]
        yield (code[inside] * np.uint32(0xC2B2AE3D) >> np.uint32(32 - BITS)).astype(np.int32), np.append(0, np.cumsum(inside))[np.minimum(bounds, m)]


def _symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the UTF-8 bytes of each character as one number, bounds of each row's characters)."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(start, len(data)))
    symbol = data[start].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        symbol[more] |= data[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return symbol, np.searchsorted(start, offsets)


def _means(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    count = np.diff(bounds)
    return np.where(count > 0, (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(count, 1), 0.0)


@dataclass
class Model:
    """weights[kind][slot] and the calibration sigmoid(a * score + b)."""

    weights: np.ndarray
    bias: float = 0.0
    a: float = 0.0
    b: float = 50.0

    def raw(self, data: np.ndarray, offsets: np.ndarray, words: Words, h: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.bias)
        for w, (slot, bounds) in zip(self.weights, _slots(data, offsets, words, h), strict=True):
            out += _means(w[slot], bounds)
        return out

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * score + self.b, -50, 50)))


def _platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """sigmoid(a * score + b) of the greatest likelihood for the usual smoothed targets.

    Newton steps on the standardised scores, halved until the likelihood rises, so that they cannot
    run off. A slope that is not positive says that the scores tell nothing: then the share of class 1 is the probability.
    """
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    center, scale = score.mean(), score.std()
    if not scale > 0:
        return 0.0, prior
    x = np.column_stack([(score - center) / scale, np.ones(len(score))])

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((np.logaddexp(0, z) - target * z).sum() + 1e-4 * theta[0] ** 2)

    theta = np.array([0.0, prior])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        slope = x.T @ (p - target) + np.array([2e-4 * theta[0], 0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag([2e-4, 1e-9]), slope)
        size, now = 1.0, loss(theta)
        while size > 1e-6 and loss(theta - size * step) > now:
            size /= 2
        if size <= 1e-6 or np.abs(size * step).max() < 1e-9:
            break
        theta = theta - size * step
    if theta[0] <= 0:
        return 0.0, prior
    return float(theta[0] / scale), float(theta[1] - theta[0] * center / scale)


def _held(y: np.ndarray) -> np.ndarray:
    """Every fourth row of each class."""
    place = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0))
    return place % 4 == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on the bounded sample: its feature counts, not its texts, reach the driver."""
    spark = ship(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    ids = known.select("doc_id").distinct()
    # ids that have a document: no more than labels, so that only labels are sorted
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(ids) if known.count() <= BROADCAST_LABELS else ids, "doc_id").distinct()
    chosen = known.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "y").limit(rows).collect()
    blank = Model(np.zeros((4, SIZE), np.float32))
    if not chosen:
        return blank
    picked = spark.createDataFrame([(r[0], r[1]) for r in chosen], "doc_id long, y int")
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            words = Words(data, offsets)
            slots, parts = [], []
            for kind, (slot, bounds) in enumerate(_slots(data, offsets, words, words.hashes())):
                for k in range(batch.num_rows):
                    some = slot[bounds[k] : bounds[k + 1]]
                    found, n = np.unique(some, return_counts=True)
                    slots.append((k, found + kind * SIZE, n / max(1, len(some))))
            for k in range(batch.num_rows):
                mine = [x for x in slots if x[0] == k]
                parts.append((np.concatenate([x[1] for x in mine]).astype(np.int32).tobytes(), np.concatenate([x[2] for x in mine]).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array([p[0] for p in parts], pa.binary()), pa.array([p[1] for p in parts], pa.binary())], names=["doc_id", "y", "slots", "values"])

    # one job over the documents; what it leaves is as small as the sample
    counted = materialize(sample.mapInArrow(run, "doc_id long, y int, slots binary, values binary"), "features")
    got = sorted(zip(*(counted.toArrow().column(c).to_pylist() for c in ("doc_id", "y", "slots", "values")), strict=True), key=lambda r: r[:3])
    discard(counted)
    y = np.array([r[1] for r in got], np.float64)
    if len({*y}) < 2:
        return blank
    held = _held(y)
    if len({*y[held]}) < 2:
        held[:] = False
    slot = np.concatenate([np.frombuffer(r[2], np.int32) for r in got])
    value = np.concatenate([np.frombuffer(r[3], np.float32) for r in got])
    counts = np.array([len(r[2]) // 4 for r in got])
    row = np.repeat(np.arange(len(got), dtype=np.int32), counts)
    del got
    starts = np.append(0, np.cumsum(counts)[:-1])
    w, seen, bias, seen_bias = np.zeros(4 * SIZE), np.full(4 * SIZE, 1e-12), 0.0, 1e-12
    weight = np.where(y == 1, 0.5 / (y[~held] == 1).sum(), 0.5 / (y[~held] == 0).sum())
    weight[held] = 0

    def score() -> np.ndarray:
        sums = np.add.reduceat(np.append(w.astype(np.float32)[slot] * value, np.float32(0)), starts).astype(np.float64)
        return np.where(counts > 0, sums, 0.0) + bias

    for _ in range(STEPS):
        gap = weight * (1 / (1 + np.exp(-np.clip(score(), -50, 50))) - y)
        grad = np.bincount(slot, gap.astype(np.float32)[row] * value, 4 * SIZE) + L2 * w / (4 * SIZE)
        seen += grad * grad
        w -= RATE * grad / np.sqrt(seen)
        seen_bias += gap.sum() ** 2
        bias -= RATE * gap.sum() / np.sqrt(seen_bias)
    calibrating = held if held.any() else ~held
    a, b = _platt(score()[calibrating], y[calibrating])
    return Model(w.reshape(4, SIZE).astype(np.float32), bias, a, b)


def assess(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, name: str = "quality") -> DataFrame:
    """The columns of docs and, under a name that none of them has, a struct of the base counts, base_failed, probability and kept."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    kinds = "struct<" + ", ".join(f"{c}: bigint" for c in BASE_COLUMNS) + ", base_failed: boolean, probability: double, kept: boolean>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            words = Words(data, offsets)
            h = words.hashes()
            base = base_counts(data, offsets, words, h)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
            p = model.value.probability(model.value.raw(data, offsets, words, h))
            fields = {c: pa.array(base[c], pa.int64()) for c in BASE_COLUMNS} | {"base_failed": pa.array(failed), "probability": pa.array(p), "kept": pa.array(~failed & (p >= KEEP_AT))}
            columns = {f.name: batch.column(f.name) for f in batch.schema} | {name: pa.StructArray.from_arrays(list(fields.values()), names=list(fields))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(kinds))]))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept documents, with the columns of docs."""
    name = unused("quality", docs.columns)
    return assess(docs, labels, name=name).where(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op2 for every document."""
    return assess(docs.select("doc_id", "text"), labels).select("doc_id", "quality.*")
