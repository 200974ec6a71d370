"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

A word is `^`, its bytes (A-Z lower-cased, split at ASCII other than [0-9a-z]) and `$`. Each
class has counts of symbols after up to seven symbols of the word; they back off, by an
interpolated discount with strength STRENGTH, to continuation counts that both classes share
(of four and of two symbols) and from there to the uniform distribution. A text's toxic and
ordinary log-likelihoods are compared per word and normalised by its length; a sigmoid over
the normalised differences, fitted on one fold of the training rows, gives the score.

The n-gram counts are summed exactly by Spark and kept by exact key, so the tables grow with the
distinct n-grams. Up to BROADCAST_KEYS rows of them are broadcast as sorted arrays; beyond that the
tables stay where they are: the distinct words of the texts are spelled out and joined with them,
the values of the COMMON_WORDS most frequent words are broadcast, and only the other words of
a text are joined with their values. Training rows are labelled rows whose crc32(doc_id as text) % 5
is not 0. Of every third of these at most CALIBRATION_ROWS (the smallest hashes of doc_id) only
calibrate; all others are counted.

Edge cases: a null or empty text has no words and scores like a text of length zero; null labels
and labels without a document are ignored; without training rows of both classes every score
is 0; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaver.llm.textvec import LOWER, Words, slices, text_bytes
from quaver.session import materialize, ship

FOLDS = 5
CALIBRATION_ROWS = 6000
#: Labels (16 bytes each) that one broadcast may hold, so that texts need not move to meet them.
BROADCAST_LABELS = 2_000_000
#: Rows of the count tables (16 to 24 bytes each) that one broadcast may hold; above, words are joined with the tables.
BROADCAST_KEYS = 4_000_000
#: Words (16 bytes each) whose values are broadcast when the tables are not.
COMMON_WORDS = 1_000_000
DISCOUNT, STRENGTH = 0.75, 30.0
BEGIN, END = 1, 2

STOP = np.ones(256, bool)
STOP[128:] = False
STOP[48:58] = False
STOP[97:123] = False

_ONE, _EIGHT = np.uint64(1), np.uint64(8)


@dataclass
class Distinct:
    """The distinct words of a slice: their bytes end to end, and per word of the slice which one it is."""

    data: np.ndarray
    offsets: np.ndarray
    which: np.ndarray


def distinct(words: Words) -> Distinct:
    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    size = words.end[first] - words.start[first]
    ends = np.cumsum(size)
    at = np.repeat(words.start[first] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return Distinct(words.data[at], np.append(0, ends), which)


def keys(d: Distinct) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, word) of every symbol after `^`: the newest symbol in the lowest of eight bytes, zero where none is."""
    n = len(d.offsets) - 1
    size = np.diff(d.offsets) + 2  # with ^ and $
    ends = np.cumsum(size)
    total = int(ends[-1]) if n else 0
    symbol = np.zeros(total, np.uint64)
    begin = ends - size
    symbol[begin] = BEGIN
    symbol[ends - 1] = END
    inner = np.ones(total, bool)
    inner[begin] = inner[ends - 1] = False
    symbol[inner] = d.data
    word = np.repeat(np.arange(n), size)
    place = np.arange(total) - np.repeat(begin, size)
    key = symbol.copy()
    for j in range(1, 8):
        back = np.zeros(total, np.uint64)
        back[j:] = symbol[:-j] if j < total else 0
        back[place < j] = 0
        key |= back << np.uint64(8 * j)
    after = place > 0
    return key[after], word[after]


def log_ratio(two: np.ndarray, key: np.ndarray, four: np.ndarray, four_context: np.ndarray, gram: np.ndarray, context: np.ndarray) -> np.ndarray:
    """log P(symbol | context, toxic) - log P(symbol | context, ordinary) of the counts of each key.

    Rows of four_context are n and kinds; of gram n by class; of context n by class, then kinds by class.
    """
    d = DISCOUNT
    pair = (key & np.uint64(0xFFFF)).astype(np.int64)
    by = two.reshape(256, 256)
    total, kinds = by.sum(1)[pair >> 8], (by > 0).sum(1)[pair >> 8]
    p = np.where(total > 0, (np.maximum(two[pair] - d, 0) + d * kinds / 256) / np.maximum(total, 1), 1 / 256)
    total, kinds = four_context
    p = np.where(total > 0, (np.maximum(four[0] - d, 0) + d * kinds * p) / np.maximum(total, 1), p)
    p = np.maximum(p, 1e-9)
    by_class = [(np.maximum(gram[c] - d, 0) + (d * context[2 + c] + STRENGTH) * p) / (context[c] + STRENGTH) for c in (1, 0)]
    return np.log(by_class[0]) - np.log(by_class[1])


@dataclass
class Sorted:
    """Count rows by exact key."""

    key: np.ndarray
    values: np.ndarray  # [column, key]

    @classmethod
    def read(cls, table: DataFrame) -> Sorted:
        names = [c for c in table.columns if c != "key"]
        rows = table.select("key", *[F.col(c).cast("float") for c in names]).toArrow()
        key = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        return cls(key[order], np.stack([rows.column(c).to_numpy()[order] for c in names]))

    def find(self, key: np.ndarray) -> np.ndarray:
        """The counts of each key, zeros where it never occurred."""
        if not len(self.key):
            return np.zeros((len(self.values), len(key)))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.values[:, at], 0).astype(float)


@dataclass
class Counts:
    """Exact counts: of full n-grams and their contexts by class, of shared continuations, and of symbol pairs."""

    gram: Sorted
    context: Sorted
    four: Sorted
    four_context: Sorted
    two: np.ndarray  # [65536]

    def difference(self, key: np.ndarray) -> np.ndarray:
        """log P(symbol | context, toxic) - log P(symbol | context, ordinary)."""
        key, which = np.unique(key, return_inverse=True)
        four, four_context = self.four.find(key & np.uint64(0xFFFFFFFF)), self.four_context.find((key >> _EIGHT) & np.uint64(0xFFFFFF))
        return log_ratio(self.two, key, four, four_context, self.gram.find(key), self.context.find(key >> _EIGHT))[which]


@dataclass
class Tables:
    """The same counts as tables by `key`, for more rows than one broadcast may hold."""

    gram: DataFrame
    context: DataFrame
    four: DataFrame
    four_context: DataFrame
    two: np.ndarray

    def values(self, words: DataFrame) -> DataFrame:
        """(word_id, value): the summed differences of the (word_id, word) rows."""
        two = self.two

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "word"):
                key, word = keys(Distinct(*text_bytes(batch.column("word")), np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("word_id").take(pa.array(word)), pa.array(key.view(np.int64))], names=["word_id", "key"])

        def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, *counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names)
                value = log_ratio(two, key.view(np.uint64), counts[0:1], counts[1:3], counts[3:5], counts[5:9])
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(value)], names=["key", "value"])

        spelled = materialize(words.mapInArrow(spell, "word_id long, key long"), "spelled")
        joined = spelled.select("key").distinct()
        parts = {"four": (self.four, 0, 0xFFFFFFFF), "four_context": (self.four_context, 8, 0xFFFFFF), "gram": (self.gram, 0, -1), "context": (self.context, 8, -1)}
        for name, (table, move, mask) in parts.items():
            held = table.select(*[F.col(c).alias(f"{name}_{c}") for c in table.columns])
            joined = joined.join(held, F.shiftrightunsigned("key", move).bitwiseAND(F.lit(mask).cast("long")) == F.col(f"{name}_key"), "left").drop(f"{name}_key")
        by_key = joined.select("key", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in joined.columns if c != "key"]).mapInArrow(differ, "key long, value double")
        return spelled.join(by_key, "key").groupBy("word_id").agg(F.sum("value").alias("value"))


def shape(n: np.ndarray, total: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """Per text: the difference of log-likelihoods per word, per root of words, and the share of it in telling words."""
    n = np.maximum(n, 1)
    return np.column_stack([total / n, total / np.sqrt(n), telling / np.sqrt(n), np.log1p(telling)])


def features(counts: Counts, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words = Words(LOWER[data], offsets, STOP)
    d = distinct(words)
    key, word = keys(d)
    per_word = np.bincount(word, counts.difference(key), len(d.offsets) - 1)[d.which] if len(key) else np.zeros(0)
    rows = len(offsets) - 1
    return shape(words.count, np.bincount(words.doc, per_word, rows), np.bincount(words.doc, np.maximum(per_word - 1, 0), rows))


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word_id, word, n): the distinct words of each slice and how often they occur."""
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        words = Words(LOWER[data], offsets, STOP)
        if not len(words.start):
            continue
        h, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
        raw = words.data.tobytes()
        spelled = [raw[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(spelled, pa.binary()), pa.array(n.astype(np.int64))], names=["word_id", "word", "n"])


def joined_features(rows: DataFrame, tables: Tables, common_words: int = COMMON_WORDS) -> DataFrame:
    """The other columns of rows (text and longs) with features a to d, without a broadcast of the tables."""
    carried = [c for c in rows.columns if c != "text"]
    words = materialize(rows.select("text").mapInArrow(_vocabulary, "word_id long, word binary, n long").groupBy("word_id").agg(F.first("word").alias("word"), F.sum("n").alias("n")), "words")
    values = materialize(words.select("word_id", "n").join(tables.values(words.select("word_id", "word")), "word_id"), "values")
    common = rows.sparkSession.sparkContext.broadcast(Sorted.read(values.orderBy(F.desc("n"), "word_id").limit(common_words).select(F.col("word_id").alias("key"), F.lit(1).alias("known"), "value")))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", *carried, "word_id", "n", "total", "telling"]
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            words = Words(LOWER[data], offsets, STOP)
            h = words.hashes()
            known, value = common.value.find(h)
            rows = len(offsets) - 1
            kept = [batch.column(c) for c in ("row", *carried)]
            sums = [words.count, np.bincount(words.doc, value, rows), np.bincount(words.doc, np.where(known > 0, np.maximum(value - 1, 0), 0), rows)]
            yield pa.RecordBatch.from_arrays([*kept, pa.nulls(rows, pa.int64()), pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])], names=names)
            rare = np.flatnonzero(known == 0)
            if len(rare):
                pair, n = np.unique(np.stack([words.doc[rare], h[rare].view(np.int64)]), axis=1, return_counts=True)
                none = pa.array(np.zeros(len(n)))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(pair[0])) for c in kept), pa.array(pair[1]), pa.array(n.astype(np.int64)), none, none], names=names)

    longs = ", ".join(f"{c} long" for c in ("row", *carried, "word_id", "n"))
    dealt = materialize(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(deal, f"{longs}, total double, telling double"), "dealt")
    whole = dealt.where("word_id is null").drop("word_id")
    rest = dealt.where("word_id is not null").drop("total", "telling").join(values.select("word_id", "value"), "word_id")
    rest = rest.select("row", *carried, F.lit(0).cast("long").alias("n"), (F.col("n") * F.col("value")).alias("total"), (F.col("n") * F.greatest(F.col("value") - 1, F.lit(0.0))).alias("telling"))
    sums = whole.union(rest).groupBy("row", *carried).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("telling").alias("telling"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shape(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "total", "telling")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *map(pa.array, x.T)], names=[*carried, "a", "b", "c", "d"])

    return sums.mapInArrow(run, ", ".join([*(f"{c} long" for c in carried), *(f"{c} double" for c in "abcd")]))


@dataclass
class Model:
    counts: Broadcast | None
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.counts is None:
            return np.zeros(len(offsets) - 1)
        return self.chance(features(self.counts.value, data, offsets))

    def chance(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40)))


def calibrate(counts: Broadcast | None, x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge logistic regression on the few normalised differences, classes weighted by the root of their size."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-2] * (len(w) - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge
        w -= np.clip(np.linalg.solve(hess, z.T @ (p - y) + ridge @ w), -3, 3)
    return Model(counts, w, mean, scale)


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)) == 0


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of labelled texts with their counts by class."""
    kept: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        rows = np.concatenate(kept)
        key, which = np.unique(rows[:, 0], return_inverse=True)
        by = [np.bincount(which, rows[:, c], len(key)).astype(np.int64) for c in (1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), *map(pa.array, by)], names=["key", "ordinary", "toxic"])

    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        words = Words(LOWER[data], offsets, STOP)
        d = distinct(words)
        if not len(d.which):
            continue
        y = batch.column("y").to_numpy(zero_copy_only=False)[words.doc]
        times = [np.bincount(d.which[y == c], minlength=len(d.offsets) - 1) for c in (0, 1)]
        key, word = keys(d)
        found, which = np.unique(key.view(np.int64), return_inverse=True)
        kept.append(np.column_stack([found, *(np.bincount(which, t[word], len(found)).astype(np.int64) for t in times)]))
        size += len(found)
        if size > 1_000_000:
            yield out()
            kept.clear()
            size = 0
    if kept:
        yield out()


def count(labelled: DataFrame, limit: int = BROADCAST_KEYS) -> Counts | Tables:
    """The counts of (text, y) rows: as arrays if they have at most `limit` rows."""
    grams = labelled.mapInArrow(_grams, "key long, ordinary long, toxic long")
    gram = materialize(grams.groupBy("key").agg(F.sum("ordinary").alias("n0"), F.sum("toxic").alias("n1")), "grams")
    before = F.shiftrightunsigned("key", 8).alias("key")
    context = materialize(gram.groupBy(before).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count_if(F.col("n0") > 0).alias("k0"), F.count_if(F.col("n1") > 0).alias("k1")), "contexts")
    four = materialize(gram.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("key")).agg(F.count("*").alias("n")), "fours")
    four_context = materialize(four.groupBy(before).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")), "four-contexts")
    two = np.zeros(65536, np.float32)
    for key, n in four.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFF))).agg(F.count("*")).collect():
        two[key] = n
    tables = (gram, context, four, four_context)
    if sum(t.count() for t in tables) > limit:
        return Tables(*tables, two)
    return Counts(*map(Sorted.read, tables), two)


def fit(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_KEYS, common_words: int = COMMON_WORDS) -> tuple[Model, Tables | None]:
    """The model, and the tables if they are too large for it."""
    spark = ship(docs.sparkSession)
    nothing = Model(None, np.zeros(5), np.zeros(4), np.ones(4)), None
    y = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = y.where(fold == 0).orderBy(F.xxhash64("doc_id", F.lit(12)), "doc_id", "y").limit(CALIBRATION_ROWS).collect()
    picked = F.broadcast(spark.createDataFrame([tuple(r) for r in chosen], "doc_id long, y long"))
    train = y.join(picked, "doc_id", "left_anti")
    if train.count() <= BROADCAST_LABELS:  # else both sides are shuffled, whole texts too
        train = F.broadcast(train)
    counted = materialize(text.join(train, "doc_id").select("text", "y"), "training")
    if len(counted.select("y").distinct().collect()) < 2:
        return nothing
    counts = count(counted, limit)
    tables = counts if isinstance(counts, Tables) else None
    shared = None if tables else spark.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(shared.value, *text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), *map(pa.array, x.T)], names=["doc_id", "y", "a", "b", "c", "d"])

    calibrating = text.join(picked, "doc_id")
    found = joined_features(calibrating, tables, common_words) if tables else calibrating.mapInArrow(run, "doc_id long, y long, a double, b double, c double, d double")
    rows = sorted(map(tuple, found.select("doc_id", "y", "a", "b", "c", "d").collect()))
    if len({r[1] for r in rows}) < 2:
        return nothing
    return calibrate(shared, np.array([r[2:] for r in rows]), np.array([r[1] for r in rows], float)), tables


def score(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_KEYS, common_words: int = COMMON_WORDS) -> DataFrame:
    """(doc_id, held_out, score) for every row."""
    model, tables = fit(docs, labels, limit, common_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = model.score(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.chance(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in "abcd"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    texts, kind = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, score double"
    scored = joined_features(texts, tables, common_words).mapInArrow(weigh, kind) if tables else texts.mapInArrow(run, kind)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op6 for every document."""
    return score(docs, labels).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
