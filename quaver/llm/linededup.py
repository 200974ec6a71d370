"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends with A-Z lower-cased; a key
counts once per document row. `LineIndex` keeps for every key its reference count (rows of
(hi, lo, refs), the 128-bit XXH3 of the key) and, per shard, a cuckoo filter over the keys
that at least `min_docs` documents hold. insert() and delete() add documents and take them
back; apply() drops the lines whose key the filter may hold and the table confirms. There are as many
shards as the common keys need, KEYS_EACH to a shard. save() writes the index to a folder that
outlives the application, and load() reads it back.

Edge cases: a null or empty text is one empty line and stays as it is; empty keys are never
counted or dropped; repeated rows are documents of their own; an empty table gives an empty
index; deleting what was never inserted raises; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaver.llm.textvec import LOWER, Words, mix, slices, text_bytes
from quaver.session import materialize, ship, unused

MIN_DOCS = 10
#: Shards of an empty index; they are doubled while common keys are more than KEYS_EACH a shard.
SHARDS, KEYS_EACH = 64, 1 << 18
#: Bytes of filters and confirmed keys that one broadcast may hold; beyond it apply() joins instead.
BROADCAST_BYTES = 32 << 20
#: Distinct keys that a task sums up before it hands them on.
FLUSH_KEYS = 200_000

SETTINGS = "min_docs long, shards long"
COUNTS = "hi long, lo long, refs long"


class Lines:
    """Lines of a slice that hold a word: row, line number within the row, and the key's digest."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        words = Words(data, offsets)
        breaks = np.concatenate(([0], np.cumsum(data == 10)))
        line = breaks[words.start]
        n = len(line)
        fresh = np.ones(n, bool)
        fresh[1:] = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
        self.first = np.flatnonzero(fresh)
        last = np.append(self.first[1:], n)[: len(self.first)] - 1
        self.doc = words.doc[self.first]
        self.n_lines = breaks[offsets[1:]] - breaks[offsets[:-1]] + 1
        self.number = line[self.first] - breaks[offsets[:-1]][self.doc]
        low, digest = LOWER[data].tobytes(), xxhash.xxh3_128_digest
        keys = b"".join([digest(low[a:b]) for a, b in zip(words.start[self.first].tolist(), words.end[last].tolist(), strict=True)])
        self.key = np.frombuffer(keys, "<i8").reshape(-1, 2)


def line_counts(docs: DataFrame) -> DataFrame:
    """(hi, lo, refs): in how many document rows each key occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            pair = np.frombuffer(b"".join(seen), "<i8").reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(list(seen.values()), pa.int64())], names=["hi", "lo", "refs"])

        for batch in slices(batches):
            lines = Lines(*text_bytes(batch.column("text")))
            raw = lines.key.tobytes()
            bounds = (np.searchsorted(lines.doc, np.arange(batch.num_rows + 1)) * 16).tolist()
            for a, b in zip(bounds, bounds[1:], strict=False):
                if b > a:
                    seen.update({raw[i : i + 16] for i in range(a, b, 16)})
            if len(seen) >= FLUSH_KEYS:
                yield out()
                seen.clear()
        if seen:
            yield out()

    parts = docs.select("text").mapInArrow(run, COUNTS)
    return parts.groupBy("hi", "lo").agg(F.sum("refs").alias("refs"))


class Cuckoo:
    """A cuckoo filter of 16-bit tags in buckets of four; tag 0 means empty."""

    def __init__(self, tags: np.ndarray) -> None:
        self.tags = tags

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(2, int(np.ceil(keys / 3.2)).bit_length())
        return cls(np.zeros((buckets, 4), np.uint16))

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return places(hi, lo, np.uint64(len(self.tags) - 1))

    def _fill(self, at: np.ndarray, tag: np.ndarray, hold: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Put value[k] into a slot of bucket at[k] that has hold[k]; which k found none."""
        order = np.lexsort((hold, at))
        bucket, wanted = at[order], hold[order]
        fresh = np.append(True, (bucket[1:] != bucket[:-1]) | (wanted[1:] != wanted[:-1])) if len(order) else np.zeros(0, bool)
        place = np.arange(len(order)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        other = self.tags[bucket] != wanted[:, None]
        fits = place < (~other).sum(1)
        slot = np.argsort(other, axis=1, kind="stable")[np.flatnonzero(fits), place[fits]]
        self.tags[bucket[fits], slot] = value[order][fits]
        return np.sort(order[~fits])

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False if the filter is full; the caller then builds a larger one from the table."""
        mask = len(self.tags) - 1
        tag, a, b = (x.astype(np.int64) for x in self.places(hi, lo))
        left = np.arange(len(tag))
        for at in (a, b):
            left = left[self._fill(at[left], tag[left], np.zeros(len(left), np.int64), tag[left])]
        for tag, at in zip(tag[left].tolist(), b[left].tolist(), strict=True):
            for turn in range(500):  # the few that meet two full buckets push others on
                row = self.tags[at]
                free = np.flatnonzero(row == 0)
                if len(free):
                    row[free[0]] = tag
                    break
                k = turn & 3
                tag, row[k] = int(row[k]), tag
                at = (at ^ int(spread(np.array([tag], np.uint64))[0])) & mask
            else:
                return False
        return True

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        tag, a, b = (x.astype(np.int64) for x in self.places(hi, lo))
        left = np.arange(len(tag))
        for at in (a, b):
            left = left[self._fill(at[left], tag[left], tag[left], np.zeros(len(left), np.int64))]
        if len(left):
            raise ValueError("the filter does not hold a key to be deleted")


def spread(tag: np.ndarray) -> np.ndarray:
    return mix(tag.astype(np.uint64) + np.uint64(0x51ED27))


def places(hi: np.ndarray, lo: np.ndarray, mask: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tag, bucket, other bucket) of keys; either bucket follows from the other and the tag."""
    h = mix(hi.astype(np.int64).view(np.uint64) ^ mix(lo.astype(np.int64).view(np.uint64)))
    tag = ((h >> np.uint64(48)) % np.uint64(65535)) + np.uint64(1)
    first = h & mask
    return tag, first, (first ^ spread(tag)) & mask


class Probe:
    """Filters of all shards and the sorted keys that confirm their answers, as one broadcast."""

    def __init__(self, filters: list[tuple[int, bytes]], hi: np.ndarray, lo: np.ndarray, shards: int) -> None:
        self.shards = shards
        self.base, self.mask = np.zeros(shards, np.int64), np.zeros(shards, np.uint64)
        tables, at = [np.zeros((1, 4), np.uint16)], 1
        for shard, blob in filters:
            table = np.frombuffer(blob, np.uint16).reshape(-1, 4)
            self.base[shard], self.mask[shard] = at, len(table) - 1
            tables.append(table)
            at += len(table)
        self.tags = np.concatenate(tables)
        order = np.lexsort((lo, hi))
        self.keys = np.stack([hi[order], lo[order]], 1) if len(hi) else np.zeros((0, 2), np.int64)

    def maybe(self, key: np.ndarray) -> np.ndarray:
        shard = key[:, 0] % self.shards
        tag, a, b = places(key[:, 0], key[:, 1], self.mask[shard])
        t, base = tag.astype(np.uint16)[:, None], self.base[shard]
        return (self.tags[base + a.astype(np.int64)] == t).any(1) | (self.tags[base + b.astype(np.int64)] == t).any(1)

    def held(self, key: np.ndarray) -> np.ndarray:
        out = self.maybe(key)
        if not len(self.keys):
            return np.zeros(len(key), bool)
        known = {x.tobytes() for x in self.keys} if len(self.keys) < 64 else None
        ask = np.flatnonzero(out)
        if known is not None:
            out[ask] = [key[i].tobytes() in known for i in ask]
            return out
        lo = np.searchsorted(self.keys[:, 0], key[ask, 0], "left")
        same = np.zeros(len(ask), bool)
        for step in range(int(np.unique(self.keys[:, 0], return_counts=True)[1].max())):
            at = np.minimum(lo + step, len(self.keys) - 1)
            same |= (self.keys[at] == key[ask]).all(1)
        out[ask] = same
        return out


def _rewrite(batch: pa.RecordBatch, lines: Lines, drop: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The text column without the lines marked in drop, and how many went from each row."""
    n_dropped = np.bincount(lines.doc[drop], minlength=batch.num_rows)
    column = batch.column("text")
    if not n_dropped.any():
        return column, n_dropped
    texts = column.to_pylist()
    gone: dict[int, set[int]] = {}
    for k, number in zip(lines.doc[drop].tolist(), lines.number[drop].tolist(), strict=True):
        gone.setdefault(k, set()).add(number)
    for k, numbers in gone.items():
        texts[k] = "\n".join([x for i, x in enumerate(texts[k].split("\n")) if i not in numbers])
    return pa.array(texts, column.type), n_dropped


def _output(batch: pa.RecordBatch, names: list[str], text: pa.Array, lines: Lines, dropped: np.ndarray, report: bool) -> pa.RecordBatch:
    columns = {c: batch.column(c) for c in names} | {"text": text}
    if report:
        columns |= {unused("n_lines", names): pa.array(lines.n_lines, pa.int64()), unused("n_dropped", names): pa.array(dropped, pa.int64())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _shard(shards: int):
    return F.pmod("hi", F.lit(shards)).cast("int").alias("shard")


def _change(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter with the keys that crossed the bound put in or taken out; null if it must be built anew."""
    blob = next(iter(pdf["filter"].dropna()), None)
    filt = Cuckoo(np.frombuffer(blob, np.uint16).reshape(-1, 4).copy()) if blob is not None else None
    came, went = (pdf[pdf["sign"] == s][["hi", "lo"]].to_numpy(np.int64) for s in (1, -1))
    if filt is not None:
        filt.delete(went[:, 0], went[:, 1])
    if filt is None or not filt.insert(came[:, 0], came[:, 1]):
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "filter": [None]})
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "filter": [filt.tags.tobytes()]})


def _built(keys: DataFrame, shards: int) -> DataFrame:
    """Filters over (hi, lo) keys."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        size = len(pdf)
        hi, lo = (pdf[c].to_numpy(np.int64) for c in ("hi", "lo"))
        while not (filt := Cuckoo.sized(size)).insert(hi, lo):
            size *= 2
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "filter": [filt.tags.tobytes()]})

    return keys.select(_shard(shards), "hi", "lo").groupBy("shard").applyInPandas(run, "shard int, filter binary")


@dataclass
class LineIndex:
    """refs: (hi, lo, refs) of every key; filters: (shard, filter) over the keys with min_docs references."""

    refs: DataFrame
    filters: DataFrame
    min_docs: int = MIN_DOCS
    shards: int = SHARDS

    @classmethod
    def empty(cls, spark, min_docs: int = MIN_DOCS, shards: int = SHARDS) -> LineIndex:
        ship(spark)
        return cls(spark.createDataFrame([], COUNTS), spark.createDataFrame([], "shard int, filter binary"), min_docs, shards)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(line_counts(docs))

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._changed(line_counts(docs).select("hi", "lo", (-F.col("refs")).alias("refs")))

    def _changed(self, change: DataFrame) -> LineIndex:
        """The index after some references came or went; filters change by the keys that crossed min_docs."""
        old = self.refs.select("hi", "lo", F.col("refs").alias("old"), F.lit(0).cast("long").alias("more"))
        both = old.union(change.select("hi", "lo", F.lit(0).cast("long"), F.col("refs")))
        sums = both.groupBy("hi", "lo").agg(F.sum("old").alias("old"), F.sum(F.col("old") + F.col("more")).alias("refs"))
        sums = sums.withColumn("refs", F.when(F.col("refs") < 0, F.raise_error(F.lit("deleted lines that were never inserted")).cast("long")).otherwise(F.col("refs")))
        table = materialize(sums.where("refs > 0 or old > 0"), "line-refs")
        now, before = F.col("refs") >= self.min_docs, F.col("old") >= self.min_docs
        shards, common = self.shards, table.where(now).count()
        while common > shards * KEYS_EACH:
            shards *= 2
        if shards != self.shards:
            filters = _built(table.where(now), shards)
        else:
            crossed = table.where(now != before).select(_shard(shards), "hi", "lo", F.when(now, 1).otherwise(-1).alias("sign"), F.lit(None).cast("binary").alias("filter"))
            held = self.filters.select("shard", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0), "filter")
            changed = materialize(crossed.union(held).groupBy("shard").applyInPandas(_change, "shard int, filter binary"), "line-changes")
            full = [r[0] for r in changed.where("filter is null").collect()]
            filters = changed.where("filter is not null")
            if full:
                filters = filters.union(_built(table.where(now).where(_shard(shards).isin(full)), shards))
        return LineIndex(table.where("refs > 0").select("hi", "lo", "refs"), materialize(filters, "line-filters"), self.min_docs, shards)

    def save(self, path: str) -> None:
        """Write the index to a new folder; it is complete once its settings are there."""
        self.refs.write.parquet(f"{path}/refs")
        self.filters.write.parquet(f"{path}/filters")
        self.refs.sparkSession.createDataFrame([(self.min_docs, self.shards)], SETTINGS).coalesce(1).write.json(f"{path}/settings")

    @classmethod
    def load(cls, spark, path: str) -> LineIndex:
        ship(spark)
        found = spark.read.schema(SETTINGS).json(f"{path}/settings").first()
        return cls(spark.read.schema(COUNTS).parquet(f"{path}/refs"), spark.read.schema("shard int, filter binary").parquet(f"{path}/filters"), found.min_docs, found.shards)

    def apply(self, docs: DataFrame, report: bool = False, limit: int = BROADCAST_BYTES) -> DataFrame:
        """docs with the common lines dropped from `text`; with report also n_lines and n_dropped (with underscores after them where taken)."""
        spark, names = docs.sparkSession, list(docs.columns)
        schema = T.StructType([*docs.schema.fields, *([T.StructField(unused(c, names), T.LongType()) for c in ("n_lines", "n_dropped")] if report else [])])
        common = self.refs.where(F.col("refs") >= self.min_docs).select("hi", "lo")
        size = common.count() * 16 + (self.filters.agg(F.sum(F.octet_length("filter"))).first()[0] or 0)
        if size > limit:
            return self._apply_joined(docs, common, names, schema, report)
        keys = common.toArrow()
        probe = spark.sparkContext.broadcast(Probe([(r[0], bytes(r[1])) for r in self.filters.collect()], *(keys.column(c).to_numpy() for c in ("hi", "lo")), self.shards))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                lines = Lines(*text_bytes(batch.column("text")))
                text, dropped = _rewrite(batch, lines, probe.value.held(lines.key))
                yield _output(batch, names, text, lines, dropped, report)

        return docs.mapInArrow(run, schema)

    def _apply_joined(self, docs: DataFrame, common: DataFrame, names: list[str], schema: T.StructType, report: bool) -> DataFrame:
        """The way past the broadcast bound: join (text, key) pairs with the table, then the found keys with the texts."""

        mark, found = unused("mark", names), unused("found", names)

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                lines = Lines(*text_bytes(batch.column("text")))
                rows = np.unique(np.column_stack([lines.doc, lines.key]), axis=0)
                marks = batch.column("mark").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(marks[rows[:, 0]]), pa.array(rows[:, 1]), pa.array(rows[:, 2])], names=["mark", "hi", "lo"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                lines = Lines(*text_bytes(batch.column("text")))
                keys = [{(x["hi"], x["lo"]) for x in some or ()} for some in batch.column(found).to_pylist()]
                drop = np.array([(h, l) in keys[k] for k, (h, l) in zip(lines.doc.tolist(), lines.key.tolist(), strict=True)], bool)
                text, dropped = _rewrite(batch, lines, drop)
                yield _output(batch, names, text, lines, dropped, report)

        made = F.xxhash64(F.coalesce("text", F.lit("")))
        hits = docs.select(made.alias("mark"), "text").mapInArrow(pairs, "mark long, hi long, lo long").join(common, ["hi", "lo"])
        rows = materialize(hits.groupBy(F.col("mark").alias(mark)).agg(F.collect_set(F.struct("hi", "lo")).alias(found)), "line-hits")
        joined = docs.withColumn(mark, made).join(rows, mark, "left")
        return joined.select(*[F.col(f"`{c}`") for c in names], found).mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One batch: index all of docs, then drop their common lines; the columns of docs."""
    return LineIndex.empty(docs.sparkSession, min_docs).insert(docs).apply(docs)


def query(docs: DataFrame) -> DataFrame:
    """The digest columns of op5 for every document."""
    docs = docs.select("doc_id", "text")
    kept = LineIndex.empty(docs.sparkSession).insert(docs).apply(docs, report=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
