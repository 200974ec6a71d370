"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over whole texts.

Words are runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z. A window is 10
consecutive words of a benchmark item; an item of 1 to 9 words is one window; an item without
words (null or empty text) has none. Hash hits are verified on the words themselves.

Edge cases: a null or empty document has no words and is never hit; a null item_id's windows
count as hits but name no item; repeated items and rows change nothing; an empty benchmark
hits nothing; other columns of `docs` pass through remove_documents() and remove_spans() whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaver.llm.textvec import LOWER, Words, rolled, slices, text_bytes
from quaver.session import discard, materialize, ship, unused

WIDTH = 10
#: Bytes of one broadcast set: its text, and so many for each word, which begins a window at most. A larger
#: benchmark is scanned in parts of this size, of one item at least.
BROADCAST_BYTES, WINDOW_BYTES = 48 << 20, 64
#: Every ASCII byte but [0-9a-z] ends a word.
STOP = np.ones(256, bool)
STOP[128:] = False
STOP[48:58] = False
STOP[97:123] = False

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


class Grams:
    """The windows of some benchmark items: by width, their sorted hashes behind a bitmap, where their words stand, and their items.

    The words stand once in `raw`, a space after each; a window is a range of it.
    """

    def __init__(self, rows: Iterable[tuple[str | None, str | None]], width: int = WIDTH) -> None:
        self.names: list[str | None] = []
        parts: list[bytes] = []
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        at = 0
        for item, text in rows:
            data, offsets = text_bytes(pa.array([text], pa.large_string()))
            data = LOWER[data]
            words = Words(data, offsets, STOP)
            n = len(words.start)
            if not n:
                continue
            w = min(width, n)
            bound = at + np.append(0, np.cumsum(words.end - words.start + 1))
            parts += [data[a:b].tobytes() for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)]
            at = int(bound[-1])
            found.setdefault(w, []).append((rolled(words.hashes(), w), bound[: n - w + 1], bound[w:] - 1, np.full(n - w + 1, len(self.names))))
            self.names.append(item)
        self.raw = b" ".join([*parts, b""])
        self.widths = {w: self._sorted(*map(np.concatenate, zip(*some, strict=True))) for w, some in found.items()}

    def _sorted(self, h: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
        """(bitmap, hash, start, end of each distinct window; bounds and numbers of the items of each)."""
        order = np.lexsort((item, h))
        h, start, end, item = h[order], start[order], end[order], item[order]
        head = np.append(True, h[1:] != h[:-1])
        # windows of one hash: told apart by their words
        rank = np.zeros(len(h), np.int64)
        size = np.diff(np.append(np.flatnonzero(head), len(h)))
        for a, n in zip(np.flatnonzero(head)[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            seen: dict[bytes, int] = {}
            rank[a : a + n] = [seen.setdefault(self.raw[start[k] : end[k]], len(seen)) for k in range(a, a + n)]
        order = np.lexsort((item, rank, h))
        h, start, end, item, rank = (x[order] for x in (h, start, end, item, rank))
        head = np.append(True, (h[1:] != h[:-1]) | (rank[1:] != rank[:-1]))
        own = head | np.append(True, item[1:] != item[:-1])  # an item counts once a window
        bits = np.zeros(1 << max(16, min(24, len(h).bit_length() + 4)), bool)
        bits[(h & np.uint64(len(bits) - 1)).astype(np.int64)] = True
        bounds = np.append(np.flatnonzero(head[own]), own.sum())
        return bits, h[head], start[head], end[head], bounds, item[own].astype(np.int32)

    def scan(self, words: Words) -> list[tuple[int, int, list[str]]]:
        """(first word, width, items) of each verified hit, over all rows of a slice."""
        hits = []
        h = words.hashes()
        for w, (bits, known, start, end, bounds, item) in self.widths.items():
            rolled_h = rolled(h, w)
            at = words.windows(w)
            at = at[bits[(rolled_h[at] & np.uint64(len(bits) - 1)).astype(np.int64)]]
            if not len(at):
                continue
            place = np.searchsorted(known, rolled_h[at])
            same = known[np.minimum(place, len(known) - 1)] == rolled_h[at]
            for i, k in zip(at[same].tolist(), place[same].tolist(), strict=True):
                key = b" ".join(words.data[a:b].tobytes() for a, b in zip(words.start[i : i + w], words.end[i : i + w], strict=True))
                while k < len(known) and known[k] == rolled_h[i]:
                    if self.raw[start[k] : end[k]] == key:
                        hits.append((i, w, [x for j in item[bounds[k] : bounds[k + 1]].tolist() if (x := self.names[j]) is not None]))
                        break
                    k += 1
        return hits


def _found(grams: Grams, batch: pa.RecordBatch, name: str) -> pa.StructArray:
    data, offsets = text_bytes(batch.column("text"))
    words = Words(LOWER[data], offsets, STOP)
    rows = batch.num_rows
    spans: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    if name in batch.schema.names:
        for k, x in enumerate(batch.column(name).to_pylist()):
            if x["spans"]:
                spans[k] = [(s["first"], s["last"]) for s in x["spans"]]
                items[k] = set(x["items"])
    for i, w, names in grams.scan(words):
        k = int(words.doc[i])
        spans.setdefault(k, []).append((i - int(words.first[k]), i - int(words.first[k]) + w))
        items.setdefault(k, set()).update(names)
    out: list[list[dict]] = [[]] * rows
    for k, some in spans.items():
        merged: list[list[int]] = []
        for a, b in sorted(some):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        base = int(words.first[k])
        out[k] = [{"first": a, "last": b, "start": int(words.start[base + a] - offsets[k]), "end": int(words.end[base + b - 1] - offsets[k])} for a, b in merged]
    return pa.StructArray.from_arrays([pa.array(words.count, pa.int64()), pa.array(out, pa.list_(_SPAN)), pa.array([sorted(items.get(k, ())) for k in range(rows)], pa.list_(pa.string()))], fields=list(_FOUND))


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, limit: int = BROADCAST_BYTES, name: str = "found") -> DataFrame:
    """(columns of docs..., found): under `name`, which none of them has: n_words, the merged hit spans (word and UTF-8 byte ranges) and the items."""
    spark = ship(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text"))
    words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    size = items.agg(F.sum(F.octet_length("text") + words.cast("long") * WINDOW_BYTES)).first()[0] or 0
    parts = max(1, math.ceil(size / limit))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
    out = docs
    for part in range(parts):
        rows = items if parts == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        shared = spark.sparkContext.broadcast(Grams(((r[0], r[1]) for r in rows.collect()), width))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = _found(shared.value, batch, name)
                columns = {f.name: batch.column(f.name) for f in batch.schema if f.name != name} | {name: found}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        before, out = out, out.mapInArrow(run, schema)
        if parts > 1:
            out = materialize(out, "scanned")
            shared.unpersist()
            if part:
                discard(before)
    return out


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their columns."""
    name = unused("found", docs.columns)
    kept = scan(docs, benchmark, name=name, **options).where(F.size(f"{name}.spans") == 0)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents with the bytes from the first to the last word of each hit span cut out of `text`."""
    name = unused("found", docs.columns)
    found = scan(docs, benchmark, name=name, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, x in zip(batch.column("text").to_pylist(), batch.column(name).to_pylist(), strict=True):
                if x["spans"]:
                    raw, at, kept = text.encode(), 0, []
                    for s in x["spans"]:
                        kept.append(raw[at : s["start"]])
                        at = s["end"]
                    text = b"".join([*kept, raw[at:]]).decode()
                texts.append(text)
            names = [c for c in batch.schema.names if c != name]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)

    return found.mapInArrow(run, docs.schema)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of op10 for every document."""
    found = scan(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )
