"""Substring dedup over a log-structured index of window fingerprints.

Every WIDTH consecutive words of a document are a window with a 64-bit fingerprint and 16 check bits
of an independent hash. The index is a list of immutable runs; a run holds, per shard, the sorted
fingerprints of past batches with their check bits.
ingest() deals the windows of a new batch to shards, sorts them, merge-joins them with every run
and with the batch itself (a window also counts if a smaller doc_id of the same batch has it),
and writes the fingerprints that are new as the next run. Before a batch comes, FANOUT newest runs of one
level are compacted into one of the next level, so that there are few runs and none is rewritten often. Batches must come in ascending doc_id order. save() copies the runs to a
folder that outlives the application, and load() goes on from there.

A fingerprint is looked up by all of its 64 bits, and what it meets is verified by the check bits,
which come from independent word hashes; the shard follows from the fingerprint and verifies nothing.
Texts are not compared: a window meets one of other words by chance only, for one of N windows with
a chance of about N / 2**80.

Edge cases: a null or empty text has no words; texts under WIDTH words keep all of them; rows
with a null doc_id cannot be ordered: they are kept whole and not indexed; rows of equal doc_id
never remove words of each other; an empty table gives an empty result; other columns pass through
SubstringIndex.remove(), and its own get underscores where their names are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaver.llm.textvec import Words, mix, rolled, slices, text_bytes
from quaver.session import arrow_rows, release_shuffles, remove_path, scratch_path, ship, unused

WIDTH = 13
#: Runs of a level that are merged into one of the next.
FANOUT = 2
#: Parts of the doc_id range that query() ingests one after the other.
BATCHES = 4
#: Text bytes that one shard serves, and the least number of shards.
SHARD_BYTES, LEAST_SHARDS = 32 << 20, 32

#: Fingerprints in one row of a run, documents in one Arrow batch, and text bytes hashed at once:
#: small, so that an executor never holds a whole run's shard in several copies.
PIECE, ARROW_ROWS = 1 << 14, 1000
SLICE = 1 << 20
#: No dictionaries over the blobs, small row groups; compression is for the places of hits.
WRITE = {"compression": "zstd", "parquet.enable.dictionary": "false", "parquet.block.size": str(4 << 20)}

DEALT = "shard int, docs binary, hashes binary, checks binary, places binary"
SETTINGS = "shards long, width long, fanout long, levels array<int>"
FOUND = "kind int, doc_id long, mark long, shard int, blob binary"


def pack(values: np.ndarray) -> bytes:
    """Sorted fingerprints or rising positions as zstd over the byte planes of their differences."""
    step = np.diff(values, prepend=values.dtype.type(0))
    planes = step.view(np.uint8).reshape(len(step), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    step = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(step, dtype=kind)


def pack_head(ids: np.ndarray, marks: np.ndarray, counts: np.ndarray) -> bytes:
    """Documents of some windows: rising ids and the numbers of their windows as differences, the marks as they are."""
    a = pack(ids.view(np.uint64))
    return len(ids).to_bytes(4, "little") + len(a).to_bytes(4, "little") + a + marks.tobytes() + pack(counts.astype(np.uint32))


def unpack_head(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, size = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
    at = 8 + size
    return unpack(blob[8:at], np.uint64).view(np.int64), np.frombuffer(blob, np.uint32, n, at), unpack(blob[at + 4 * n :], np.uint32)


def pack_run(h: np.ndarray, check: np.ndarray) -> bytes:
    """Check bits, two bytes each after their number, and the sorted fingerprints."""
    return len(h).to_bytes(4, "little") + check.tobytes() + pack(h)


def unpack_run(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    return unpack(blob[4 + 2 * n :], np.uint64), np.frombuffer(blob, np.uint16, n, 4)


def checks(words: Words, width: int) -> np.ndarray:
    """Check bits of each run of `width` words."""
    return (rolled(words.hashes(1), width, 0x9FB21C651E98DF25) >> np.uint64(48)).astype(np.uint16)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(shards)).astype(np.uint32)


def _deal(shards: int, width: int):
    """Windows of a slice of documents by shard: (doc_id, mark, count) rows, fingerprints and word positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            data, offsets = text_bytes(batch.column("text"))
            words = Words(data, offsets)
            at = words.windows(width)
            if not len(at):
                continue
            raw = data.tobytes()
            marks = np.array([xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in pairwise(offsets.tolist())], np.uint64).astype(np.uint32)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            h, check = rolled(words.hashes(), width)[at], checks(words, width)[at]
            doc = words.doc[at]
            place = (at - words.first[doc]).astype(np.uint32)
            shard = shard_of(h, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0))
            rows: list[tuple[int, bytes, bytes, bytes, bytes]] = []
            for a, b in pairwise([*cuts.tolist(), len(order)]):
                own = order[a:b]
                starts = np.flatnonzero(np.append(True, np.diff(doc[own]) != 0))
                some = doc[own][starts]
                head = pack_head(ids[some], marks[some], np.diff(np.append(starts, b - a)))
                rows.append((int(shard[own[0]]), head, h[own].tobytes(), check[own].tobytes(), pack(place[own])))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], names=["shard", "docs", "hashes", "checks", "places"])

    return run


def _blobs(column: pa.ChunkedArray) -> list[bytes]:
    return [x.as_buffer().to_pybytes() for x in column]


def _run_rows(shard: int, h: np.ndarray, check: np.ndarray) -> pa.Table:
    blobs = [pack_run(h[a : a + PIECE], check[a : a + PIECE]) for a in range(0, len(h), PIECE)]
    n = len(blobs)
    return pa.table({"kind": pa.array([1] * n, pa.int32()), "doc_id": pa.nulls(n, pa.int64()), "mark": pa.nulls(n, pa.int64()), "shard": pa.array([shard] * n, pa.int32()), "blob": pa.array(blobs, pa.binary())})


def _held(known: np.ndarray, check: np.ndarray, run: np.ndarray, run_check: np.ndarray) -> np.ndarray:
    """Which (fingerprint, check bits) the run has; equal fingerprints may differ in the check bits."""
    out = np.zeros(len(known), bool)
    ask, at = np.arange(len(known)), np.searchsorted(run, known)
    while len(ask):
        inside = at < len(run)
        ask, at = ask[inside], at[inside]
        same = run[at] == known[ask]
        ask, at = ask[same], at[same]
        right = run_check[at] == check[ask]
        out[ask[right]] = True
        ask, at = ask[~right], at[~right] + 1
    return out


def _merge(new: pa.Table, runs: pa.Table) -> pa.Table:
    """One shard: the words that earlier windows cover (kind 0) and the fingerprints that are new (kind 1)."""
    if not new.num_rows:
        return _run_rows(0, np.zeros(0, np.uint64), np.zeros(0, np.uint16))
    shard = new.column("shard")[0].as_py()
    ids, marks, counts = map(np.concatenate, zip(*map(unpack_head, _blobs(new.column("docs"))), strict=True))
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in _blobs(new.column("hashes"))])
    check = np.concatenate([np.frombuffer(x, np.uint16) for x in _blobs(new.column("checks"))])
    place = np.concatenate([unpack(x, np.uint32) for x in _blobs(new.column("places"))])
    group = np.repeat(np.arange(len(ids)), counts)
    doc = ids[group]
    order = np.lexsort((doc, check, h))
    sorted_h, sorted_check = h[order], check[order]
    fresh = np.append(True, (sorted_h[1:] != sorted_h[:-1]) | (sorted_check[1:] != sorted_check[:-1]))
    starts = np.flatnonzero(fresh)
    known, known_check = sorted_h[starts], sorted_check[starts]
    old = np.zeros(len(known), bool)
    for blob in _blobs(runs.column("blob")):
        run, run_check = unpack_run(blob)
        a, b = np.searchsorted(known, run[0]), np.searchsorted(known, run[-1], "right")
        old[a:b] |= _held(known[a:b], known_check[a:b], run, run_check)
    which = np.cumsum(fresh) - 1
    del sorted_h, sorted_check, fresh
    hit = np.empty(len(h), bool)
    hit[order] = old[which] | (doc[order] > doc[order][starts][which])
    at = np.flatnonzero(hit)
    out = [_run_rows(shard, known[~old], known_check[~old])]
    if len(at):
        cuts = np.flatnonzero(np.append(True, np.diff(group[at]) != 0))
        some = group[at][cuts]
        ends = np.append(cuts, len(at)).astype(np.int32) * 4
        blobs = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(place[at].tobytes())])
        n = len(cuts)
        out.append(pa.table({"kind": pa.array(np.zeros(n, np.int32)), "doc_id": pa.array(ids[some]), "mark": pa.array(marks[some].astype(np.int64)), "shard": pa.nulls(n, pa.int32()), "blob": blobs}))
    return pa.concat_tables(out)


def _compact(runs: pa.Table) -> pa.Table:
    h, check = map(np.concatenate, zip(*map(unpack_run, _blobs(runs.column("blob"))), strict=True))
    order = np.argsort(h, kind="stable")
    return _run_rows(runs.column("shard")[0].as_py(), h[order], check[order])


def _covered(starts: np.ndarray, n_words: int, width: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n_words), -1)
    return np.cumsum(change[:-1]) > 0


def _remove(width: int, hits: str, made_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, n_words, n_removed = [], [], []
            for text, blobs in zip(batch.column("text").to_pylist(), batch.column(hits), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if blobs.is_valid and len(blobs):
                    starts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in blobs.values]).astype(np.int64)
                    gone = _covered(np.unique(starts), len(words), width)
                    words = list(compress(words, (~gone).tolist()))
                n_removed.append(n_words[-1] - len(words))
                texts.append(b" ".join(words))
            names = [c for c in batch.schema.names if c not in ("text", hits)]
            made = [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], names=[*names, *made_names])

    return run


class SubstringIndex:
    """The runs of past batches, and the batches' removals."""

    def __init__(self, spark, shards: int = LEAST_SHARDS, width: int = WIDTH, fanout: int = FANOUT) -> None:
        ship(spark)
        self.spark, self.shards, self.width, self.fanout = spark, shards, width, fanout
        self.runs: list[DataFrame] = []
        self.levels: list[int] = []
        self.paths: list[str | None] = []  # None: a folder of save()

    def ingest(self, docs: DataFrame) -> DataFrame:
        """(doc_id, mark, blob): starts of the windows of docs that an earlier document has; adds a run."""
        self.compact()
        path = scratch_path(self.spark, "windows")
        with arrow_rows(self.spark, ARROW_ROWS):
            self._merged(docs).write.partitionBy("kind").options(**WRITE).parquet(path)
        out = self.spark.read.schema(FOUND).parquet(path)
        self.runs.append(out.where("kind = 1").select("shard", "blob"))
        self.levels.append(0)
        self.paths.append(f"{path}/kind=1")
        release_shuffles(self.spark)
        return out.where("kind = 0").select("doc_id", "mark", "blob")

    def _past(self, last: int | None = None) -> DataFrame:
        """The rows of all runs, or of the last ones."""
        past = self.spark.createDataFrame([], "shard int, blob binary")
        for run in self.runs[-last if last else 0 :]:
            past = past.union(run)
        return past

    def _merged(self, docs: DataFrame) -> DataFrame:
        rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        new = rows.mapInArrow(_deal(self.shards, self.width), DEALT)
        return new.groupBy("shard").cogroup(self._past().groupBy("shard")).applyInArrow(_merge, FOUND)

    def compact(self) -> None:
        """Merge the newest runs while `fanout` of them are of one level."""
        n = self.fanout
        while len(self.runs) >= n and len(set(self.levels[-n:])) == 1:
            path = scratch_path(self.spark, "run")
            self._past(n).groupBy("shard").applyInArrow(_compact, FOUND).select("shard", "blob").write.options(**WRITE).parquet(path)
            level = self.levels[-1] + 1
            self._drop(n)
            release_shuffles(self.spark)
            self.runs.append(self.spark.read.schema("shard int, blob binary").parquet(path))
            self.levels.append(level)
            self.paths.append(path)

    def _drop(self, n: int) -> None:
        for old in self.paths[len(self.paths) - n :]:
            if old:
                remove_path(self.spark, old)
        keep = len(self.runs) - n
        self.runs, self.levels, self.paths = self.runs[:keep], self.levels[:keep], self.paths[:keep]

    def drop(self) -> None:
        """Remove the runs, but not those of a saved index; what ingest() returned stays."""
        self._drop(len(self.runs))

    def remove(self, docs: DataFrame, hits: DataFrame) -> DataFrame:
        """The other columns of docs with kept_text, n_words and n_removed; kept words are joined by one space."""
        mark, hit_id, hit_mark, blobs = (unused(c, docs.columns) for c in ("mark", "hit_id", "hit_mark", "hits"))
        found = hits.groupBy(F.col("doc_id").alias(hit_id), F.col("mark").alias(hit_mark)).agg(F.collect_list("blob").alias(blobs))
        keyed = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF)))
        joined = keyed.join(found, (F.col("doc_id").cast("long") == F.col(hit_id)) & (F.col(mark) == F.col(hit_mark)), "left")
        fields = [f for f in docs.schema.fields if f.name != "text"]
        names = [unused(c, [f.name for f in fields]) for c in ("kept_text", "n_words", "n_removed")]
        schema = T.StructType([*fields, *(T.StructField(c, kind) for c, kind in zip(names, (T.StringType(), T.LongType(), T.LongType()), strict=True))])
        return joined.select(*[F.col(f"`{c}`") for c in docs.columns], blobs).mapInArrow(_remove(self.width, blobs, names), schema)

    def save(self, path: str) -> None:
        """Write the runs and settings to a new folder; it is complete once its settings are there."""
        for k, run in enumerate(self.runs):
            run.write.options(**WRITE).parquet(f"{path}/run-{k}")
        self.spark.createDataFrame([(self.shards, self.width, self.fanout, self.levels)], SETTINGS).coalesce(1).write.json(f"{path}/settings")

    @classmethod
    def load(cls, spark, path: str) -> SubstringIndex:
        """The index that save() wrote; its folder is only read."""
        found = spark.read.schema(SETTINGS).json(f"{path}/settings").first()
        index = cls(spark, found.shards, found.width, found.fanout)
        index.levels = list(found.levels)
        index.runs = [spark.read.schema("shard int, blob binary").parquet(f"{path}/run-{k}") for k in range(len(index.levels))]
        index.paths = [None] * len(index.runs)
        return index


def dedup_substrings(docs: DataFrame, batches: int = BATCHES, width: int = WIDTH, shards: int | None = None) -> DataFrame:
    """All of docs, ingested in `batches` parts of the doc_id range by an index that goes afterwards: see SubstringIndex.remove."""
    spark = docs.sparkSession
    least = F.percentile_approx("doc_id", [k / batches for k in range(1, batches)] or [1.0], 1000)
    cuts, size = docs.agg(least, F.sum(F.octet_length("text"))).first()
    if shards is None:
        shards = max(LEAST_SHARDS, (size or 0) // SHARD_BYTES)
    cuts = cuts if batches > 1 else []
    cuts = sorted(set(cuts or []))
    index = SubstringIndex(spark, shards, width)
    hits = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = docs
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        found = index.ingest(part)
        hits = found if hits is None else hits.union(found)
    index.drop()
    return index.remove(docs, hits)


def query(docs: DataFrame) -> DataFrame:
    """The digest columns of op4 for every document."""
    kept = dedup_substrings(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
