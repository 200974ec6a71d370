"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within the radius r meet when each emits every variant of itself within r / 2:
some variant is common to both. Emitting whole 64-bit balls costs 2,081 variants at r = 4, so
the ball is taken where it is small: the fingerprint is cut in BLOCKS blocks, and of two
fingerprints within r bits some block holds at least ceil(r / BLOCKS) of the differing bits.
Without that block at most r - ceil(r / BLOCKS) bits differ, and balls of half that radius meet
(132 variants at r = 4 and three blocks). Variants are shuffled, sorted, and colliding
fingerprints verified on all 64 bits. A bucket holds distinct fingerprints only, so its size is
bounded by the dropped block; buckets of more than CROWD members are not compared pairwise:
their members emit whole-fingerprint balls, where all that share a variant are linked without
verification, so that neighbours in sorted order give the links.

Edge cases: a null text has no words; texts without words have fingerprint zero and link like
any other; texts under SHINGLE words are one shingle; repeated rows share a fingerprint; a null
doc_id gets the smallest other id of its component (null if there is none); an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaver.llm.textvec import slices
from quaver.operators.components import connected_components
from quaver.session import discard, materialize, ship, unused

SHINGLE, SEED = 4, 42
RADIUS, BLOCKS = 4, 3
#: Largest bucket that is compared pair by pair within a task.
CROWD = 1024
LINKS = "a long, b long"


def fingerprint(text: str | None) -> int:
    """The signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return int.from_bytes(xxhash.xxh64_digest(joined, SEED), "big", signed=True)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, digest = (end - size)[: 1 - SHINGLE], xxhash.xxh64_digest
    n, counts = len(start), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        some = zip(start[at : at + (1 << 16)].tolist(), end[at + SHINGLE - 1 : at + SHINGLE - 1 + (1 << 16)].tolist(), strict=False)
        h = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in some]), np.uint8)
        counts += np.unpackbits(h.reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def text_mark():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, fp) for every row; the mark tells texts of one doc_id apart."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = [fingerprint(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(fp, pa.int64())], names=["doc_id", "mark", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_mark().alias("mark")).mapInArrow(run, "doc_id long, mark long, fp long")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _flips(bits: list[int], radius: int) -> list[int]:
    return [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(bits, r)]


def projections(radius: int, blocks: int) -> list[tuple[int, int]]:
    """(bits kept, bits flipped and tagged) of every variant: variant = fp & kept ^ flipped."""
    if blocks <= 1:
        return [(_signed(2**64 - 1), _signed(x)) for x in _flips(list(range(64)), math.ceil(radius / 2))]
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    reach = math.ceil((radius - math.ceil(radius / blocks)) / 2)
    out = []
    for k in range(blocks):
        dropped = sum(1 << b for b in range(cuts[k], cuts[k + 1]))
        bits = [b for b in range(64) if not dropped >> b & 1]
        tag = 1 << cuts[k]  # in the dropped bits: keeps the projections apart
        out += [(_signed((2**64 - 1) ^ dropped), _signed(x | tag)) for x in _flips(bits, reach)]
    return out


def variants(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(key, fp): every variant of every fingerprint, dealt by key and sorted by (key, fp)."""
    shapes = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(x).cast("long").alias("x")) for k, x in projections(radius, blocks)])
    key = F.transform(shapes, lambda s: F.col("fp").bitwiseAND(s["k"]).bitwiseXOR(s["x"]))
    return fps.select(F.explode(key).alias("key"), "fp").repartition("key").sortWithinPartitions("key", "fp")


def _forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one bucket."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    left, out = np.ones(len(fp), bool), []
    for root in range(len(fp)):
        if not left[root]:
            continue
        left[root] = False
        todo = [root]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & left).tolist():
                left[j] = False
                out.append((i, j))
                todo.append(j)
    return out


def _bucket_links(radius: int, crowd: int):
    """Links within the sorted buckets of a partition; a member of a crowded bucket is marked by a link to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        crowded = None  # the key of a bucket that has already outgrown the limit

        def settle(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(starts, len(key)))
            two = starts[sizes == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
            a, b = [fp[two]], [fp[two + 1]]
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                some = fp[s : s + n]
                if n > crowd or key[s] == crowded:
                    a.append(some)
                    b.append(some)
                elif pairs := np.array(_forest(some, radius), np.int64).reshape(-1, 2).T.tolist():
                    a.append(some[pairs[0]])
                    b.append(some[pairs[1]])
            for s, n in zip(starts[sizes <= 2].tolist(), sizes[sizes <= 2].tolist(), strict=True) if crowded is not None else ():
                if key[s] == crowded:
                    a.append(fp[s : s + n])
                    b.append(fp[s : s + n])
            x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            if len(x):
                pairs = np.unique(np.column_stack([np.minimum(x, y), np.maximum(x, y)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(key) < 1 << 17:
                continue
            cut = int(np.searchsorted(key, key[-1], "left"))  # the last bucket may go on
            if len(key) - cut > crowd or key[-1] == crowded:
                yield from settle(key, fp)
                crowded, cut = int(key[-1]), len(key)
            elif cut:
                yield from settle(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
        if len(key):
            yield from settle(key, fp)

    return run


def _chain_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of neighbours that share a whole-fingerprint variant."""
    last: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for batch in batches:
        key = np.concatenate([last[0], batch.column("key").to_numpy(zero_copy_only=False)])
        fp = np.concatenate([last[1], batch.column("fp").to_numpy(zero_copy_only=False)])
        at = np.flatnonzero(key[1:] == key[:-1])
        if len(at):
            pairs = np.unique(np.column_stack([fp[at], fp[at + 1]]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        last = (key[-1:], fp[-1:])


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """(a, b): verified links between distinct fingerprints that join whatever is linked within the radius."""
    found = materialize(variants(fps, radius, blocks).mapInArrow(_bucket_links(radius, crowd), LINKS), "links")
    dense = materialize(found.where("a = b").select(F.col("a").alias("fp")).distinct(), "crowded")
    out = found.where("a != b")
    if not dense.isEmpty():
        # even radius: two balls of half of it meet exactly within the radius
        if radius % 2:
            raise ValueError("crowded buckets need an even radius")
        out = out.union(variants(dense, radius, 1).mapInArrow(_chain_links, LINKS))
    return out.distinct()


def grouped_rows(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """(doc_id, mark, fp, root, component_id) for every row; the root, a fingerprint, tells components of one component_id apart."""
    rows = materialize(fingerprints(docs), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = materialize(connected_components(links(fps.select("fp"), radius, blocks, crowd)).select(F.col("id").alias("fp"), "root"), "roots")
    least = materialize(roots.join(fps, "fp").groupBy("root").agg(F.min("first").alias("component_id")), "least")
    grouped = roots.join(least, "root").select("fp", "root", "component_id")
    named = materialize(fps.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id")), "named")
    for old in (fps, roots, least):
        discard(old)
    return rows.join(named, "fp", "left").select("doc_id", "mark", "fp", "root", "component_id")


def components(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    return grouped_rows(docs, **options).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, the one of the smallest doc_id; rows without doc_id stay.

    Rows that share a doc_id are told apart by their texts: those of different components may all
    stay, and of a component that has several texts of its smallest doc_id one stays. Repeated
    rows of the kept document leave one of them. The columns of docs are returned.
    """
    mark, kept_id, kept_mark = (unused(c, docs.columns) for c in ("mark", "kept_id", "kept_mark"))
    first = F.min(F.struct("fp", "mark"))["mark"].alias(kept_mark)
    kept = grouped_rows(docs, **options).where("doc_id = component_id").groupBy("root", F.col("doc_id").alias(kept_id)).agg(first).drop("root")
    marked = docs.where("doc_id is not null").withColumn(mark, text_mark())
    same = (F.col("doc_id").cast("long") == F.col(kept_id)) & (F.col(mark) == F.col(kept_mark))
    with_id = marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", mark])
    return with_id.drop(mark).union(docs.where("doc_id is null"))


def query(docs: DataFrame) -> DataFrame:
    """The columns of op1 for every document."""
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
