"""Object inventories: canonicalization, coverage, comparison, run verification, packing and plans."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.operators.ranks import numbered
from quaver.session import unused

KEY = ["bucket", "key"]
META = ["size", "etag"]
MAGIC = b"QUAVPK01"


def canonicalize(records: DataFrame, fail: bool = True) -> DataFrame:
    """One row per (bucket, key): identical repeats collapse, conflicting ones fail (or are flagged)."""
    digest = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in META]), 256)
    rows = records.withColumn("digest", digest).groupBy(*KEY).agg(*[F.min(c).alias(c) for c in META], F.count("*").alias("copies"), (F.min("digest") != F.max("digest")).alias("conflict"))
    if not fail:
        return rows
    bad = F.raise_error(F.concat(F.lit("conflicting records for "), F.col("bucket"), F.lit("/"), F.col("key").cast("string")))
    return rows.where(F.when(F.col("conflict"), bad.cast("boolean")).otherwise(F.lit(True))).drop("conflict")


def ingest_stats(records: DataFrame, order: str = "position") -> DataFrame:
    """Rows, unique keys, identical repeats, and repeats that differ from the key's first record."""
    first = F.min_by(F.struct(*META), F.col(order)).over(W.partitionBy(*KEY))
    rank = F.row_number().over(W.partitionBy(*KEY).orderBy(order))
    rows = records.select(rank.alias("rank"), (first == F.struct(*META)).alias("same"))
    return rows.agg(
        F.count("*").alias("source_rows"),
        F.count_if(F.col("rank") == 1).alias("unique_keys"),
        F.count_if((F.col("rank") > 1) & F.col("same")).alias("identical"),
        F.count_if((F.col("rank") > 1) & ~F.col("same")).alias("conflicting"),
    )


def bucket_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("bucket").agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))


def classify(expected: DataFrame, covered: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Every key of either table with its class: matched, mismatched, missing or extra; one full outer join."""
    key = key or KEY
    a = expected.select(*key, *[F.col(c).alias(f"old_{c}") for c in META], F.lit(True).alias("in_old"))
    b = covered.select(*key, *[F.col(c).alias(f"new_{c}") for c in META], F.lit(True).alias("in_new"))
    same = F.lit(True)
    for c in META:
        same = same & F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    kind = F.when(F.col("in_new").isNull(), "missing").when(F.col("in_old").isNull(), "extra").when(same, "matched").otherwise("mismatched")
    return a.join(b, key, "full").withColumn("class", kind).drop("in_old", "in_new")


def coverage_report(expected: DataFrame, covered: DataFrame) -> DataFrame:
    """One row: counts by class, and COMPLETE only if everything expected is matched."""
    n = lambda x: F.count_if(F.col("class") == x)
    rows = classify(expected, covered).agg(F.count_if(F.col("class") != "extra").alias("expected"), *[n(x).alias(x) for x in ("matched", "missing", "mismatched", "extra")])
    return rows.withColumn("state", F.when((F.col("expected") == F.col("matched")) & (F.col("extra") == 0), "COMPLETE").otherwise("INCOMPLETE"))


def compare_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts and byte sums per class of two inventories."""
    names = F.create_map(*[F.lit(x) for x in ("matched", "identical", "mismatched", "changed", "missing", "old_only", "extra", "new_only")])
    rows = classify(old, new).groupBy("class").agg(F.count("*").alias("objects"), F.coalesce(F.sum("old_size"), F.lit(0)).alias("old_bytes"), F.coalesce(F.sum("new_size"), F.lit(0)).alias("new_bytes"))
    return rows.select(names[F.col("class")].alias("class"), "objects", "old_bytes", "new_bytes")


def compare_samples(old: DataFrame, new: DataFrame, most: int = 20) -> DataFrame:
    """The first keys of each differing class, in key order."""
    rows = classify(old, new).where("class != 'matched'")
    return rows.withColumn("place", F.row_number().over(W.partitionBy("class").orderBy(*KEY))).where(F.col("place") <= most).select("class", *KEY)


def ledger_difference(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Ids that only one side has, with multiplicity; no rows mean equal ledgers."""
    a = declared.exceptAll(actual).withColumn("side", F.lit("declared"))
    return a.unionAll(actual.exceptAll(declared).withColumn("side", F.lit("actual")))


def ledger_intersection(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Ids that both sides have, each once."""
    return declared.intersect(actual)


def package_overlap(packages: DataFrame) -> DataFrame:
    """(item_id, shard_id, owner): items of more than one shard, for each shard but the smallest."""
    owner = packages.groupBy("item_id").agg(F.min("shard_id").alias("owner"), F.max("shard_id").alias("last")).where("owner != last")
    return packages.join(owner.select("item_id", "owner"), "item_id").where("shard_id != owner").distinct()


def run_verification(packages: DataFrame, markers: DataFrame, shards: int) -> DataFrame:
    """One row: expected, completed, missing and unexpected shards, overlapping shards, unique items, verdict."""
    spark = packages.sparkSession
    want = spark.range(shards).select(F.col("id").cast("int").alias("shard_id"), F.lit(1).alias("want"))
    have = markers.where("state = 'COMPLETE'").select("shard_id").distinct().withColumn("have", F.lit(1))
    sides = want.join(have, "shard_id", "full").agg(
        F.count("want").alias("expected"),
        F.count_if(F.col("want").isNotNull() & F.col("have").isNotNull()).alias("completed"),
        F.count_if(F.col("have").isNull()).alias("missing"),
        F.count_if(F.col("want").isNull()).alias("unexpected"),
    )
    overlaps = package_overlap(packages).agg(F.count_distinct("shard_id").alias("overlapping_shards"))
    items = packages.agg(F.count_distinct("item_id").alias("unique_items"))
    one = sides.crossJoin(overlaps).crossJoin(items)  # one row each
    done = (F.col("missing") == 0) & (F.col("unexpected") == 0) & (F.col("overlapping_shards") == 0)
    return one.withColumn("state", F.when(done, "COMPLETE").otherwise("INCOMPLETE"))


def allow_list_paths(lines: DataFrame, column: str = "value") -> DataFrame:
    """Normalized paths of an allow list: no leading ./, data/ becomes mid/, a .mid suffix."""
    path = F.regexp_replace(F.trim(F.col(column)), r"^(\./)+", "")
    path = F.regexp_replace(F.regexp_replace(path, "^data/", "mid/"), r"\.[A-Za-z0-9]+$", ".mid")
    return lines.select(path.alias("path")).where("path != ''").distinct()


def deletion_batches(records: DataFrame, size: int = 1000) -> DataFrame:
    """Records with the number of their batch within the bucket, in key order; a bucket of any size is ranked in ranges."""
    place = unused("place", records.columns)
    return numbered(records, ["key"], ("bucket",), place).withColumn("batch", F.floor(F.col(place) / size).cast("bigint")).drop(place)


def chunk_plan(objects: DataFrame, chunk: int) -> DataFrame:
    """Byte ranges of every object; the last one is short, and an empty object has none."""
    n = F.ceil(F.col("size") / chunk).cast("bigint")
    rows = objects.where("size > 0").withColumn("chunk_index", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    start = F.col("chunk_index") * chunk
    return rows.select(*KEY, "chunk_index", start.alias("start"), F.least(start + chunk, "size").alias("end"))


def first_missing_chunk(plan: DataFrame, receipts: DataFrame) -> DataFrame:
    """Where each unfinished object resumes: its smallest planned chunk without a receipt."""
    return plan.join(receipts.select(*KEY, "chunk_index").distinct(), [*KEY, "chunk_index"], "left_anti").groupBy(*KEY).agg(F.min("chunk_index").alias("resume_at"))


def frame_size(object_id: Column, size: Column) -> Column:
    """Bytes of a framed object: a length, a JSON header and the payload."""
    header = F.concat(F.lit('{"object_id":"'), object_id, F.lit('","size":'), size.cast("string"), F.lit("}"))
    return F.octet_length(header) + 4 + size


def next_fit_packs(records: DataFrame, pack_bytes: int, small_bytes: int, max_records: int = 10_000, group: str = "worker") -> DataFrame:
    """(group, pack_index, position, object_id, size): greedy packs of small objects in id order.

    A pack closes when the next frame would pass the byte or the record limit. The rule is a
    sequential fold, so each worker's records (its hash share) stream through one task in
    order; memory does not grow with them. Larger objects, and those whose frame is larger than
    a pack, belong to the direct lane.
    """
    small = records.withColumn("frame", frame_size(F.col("object_id"), F.col("size"))).where((F.col("size") <= small_bytes) & (F.col("frame") + len(MAGIC) <= pack_bytes))
    dealt = small.select(group, "object_id", F.col("size").cast("long").alias("size"), F.col("frame").cast("long").alias("frame")).repartition(group).sortWithinPartitions(group, "object_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, pack, used, count = None, 0, len(MAGIC), 0
        for batch in batches:
            packs, places = [], []
            for g, frame in zip(batch[group].tolist(), batch["frame"].tolist(), strict=True):
                if g != owner:
                    owner, pack, used, count = g, 0, len(MAGIC), 0
                if count and (used + frame > pack_bytes or count >= max_records):
                    pack, used, count = pack + 1, len(MAGIC), 0
                packs.append(pack)
                places.append(count)
                used += frame
                count += 1
            yield batch[[group, "object_id", "size"]].assign(pack_index=packs, position=places)

    kind = dict(records.dtypes)[group]
    return dealt.mapInPandas(run, f"{group} {kind}, object_id string, size long, pack_index long, position long")


def large_lane(records: DataFrame, pack_bytes: int, small_bytes: int) -> DataFrame:
    """What no pack takes: large objects and small ones whose frame does not fit."""
    frame = frame_size(F.col("object_id"), F.col("size"))
    return records.where((F.col("size") > small_bytes) | (frame + len(MAGIC) > pack_bytes))


def write_frames(objects: DataFrame, group: str = "pack_index") -> DataFrame:
    """(group, pack binary): magic, then length, JSON header and payload of every (object_id, payload) in order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [MAGIC]
        for oid, payload in pdf.sort_values("position")[["object_id", "payload"]].itertuples(index=False):
            header = json.dumps({"object_id": oid, "size": len(payload)}, sort_keys=True, separators=(",", ":")).encode()
            parts += [len(header).to_bytes(4, "big"), header, payload]
        return pd.DataFrame({group: [pdf[group].iloc[0]], "pack": [b"".join(parts)]})

    kind = dict(objects.dtypes)[group]
    return objects.groupBy(group).applyInPandas(run, f"{group} {kind}, pack binary")


def read_frames(packs: DataFrame, group: str = "pack_index") -> DataFrame:
    """(group, position, object_id, payload) of framed packs; a damaged pack is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for g, pack in batch[[group, "pack"]].itertuples(index=False):
                if not pack.startswith(MAGIC):
                    raise ValueError("not a pack")
                at, k = len(MAGIC), 0
                while at < len(pack):
                    n = int.from_bytes(pack[at : at + 4], "big")
                    header = json.loads(pack[at + 4 : at + 4 + n])
                    at += 4 + n
                    rows.append((g, k, header["object_id"], pack[at : at + header["size"]]))
                    at, k = at + header["size"], k + 1
                    if at > len(pack):
                        raise ValueError("a pack ends early")
            yield pd.DataFrame(rows, columns=[group, "position", "object_id", "payload"])

    kind = dict(packs.dtypes)[group]
    return packs.mapInPandas(run, f"{group} {kind}, position long, object_id string, payload binary")
