"""Receipt reconciliation, exact dedupe with provenance, families and leak-free splits, upserts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.functions.ids import hash_split
from quaver.operators.components import connected_components

ERRORS = ("error_unproven_accept", "error_unknown_cache", "error_missing_hash", "error_hash_mismatch")


def explicit_decision(status: Column) -> Column:
    """ACCEPT or REJECT as a receipt says it; anything else is no decision."""
    return F.when(status.isin("ACCEPT", "REJECT"), status)


def outcome(receipt: Column, cached: Column, event_hash: Column, item_hash: Column) -> Column:
    """The reconciliation decision table as one column."""
    return (
        F.when((receipt == "REJECT") & F.coalesce(cached == "ACCEPT", F.lit(False)), "reclassified_reject")
        .when(receipt == "REJECT", "explicit_reject")
        .when(receipt.isNull() & (cached == "REJECT"), "legacy_reject")
        .when(receipt.isNull() & (cached == "ACCEPT"), ERRORS[0])
        .when(receipt.isNull(), "skipped")
        .when(cached.isNotNull() & ~cached.isin("ACCEPT", "REJECT"), ERRORS[1])
        .when(event_hash.isNull(), ERRORS[2])
        .when(item_hash.isNotNull() & (item_hash != event_hash), ERRORS[3])
        .otherwise("accepted")
    )


def reconcile(items: DataFrame) -> DataFrame:
    """Items (receipt_status, cached_status, event_hash, canonical_hash, ...) with their outcome."""
    status = explicit_decision(F.col("receipt_status"))
    return items.withColumn("outcome", outcome(status, F.col("cached_status"), F.col("event_hash"), F.col("canonical_hash")))


def reconciliation_counts(items: DataFrame) -> DataFrame:
    """Counters of a shard; an explicit reject that was accepted before counts in both reject columns."""
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    return reconcile(items).groupBy("shard_id").agg(
        n("accepted").alias("accepted"),
        n("explicit_reject", "reclassified_reject").alias("explicit_rejects"),
        n("reclassified_reject").alias("reclassified_rejects"),
        n("legacy_reject").alias("legacy_rejects"),
        n("skipped").alias("skipped"),
        n(*ERRORS).alias("errors"),
    )


def fail_closed(items: DataFrame) -> DataFrame:
    """Accepted items; an item in error fails the job."""
    bad = F.raise_error(F.concat(F.lit("invalid accepted receipt: "), F.col("stream_id")))
    checked = reconcile(items).withColumn("outcome", F.when(F.col("outcome").isin(*ERRORS), bad.cast("string")).otherwise(F.col("outcome")))
    return checked.where("outcome = 'accepted'").drop("outcome")


def first_owner(items: DataFrame) -> DataFrame:
    """UNIQUE or DUPLICATE per item; the owner of a hash is the first in (shard, stream) order.

    The owner and the count are combined map-side, and the join back exchanges both sides, so
    that AQE may split a hash that very many items share.
    """
    owners = items.groupBy("canonical_hash").agg(F.min(F.struct("shard_id", "stream_id")).alias("kept"), F.count("*").alias("occurrence_count"))
    joined = items.join(owners, "canonical_hash")
    return joined.select(
        "stream_id",
        "shard_id",
        "canonical_hash",
        F.when((F.col("kept.shard_id") == F.col("shard_id")) & (F.col("kept.stream_id") == F.col("stream_id")), "UNIQUE").otherwise("DUPLICATE").alias("status"),
        F.col("kept.stream_id").alias("kept_stream_id"),
        F.col("kept.shard_id").alias("kept_shard_id"),
        "occurrence_count",
    )


def occurrence_counts(items: DataFrame) -> DataFrame:
    owners = items.groupBy("canonical_hash").agg(F.min(F.struct("shard_id", "stream_id")).alias("kept"), F.count("*").alias("occurrence_count"))
    return owners.select("canonical_hash", F.col("kept.stream_id").alias("kept_stream_id"), F.col("kept.shard_id").alias("kept_shard_id"), "occurrence_count")


def winners(items: DataFrame, order: tuple[str, ...] = ("dataset_id", "stream_id")) -> DataFrame:
    """One item per hash: the smallest in the given order."""
    return items.groupBy("canonical_hash").agg(F.min(F.struct(*order)).alias("m")).select("canonical_hash", *[F.col(f"m.{c}").alias(c) for c in order])


def provenance_edges(items: DataFrame) -> DataFrame:
    """Every item and the item that stands for its hash."""
    kept = winners(items).select("canonical_hash", F.col("stream_id").alias("kept_stream_id"))
    return items.select("stream_id", "dataset_id", "canonical_hash").join(kept, "canonical_hash")


def families(items: DataFrame) -> DataFrame:
    """(piece_id, root, family_id): pieces that share a hash, directly or through others.

    Each hash links its pieces to its smallest piece: a star, so the links are as many as the
    (piece, hash) pairs. The id hashes the sorted members.
    """
    pairs = items.select(F.col("piece_id").cast("string").alias("piece_id"), "canonical_hash").distinct()
    center = pairs.groupBy("canonical_hash").agg(F.min("piece_id").alias("center"))
    roots = connected_components(pairs.join(center, "canonical_hash").select(F.col("piece_id").alias("a"), F.col("center").alias("b")))
    pieces = pairs.select("piece_id").distinct().join(roots.withColumnRenamed("id", "piece_id"), "piece_id", "left").select("piece_id", F.coalesce("root", "piece_id").alias("root"))
    dealt = pieces.repartition("root").sortWithinPartitions("root", "piece_id")
    ids = dealt.mapInPandas(_family_ids, "root string, family_id string")
    return pieces.join(ids, "root").select("piece_id", "root", "family_id")


def _family_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The id of each family from its members as they come, in order; none is held."""
    now, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for root, piece in batch[["root", "piece_id"]].itertuples(index=False):
            if root != now:
                if now is not None:
                    done.append((now, "family_" + digest.hexdigest()[:24]))
                now, digest = root, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield pd.DataFrame(done, columns=["root", "family_id"])
    if now is not None:
        yield pd.DataFrame([(now, "family_" + digest.hexdigest()[:24])], columns=["root", "family_id"])


def family_split(items: DataFrame) -> DataFrame:
    """(piece_id, family_id, split): a family is never divided."""
    return families(items).withColumn("split", hash_split(F.col("family_id"))).select("piece_id", "family_id", "split")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str, last_wins: bool = True) -> DataFrame:
    """One row per key of both tables: the last by `order` (replace), or the first (ignore)."""
    rows = old.unionByName(new)
    pick = F.max_by if last_wins else F.min_by
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(pick(F.struct(*rest), F.col(order)).alias("row")).select(*key, *[F.col(f"row.{c}").alias(c) for c in rest])


def partial_upsert(old: DataFrame, new: DataFrame, key: list[str], updated: list[str]) -> DataFrame:
    """Rows of old, with the `updated` columns from new where it has the key, and the keys only new has."""
    rest = [c for c in old.columns if c not in key]
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, key, "full")
    return joined.select(*key, *[(F.coalesce(f"b.{c}", f"a.{c}") if c in updated else F.coalesce(f"a.{c}", f"b.{c}")).alias(c) for c in rest])


def replace_streams(old: DataFrame, new: DataFrame, key: str = "stream_id") -> DataFrame:
    """Rows of old, but for streams that new has: all of their rows go, and new's come."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*old.columns))


def sibling_tracks(tracks: DataFrame) -> DataFrame:
    """Candidate tracks (no drums, with notes) and the other tracks of their piece, in track order."""
    every = F.array_sort(F.collect_list(F.struct("track_index", "track_id")).over(W.partitionBy("piece_id")))
    others = F.filter(F.transform(every, lambda x: x["track_id"]), lambda t: t != F.col("track_id"))
    return tracks.withColumn("siblings", others).where("not is_drum and has_notes").select("piece_id", "track_id", "siblings")
