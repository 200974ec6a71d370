"""Incremental forms: shard-at-a-time dedupe, idempotent batches, and event-time extensions.

The event-time windows and the gap sessions have no counterpart among the batch operators; they are
extensions for live event tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quaver.operators.dedupe import first_owner

INDEX = "canonical_hash string, kept_stream_id string, kept_shard_id int, occurrence_count long"


def consolidate(index: DataFrame, shard: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the shard with status and owner, the index with the shard's hashes): one step of a run.

    The index is (canonical_hash, kept_stream_id, kept_shard_id, occurrence_count). Computed from its inputs only, so a
    step that is repeated after a failure gives the same rows.
    """
    own = first_owner(shard).withColumnRenamed("occurrence_count", "here")
    known = index.select("canonical_hash", F.col("kept_stream_id").alias("old_stream"), F.col("kept_shard_id").alias("old_shard"))
    rows = own.join(known, "canonical_hash", "left").select(
        "stream_id",
        "shard_id",
        "canonical_hash",
        F.when(F.col("old_stream").isNotNull(), "DUPLICATE").otherwise(F.col("status")).alias("status"),
        F.coalesce("old_stream", "kept_stream_id").alias("kept_stream_id"),
        F.coalesce("old_shard", "kept_shard_id").alias("kept_shard_id"),
    )
    new = own.groupBy("canonical_hash").agg(F.min("kept_stream_id").alias("kept_stream_id"), F.min("kept_shard_id").alias("kept_shard_id"), F.max("here").alias("occurrence_count"))
    both = index.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    after = both.groupBy("canonical_hash").agg(F.min_by(F.struct("kept_stream_id", "kept_shard_id"), "age").alias("k"), F.sum("occurrence_count").alias("occurrence_count"))
    return rows, after.select("canonical_hash", "k.kept_stream_id", "k.kept_shard_id", "occurrence_count")


def idempotent(write: Callable[[DataFrame, int], None], folder: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that skips batches whose marker is there, and marks a batch once it is written."""

    def run(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch-{batch}.done")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            write(df, batch)
            fs.create(path, True).close()

    return run


def event_windows(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Counts and sums per tumbling or sliding window and type; late rows are dropped after the watermark."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def event_sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Sessions per user that end after a gap without events."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("session_start"), "n")


def first_seen(items: DataFrame, late: str = "30 days") -> DataFrame:
    """The stream of items with the first of each hash within the watermark."""
    return items.withWatermark("ts", late).dropDuplicatesWithinWatermark(["canonical_hash"])


def fault_alarms(samples: DataFrame, strikes: int = 3, cooldown: int = 5) -> DataFrame:
    """(source, at, state): ALARM after `strikes` bad samples in a row, then quiet for `cooldown` samples.

    Samples are a stream of (source, at, ok); the state per source is (bad in a row, quiet left).
    """
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bad, quiet = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values("at")
        out = []
        for at, ok in rows[["at", "ok"]].itertuples(index=False):
            bad, quiet = (0 if ok else bad + 1), max(0, quiet - 1)
            if bad >= strikes and not quiet:
                out.append((key[0], at, "ALARM"))
                bad, quiet = 0, cooldown
        state.update((bad, quiet))
        yield pd.DataFrame(out, columns=["source", "at", "state"])

    return samples.groupBy("source").applyInPandasWithState(run, "source string, at long, state string", "bad int, quiet int", "append", GroupStateTimeout.NoTimeout)


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INDEX)
