"""Source registry decisions, storage guard, progress and estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def classify_sources(sources: DataFrame, completed: DataFrame) -> DataFrame:
    """Disposition and reason of every source: done ones are skipped, only automated, allowed raw ones are queued.

    `completed` (dataset_id) is a list of finished sources.
    """
    done = completed.select("dataset_id").distinct().withColumn("done", F.lit(True))
    text = lambda c: F.coalesce(F.col(c), F.lit("None"))
    steps = [
        (F.col("done").isNotNull(), "COMPLETED_SKIP", F.lit("durably completed before this controller")),
        (text("role") != "raw", "GATED", F.concat(F.lit("role="), text("role"), F.lit(" is not a raw training source"))),
        (text("training") != "ALLOWED", "GATED", F.concat(F.lit("training="), text("training"))),
        (text("method").isin("manual_gated", "none"), "GATED", F.concat(F.lit("acquisition method="), text("method"), F.lit(" requires explicit external authority"))),
    ]
    disposition, reason = F.lit("QUEUED"), F.lit("automated raw source with training ALLOWED")
    for condition, name, why in reversed(steps):
        disposition, reason = F.when(condition, name).otherwise(disposition), F.when(condition, why).otherwise(reason)
    joined = sources.join(done, "dataset_id", "left")
    return joined.select("dataset_id", disposition.alias("disposition"), reason.alias("reason"), F.coalesce("estimate", F.lit(0)).cast("bigint").alias("estimate_bytes"))


def run_gate(role: Column, training: Column, method: Column) -> Column:
    """What a build run does with a source."""
    return F.when(role != "raw", "SKIP").when((training != "ALLOWED") | (method == "manual_gated"), "GATED_USER_ACTION_REQUIRED").otherwise("RUN")


def storage_guard(free: Column, estimate: Column, reserve: Column | int, multiplier: float) -> Column:
    """True if the free bytes hold the estimate times the multiplier and the reserve."""
    reserve = reserve if isinstance(reserve, Column) else F.lit(reserve)
    return free >= F.floor(estimate * multiplier).cast("bigint") + reserve


def preflight(sources: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("estimate"), F.lit(0)).cast("bigint")
    return sources.agg(F.count("*").alias("sources"), total.alias("bytes"), (total * 2).alias("bytes_x2"), (total * 3).alias("bytes_x3"))


def progress(items: DataFrame) -> DataFrame:
    """State counts, accepted items, distinct hashes and duplicates, in one pass."""
    accepted, unique = F.count("canonical_hash"), F.count_distinct("canonical_hash")
    return items.agg(
        F.count("*").alias("items"),
        F.count_if(F.col("state") == "COMPLETE").alias("complete"),
        accepted.alias("accepted"),
        (F.count_if(F.col("state") == "COMPLETE") - accepted).alias("rejected"),
        unique.alias("distinct_hashes"),
        F.greatest(F.lit(0), accepted - unique).alias("duplicates"),
    )


def eta(done: Column, total: Column, elapsed: Column) -> Column:
    """Best, likely and worst seconds left; null until 100 items and 60 seconds are there."""
    left = F.greatest(F.lit(0), total - done) / (done / elapsed)
    known = (done >= 100) & (elapsed >= 60)
    return F.when(known, F.struct(F.bround(left * 0.8).cast("bigint").alias("best"), F.bround(left).cast("bigint").alias("likely"), F.bround(left * 1.25).cast("bigint").alias("worst")))


def sample_audit(items: DataFrame, limit: int = 64) -> DataFrame:
    """Accept and reject rates over the first `limit` candidates of every dataset.

    Items are (dataset_id, stream_id, status, reason_codes); a null status is a failed execution.
    """
    place = F.row_number().over(W.partitionBy("dataset_id").orderBy("stream_id"))
    some = items.withColumn("place", place).where(F.col("place") <= limit)
    n = F.count("*")
    accepted, failed = F.count_if(F.col("status") == "ACCEPT"), F.count_if(F.col("status").isNull())
    return some.groupBy("dataset_id").agg(
        n.alias("sample_size"),
        accepted.alias("accepted"),
        (n - accepted - failed).alias("rejected"),
        failed.alias("execution_failures"),
        (accepted / n).alias("accept_rate"),
        ((n - accepted - failed) / n).alias("reject_rate"),
    )


def reason_counts(items: DataFrame, limit: int = 64) -> DataFrame:
    """How many sampled streams of a dataset have each reason code; a code counts once per stream."""
    place = F.row_number().over(W.partitionBy("dataset_id").orderBy("stream_id"))
    some = items.withColumn("place", place).where(F.col("place") <= limit)
    return some.select("dataset_id", F.explode(F.array_distinct("reason_codes")).alias("code")).groupBy("dataset_id", "code").agg(F.count("*").alias("streams"))
