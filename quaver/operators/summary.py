"""Characterization of controls and comparison of lifecycle label policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaver.operators.controls import CONTROLS
from quaver.operators.ranks import running

NUMERIC = ("rhythmic_density", "occupancy", "contour_reversal")
POLICIES = ("fixed-bar", "fractional-position", "asymmetric", "hybrid")
LABELS = ("START", "CRUISE", "END")


def characterize(rows: DataFrame, numeric: tuple[str, ...] = NUMERIC) -> DataFrame:
    """Per control: present and missing rows, moments, nearest-rank quantiles and status.

    Only scalar controls have numbers; composite controls are present in every row. One pass over the
    rows counts the distinct values of each control; what follows works on these counts, in
    ranges of the values, so that no buffer holds all values of a control.
    """
    long = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("control"), F.col(c).cast("double").alias("v")) for c in numeric])))
    counts = running(long.groupBy("control", "v").agg(F.count("*").alias("n")), "n", ["v"], ("control",))
    known = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)
    stats = counts.groupBy("control").agg(F.sum("n").alias("n"), F.sum(known).alias("present"), (F.sum(F.col("v") * F.col("n")) / F.sum(known)).alias("mean")).hint("broadcast")
    # a row for every control; nulls come first in the order of the values
    joined = counts.join(stats.select("control", F.col("n").alias("all"), "present", "mean"), "control")
    upto = F.col("before") + F.col("n") - (F.col("all") - F.col("present"))
    rank = lambda tenths: F.min(F.when(F.col("v").isNotNull() & (upto * 10 >= F.col("present") * tenths), F.col("v")))
    spread = F.sum(F.pow(F.col("v") - F.col("mean"), 2) * F.col("n")) / F.max("present")
    numbers = joined.groupBy("control").agg(F.max("all").alias("n"), F.max("present").alias("present"), F.max("mean").alias("mean"), F.sqrt(spread).alias("std"), rank(1).alias("p10"), rank(5).alias("p50"), rank(9).alias("p90"))
    total = stats.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    others = total.select(F.explode(F.array(*[F.lit(c) for c in CONTROLS if c not in numeric])).alias("control"), "n", F.col("n").alias("present"))
    every = numbers.unionByName(others, allowMissingColumns=True)
    return every.select("control", "present", (F.col("n") - F.col("present")).alias("missing"), "mean", "std", "p10", "p50", "p90", F.when(F.col("present") > 0, "ACCEPTED_FOR_MODELING").otherwise("DEFERRED").alias("status"))


def control_status(rows: DataFrame) -> DataFrame:
    reason = F.when(F.col("present") > 0, "observed in synthetic or canonical-derived rows").otherwise("no non-missing observations")
    return characterize(rows).select("control", "status", reason.alias("reason"), "present", "missing")


def lifecycle_label(policy: str, index: Column, count: Column, position: Column) -> Column:
    first, last = index == 0, index == count - 1
    ends = {
        "fixed-bar": (first, last),
        "fractional-position": (position < 0.25, position >= 0.75),
        "asymmetric": (position < 0.20, position >= 0.80),
        "hybrid": (first | (position < 0.20), last | (position >= 0.80)),
    }[policy]
    return F.when(ends[0], "START").when(ends[1], "END").otherwise("CRUISE")


def labelled(rows: DataFrame) -> DataFrame:
    """Four rows per bar: its label under each policy."""
    labels = [F.struct(F.lit(p).alias("policy"), lifecycle_label(p, F.col("bar_index"), F.col("source_bar_count"), F.col("source_position")).alias("label")) for p in POLICIES]
    return rows.select("*", F.inline(F.array(*labels)))


def lifecycle_crosstab(rows: DataFrame) -> DataFrame:
    """Counts by policy and label, within each dataset and within each split, in one aggregation.

    Absent labels appear with 0; a missing split is UNASSIGNED.
    """
    named = labelled(rows.withColumn("split", F.coalesce("split", F.lit("UNASSIGNED"))))
    counted = named.groupingSets([["policy"], ["policy", "dataset_id"], ["policy", "split"]], "policy", "dataset_id", "split").agg(
        F.grouping("dataset_id").alias("no_dataset"), F.grouping("split").alias("no_split"), *[F.count_if(F.col("label") == x).alias(x) for x in LABELS]
    )
    scope = F.when(F.col("no_dataset") == 0, "dataset").when(F.col("no_split") == 0, "split").otherwise("all")
    value = F.when(F.col("no_dataset") == 0, F.col("dataset_id")).when(F.col("no_split") == 0, F.col("split")).otherwise("")
    cells = F.inline(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("n")) for x in LABELS]))
    return counted.select("policy", scope.alias("scope"), value.alias("value"), *LABELS).select("policy", "scope", "value", cells)


def lifecycle_means(rows: DataFrame, numeric: tuple[str, ...] = NUMERIC) -> DataFrame:
    """Mean of each scalar control per policy and label."""
    return labelled(rows).groupBy("policy", "label").agg(*[F.avg(c).alias(c) for c in numeric])


def boundary_rows(rows: DataFrame) -> DataFrame:
    """Bars where a segment begins, and the first and last bar of a stream, under each policy."""
    edge = (F.coalesce("segment_position", F.lit(-1)) == 0) | (F.col("bar_index") == 0) | (F.col("bar_index") == F.col("source_bar_count") - 1)
    return labelled(rows.where(edge)).select("policy", "stream_id", "bar_index", "label", "source_position", "segment_position")
