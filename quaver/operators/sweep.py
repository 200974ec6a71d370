"""Interval algebra of notes over bars: clipping, polyphony sweep, voices, first-generation bar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.operators.canonical import bar_grid

BAR = ["stream_id", "bar_index"]


def clipped(notes: DataFrame, silent: bool = False) -> DataFrame:
    """One row per note and bar it sounds in, with the part [l, r) inside the bar; notes without length only if `silent`."""
    first, last = "onset_tick div bar_ticks", "greatest(onset_tick div bar_ticks, (onset_tick + duration_ticks - 1) div bar_ticks)"
    rows = notes.withColumn("bar_index", F.explode(F.expr(f"sequence({first}, {last})")))
    left = F.greatest("onset_tick", F.col("bar_index") * F.col("bar_ticks"))
    right = F.least(F.col("onset_tick") + F.col("duration_ticks"), (F.col("bar_index") + 1) * F.col("bar_ticks"))
    return rows.select(*BAR, "note_index", "onset_tick", "duration_ticks", "pitch", "velocity", "bar_ticks", left.alias("l"), right.alias("r")).where("true" if silent else "l < r")


def polyphony(notes: DataFrame) -> DataFrame:
    """Per bar with a note: most notes at once, and the fractions of time with one and with two or more.

    Edges at a tick are netted first, so that notes that touch do not overlap. The rows are
    dealt by bar once: the netting and the running sum both use that exchange.
    """
    parts = clipped(notes).select(*BAR, "bar_ticks", "l", "r").repartition(*BAR)
    edges = parts.select(*BAR, "bar_ticks", F.inline(F.array(F.struct(F.col("l").alias("t"), F.lit(1).alias("d")), F.struct(F.col("r").alias("t"), F.lit(-1).alias("d")))))
    net = edges.groupBy(*BAR, "t").agg(F.sum("d").alias("d"), F.max("bar_ticks").alias("bar_ticks"))
    w = W.partitionBy(*BAR).orderBy("t")
    steps = net.select(*BAR, "bar_ticks", F.sum("d").over(w).alias("active"), (F.lead("t").over(w) - F.col("t")).alias("held"))
    held = F.coalesce("held", F.lit(0))
    time = lambda least: F.sum(F.when(F.col("active") >= least, held).otherwise(0)) / F.max("bar_ticks")
    return steps.groupBy(*BAR).agg(F.max("active").cast("bigint").alias("max_voices"), time(1).alias("occupied"), time(2).alias("polyphonic_fraction"))


def voices(notes: DataFrame) -> DataFrame:
    """Per bar with a note: the time-weighted number of voices."""
    return clipped(notes).groupBy(*BAR).agg((F.sum(F.col("r") - F.col("l")) / F.max("bar_ticks")).alias("time_weighted_voices"))


def primitive_features(notes: DataFrame) -> DataFrame:
    """The twelve measures per bar; onset_count repeats note_count, as the feature contract has it.

    One exchange by bar: the sweep over the edges of its notes carries what the other measures need.
    """
    kinds = dict(notes.dtypes)
    part = F.greatest(F.col("r") - F.col("l"), F.lit(0))
    sounds = (part > 0).cast("int")
    here = lambda c: F.when(F.col("l") == F.col("onset_tick"), F.col(c))  # noqa: E731  of notes that begin in the bar
    begin = F.struct(F.col("l").alias("t"), sounds.alias("d"), part.alias("part"), *[here(c).alias(c) for c in ("duration_ticks", "pitch", "velocity")])
    end = F.struct(F.greatest("l", "r").alias("t"), (-sounds).alias("d"), F.lit(0).cast("bigint").alias("part"), *[F.lit(None).cast(kinds[c]).alias(c) for c in ("duration_ticks", "pitch", "velocity")])
    edges = clipped(notes, silent=True).select(*BAR, "bar_ticks", F.inline(F.array(begin, end)))
    # ends come before beginnings at a tick, so that notes that touch do not overlap
    w = W.partitionBy(*BAR).orderBy("t", "d")
    steps = edges.withColumns({"active": F.sum("d").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)), "held": F.coalesce(F.lead("t").over(w) - F.col("t"), F.lit(0))})
    local = steps.groupBy(*BAR).agg(
        F.count("duration_ticks").alias("note_count"),
        F.median("duration_ticks").alias("median_duration"),
        F.median("pitch").alias("median_pitch"),
        (F.max("pitch") - F.min("pitch")).cast("bigint").alias("pitch_range"),
        F.avg("velocity").alias("mean_velocity"),
        F.max("active").cast("bigint").alias("max_voices"),
        (F.sum(F.when(F.col("active") >= 1, F.col("held")).otherwise(0)) / F.max("bar_ticks")).alias("occupied"),
        (F.sum("part") / F.max("bar_ticks")).alias("time_weighted_voices"),
    )
    n = F.coalesce("note_count", F.lit(0))
    zero = F.lit(0.0)
    return (
        bar_grid(notes)
        .join(local, BAR, "left")
        .select(
            *BAR,
            n.alias("note_count"),
            n.alias("onset_count"),
            (n / F.col("beats")).alias("notes_per_beat"),
            (n / F.col("beats")).alias("onsets_per_beat"),
            F.coalesce("time_weighted_voices", zero).alias("mean_polyphony"),
            F.coalesce("max_voices", F.lit(0)).alias("max_polyphony"),
            F.coalesce("occupied", zero).alias("occupied_fraction"),
            (1 - F.coalesce("occupied", zero)).alias("rest_fraction"),
            "median_duration",
            "median_pitch",
            "pitch_range",
            "mean_velocity",
        )
    )
