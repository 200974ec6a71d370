"""The bar controls: rhythm, pitch, articulation and tonality measures per bar.

Everything works on two relations: the notes that begin in a bar, in the order (onset, pitch,
velocity), and its distinct onsets with the median pitch of each. Both are clustered by bar, so
that the windows and aggregations of a control share one exchange. Two definitions are
kept as the feature contract has them although they look odd: `tonic_pc` is the least
frequent pitch class (ties: the larger), and articulation pairs the k-th note's duration with
the k-th gap between onsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.operators.canonical import bar_grid
from quaver.operators.projection import live_bars
from quaver.operators.sweep import polyphony, voices

BAR = ["stream_id", "bar_index"]
CONTROLS = (
    "rhythmic_density polyphony occupancy articulation time_signature key_tonal_center pitch_trend contour_reversal "
    "interval_magnitude register pitch_span note_duration_tendency microtiming_grid_rigidity pitch_class_diversity lifecycle"
).split()


def nearest_rank(column: str, q: float):
    """The value at rank ceil(q * n): an element of the group, null for none."""
    return F.expr(f"percentile_disc({q}) within group (order by {column})")


def local_notes(notes: DataFrame) -> DataFrame:
    """Notes in the bar of their onset, dealt by bar, with their rank in it."""
    placed = notes.withColumn("bar_index", F.expr("onset_tick div bar_ticks")).repartition(*BAR)
    order = W.partitionBy(*BAR).orderBy("onset_tick", "pitch", "velocity", "note_index")
    return placed.withColumn("rank", F.row_number().over(order))


def onsets(notes: DataFrame) -> DataFrame:
    """Distinct onsets of a bar with the median pitch of each, and the next onset's."""
    groups = local_notes(notes).groupBy(*BAR, "onset_tick").agg(F.median("pitch").alias("reduced"), F.max("bar_ticks").alias("bar_ticks"), F.max("beats").alias("beats"))
    order = W.partitionBy(*BAR).orderBy("onset_tick")
    return groups.select(
        *BAR,
        "onset_tick",
        "reduced",
        "bar_ticks",
        "beats",
        F.row_number().over(order).alias("rank"),
        (F.lead("onset_tick").over(order) - F.col("onset_tick")).alias("ioi"),
        (F.lead("reduced").over(order) - F.col("reduced")).alias("step"),
    )


def rhythmic_density(notes: DataFrame) -> DataFrame:
    some = onsets(notes).groupBy(*BAR).agg(F.count("*").alias("n"))
    return bar_grid(notes).join(some, BAR, "left").select(*BAR, F.when(F.col("beats") > 0, F.coalesce("n", F.lit(0)) / F.col("beats")).otherwise(0.0).alias("rhythmic_density"))


def pitch_class_counts(notes: DataFrame) -> DataFrame:
    return local_notes(notes).groupBy(*BAR, (F.col("pitch") % 12).alias("pc")).agg(F.count("*").alias("n"))


def pitch_entropy(notes: DataFrame) -> DataFrame:
    """Distinct pitch classes and their Shannon entropy in bits, per bar with an onset."""
    share = F.col("n") / F.sum("n").over(W.partitionBy(*BAR))
    return pitch_class_counts(notes).select(*BAR, share.alias("p")).groupBy(*BAR).agg(F.count("*").alias("unique_count"), (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))


def tonal_center(notes: DataFrame) -> DataFrame:
    """tonic_pc by contract, the modal pitch class, and the margin of the two largest counts."""
    ranked = pitch_class_counts(notes).withColumn("place", F.row_number().over(W.partitionBy(*BAR).orderBy(F.desc("n"), F.desc("pc"))))
    top, second = (F.max(F.when(F.col("place") == k, F.col("n"))) for k in (1, 2))
    return ranked.groupBy(*BAR).agg(
        F.max(F.struct(-F.col("n"), F.col("pc").alias("pc")))["pc"].alias("tonic_pc"),
        F.max(F.when(F.col("place") == 1, F.col("pc"))).alias("modal_pc"),
        ((top - second) / F.sum("n")).alias("score_margin"),
        F.sum("n").alias("evidence_count"),
    )


def pitch_trend(notes: DataFrame) -> DataFrame:
    """Theil-Sen slope over distinct onsets, and last minus first reduced pitch.

    Slopes are taken within an array of one bar's onsets: a bar's onsets are bounded by its ticks.
    """
    points = onsets(notes).groupBy(*BAR).agg(F.array_sort(F.collect_list(F.struct(F.col("onset_tick").alias("x"), F.col("reduced").alias("y")))).alias("p"))
    slopes = F.flatten(F.transform("p", lambda a, i: F.transform(F.slice("p", i + 2, F.greatest(F.size("p") - i - 1, F.lit(0))), lambda b: (b["y"] - a["y"]) / (b["x"] - a["x"]))))
    middle = F.expr("case when size(s) % 2 = 1 then s[size(s) div 2] else (s[size(s) div 2 - 1] + s[size(s) div 2]) / 2 end")
    return (
        points.where(F.size("p") > 1)
        .select(*BAR, F.array_sort(slopes).alias("s"), (F.element_at("p", -1)["y"] - F.element_at("p", 1)["y"]).alias("first_last"))
        .select(*BAR, middle.alias("theil_sen"), "first_last")
    )


def contour_reversals(notes: DataFrame) -> DataFrame:
    """Share of direction changes among moves; steps on the spot do not count."""
    moves = onsets(notes).select(*BAR, "rank", F.signum("step").alias("d")).where("d != 0")
    next_d = F.lead("d").over(W.partitionBy(*BAR).orderBy("rank"))
    turns = moves.select(*BAR, F.when(next_d != F.col("d"), 1).otherwise(0).alias("turn"))
    some = turns.groupBy(*BAR).agg((F.sum("turn") / F.greatest(F.lit(1), F.count("*") - 1)).alias("r"))
    return bar_grid(notes).join(some, BAR, "left").select(*BAR, F.coalesce("r", F.lit(0.0)).alias("contour_reversal"))


def interval_magnitude(notes: DataFrame) -> DataFrame:
    steps = onsets(notes).select(*BAR, F.abs("step").alias("size")).where("size is not null")
    return steps.groupBy(*BAR).agg(F.median("size").alias("median_abs_interval"), nearest_rank("size", 0.9).alias("p90_abs_interval"))


def pitch_span(notes: DataFrame) -> DataFrame:
    return local_notes(notes).groupBy(*BAR).agg(
        F.median("pitch").alias("median_pitch"),
        (nearest_rank("pitch", 0.9) - nearest_rank("pitch", 0.1)).cast("double").alias("p90_p10"),
        (F.max("pitch") - F.min("pitch")).cast("bigint").alias("absolute"),
    )


def duration_tendency(notes: DataFrame) -> DataFrame:
    return local_notes(notes).groupBy(*BAR).agg(
        nearest_rank("duration_ticks", 0.25).cast("double").alias("p25"),
        F.median("duration_ticks").alias("median"),
        nearest_rank("duration_ticks", 0.75).cast("double").alias("p75"),
    )


def grid_rigidity(notes: DataFrame) -> DataFrame:
    """Share of onsets on the beat grid; the resolution rounds half to even."""
    step = F.greatest(F.lit(1), F.expr("cast(bround(bar_ticks / beats) as bigint)"))
    residual = (F.col("onset_tick") % F.col("bar_ticks")) % step
    return onsets(notes).groupBy(*BAR).agg(
        F.avg(F.when(residual == 0, 1.0).otherwise(0.0)).alias("exact_grid_fraction"),
        F.sum(residual).alias("residual_sum"),
        F.max(F.greatest(F.lit(1), F.expr("cast(bround(bar_ticks / greatest(1, beats)) as bigint)"))).alias("declared_resolution_ticks"),
    )


def articulation(notes: DataFrame) -> DataFrame:
    """Median of the k-th note's duration over the k-th gap between onsets."""
    gaps = onsets(notes).select(*BAR, "rank", "ioi").where("ioi > 0")
    ratio = local_notes(notes).select(*BAR, "rank", "duration_ticks").join(gaps, [*BAR, "rank"])
    return ratio.groupBy(*BAR).agg(F.median(F.col("duration_ticks") / F.col("ioi")).alias("median_duration_to_next_onset"))


def overlap_pairs(notes: DataFrame) -> DataFrame:
    """Unordered pairs of a bar's own notes that sound together.

    In onset order the pairs of a note are the later notes that begin before it ends: a running
    count of begun notes gives them without joining the notes with each other.
    """
    own = local_notes(notes).select(*BAR, F.col("onset_tick").alias("a"), (F.col("onset_tick") + F.col("duration_ticks")).alias("b")).where("b > a")
    marks = own.select(*BAR, F.inline(F.array(F.struct(F.col("b").alias("t"), F.lit(0).alias("begun"), F.lit(1).alias("ended")), F.struct(F.col("a").alias("t"), F.lit(1).alias("begun"), F.lit(0).alias("ended")))))
    # at a tick the ends stand before the beginnings, so that touching notes do not overlap
    order = W.partitionBy(*BAR).orderBy("t", F.desc("ended")).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = marks.select(*BAR, "begun", (F.sum("begun").over(order) - F.sum("ended").over(order)).alias("sounding"))
    return counted.where("begun = 1").groupBy(*BAR).agg(F.sum(F.col("sounding") - 1).alias("overlap_count"))


def time_signature(notes: DataFrame) -> DataFrame:
    """The meter of every stream: its notes' numerator and denominator, or else quarters to a bar."""
    has = {"numerator", "denominator"} <= set(notes.columns)
    numerator, denominator = (F.col("numerator"), F.col("denominator")) if has else (F.col("beats"), F.lit(4))
    return notes.groupBy("stream_id").agg(F.max(numerator.cast("int")).alias("numerator"), F.max(denominator.cast("int")).alias("denominator"))


def bar_controls(notes: DataFrame) -> DataFrame:
    """The controls of every bar side by side, with its lifecycle fields; each part is clustered by bar already."""
    out = live_bars(notes).select(*BAR, "source_position", "source_bar_count", "segment_id", "segment_position")
    poly = polyphony(notes).withColumnRenamed("occupied", "occupancy")
    parts = [rhythmic_density, contour_reversals, pitch_entropy, tonal_center, pitch_trend, interval_magnitude, pitch_span, duration_tendency, grid_rigidity, articulation, overlap_pairs]
    for part in [poly, voices(notes), *(f(notes) for f in parts)]:
        out = out.join(part, BAR, "left")
    out = out.fillna(0, ["max_voices", "occupancy", "polyphonic_fraction", "time_weighted_voices", "overlap_count"])
    # the register's second candidate is the plain median too, as the feature contract has it
    return out.join(time_signature(notes), "stream_id").withColumns({"duration_weighted_median_candidate": F.col("median_pitch"), "mode": F.lit("UNKNOWN")})
