"""Canonical note and bar tables from accepted note events.

Notes carry (stream_id, note_index, onset_tick, duration_ticks, pitch, velocity) and their
stream's meter as (bar_ticks, beats). Bars form a uniform grid per stream, so that every
interval relation between notes and bars is an equi-join on a bar index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

REASONS = "schema meter_count tempo_count first_tick hash duration span".split()


def canonical_notes(notes: DataFrame) -> DataFrame:
    """Notes with their end and their place in the bar grid."""
    end = F.col("onset_tick") + F.col("duration_ticks")
    first = F.expr("onset_tick div bar_ticks")
    last = F.expr("(onset_tick + duration_ticks - 1) div bar_ticks")
    return notes.select(
        "stream_id",
        "note_index",
        "onset_tick",
        "duration_ticks",
        end.alias("end_tick"),
        "pitch",
        "velocity",
        first.alias("onset_bar_index"),
        F.greatest(first, last).alias("end_bar_index"),
        (F.col("onset_tick") % F.col("bar_ticks")).alias("onset_in_bar_tick"),
    )


def stream_spans(notes: DataFrame) -> DataFrame:
    """(stream_id, bar_ticks, beats, n_bars): the span ends with the last note; a stream has a bar at least."""
    return notes.groupBy("stream_id").agg(
        F.max("bar_ticks").alias("bar_ticks"),
        F.max("beats").alias("beats"),
        F.greatest(F.lit(1), F.ceil(F.max(F.col("onset_tick") + F.col("duration_ticks")) / F.max("bar_ticks"))).cast("bigint").alias("n_bars"),
    )


def bar_grid(notes: DataFrame) -> DataFrame:
    """Every bar of every stream."""
    bars = stream_spans(notes).select("stream_id", "bar_ticks", "beats", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_bars") - 1)).alias("bar_index"))
    return bars.select("stream_id", "bar_index", (F.col("bar_index") * F.col("bar_ticks")).alias("start_tick"), ((F.col("bar_index") + 1) * F.col("bar_ticks")).alias("end_tick"), "beats")


def canonical_bars(notes: DataFrame) -> DataFrame:
    """The bar grid with is_empty by difference counts: one row per note and edge, never one per note and bar.

    All steps cluster by stream, so that one exchange of the notes serves them.
    """
    placed = canonical_notes(notes).select("stream_id", F.col("onset_bar_index").alias("a"), (F.col("end_bar_index") + 1).alias("b"))
    edges = placed.select("stream_id", F.inline(F.array(F.struct(F.col("a").alias("bar_index"), F.lit(1).alias("d")), F.struct(F.col("b").alias("bar_index"), F.lit(-1).alias("d")))))
    change = edges.groupBy("stream_id", "bar_index").agg(F.sum("d").alias("d"))
    active = F.sum(F.coalesce("d", F.lit(0))).over(W.partitionBy("stream_id").orderBy("bar_index"))
    return bar_grid(notes).join(change, ["stream_id", "bar_index"], "left").withColumn("is_empty", active == 0).drop("d")


def materialization_gate(receipts: DataFrame) -> DataFrame:
    """Receipts with `reject_reason`, null where the score may be materialized.

    Expects (schema, tempo_count, meter_count, first_tick, event_hash, min_duration, span_end).
    """
    reason = (
        F.when(F.col("schema").isNull() | (F.col("schema") == ""), "schema")
        .when(F.coalesce("tempo_count", F.lit(0)) != 1, "tempo_count")
        .when(F.coalesce("meter_count", F.lit(0)) != 1, "meter_count")
        .when(F.coalesce("first_tick", F.lit(-1)) != 0, "first_tick")
        .when(F.col("event_hash").isNull(), "hash")
        .when(F.coalesce("min_duration", F.lit(0)) <= 0, "duration")
        .when(F.coalesce("span_end", F.lit(0)) < 0, "span")
    )
    return receipts.withColumn("reject_reason", reason)
