"""Live bars, gaps-and-islands segments, represented spans and window eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.operators.canonical import bar_grid, canonical_notes

BAR = ["stream_id", "bar_index"]
SCHEMA = "quaver.live-projection/v1"


def live_bars(notes: DataFrame, schema: str = SCHEMA) -> DataFrame:
    """Every bar with occupancy (by sounding notes), its segment and its position in it.

    A segment is a maximal run of occupied bars; bar_index minus the rank among occupied bars is
    constant in a run. Its id hashes the canonical JSON of the schema name, the stream and the
    run's first and last bar (stream ids are plain names, without quotes or backslashes).
    """
    placed = canonical_notes(notes).where("end_tick > onset_tick")
    sounding = placed.select("stream_id", F.explode(F.sequence("onset_bar_index", "end_bar_index")).alias("bar_index")).distinct().withColumn("occupied", F.lit(True))
    bars = bar_grid(notes).join(sounding, BAR, "left").withColumn("occupied", F.coalesce("occupied", F.lit(False)))
    rank = F.row_number().over(W.partitionBy("stream_id", "occupied").orderBy("bar_index"))
    marked = bars.withColumn("run", F.when(F.col("occupied"), F.col("bar_index") - rank))
    run = W.partitionBy("stream_id", "run")
    first, last = F.min("bar_index").over(run), F.max("bar_index").over(run)
    whole = W.partitionBy("stream_id")
    payload = F.concat(F.lit('{"end_bar_index":'), last.cast("string"), F.lit(f',"schema":"{schema}","start_bar_index":'), first.cast("string"), F.lit(',"stream_id":"'), F.col("stream_id"), F.lit('"}'))
    named = F.concat(F.col("stream_id"), F.lit(":"), F.substring(F.sha2(payload, 256), 1, 24))
    return marked.select(
        *BAR,
        "start_tick",
        "end_tick",
        "occupied",
        F.count("*").over(whole).alias("source_bar_count"),
        ((F.col("bar_index") + 0.5) / F.count("*").over(whole)).alias("source_position"),
        F.when(F.col("occupied"), named).alias("segment_id"),
        F.when(F.col("occupied"), F.col("bar_index") - first).alias("segment_position"),
        F.when(F.col("occupied"), last - first + 1).alias("segment_bars"),
    )


def live_segments(notes: DataFrame) -> DataFrame:
    """One row per segment."""
    return live_bars(notes).where("occupied").groupBy("stream_id", "segment_id").agg(F.min("bar_index").alias("first_bar"), F.max("bar_index").alias("last_bar"), F.count("*").alias("n_bars"))


def number_spans(bars: DataFrame) -> DataFrame:
    """Default span numbers: per stream, in bar order, from 0."""
    return bars.withColumn("span_index", F.row_number().over(W.partitionBy("stream_id").orderBy("bar_index")) - 1)


def bind_spans(spans: DataFrame, bars: DataFrame) -> DataFrame:
    """Spans with the bar they stand for; a span without a bar is an error."""
    joined = spans.join(bars.withColumn("found", F.lit(True)), BAR, "left")
    missing = F.raise_error(F.concat(F.lit("no bar for "), F.col("stream_id"), F.lit(":"), F.col("bar_index").cast("string")))
    # in a filter, so that no projection can prune the check
    return joined.where(F.when(F.col("found"), F.lit(True)).otherwise(missing.cast("boolean"))).drop("found")


def resolve_streamless(spans: DataFrame, bars: DataFrame) -> DataFrame:
    """Spans that name a bar only: matched where exactly one stream has that bar, unmatched otherwise."""
    single = bars.groupBy("bar_index").agg(F.count("*").alias("n"), F.min("stream_id").alias("only")).where("n = 1").select("bar_index", "only")
    return spans.join(single, "bar_index", "left").withColumn("stream_id", F.coalesce("stream_id", "only")).drop("only")


def attach_projection(features: DataFrame, bars: DataFrame) -> DataFrame:
    """Feature rows with their bar's segment; a row without a bar is an error."""
    return bind_spans(features, bars.select(*BAR, "segment_id", "segment_position"))


def eligible_windows(spans: DataFrame, bars: DataFrame, size: int = 4) -> DataFrame:
    """Windows of `size` consecutive spans of a stream, all in one live segment.

    Spans are (stream_id, span_index, bar_index); windows are found per stream.
    """
    if size < 1:
        raise ValueError("a window needs a span")
    live = spans.join(bars.select(*BAR, "segment_id"), BAR, "left")
    w = W.partitionBy("stream_id").orderBy("span_index")
    ahead = w.rowsBetween(0, size - 1)
    rows = live.select(
        "stream_id",
        F.col("span_index").alias("start_span_index"),
        F.collect_list("bar_index").over(ahead).alias("bar_indices"),
        F.count("segment_id").over(ahead).alias("n"),
        F.min("segment_id").over(ahead).alias("segment_id"),
        F.max("segment_id").over(ahead).alias("other"),
    )
    return rows.where((F.col("n") == size) & (F.col("segment_id") == F.col("other"))).select("stream_id", "start_span_index", "segment_id", "bar_indices")
