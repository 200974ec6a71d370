"""Length caps, percentiles and histograms; windows, padding and numbering of training blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.operators.controls import nearest_rank
from quaver.operators.ranks import numbered

CAPS = (64, 96, 128, 160, 192, 224, 256)
PERCENTS = (50, 75, 90, 95, 99)
COVERAGE = 0.99


def length_percentiles(bars: DataFrame, column: str = "length") -> DataFrame:
    """One row: the nearest-rank percentiles and the largest; nulls for no bars."""
    return bars.agg(*[nearest_rank(column, p / 100).cast("bigint").alias(f"p{p}") for p in PERCENTS], F.max(column).cast("bigint").alias("max"))


def cap_profile(bars: DataFrame, caps: tuple[int, ...] = CAPS) -> DataFrame:
    """Per cap: how many bars and whole streams fit, and the padding if all did.

    Bars are (stream_id, length). The bars are summed up once per stream, for all caps at
    once; only the few caps multiply the final row. An empty input gives zero ratios.
    """
    fits = [F.count_if(F.col("length") <= c).alias(f"fit{c}") for c in caps]
    per_stream = bars.groupBy("stream_id").agg(F.count("*").alias("bars"), F.max("length").alias("longest"), F.sum("length").alias("tokens"), *fits)
    total = per_stream.agg(
        F.coalesce(F.sum("bars"), F.lit(0)).alias("bars_total"),
        F.count("*").alias("whole_streams_total"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        *[F.coalesce(F.sum(f"fit{c}"), F.lit(0)).alias(f"bars{c}") for c in caps],
        *[F.count_if(F.col("longest") <= c).alias(f"streams{c}") for c in caps],
    )
    rows = total.select("bars_total", "whole_streams_total", "tokens", F.inline(F.array(*[F.struct(F.lit(c).alias("cap"), F.col(f"bars{c}").alias("bars_fit"), F.col(f"streams{c}").alias("whole_streams_fit")) for c in caps])))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    bars_total, streams = F.col("bars_total"), F.col("whole_streams_total")
    return rows.select(
        "cap",
        "bars_fit",
        "bars_total",
        "whole_streams_fit",
        "whole_streams_total",
        (bars_total - F.col("bars_fit")).alias("overflow_bars"),
        (streams - F.col("whole_streams_fit")).alias("overflow_streams"),
        ratio(F.col("bars_fit"), bars_total).alias("bar_coverage"),
        ratio(F.col("whole_streams_fit"), streams).alias("stream_coverage"),
        ratio(F.col("cap") * bars_total - F.col("tokens"), F.col("cap") * bars_total).alias("pad_ratio"),
    )


def cap_choice(bars: DataFrame, caps: tuple[int, ...] = CAPS) -> DataFrame:
    """The smallest cap that covers 99 % of bars and of streams, else the best by stream, then bar coverage, then size."""
    enough = (F.col("bar_coverage") >= COVERAGE) & (F.col("stream_coverage") >= COVERAGE)
    best = F.max_by("cap", F.struct("stream_coverage", "bar_coverage", -F.col("cap")))
    return cap_profile(bars, caps).agg(F.coalesce(F.min(F.when(enough, F.col("cap"))), best).alias("selected_cap"), F.coalesce(F.bool_or(enough), F.lit(False)).alias("covered"))


def label_breakdown(bars: DataFrame, labels: tuple[str, ...], caps: tuple[int, ...] = CAPS) -> DataFrame:
    """Coverage per cap and label; labels without streams appear with zeros. Bars are (stream_id, label, length)."""
    streams = bars.groupBy("label", "stream_id").agg(F.count("*").alias("bars"), F.max("length").alias("longest"), *[F.count_if(F.col("length") <= c).alias(f"fit{c}") for c in caps])
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("cap"), F.col(f"fit{c}").alias("fit"), (F.col("longest") <= c).cast("int").alias("whole")) for c in caps]))
    sums = streams.select("label", "bars", cells).groupBy("cap", "label").agg(F.count("*").alias("streams"), F.sum("bars").alias("bars"), F.sum("fit").alias("bars_fit"), F.sum("whole").alias("whole_streams_fit"))
    every = bars.sparkSession.createDataFrame([(c, x) for c in caps for x in labels], "cap int, label string")
    out = every.join(sums, ["cap", "label"], "left").fillna(0)
    return out.withColumn("bar_coverage", F.when(F.col("bars") > 0, F.col("bars_fit") / F.col("bars")).otherwise(0.0)).withColumn("stream_coverage", F.when(F.col("streams") > 0, F.col("whole_streams_fit") / F.col("streams")).otherwise(0.0))


def length_histogram(bars: DataFrame) -> DataFrame:
    """Lengths of the bars after each stream's first."""
    first = F.min("bar_index").over(W.partitionBy("stream_id"))
    return bars.withColumn("first", first).where("bar_index > first").groupBy("length").agg(F.count("*").alias("n"))


def split_counters(bars: DataFrame, windows: DataFrame) -> DataFrame:
    """Streams, bars, tokens and windows per split. Both inputs carry `split`."""
    a = bars.groupBy("split").agg(F.count_distinct("stream_id").alias("streams"), F.count("*").alias("bars"), F.sum("length").alias("tokens"))
    b = windows.groupBy("split").agg(F.count("*").alias("windows"))
    return a.join(b, "split", "left").select("split", "streams", "bars", "tokens", F.coalesce("windows", F.lit(0)).alias("windows"))


def block_windows(bars: DataFrame, size: int = 4, empty_allowed: bool = False) -> DataFrame:
    """Starts of `size` consecutive bars of a stream; without empty bars unless they are allowed."""
    ahead = W.partitionBy("stream_id").orderBy("bar_index").rowsBetween(0, size - 1)
    rows = bars.select("*", F.count("*").over(ahead).alias("n"), F.max(F.col("is_empty").cast("int")).over(ahead).alias("hole"), F.collect_list("length").over(ahead).alias("lengths"))
    kept = rows.where(F.col("n") == size)
    return (kept if empty_allowed else kept.where("hole = 0")).select("stream_id", F.col("bar_index").alias("start_bar"), "lengths")


def number_windows(windows: DataFrame, order: list[str]) -> DataFrame:
    """Windows numbered from 0 in `order`, without one global sort."""
    return numbered(windows, order, name="window_index")


def padded(rows: DataFrame, ids: str, cap: int) -> DataFrame:
    """`ids` filled with zeros up to cap, and the mask of real entries; longer rows are refused."""
    size = F.size(ids)
    fits = F.when(size <= cap, size).otherwise(F.raise_error(F.lit("a block is longer than the cap")).cast("int"))
    return rows.withColumn("mask", F.transform(F.sequence(F.lit(1), F.lit(cap)), lambda i: i <= fits)).withColumn(ids, F.concat(F.col(ids), F.array_repeat(F.lit(0).cast("bigint"), F.lit(cap) - size)))
