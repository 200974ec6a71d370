"""Track inventory, timing, candidate filters, realtime stripping and pedal flattening of event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TRACK = ["file", "track_index"]
COUNTERS = ("cc64_rendered", "cc66_rendered", "cc67_discarded", "cc121_resets_consumed", "realtime_discarded", "zero_duration_dropped", "end_of_track_noteoffs")


def is_note_on():
    return (F.col("kind") == "note_on") & (F.col("data2") > 0)


def track_inventory(events: DataFrame) -> DataFrame:
    """Name, programs, channels, drums (channel 9), notes and end tick of every track, in one aggregation."""
    named = F.when(F.col("kind") == "meta_03", F.decode("payload", "UTF-8"))
    return events.groupBy(*TRACK).agg(
        F.min_by(named, F.when(F.col("kind") == "meta_03", F.col("seq"))).alias("track_name"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == "program_change", F.col("data1")))).alias("programs"),
        F.array_sort(F.collect_set("channel")).alias("channels"),
        F.coalesce(F.bool_or(F.col("channel") == 9), F.lit(False)).alias("is_drum"),
        F.bool_or(is_note_on()).alias("has_notes"),
        F.max("tick").alias("end_tick"),
    )


def source_timing(events: DataFrame) -> DataFrame:
    """Tempo and meter changes of every file with their absolute ticks, in time order."""
    number = lambda a, n: F.conv(F.hex(F.substring("payload", a, n)), 16, 10).cast("bigint")
    tempo = F.when(F.col("kind") == "meta_51", F.array(F.col("tick"), number(1, 3)))
    meter = F.when(F.col("kind") == "meta_58", F.array(F.col("tick"), number(1, 1), F.pow(F.lit(2), number(2, 1)).cast("bigint")))
    return events.groupBy("file").agg(F.array_sort(F.collect_list(tempo)).alias("tempos"), F.array_sort(F.collect_list(meter)).alias("meters"), F.max("tpq").alias("tpq"))


def candidate_tracks(inventory: DataFrame) -> DataFrame:
    return inventory.where("has_notes and not is_drum")


def strip_realtime(events: DataFrame) -> DataFrame:
    """Events without realtime messages, as deltas: elapsed time moves to the next kept event, or a new end of track.

    Expects (file, track_index, seq, delta, kind, ...).
    """
    w = W.partitionBy(*TRACK).orderBy("seq")
    timed = events.withColumn("tick", F.sum("delta").over(w)).withColumn("last_tick", F.sum("delta").over(W.partitionBy(*TRACK)))
    kept = timed.where("kind != 'realtime'")
    back = W.partitionBy(*TRACK).orderBy(F.desc("seq"))
    marked = kept.withColumn("delta", F.col("tick") - F.coalesce(F.lag("tick").over(w), F.lit(0))).withColumn("final", F.row_number().over(back) == 1)
    ended = marked.withColumn("delta", F.when(F.col("final") & (F.col("kind") == "end_of_track"), F.col("delta") + F.col("last_tick") - F.col("tick")).otherwise(F.col("delta")))
    extra = marked.where(F.col("final") & (F.col("kind") != "end_of_track") & (F.col("last_tick") > F.col("tick")))
    names = [c for c in events.columns if c not in ("delta", "kind", "seq", *TRACK)]
    tail = extra.select(*TRACK, (F.col("seq") + 1).alias("seq"), (F.col("last_tick") - F.col("tick")).alias("delta"), F.lit("end_of_track").alias("kind"), *[F.lit(None).cast(dict(events.dtypes)[c]).alias(c) for c in names])
    return ended.select(*TRACK, "seq", "delta", "kind", *names).unionByName(tail)


def _paired(rows: DataFrame) -> DataFrame:
    """on_seq: the beginning that a release ends, null for a stray one; zero: beginning and end at one tick.

    Of equal notes the last begun ends first. A release is stray where fewer notes were begun than
    ended: there the running sum of beginnings less releases has a new minimum below zero. All
    others stand, like their beginnings, at a height over that minimum, where they take turns.
    """
    off = F.col("kind").isin("note_on", "note_off") & ~F.col("is_on")
    key = W.partitionBy(*TRACK, "channel", "data1").orderBy("seq")
    rows = rows.withColumn("is_off", off).withColumn("sum", F.sum(F.when(F.col("is_on"), 1).when(F.col("is_off"), -1).otherwise(0)).over(key))
    floor = F.least(F.lit(0), F.min("sum").over(key.rowsBetween(W.unboundedPreceding, W.currentRow)))
    before = F.least(F.lit(0), F.coalesce(F.min("sum").over(key.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("stray", F.col("is_off") & (F.col("sum") < before)).withColumn("height", F.col("sum") - floor + F.col("is_off").cast("int"))
    turn = W.partitionBy(*TRACK, "channel", "data1", F.when(F.col("is_on") | (F.col("is_off") & ~F.col("stray")), F.col("height"))).orderBy("seq")
    ends = F.col("is_off") & ~F.col("stray")
    return rows.withColumns(
        {
            "on_seq": F.when(ends, F.lag("seq").over(turn)),
            "zero": F.coalesce(F.when(ends, F.lag("tick").over(turn)).when(F.col("is_on"), F.lead("tick").over(turn)) == F.col("tick"), F.lit(False)),
        }
    )


def _let_go(rows: DataFrame) -> DataFrame:
    """(end_seq, end_tick): the event at which a paired release is let go, both null if none does.

    A release is held while the sustain pedal is down, or while the sostenuto pedal is down and has caught the
    note: it was pressed while the key was, and was neither lifted nor reset (by controller 121)
    since the release. So it goes at the first event from its own on at which sustain is up, unless
    sostenuto holds it there: then at the first such event from the next lift of sostenuto on.
    """
    number = F.when(F.col("kind") == "control_change", F.col("data1"))
    down = F.col("data2") >= 64
    reset = number == 121
    channel = W.partitionBy(*TRACK, "channel").orderBy("seq")
    now, past, ahead = (channel.rowsBetween(*x) for x in ((W.unboundedPreceding, 0), (W.unboundedPreceding, -1), (1, W.unboundedFollowing)))
    latest = lambda x, w: F.coalesce(F.last(x, True).over(w), F.lit(False))
    following = lambda when, *what: F.first(F.when(when, F.struct(*what)), True).over(ahead)
    rows = rows.withColumns({"sustain_set": F.when(reset, False).when(number == 64, down), "sostenuto_set": F.when(reset, False).when(number == 66, down)})
    rows = rows.withColumns({"sustain": latest("sustain_set", now), "sostenuto": latest("sostenuto_set", now), "sostenuto_before": latest("sostenuto_set", past)})
    rows = rows.withColumns(
        {
            "pressed": F.col("sostenuto_set") & ~F.col("sostenuto_before"),
            "lifted": F.coalesce(reset | (~F.col("sostenuto_set") & F.col("sostenuto_before")), F.lit(False)),
            "upped": ~F.col("sustain_set"),
        }
    )
    rows = rows.withColumn("up", F.when(~F.col("sustain"), F.struct("seq", "tick")).otherwise(following(F.col("upped"), "seq", "tick")))
    rows = rows.withColumns(
        {
            "lifts": F.count_if("lifted").over(now),
            "after_lift": following(F.col("lifted"), F.col("up.seq").alias("seq"), F.col("up.tick").alias("tick")),
            "caught": F.coalesce(F.last(F.when(F.col("pressed"), F.col("seq")), True).over(past) > F.greatest("on_seq", F.last(F.when(reset, F.col("seq")), True).over(past)), F.lit(False)),
        }
    )
    state = ("seq", "tick", "sostenuto", "lifts", "after_lift")
    rows = rows.withColumn("first_up", F.when(~F.col("sustain"), F.struct(*state)).otherwise(following(F.col("upped"), *state)))
    free = ~F.col("sustain") & ~(F.col("sostenuto") & F.col("caught"))
    blocked = F.col("caught") & F.col("first_up.sostenuto") & (F.col("first_up.lifts") == F.col("lifts"))
    end = lambda c: F.when(free, F.col(c)).when(blocked, F.col(f"first_up.after_lift.{c}")).otherwise(F.col(f"first_up.{c}"))
    return rows.withColumns({"end_seq": end("seq"), "end_tick": end("tick")})


def flatten_pedals(events: DataFrame) -> DataFrame:
    """Event rows with the pedals rendered into note lengths, and the track's counters on every row.

    Pedal, reset and realtime events go, as do notes that end at the tick they began. Releases move
    to where no pedal holds them any more, or to the track's last tick, before its end. Windows over one exchange by track; a
    track is bounded by its file. Expects (file, track_index, seq, tick, kind, channel, data1, data2).
    """
    rows = events.select(*TRACK, "seq", "tick", "kind", "channel", "data1", "data2").repartition(*TRACK)
    rows = rows.withColumn("is_on", F.coalesce((F.col("kind") == "note_on") & (F.col("data2") > 0), F.lit(False)))
    rows = _let_go(_paired(rows))
    whole = W.partitionBy(*TRACK)
    ended, ending = F.col("on_seq").isNotNull() & ~F.col("zero"), F.col("kind") == "end_of_track"
    control = lambda *n: (F.col("kind") == "control_change") & F.col("data1").isin(*n)
    counted = (control(64), control(66), control(67), control(121), F.col("kind") == "realtime", F.col("on_seq").isNotNull() & F.col("zero"), ended & F.col("end_seq").isNull())
    late = F.lit(2**63 - 1)
    rows = rows.withColumns(
        {
            **{name: F.count_if(what).over(whole) for name, what in zip(COUNTERS, counted, strict=True)},
            "last_tick": F.max("tick").over(whole),
            "last_end": F.max(F.when(ending, F.col("seq"))).over(whole),
        }
    )
    rows = rows.where(~F.coalesce(control(64, 66, 67, 121), F.lit(False)) & (F.col("kind") != "realtime") & ~F.col("zero") & (~ending | (F.col("seq") == F.col("last_end"))))
    rows = rows.withColumns(
        {
            "place": F.when(ending, late).when(ended, F.coalesce("end_seq", late - 1)).otherwise(F.col("seq")),
            "tick": F.when(ending, F.col("last_tick")).when(ended, F.coalesce("end_tick", "last_tick")).otherwise(F.col("tick")),
        }
    )
    order = W.partitionBy(*TRACK).orderBy("tick", "place", "seq")
    return rows.select(*TRACK, (F.row_number().over(order) - 1).cast("long").alias("seq"), "tick", "kind", "channel", "data1", "data2", *COUNTERS)


def conversion_receipts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(file, track_index, source_sha256, output_sha256, counters): what flattening did to each track."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("tick", "kind", "channel", "data1", "data2")])
    digest = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n"), 256)
    a = before.groupBy(*TRACK).agg(digest.alias("source_sha256"))
    b = after.groupBy(*TRACK).agg(digest.alias("output_sha256"), *[F.max(c).alias(c) for c in COUNTERS])
    return a.join(b, TRACK, "left")
