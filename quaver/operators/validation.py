"""Constraint queries over a built view: each gives the rows that break a rule, so none means valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rule(name: str, rows: DataFrame, key) -> DataFrame:
    return rows.select(F.lit(name).alias("rule"), key.cast("string").alias("key"))


def note_violations(notes: DataFrame, bars: DataFrame) -> DataFrame:
    """Canonical notes against themselves and the bars of their stream."""
    key = F.concat_ws(":", "stream_id", "note_index")
    bar_key = F.concat_ws(":", "stream_id", "bar_index")
    last = bars.groupBy("stream_id").agg(F.max("bar_index").alias("last_bar"), F.count("*").alias("n_bars"))
    placed = notes.join(last, "stream_id", "left")
    checks = [
        _rule("note has no length", notes.where("duration_ticks <= 0"), key),
        _rule("end is not onset plus duration", notes.where("end_tick != onset_tick + duration_ticks"), key),
        _rule("bars of a note are reversed", notes.where("end_bar_index < onset_bar_index"), key),
        _rule("pitch out of range", notes.where("pitch not between 0 and 127"), key),
        _rule("velocity out of range", notes.where("velocity not between 1 and 127"), key),
        _rule("note number repeats", notes.groupBy("stream_id", "note_index").count().where("count > 1"), key),
        _rule("stream has no bars", placed.where("last_bar is null"), key),
        _rule("note ends past the last bar", placed.where("end_bar_index > last_bar"), key),
        _rule("bars have gaps", last.where("n_bars != last_bar + 1"), F.col("stream_id")),
        _rule("bar repeats", bars.groupBy("stream_id", "bar_index").count().where("count > 1"), bar_key),
    ]
    return reduce(DataFrame.unionAll, checks)


def split_violations(items: DataFrame, splits: DataFrame) -> DataFrame:
    """Pieces in two splits, pieces without one, and hashes whose pieces are in two splits."""
    joined = items.select(F.col("piece_id").cast("string").alias("piece_id"), "canonical_hash").join(splits, "piece_id", "left")
    two = F.min("split") != F.max("split")
    checks = [
        _rule("piece in two splits", splits.groupBy("piece_id").agg(two.alias("bad")).where("bad"), F.col("piece_id")),
        _rule("piece without a split", joined.where("split is null"), F.col("piece_id")),
        _rule("hash in two splits", joined.groupBy("canonical_hash").agg(two.alias("bad")).where("bad"), F.col("canonical_hash")),
    ]
    return reduce(DataFrame.unionAll, checks)


def dedupe_violations(rows: DataFrame) -> DataFrame:
    """Rows of first_owner(): each hash has one UNIQUE row, its owner, and counts all of its rows."""
    one = rows.groupBy("canonical_hash").agg(F.count_if(F.col("status") == "UNIQUE").alias("unique"), F.count("*").alias("n"), F.max("occurrence_count").alias("declared"))
    checks = [
        _rule("hash without one owner", one.where("unique != 1"), F.col("canonical_hash")),
        _rule("occurrences do not add up", one.where("n != declared"), F.col("canonical_hash")),
        _rule("unique row owned by another", rows.where("status = 'UNIQUE' and stream_id != kept_stream_id"), F.col("stream_id")),
    ]
    return reduce(DataFrame.unionAll, checks)


def record_violations(records: DataFrame, labels: tuple[str, ...], splits: tuple[str, ...] = ("train", "validation", "test"), siblings: int | None = None) -> DataFrame:
    """Candidate records: (stream_id, label, split, status, canonical_hash, reason_codes, sibling_track_ids, receipt_sha256, declared_receipt_sha256)."""
    key = F.col("stream_id")
    missing = lambda c: f"{c} is null or {c} = ''"
    checks = [
        _rule("unknown label", records.where(~F.coalesce(F.col("label").isin(*labels), F.lit(False))), key),
        _rule("unknown split", records.where(~F.coalesce(F.col("split").isin(*splits), F.lit(False))), key),
        _rule("unknown status", records.where("coalesce(status not in ('ACCEPT', 'REJECT'), true)"), key),
        _rule("receipt is not the declared one", records.where("not receipt_sha256 <=> declared_receipt_sha256"), key),
        _rule("accepted without a hash", records.where("status = 'ACCEPT'").where(missing("canonical_hash")), key),
        _rule("rejected without a reason", records.where("status = 'REJECT' and coalesce(size(reason_codes), 0) <= 0"), key),
        _rule("record repeats", records.groupBy("stream_id").count().where("count > 1"), key),
    ]
    if siblings is not None:
        checks.append(_rule("wrong number of siblings", records.where(F.coalesce(F.size("sibling_track_ids"), F.lit(-1)) != siblings), key))
    return reduce(DataFrame.unionAll, checks)


def window_violations(windows: DataFrame, members: DataFrame, cap: int, size: int = 4) -> DataFrame:
    """Packed windows against the cap and their streams' membership: (window_index, stream_id, split, lengths, ids, mask)."""
    key = F.col("window_index")
    padding = F.exists(F.arrays_zip("ids", "mask"), lambda x: ~x["mask"] & (x["ids"] != 0))
    real = F.size(F.filter("mask", lambda m: m))
    numbers = windows.agg(F.count("*").alias("n"), F.count_distinct("window_index").alias("distinct"), F.min("window_index").alias("least"), F.max("window_index").alias("most"))
    named = windows.join(members.select("stream_id", F.col("split").alias("member_split")), "stream_id", "left")
    checks = [
        _rule("window of a wrong shape", windows.where((F.size("ids") != size * cap) | (F.size("mask") != size * cap) | (F.size("lengths") != size)), key),
        _rule("bar over the cap", windows.where(F.array_max("lengths") > cap), key),
        _rule("empty bar in a window", windows.where(F.array_min("lengths") <= 0), key),
        _rule("padding is not zero", windows.where(padding), key),
        _rule("mask is not the lengths", windows.where(real != F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)), key),
        _rule("window of no member", named.where("member_split is null"), key),
        _rule("window in another split than its stream", named.where("split != member_split"), key),
        _rule("window numbers have gaps", numbers.where("n > 0 and (n != distinct or least != 0 or most != n - 1)"), F.col("n")),
    ]
    return reduce(DataFrame.unionAll, checks)


def require_none(violations: DataFrame) -> None:
    """Raise with the first violations if there are any."""
    some = violations.limit(20).collect()
    if some:
        raise ValueError("; ".join(f"{r.rule}: {r.key}" for r in some))


def identity_gate(actual: dict, expected: dict) -> None:
    """Raise unless a snapshot's manifest has exactly the expected facts (hashes, shapes) under their names."""
    wrong = {k: (actual.get(k), v) for k, v in expected.items() if actual.get(k) != v}
    if wrong:
        raise ValueError(f"not the base snapshot: {wrong}")


def pending(items: DataFrame, receipts: DataFrame, key: list[str]) -> DataFrame:
    """What a resumed run still has to do: items without a COMPLETE receipt."""
    return items.join(receipts.where("state = 'COMPLETE'").select(*key).distinct(), key, "left_anti")


def confidence(notes: DataFrame) -> DataFrame:
    """Per stream: how far its note count supports a tonal centre."""
    return notes.groupBy("stream_id").agg(F.least(F.lit(1.0), F.count("*") / 8).alias("tonal_confidence"))


def first_streams(streams: DataFrame, limit: int) -> DataFrame:
    """The first streams by id."""
    return streams.orderBy("stream_id").limit(limit)
