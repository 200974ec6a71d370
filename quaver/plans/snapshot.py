"""Training snapshots: from accepted items and their bars to membership, windows, tensors and a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaver.operators import dedupe, profile, projection, sweep
from quaver.operators.controls import bar_controls
from quaver.operators.validation import identity_gate
from quaver.session import materialize
from quaver.sources import sinks

WINDOW = 4


def membership(items: DataFrame) -> DataFrame:
    """One accepted item for every hash, with the family of its piece and the family's split."""
    accepted = dedupe.reconcile(items).where("outcome = 'accepted'").withColumn("piece_id", F.col("piece_id").cast("string"))
    winner = dedupe.winners(accepted, ("dataset_id", "stream_id", "piece_id"))
    return winner.join(dedupe.family_split(accepted), "piece_id").select("stream_id", "canonical_hash", "dataset_id", "piece_id", "family_id", "split")


def packed_windows(members: DataFrame, bars: DataFrame, cap: int, size: int = WINDOW) -> DataFrame:
    """Windows of `size` bars without an empty one, of the streams all of whose bars fit the cap.

    Bars are (stream_id, bar_index, ids, is_empty). Rows are numbered by (stream_id, start_bar);
    `ids` and `mask` are the window's bars one after the other, each filled up to the cap.
    """
    named = bars.join(members.select("stream_id", "family_id", "split"), "stream_id").withColumn("length", F.size("ids").cast("bigint"))
    over = named.where(F.col("length") > cap).select("stream_id").distinct()
    kept = named.join(over, "stream_id", "left_anti")
    starts = profile.number_windows(profile.block_windows(kept, size), ["stream_id", "start_bar"])
    blocks = profile.padded(kept, "ids", cap).select("stream_id", "bar_index", "family_id", "split", "ids", "mask")
    places = starts.select("*", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("k")).withColumn("bar_index", F.col("start_bar") + F.col("k"))
    parts = places.join(blocks, ["stream_id", "bar_index"]).groupBy("window_index", "stream_id", "family_id", "split", "start_bar", "lengths")
    ordered = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", c))), lambda x: x[c]))
    return parts.agg(ordered("ids").alias("ids"), ordered("mask").alias("mask"))


def build(items: DataFrame, bars: DataFrame, caps: tuple[int, ...] = profile.CAPS) -> dict[str, DataFrame]:
    """The tables of a snapshot: membership, provenance, cap profile, lengths, windows and counters."""
    members = materialize(membership(items), "members")
    own = bars.join(members.select("stream_id", "split"), "stream_id").withColumn("length", F.size("ids").cast("bigint"))
    cap = profile.cap_choice(own, caps).first().selected_cap or caps[0]
    windows = packed_windows(members, bars, cap)
    kept = own.join(own.where(F.col("length") > cap).select("stream_id").distinct(), "stream_id", "left_anti")
    return {
        "membership": members,
        "provenance": dedupe.provenance_edges(dedupe.reconcile(items).where("outcome = 'accepted'")),
        "cap_profile": profile.cap_profile(own, caps).withColumn("selected", F.col("cap") == cap),
        "length_profile": profile.length_histogram(kept),
        "windows": windows.withColumn("cap", F.lit(cap)),
        "split_counters": profile.split_counters(kept, windows),
    }


def write(items: DataFrame, bars: DataFrame, folder: str, facts: dict, caps: tuple[int, ...] = profile.CAPS) -> dict:
    """Build a snapshot under another name and publish it whole; the tensors stand beside the tables, as NPY parts."""
    tables = build(items, bars, caps)
    tables["windows"] = materialize(tables["windows"], "windows")
    cap = tables["cap_profile"].where("selected").first().cap
    tensors = {f"tensor_{name}": sinks.npy_parts(tables["windows"], name, kind=kind, shape=(WINDOW, cap)) for name, kind in (("ids", "<i8"), ("mask", "|b1"))}
    return sinks.write_snapshot(tables | tensors, folder, facts | {"cap": cap, "window_bars": WINDOW, "windows": tables["windows"].count()})


def export_tensors(spark: SparkSession, folder: str, target: str) -> dict[str, list[str]]:
    """NPY files of a published snapshot's windows: (windows, bars, cap) ids and mask in parts, in order of their names."""
    return {name: sinks.write_npy(spark.read.parquet(f"{folder}/tensor_{name}"), f"{target}/{name}") for name in ("ids", "mask")}


def validate_base(spark: SparkSession, folder: str, expected: dict | None = None) -> dict:
    """The manifest of a published snapshot whose tables are what it says; refused if they or the expected facts differ."""
    manifest = sinks.read_json(spark, f"{folder}/{sinks.COMPLETE}")
    bad = [r[0] for r in sinks.verify_view(spark, folder).collect()]
    if bad:
        raise ValueError(f"not what the manifest says: {', '.join(sorted(bad))}")
    identity_gate(manifest["facts"], expected or {})
    return manifest


def sidecar(notes: DataFrame, base: str, folder: str, expected: dict | None = None) -> dict:
    """Projection and features of canonical notes beside a validated snapshot, which they name by its manifest."""
    spark = notes.sparkSession
    manifest = validate_base(spark, base, expected)
    tables = {
        "projection": projection.live_bars(notes),
        "segments": projection.live_segments(notes),
        "primitive_features": sweep.primitive_features(notes),
        "controls": bar_controls(notes),
    }
    return sinks.write_snapshot(tables, folder, {"base_manifest_sha256": manifest["manifest_sha256"], "base_facts": manifest["facts"]})
