"""Snapshots, sidecars, tensors, durable consolidation and ranks."""

import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaver import cli
from quaver.operators import validation
from quaver.operators.ranks import numbered
from quaver.plans import snapshot
from quaver.sources import sinks
from quaver.streaming import durable

ITEM = "stream_id string, dataset_id string, piece_id long, shard_id int, canonical_hash string, event_hash string, receipt_status string, cached_status string"
BAR = "stream_id string, bar_index long, ids array<long>, is_empty boolean"
NOTES = "stream_id string, note_index long, onset_tick long, duration_ticks long, pitch long, velocity long, bar_ticks long, beats double"


def corpus(spark):
    items = [("a", "one", 1, 0, "h1"), ("b", "two", 2, 0, "h1"), ("c", "one", 2, 1, "h2"), ("d", "one", 3, 1, "h3"), ("e", "one", 4, 1, "h4")]
    rows = spark.createDataFrame([(*x, x[4], "ACCEPT" if x[0] != "e" else "REJECT", None) for x in items], ITEM)
    lengths = {"a": [2, 3, 1, 2, 0, 4], "b": [1] * 6, "c": [5, 1, 2, 3, 9], "d": [200, 1, 1, 1, 1], "e": [1] * 6}
    bars = spark.createDataFrame([(s, k, [10 * k + j + 1 for j in range(n)], n == 0) for s, x in lengths.items() for k, n in enumerate(x)], BAR)
    return rows, bars


def test_snapshot(spark, tmp_path):
    items, bars = corpus(spark)
    tables = snapshot.build(items, bars, caps=(4, 16, 256))
    members = {r.stream_id: r for r in tables["membership"].collect()}
    assert set(members) == {"a", "c", "d"} and members["a"].family_id == members["c"].family_id != members["d"].family_id
    assert sorted((r.stream_id, r.kept_stream_id) for r in tables["provenance"].collect()) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "d")]
    assert [r.cap for r in tables["cap_profile"].where("selected").collect()] == [256]
    windows = {(r.stream_id, r.start_bar): r for r in tables["windows"].collect()}
    assert {k: r.window_index for k, r in windows.items()} == {("a", 0): 0, ("c", 0): 1, ("c", 1): 2, ("d", 0): 3, ("d", 1): 4}
    w = windows["c", 1]
    assert [x for x, m in zip(w.ids, w.mask, strict=True) if m] == [11, 21, 22, 31, 32, 33, *range(41, 50)] and len(w.ids) == 4 * 256
    small = snapshot.packed_windows(tables["membership"], bars, 16).collect()
    assert {r.stream_id for r in small} == {"a", "c"}  # d does not fit whole


def test_snapshot_commands(spark, tmp_path):
    items, bars = corpus(spark)
    notes = spark.createDataFrame([("s", 0, 0, 100, 60, 90, 1920, 4.0), ("s", 1, 4000, 100, 61, 90, 1920, 4.0)], NOTES)
    for name, df in (("items", items), ("bars", bars), ("notes", notes)):
        df.write.parquet(str(tmp_path / name))
    base, side = str(tmp_path / "base"), str(tmp_path / "side")
    run = lambda *a: cli.main(list(a), spark)
    assert run("snapshot-preview", "--items", str(tmp_path / "items"), "--bars", str(tmp_path / "bars"), "--output", base) == 0
    manifest = snapshot.validate_base(spark, base, {"windows": 5, "cap": 224})
    with pytest.raises(FileExistsError):
        run("snapshot-preview", "--items", str(tmp_path / "items"), "--bars", str(tmp_path / "bars"), "--output", base)
    assert run("export-tensors", "--snapshot", base, "--output", str(tmp_path / "npy")) == 0
    read = lambda kind: np.concatenate([np.load(io.BytesIO(f.read_bytes())) for f in sorted((tmp_path / "npy" / kind).glob("*.npy"))])
    ids, mask = read("ids"), read("mask")
    assert ids.shape == mask.shape == (5, 4, 224) and mask.dtype == bool and ids[0].sum() == 1 + 2 + 11 + 12 + 13 + 21 + 31 + 32 and (ids[~mask] == 0).all()
    assert run("build-sidecar", "--notes", str(tmp_path / "notes"), "--base", base, "--output", side) == 0
    made = sinks.read_json(spark, f"{side}/{sinks.COMPLETE}")
    assert made["facts"]["base_manifest_sha256"] == manifest["manifest_sha256"] and set(made["tables"]) == {"projection", "segments", "primitive_features", "controls"}
    with pytest.raises(ValueError, match="not the base snapshot"):
        snapshot.validate_base(spark, base, {"cap": 16})
    spark.createDataFrame([("x",)], "stream_id string").write.mode("overwrite").parquet(f"{base}/membership")
    with pytest.raises(ValueError, match="membership"):
        snapshot.sidecar(notes, base, str(tmp_path / "other"))


def test_window_violations(spark):
    items, bars = corpus(spark)
    members = snapshot.membership(items)
    good = snapshot.packed_windows(members, bars, 16).cache()
    assert validation.window_violations(good, members, 16).count() == 0
    broken = {
        "window of a wrong shape": good.withColumn("ids", F.slice("ids", 1, 9)),
        "bar over the cap": good.withColumn("lengths", F.transform("lengths", lambda x: x * 0 + 17)),
        "empty bar in a window": good.withColumn("lengths", F.transform("lengths", lambda x: x * 0)),
        "padding is not zero": good.withColumn("ids", F.transform("ids", lambda x: x + 1)),
        "mask is not the lengths": good.withColumn("mask", F.transform("mask", lambda x: F.lit(True))),
        "window of no member": good.withColumn("stream_id", F.lit("zz")),
        "window in another split than its stream": good.withColumn("split", F.lit("elsewhere")),
        "window numbers have gaps": good.withColumn("window_index", F.col("window_index") + 1),
    }
    for rule, rows in broken.items():
        assert rule in {r.rule for r in validation.window_violations(rows, members, 16).collect()}


def shards(spark):
    rows = [("oak", 0, "x1"), ("elm", 0, "x2"), ("ash", 1, "x1"), ("fir", 1, "x3"), ("yew", 2, "x2"), ("box", 2, "x1"), ("bay", 2, "x4")]
    return spark.createDataFrame(rows, "stream_id string, shard_id int, canonical_hash string")


def test_consolidation_resumes(spark, tmp_path):
    items = shards(spark)
    run = durable.Run(spark, str(tmp_path / "run"))
    ledger = lambda s: items.where(F.col("shard_id") == s)
    assert run.run([0, 1], lambda s: items, ledger) == {0: "COMPLETE", 1: "COMPLETE"}
    # a step that broke before its marker leaves rows that are written anew
    items.limit(1).write.parquet(str(tmp_path / "run" / "shard-000002" / "rows"))
    again = durable.Run(spark, str(tmp_path / "run"))
    assert again.run([0, 1, 2], lambda s: items, ledger) == {0: "SKIPPED_COMPLETE", 1: "SKIPPED_COMPLETE", 2: "COMPLETE"}
    got = {r.stream_id: (r.status, r.kept_stream_id) for r in again.rows().collect()}
    assert got == {"oak": ("UNIQUE", "oak"), "elm": ("UNIQUE", "elm"), "ash": ("DUPLICATE", "oak"), "fir": ("UNIQUE", "fir"), "yew": ("DUPLICATE", "elm"), "box": ("DUPLICATE", "oak"), "bay": ("UNIQUE", "bay")}
    assert {r.canonical_hash: r.occurrence_count for r in again.index(again.done()).collect()} == {"x1": 3, "x2": 2, "x3": 1, "x4": 1}
    with pytest.raises(ValueError, match="has changed"):
        again.step(1, items.withColumn("canonical_hash", F.lit("x9")))


def test_consolidation_fails_closed(spark, tmp_path):
    items = shards(spark)
    run = durable.Run(spark, str(tmp_path / "run"))
    with pytest.raises(ValueError, match="not what its ledger lists"):
        run.step(1, items, items.where("stream_id = 'ash'"))
    unproven = items.withColumns({"event_hash": F.col("canonical_hash"), "receipt_status": F.lit(None).cast("string"), "cached_status": F.lit("ACCEPT")})
    with pytest.raises(Exception, match="receipt"):
        run.step(1, unproven)
    assert run.done() == [] and run.rows().count() == 0


def test_numbers_in_ranges(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 2).cast("string")).alias("g"), (F.col("id") * 7919 % 1000).alias("place"), F.lit(1).alias("line"))
    for group in ((), ("g",)):
        got = numbered(rows.repartition(13), ["place"], group, "number").collect()
        by = {}
        for r in sorted(got, key=lambda r: r["place"]):
            by.setdefault(r.g if group else 0, []).append(r.number)
        assert len(got) == 1000 and all(x == list(range(len(x))) for x in by.values())
    assert numbered(rows.where("false"), ["place"]).count() == 0


def test_long_reports_are_refused(spark, tmp_path):
    sinks.write_report(spark, str(tmp_path / "r.md"), "t", spark.range(3))
    with pytest.raises(ValueError, match="more than 2 rows"):
        sinks.write_report(spark, str(tmp_path / "s.md"), "t", spark.range(3), most=2)
