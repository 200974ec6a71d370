"""Dedupe, receipts, families, caps, inventories, registry."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quaver.functions import ids
from quaver.operators import dedupe, inventory, profile, registry
from quaver.operators.components import connected_components
from quaver.streaming import incremental

ITEMS = "stream_id string, shard_id int, canonical_hash string"
RECEIPTS = "shard_id int, stream_id string, receipt_status string, cached_status string, event_hash string, canonical_hash string"


def test_shard_dedupe(spark):
    rows = spark.createDataFrame([("oak", 2, "x1"), ("elm", 2, "x2"), ("ash", 5, "x1"), ("fir", 5, "x3"), ("yew", 7, "x2"), ("box", 7, "x1")], ITEMS)
    got = {r.stream_id: r for r in dedupe.first_owner(rows).collect()}
    assert {k for k, r in got.items() if r.status == "UNIQUE"} == {"oak", "elm", "fir"}
    assert [(got[k].kept_stream_id, got[k].kept_shard_id, got[k].occurrence_count) for k in ("ash", "box", "yew")] == [("oak", 2, 3), ("oak", 2, 3), ("elm", 2, 2)]
    index = incremental.empty_index(spark)
    for shard in (2, 5, 7):
        out, index = incremental.consolidate(index, rows.where(F.col("shard_id") == shard))
        for r in out.collect():
            assert (r.status, r.kept_stream_id) == (got[r.stream_id].status, got[r.stream_id].kept_stream_id)
    assert {r.canonical_hash: r.occurrence_count for r in index.collect()} == {"x1": 3, "x2": 2, "x3": 1}


def test_decision_table(spark):
    cases = [("REJECT", "ACCEPT", "h", "h", "reclassified_reject"), ("REJECT", None, "h", "h", "explicit_reject"), (None, "REJECT", "h", "h", "legacy_reject"), (None, "ACCEPT", "h", "h", "error_unproven_accept"), ("other", None, "h", "h", "skipped"), ("ACCEPT", "odd", "h", "h", "error_unknown_cache"), ("ACCEPT", None, None, "h", "error_missing_hash"), ("ACCEPT", None, "h", "x", "error_hash_mismatch"), ("ACCEPT", "REJECT", "h", None, "accepted")]
    rows = spark.createDataFrame([(0, f"s{k}", *c[:4]) for k, c in enumerate(cases)], RECEIPTS)
    assert [r.outcome for r in dedupe.reconcile(rows).orderBy("stream_id").collect()] == [c[4] for c in cases]
    counts = dedupe.reconciliation_counts(rows).first()
    assert (counts.accepted, counts.explicit_rejects, counts.reclassified_rejects, counts.errors) == (1, 2, 1, 4)
    with pytest.raises(Exception, match="invalid accepted receipt"):
        dedupe.fail_closed(rows).collect()


def test_components_against_union_find(spark):
    import random

    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5000 + k) for k in range(1, 200)]
    edges += [(1, 1), (None, 2)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.id: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ids_match_hashlib(spark):
    rows = spark.createDataFrame([("lead", "data/ä.mid"), ("x", "")], "d string, p string")
    got = rows.select("d", "p", ids.hash_partition(F.col("d"), F.col("p"), 3).alias("part"), ids.stable_id("kind", F.col("d"), F.col("p")).alias("id"), ids.hash_split(F.col("p")).alias("split")).collect()
    for r in got:
        digest = hashlib.sha256(f"{r.d}\0{r.p}".encode()).hexdigest()
        assert r.part == int(digest[:16], 16) % 3
        assert r.id == "kind_" + hashlib.sha256(json.dumps([r.d, r.p], separators=(",", ":")).encode()).hexdigest()[:24]
        bucket = int(hashlib.sha256(r.p.encode()).hexdigest()[:8], 16) % 1000
        assert r.split == ("train" if bucket < 800 else "validation" if bucket < 900 else "test")
    with pytest.raises(Exception, match="must not be empty"):
        rows.select(ids.object_id(F.col("d"), F.col("p"))).collect()
    assert rows.limit(1).select(ids.semantic_hash(F.lit('{"b": 1e-07, "a": null, "c": "é"}'))).first()[0] == hashlib.sha256(json.dumps({"a": None, "b": 1e-07, "c": "é"}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_family_is_never_divided(spark):
    rows = spark.createDataFrame([("p1", "a"), ("p2", "a"), ("p2", "b"), ("p3", "b"), ("p4", "c")], "piece_id string, canonical_hash string")
    got = {r.piece_id: r for r in dedupe.families(rows).collect()}
    assert {got[p].root for p in ("p1", "p2", "p3")} == {"p1"} and got["p4"].root == "p4"
    assert len({r.split for r in dedupe.family_split(rows).where("piece_id != 'p4'").collect()}) == 1


def test_caps(spark):
    bars = spark.createDataFrame([(f"s{k}", n) for k, lengths in enumerate([(9, 2), (31, 6), (64, 1, 1)]) for n in lengths], "stream_id string, length long")
    assert profile.cap_choice(bars).first().selected_cap == 64
    assert [r.cap for r in profile.cap_profile(bars).orderBy("cap").collect()] == list(profile.CAPS)
    none = bars.where("length > 100")
    assert profile.cap_profile(none).first().bar_coverage == 0.0 and profile.length_percentiles(none).first().p50 is None


def test_padding(spark):
    rows = spark.createDataFrame([([1, 2],), ([],)], "ids array<long>")
    got = profile.padded(rows, "ids", 3).collect()
    assert (got[0].ids, got[0].mask, got[1].ids) == ([1, 2, 0], [True, True, False], [0, 0, 0])
    with pytest.raises(Exception, match="longer than the cap"):
        profile.padded(rows, "ids", 1).collect()


INVENTORY = "bucket string, key string, size long, etag string"


def test_canonicalize(spark):
    rows = [("b", "north", 4, "x"), ("b", "north", 4, "x"), ("b", "east", 6, "y")]
    got = inventory.canonicalize(spark.createDataFrame(rows, INVENTORY)).orderBy("key").collect()
    assert [(r.key, r.copies) for r in got] == [("east", 1), ("north", 2)]
    with pytest.raises(Exception, match="conflicting records"):
        inventory.canonicalize(spark.createDataFrame([*rows, ("b", "east", 6, "z")], INVENTORY)).collect()


def test_coverage(spark):
    want = spark.createDataFrame([("b", "k0", 1, "x"), ("b", "k1", 1, "x")], INVENTORY)
    assert inventory.coverage_report(want, want).first().state == "COMPLETE"
    row = inventory.coverage_report(want, want.limit(1)).first()
    assert (row.state, row.missing) == ("INCOMPLETE", 1)


def test_packs_and_frames(spark):
    sizes = [300_000, 700_000, 2_500_000, 90_000]
    rows = spark.createDataFrame([(0, f"{k:064d}", n) for k, n in enumerate(sizes)], "worker int, object_id string, size long")
    packs = inventory.next_fit_packs(rows, 1 << 20, 1 << 22).orderBy("object_id").collect()
    assert [(r.object_id[-1], r.pack_index, r.position) for r in packs] == [("0", 0, 0), ("1", 0, 1), ("3", 1, 0)]
    assert inventory.large_lane(rows, 1 << 20, 1 << 22).first().object_id[-1] == "2"
    data = spark.createDataFrame([(0, k, f"o{k}", bytes([k]) * k) for k in range(4)], "pack_index int, position long, object_id string, payload binary")
    back = inventory.read_frames(inventory.write_frames(data)).orderBy("position").collect()
    assert [(r.object_id, bytes(r.payload)) for r in back] == [(f"o{k}", bytes([k]) * k) for k in range(4)]


def test_registry(spark):
    schema = "dataset_id string, role string, training string, method string, estimate long"
    rows = spark.createDataFrame([("tin", "raw", "ALLOWED", "git", 7), ("zinc", "raw", "ALLOWED", "git", 8), ("lead", "raw", "ALLOWED", "none", 9), ("gold", "raw", "DENIED", "git", 1), ("iron", "raw", None, "git", 1), ("coal", "index", "ALLOWED", "git", None)], schema)
    got = {r.dataset_id: r.disposition for r in registry.classify_sources(rows, rows.where("dataset_id = 'tin'")).collect()}
    assert got == {"tin": "COMPLETED_SKIP", "zinc": "QUEUED", "lead": "GATED", "gold": "GATED", "iron": "GATED", "coal": "GATED"}
    guard = spark.range(1).select(*[registry.storage_guard(F.lit(5300), F.lit(n), 300, 2.5) for n in (2000, 2001)]).first()
    assert tuple(guard) == (True, False)
    eta = spark.range(1).select(registry.eta(F.lit(100), F.lit(300), F.lit(100)).alias("e"), registry.eta(F.lit(99), F.lit(300), F.lit(100)).alias("n")).first()
    assert tuple(eta.e) == (160, 200, 250) and eta.n is None


def test_allow_list(spark):
    rows = spark.createDataFrame([("./data/a/x.json",), ("mid/b.mid",), ("",)], "value string")
    assert sorted(r.path for r in inventory.allow_list_paths(rows).collect()) == ["mid/a/x.mid", "mid/b.mid"]
