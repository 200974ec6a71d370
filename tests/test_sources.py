"""Sources, sinks and streaming forms."""

import gzip
import hashlib
import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaver.sources import sinks, tables
from quaver.streaming import incremental


def record(bucket, key, size=1):
    oid = hashlib.sha256(f"{bucket}\0{key}".encode()).hexdigest()
    return {"schema": "inv/v1", "bucket": bucket, "key": key, "object_id": oid, "size": size, "etag": "e", "last_modified": "2024-01-01T00:00:00+00:00"}


def test_registry_and_inventory(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"sources": [{"id": "a", "method": "http", "estimate": 5}]}))
    assert tables.read_registry(spark, str(tmp_path / "r.json")).first().estimate == 5
    path = tmp_path / "i.jsonl"
    path.write_text(json.dumps(record("b", "k")) + "\n\n")
    assert tables.read_inventory(spark, str(path), "inv/v1").count() == 1
    path.write_text(json.dumps(record("b", "k") | {"size": -1}) + "\n")
    with pytest.raises(Exception, match="bad inventory record"):
        tables.read_inventory(spark, str(path), "inv/v1").collect()


def test_partial_inventory(spark, tmp_path):
    whole = gzip.compress((json.dumps(record("b", "a")) + "\n").encode())
    (tmp_path / "p.jsonl.gz").write_bytes(whole + b"\x1f\x8bjunk")
    assert [r.key for r in tables.read_partial_inventory(spark, str(tmp_path / "p.jsonl.gz")).collect()] == ["a"]
    (tmp_path / "q.jsonl").write_text(json.dumps(record("b", "c")) + "\n" + '{"schema": "inv')
    assert [r.key for r in tables.read_partial_inventory(spark, str(tmp_path / "q.jsonl")).collect()] == ["c"]


def test_receipts(spark):
    rows = spark.createDataFrame([(1, "COMPLETE"), (0, "COMPLETE"), (1, "COMPLETE"), (2, "FAILED")], "shard_id int, state string")
    assert [r.shard_id for r in tables.completed_shards(rows).collect()] == [0, 1]
    with pytest.raises(Exception, match="out of range"):
        tables.checked_receipts(rows, 1).collect()


def test_views_are_content_addressed_and_immutable(spark, tmp_path):
    df = spark.range(20).withColumn("x", F.col("id") * 2)
    a = sinks.write_snapshot({"t": df}, str(tmp_path / "a"), {"k": 1})
    b = sinks.write_view({"t": df.repartition(3).orderBy(F.desc("id"))}, str(tmp_path / "b"), {"k": 1})
    assert a["tables"]["t"]["digest"] == b["tables"]["t"]["digest"]
    assert sinks.verify_view(spark, str(tmp_path / "a")).count() == 0
    with pytest.raises(FileExistsError):
        sinks.write_snapshot({"t": df}, str(tmp_path / "a"), {})
    assert sinks.file_identities(spark, str(tmp_path / "a" / "t")).count() > 0


def test_npy(spark, tmp_path):
    blocks = spark.range(10).select(F.col("id").alias("window_index"), F.array(F.array("id", "id"), F.array(F.lit(0), F.col("id"))).alias("ids"))
    parts = sorted(sinks.npy_parts(blocks).collect(), key=lambda r: r.first)
    whole = np.concatenate([np.load(io.BytesIO(bytes(r.npy))) for r in parts])
    assert whole.shape == (10, 2, 2) and whole[7].tolist() == [[7, 7], [0, 7]]
    sinks.write_int64_npy(spark, str(tmp_path / "i.npy"), [3, 1])
    assert np.load(tmp_path / "i.npy").tolist() == [3, 1]


def test_event_windows_stream(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:10:00' + make_interval(0,0,0,0,0,id*20) as ts, 'a' as event_type, cast(1 as double) as value, id as user_id from range(6)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = incremental.event_windows(stream).writeStream.outputMode("complete").format("memory").queryName("windows").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.n, r.total) for r in spark.table("windows").orderBy("window_start").collect()] == [(3, 3.0), (3, 3.0)]


def test_batches_are_idempotent(spark, tmp_path):
    seen = []
    run = incremental.idempotent(lambda df, k: seen.append(k), str(tmp_path))
    for k in (0, 0, 1):
        run(spark.range(1), k)
    assert seen == [0, 1]


def test_archives_settings_and_commands(spark, tmp_path):
    import zipfile

    from quaver import cli
    from quaver.config import Settings
    from quaver.sources import archives

    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep/x.mid", b"1")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("part.zip", inner.getvalue())
        z.writestr("__MACOSX/._x", b"")
        z.writestr("b.mid", b"2")
    assert sorted((r.path, bytes(r.content)) for r in archives.read_archives(spark, str(tmp_path)).collect()) == [("b.mid", b"2"), ("part/deep/x.mid", b"1")]
    for bad in ("../x", "/etc/x", "a/../../x"):
        with pytest.raises(ValueError, match="unsafe"):
            archives.safe_name(bad)
    (tmp_path / "s.toml").write_text("shards = 3\n")
    assert Settings.read(str(tmp_path / "s.toml"), {"QUAVER_HEADROOM": "2"}) == Settings(shards=3, headroom=2.0)
    rows = spark.createDataFrame([("s", k, 480 * k, 480, 60 + k, 80, 1920, 4.0) for k in range(6)], "stream_id string, note_index long, onset_tick long, duration_ticks long, pitch long, velocity long, bar_ticks long, beats double")
    rows.write.parquet(str(tmp_path / "notes"))
    assert cli.main(["extract-features", "--notes", str(tmp_path / "notes"), "--output", str(tmp_path / "features")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "features")).count() == 2
