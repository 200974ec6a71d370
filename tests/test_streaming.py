"""Structured Streaming forms on small file streams."""

from quaver.streaming import incremental


def run(stream, name, mode):
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).start()
    query.processAllAvailable()
    query.stop()
    return stream.sparkSession.table(name)


def source(spark, rows, folder):
    rows.coalesce(1).write.parquet(str(folder))
    return spark.readStream.schema(rows.schema).parquet(str(folder))


def test_first_of_each_hash(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id) as ts, concat('h', id % 3) as canonical_hash, id from range(9)")
    got = run(incremental.first_seen(source(spark, rows, tmp_path / "in")), "first_seen", "append")
    assert got.select("canonical_hash").distinct().count() == got.count() == 3


def test_sessions(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,case when id < 3 then id else id + 20 end) as ts, 7 as user_id from range(5)")
    got = run(incremental.event_sessions(source(spark, rows, tmp_path / "in")), "sessions", "complete")
    assert sorted(r.n for r in got.collect()) == [2, 3]


def test_alarms(spark, tmp_path):
    ok = [1, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1]
    rows = spark.createDataFrame([("a", k, bool(x)) for k, x in enumerate(ok)] + [("b", k, True) for k in range(9)], "source string, at long, ok boolean")
    got = run(incremental.fault_alarms(source(spark, rows, tmp_path / "in")), "alarms", "append")
    assert sorted((r.source, r["at"], r.state) for r in got.collect()) == [("a", 6, "ALARM"), ("a", 11, "ALARM")]
