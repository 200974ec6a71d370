"""Canonical tables, features, projection and windows on the small fixtures."""

import pytest
from pyspark.sql import functions as F

from quaver.functions import ids
from quaver.operators import canonical, controls, projection, sweep

NOTES = "stream_id string, note_index long, onset_tick long, duration_ticks long, pitch long, velocity long, bar_ticks long, beats double"


def make(spark, rows, stream="s"):
    return spark.createDataFrame([(stream, k, a, b, p, v, 1920, 4.0) for k, (a, b, p, v) in enumerate(rows)], NOTES)


@pytest.fixture(scope="module")
def f1(spark):
    """Three notes in bar 0, one of which ends in bar 1; nothing in bar 2; one in bar 3."""
    return make(spark, [(0, 960, 50, 40), (0, 1920, 55, 100), (960, 1200, 59, 70), (5800, 60, 62, 10)])


@pytest.fixture(scope="module")
def f2(spark):
    """Bars 0 and 2 to 3 sound."""
    return make(spark, [(100, 50, 60, 80), (4000, 1900, 64, 80)])


def test_notes_and_bars(f1):
    rows = canonical.canonical_notes(f1).orderBy("note_index").collect()
    assert [(r.onset_tick, r.duration_ticks, r.onset_bar_index, r.end_bar_index) for r in rows] == [(0, 960, 0, 0), (0, 1920, 0, 0), (960, 1200, 0, 1), (5800, 60, 3, 3)]
    assert [(r.pitch, r.velocity) for r in rows] == [(50, 40), (55, 100), (59, 70), (62, 10)]
    bars = canonical.canonical_bars(f1).orderBy("bar_index").collect()
    assert [b.is_empty for b in bars] == [False, False, True, False]


def test_primitive_features(f1):
    rows = {r.bar_index: r for r in sweep.primitive_features(f1).collect()}
    r = rows[0]
    assert (r.note_count, r.max_polyphony, r.mean_polyphony, r.occupied_fraction, r.rest_fraction) == (3, 2, 2.0, 1.0, 0.0)
    assert (r.median_duration, r.median_pitch, r.pitch_range, r.mean_velocity, r.notes_per_beat) == (1200.0, 55.0, 9, 70.0, 0.75)
    assert (rows[1].note_count, rows[1].max_polyphony, rows[1].occupied_fraction) == (0, 1, 240 / 1920)
    assert (rows[2].note_count, rows[2].max_polyphony, rows[2].occupied_fraction, rows[2].rest_fraction, rows[2].median_pitch) == (0, 0, 0.0, 1.0, None)


def test_notes_without_length_sound_nowhere(spark):
    row = sweep.primitive_features(make(spark, [(100, 0, 60, 50), (200, 100, 64, 70), (300, 100, 62, 90)])).where("bar_index = 0").first()
    assert (row.note_count, row.max_polyphony, row.occupied_fraction, row.median_duration, row.mean_velocity) == (3, 1, 200 / 1920, 100.0, 70.0)


def test_projection(f2):
    bars = projection.live_bars(f2).orderBy("bar_index").collect()
    assert [b.occupied for b in bars] == [True, False, True, True]
    assert len({b.segment_id for b in bars} - {None}) == 2
    assert [b.source_position for b in bars[2:]] == [0.625, 0.875]
    assert bars[0].segment_position == 0 and bars[2].segment_position < bars[3].segment_position
    assert projection.live_segments(f2).count() == 2


def test_no_window_crosses_silence_or_streams(spark, f2):
    whole = make(spark, [(10, 7000, 60, 80), (7000, 3000, 60, 80)], "t")
    both = f2.union(whole)
    bars = projection.live_bars(both)
    windows = projection.eligible_windows(projection.number_spans(bars.select("stream_id", "bar_index")), bars).collect()
    assert sorted((w.stream_id, w.bar_indices) for w in windows) == [("t", [0, 1, 2, 3]), ("t", [1, 2, 3, 4]), ("t", [2, 3, 4, 5])]
    bare = spark.createDataFrame([(None, k, k) for k in range(4)], "stream_id string, bar_index long, span_index long")
    assert projection.resolve_streamless(bare, bars.select("stream_id", "bar_index")).where("stream_id is not null").count() == 0


def test_missing_bar_fails(spark, f2):
    bars = projection.live_bars(f2)
    with pytest.raises(Exception, match="no bar for"):
        projection.bind_spans(spark.createDataFrame([("s", 99)], "stream_id string, bar_index long"), bars).collect()


def test_streams_without_a_note_in_front(spark):
    late = make(spark, [(4000, 10, 60, 1)])
    assert [b.is_empty for b in canonical.canonical_bars(late).orderBy("bar_index").collect()] == [True, True, False]


def test_touching_notes_do_not_overlap(spark):
    row = sweep.polyphony(make(spark, [(0, 480, 60, 1), (480, 480, 61, 1)])).first()
    assert (row.max_voices, row.polyphonic_fraction, row.occupied) == (1, 0.0, 0.5)


def test_controls_by_hand(spark):
    notes = make(spark, [(0, 480, 60, 1), (480, 240, 64, 1), (960, 960, 62, 1), (960, 100, 66, 1), (1440, 10, 72, 1)])
    row = controls.bar_controls(notes).first()
    assert row.rhythmic_density == 1.0
    # reduced pitches 60, 64, 64, 72: up, level, up
    assert (row.contour_reversal, row.first_last, row.median_abs_interval) == (0.0, 12.0, 4.0)
    assert row.overlap_count == 2  # 62 with 66 and with 72
    assert row.tonic_pc == 6 and row.evidence_count == 5
    # durations 480, 240, 960 over gaps of 480
    assert row.median_duration_to_next_onset == 1.0
    assert row.theil_sen == pytest.approx(sorted([4 / 480, 4 / 960, 12 / 1440, 0, 8 / 960, 8 / 480])[2] / 2 + sorted([4 / 480, 4 / 960, 12 / 1440, 0, 8 / 960, 8 / 480])[3] / 2)


def test_bar_ticks(spark):
    one = spark.range(1)
    assert one.select(ids.bar_ticks(F.lit(480), F.lit(6), F.lit(8))).first()[0] == 1440
    with pytest.raises(Exception, match="whole number"):
        one.select(ids.bar_ticks(F.lit(1), F.lit(1), F.lit(8))).collect()


def test_materialization_gate(spark):
    rows = spark.createDataFrame(
        [("v1", 1, 1, 0, "h", 5, 10), (None, 1, 1, 0, "h", 5, 10), ("v1", 2, 1, 0, "h", 5, 10), ("v1", 1, 0, 0, "h", 5, 10), ("v1", 1, 1, 7, "h", 5, 10), ("v1", 1, 1, 0, None, 5, 10), ("v1", 1, 1, 0, "h", 0, 10), ("v1", 1, 1, 0, "h", 5, -1)],
        "schema string, tempo_count int, meter_count int, first_tick long, event_hash string, min_duration long, span_end long",
    )
    assert [r.reject_reason for r in canonical.materialization_gate(rows).collect()] == [None, "schema", "tempo_count", "meter_count", "first_tick", "hash", "duration", "span"]


def test_violations_and_gate(f1):
    from quaver.operators import validation

    good = canonical.canonical_notes(f1)
    bars = canonical.canonical_bars(f1)
    validation.require_none(validation.note_violations(good, bars))
    with pytest.raises(ValueError, match="velocity out of range"):
        validation.require_none(validation.note_violations(good.withColumn("velocity", F.lit(0)), bars))
    validation.identity_gate({"hash": "x", "shape": [1]}, {"hash": "x"})
    with pytest.raises(ValueError, match="not the base snapshot"):
        validation.identity_gate({"hash": "y"}, {"hash": "x"})
