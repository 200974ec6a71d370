"""MIDI files, pedal flattening and track tables."""

import random

from quaver.operators import tracks
from quaver.sources import midi

EVENT = "file string, track_index int, seq long, tick long, kind string, channel int, data1 int, data2 int"


def flatten(spark, rows):
    tick, events = 0, []
    for k, (kind, a, b, delta) in enumerate(rows):
        tick += delta
        events.append(("f", 0, k, tick, kind, 0, a, b))
    return tracks.flatten_pedals(spark.createDataFrame(events, EVENT)).orderBy("seq").collect()


def plain_release(events, k, on):
    """The event at which the release events[k] of the note begun at events[on] is let go, by walking on from it."""
    channel = events[k][5]
    controls = lambda upto: [(j, e[6], e[7]) for j, e in enumerate(events[:upto]) if e[4] == "control_change" and e[5] == channel]

    def is_down(number, upto):
        values = [(n == number and v >= 64) for _, n, v in controls(upto) if n in (number, 121)]
        return bool(values) and values[-1]

    def pressed(j):
        return events[j][4] == "control_change" and events[j][5] == channel and events[j][6] == 66 and events[j][7] >= 64 and not is_down(66, j)

    resets = [j for j, n, _ in controls(k) if n == 121]
    caught = any(pressed(j) for j in range(max([on, *resets]) + 1, k))
    for t in range(k, len(events)):
        if t > k and events[t][4] == "control_change" and events[t][5] == channel:
            number, value = events[t][6:8]
            if number == 121 or (number == 66 and value < 64 and is_down(66, t)):
                caught = False
        if not is_down(64, t + 1) and not (caught and is_down(66, t + 1)):
            return t
    return None


def plain_flatten(events):
    """(tick, place, seq, kind, channel, data1) of one track, note by note."""
    end, out = max(e[3] for e in events), []
    gone = set()
    for k, e in enumerate(events):
        off = e[4] == "note_off" or (e[4] == "note_on" and e[7] == 0)
        if not off:
            continue
        # the last begun equal note before it that no release between took
        open_notes = []
        for j in range(k):
            f = events[j]
            if f[4] in ("note_on", "note_off") and f[5:7] == e[5:7]:
                if f[4] == "note_on" and f[7] > 0:
                    open_notes.append(j)
                elif open_notes:
                    open_notes.pop()
        if not open_notes:
            continue
        gone.add(k)
        if events[open_notes[-1]][3] == e[3]:
            gone.add(open_notes[-1])
            continue
        t = plain_release(events, k, open_notes[-1])
        out.append((end if t is None else events[t][3], 10**9 if t is None else t, k, *e[4:7]))
    last = max((k for k, e in enumerate(events) if e[4] == "end_of_track"), default=None)
    for k, e in enumerate(events):
        if k in gone or e[4] == "realtime" or (e[4] == "control_change" and e[6] in (64, 66, 67, 121)) or (e[4] == "end_of_track" and k != last):
            continue
        out.append((end, 10**9 + 1, k, *e[4:7]) if k == last else (e[3], k, k, *e[4:7]))
    return [(r[0], *r[3:]) for r in sorted(out)]


def test_pedals_note_by_note(spark):
    rng, events = random.Random(8), []
    for f in range(120):
        tick = 0
        for k in range(rng.randrange(1, 50)):
            tick += rng.choice([0, 0, 2, 5])
            kind = rng.choices(["note_on", "note_off", "control_change", "realtime", "end_of_track", "meta_05"], [7, 5, 8, 1, 1, 1])[0]
            a, b = {"note_on": (rng.choice([40, 41]), rng.choice([0, 90, 90])), "note_off": (rng.choice([40, 41]), 0), "control_change": (rng.choice([64, 64, 66, 66, 67, 121, 1]), rng.choice([0, 63, 64, 127]))}.get(kind, (None, None))
            events.append((f"f{f}", 0, k, tick, kind, rng.randrange(2) if a is not None else None, a, b))
    got = {}
    for r in tracks.flatten_pedals(spark.createDataFrame(events, EVENT)).orderBy("file", "seq").collect():
        got.setdefault(r.file, []).append((r.tick, r.kind, r.channel, r.data1))
    for f in range(120):
        assert got.get(f"f{f}", []) == plain_flatten([e for e in events if e[0] == f"f{f}"])


def test_pedal_counters(spark):
    cc, on, off = "control_change", "note_on", "note_off"
    rows = flatten(spark, [(on, 50, 70, 0), (cc, 64, 90, 3), (off, 50, 0, 4), (cc, 64, 10, 6), (cc, 66, 70, 0), (cc, 67, 1, 0), (on, 51, 70, 2), (off, 51, 0, 0), (on, 52, 70, 0), (cc, 121, 0, 1), (cc, 64, 64, 0), (off, 52, 0, 8), (on, 53, 70, 5)])
    assert [(r.tick, r.kind, r.data1) for r in rows] == [(0, on, 50), (13, off, 50), (15, on, 52), (29, on, 53), (29, off, 52)]
    r = rows[0]
    assert (r.cc64_rendered, r.cc66_rendered, r.cc67_discarded, r.cc121_resets_consumed, r.realtime_discarded, r.zero_duration_dropped, r.end_of_track_noteoffs) == (3, 1, 1, 1, 0, 1, 1)


def test_realtime_keeps_time(spark):
    rows = flatten(spark, [("note_on", 48, 100, 0), ("realtime", 250, None, 70), ("note_off", 48, 0, 50)])
    assert [(r.kind, r.tick) for r in rows] == [("note_on", 0), ("note_off", 120)] and rows[0].realtime_discarded == 1
    delta = spark.createDataFrame([("f", 0, 0, 0, "note_on"), ("f", 0, 1, 70, "realtime"), ("f", 0, 2, 50, "note_off"), ("f", 0, 3, 7, "realtime")], "file string, track_index int, seq long, delta long, kind string")
    assert [(r.kind, r.delta) for r in tracks.strip_realtime(delta).orderBy("seq").collect()] == [("note_on", 0), ("note_off", 120), ("end_of_track", 7)]


def song():
    meta = [(0, "meta_51", None, None, None, (500000).to_bytes(3, "big")), (0, "meta_58", None, None, None, bytes([6, 3, 24, 8])), (0, "end_of_track", None, None, None, b"")]
    lead = [(0, "meta_03", None, None, None, b"Lead"), (0, "program_change", 0, 5, None, None), (0, "note_on", 0, 60, 90, None), (480, "note_off", 0, 60, 0, None), (500, "end_of_track", None, None, None, b"")]
    drums = [(0, "note_on", 9, 36, 90, None), (130, "note_off", 9, 36, 0, None), (130, "end_of_track", None, None, None, b"")]
    return midi.serialize(480, [meta, lead, drums])


def test_midi_round_trip_and_tables(spark, tmp_path):
    raw = song()
    kind, tpq, parsed = midi.parse(raw)
    assert (kind, tpq, len(parsed)) == (1, 480, 3) and midi.serialize(tpq, parsed) == raw
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.MID").write_bytes(raw)
    (tmp_path / "broken.mid").write_bytes(b"MThd")
    files = midi.list_files(spark, str(tmp_path))
    assert files.count() == 2
    events = midi.read_events(files, errors="skip")
    inventory = tracks.track_inventory(events)
    got = tracks.candidate_tracks(inventory).collect()
    assert [(r.track_name, r.programs, r.channels, r.end_tick) for r in got] == [("Lead", [5], [0], 500)]
    timing = tracks.source_timing(events).first()
    assert (timing.tempos, timing.meters) == ([[0, 500000]], [[0, 6, 8]])
    flat = tracks.flatten_pedals(events)
    receipts = tracks.conversion_receipts(events, flat)
    assert receipts.count() == 3


def test_running_status_and_varlen():
    body = bytes([0, 0x90, 60, 64, 0x81, 0x00, 60, 0, 0, 0xFF, 0x2F, 0])
    raw = b"MThd" + (6).to_bytes(4, "big") + bytes([0, 0, 0, 1, 1, 224]) + b"MTrk" + len(body).to_bytes(4, "big") + body
    assert [e[:5] for e in midi.parse(raw)[2][0]][:2] == [(0, "note_on", 0, 60, 64), (128, "note_on", 0, 60, 0)]
