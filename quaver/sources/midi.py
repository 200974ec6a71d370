"""Standard MIDI files as event tables, and back.

An event row is (file, track_index, seq, tick, kind, channel, data1, data2, payload): absolute
ticks, `kind` in note_on, note_off, control_change, program_change, pitchwheel, polytouch,
aftertouch, sysex, realtime, end_of_track, or meta_<type>; payload holds meta and sysex bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

EVENTS = "file string, track_index int, seq long, tick long, kind string, channel int, data1 int, data2 int, payload binary, tpq int, format int"
CHANNEL_KINDS = {8: "note_off", 9: "note_on", 10: "polytouch", 11: "control_change", 12: "program_change", 13: "aftertouch", 14: "pitchwheel"}
KIND_CODES = {name: code for code, name in CHANNEL_KINDS.items()}
ONE_BYTE = (12, 13)
END = 0x2F


def read_varlen(raw: bytes, at: int) -> tuple[int, int]:
    value = 0
    while True:
        byte = raw[at]
        at += 1
        value = value << 7 | byte & 0x7F
        if byte < 0x80:
            return value, at


def write_varlen(value: int) -> bytes:
    out = [value & 0x7F]
    while value := value >> 7:
        out.append(value & 0x7F | 0x80)
    return bytes(reversed(out))


def parse(raw: bytes) -> tuple[int, int, list[list[tuple]]]:
    """(format, ticks per quarter, tracks of (tick, kind, channel, data1, data2, payload)); a damaged file is an error."""
    if raw[:4] != b"MThd" or len(raw) < 14:
        raise ValueError("not a standard MIDI file")
    head = int.from_bytes(raw[4:8], "big")
    kind, division = int.from_bytes(raw[8:10], "big"), int.from_bytes(raw[12:14], "big")
    if division & 0x8000:
        raise ValueError("frame-based time is not supported")
    tracks, at = [], 8 + head
    while at + 8 <= len(raw):
        size = int.from_bytes(raw[at + 4 : at + 8], "big")
        if raw[at : at + 4] == b"MTrk":
            tracks.append(list(_track(raw[at + 8 : at + 8 + size])))
        at += 8 + size
    return kind, division, tracks


def _track(raw: bytes) -> Iterator[tuple]:
    at, tick, status = 0, 0, 0
    while at < len(raw):
        delta, at = read_varlen(raw, at)
        tick += delta
        byte = raw[at]
        if byte >= 0xF8 and byte != 0xFF:
            at += 1
            yield tick, "realtime", None, byte, None, None
        elif byte == 0xFF:
            code = raw[at + 1]
            size, at = read_varlen(raw, at + 2)
            payload, at = raw[at : at + size], at + size
            yield tick, "end_of_track" if code == END else f"meta_{code:02x}", None, None, None, payload
        elif byte in (0xF0, 0xF7):
            size, at = read_varlen(raw, at + 1)
            yield tick, "sysex", None, byte, None, raw[at : at + size]
            at += size
        else:
            if byte & 0x80:
                status, at = byte, at + 1
            if status < 0x80:
                raise ValueError("data without a status byte")
            two = status >> 4 not in ONE_BYTE
            yield tick, CHANNEL_KINDS[status >> 4], status & 15, raw[at], raw[at + 1] if two else None, None
            at += 2 if two else 1


def serialize(tpq: int, tracks: Iterable[Iterable[tuple]], kind: int = 1) -> bytes:
    """A file of tracks of (tick, kind, channel, data1, data2, payload) in time order; realtime events cannot be written."""
    chunks = []
    for track in tracks:
        out, now, ended = [], 0, False
        for tick, name, channel, data1, data2, payload in track:
            out.append(write_varlen(tick - now))
            now = tick
            if name == "end_of_track" or name.startswith("meta_"):
                code = END if name == "end_of_track" else int(name[5:], 16)
                out.append(bytes([0xFF, code]) + write_varlen(len(payload or b"")) + (payload or b""))
                ended = name == "end_of_track"
            elif name == "sysex":
                out.append(bytes([data1]) + write_varlen(len(payload)) + payload)
            else:
                code = KIND_CODES[name]
                out.append(bytes([code << 4 | channel, data1] + ([] if code in ONE_BYTE else [data2])))
        if not ended:
            out.append(bytes([0, 0xFF, END, 0]))
        body = b"".join(out)
        chunks.append(b"MTrk" + len(body).to_bytes(4, "big") + body)
    head = kind.to_bytes(2, "big") + len(chunks).to_bytes(2, "big") + tpq.to_bytes(2, "big")
    return b"MThd" + (6).to_bytes(4, "big") + head + b"".join(chunks)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, content) of the .mid and .midi files below a folder, whatever their case."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{mid,MID,Mid,midi,MIDI,Midi}").load(folder).select("path", "length", "content")


def read_events(files: DataFrame, errors: str = "fail") -> DataFrame:
    """Event rows of (path, content) files; damaged files fail, or with errors="skip" give no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in EVENTS.split(", ")]
        for batch in batches:
            for path, content in batch[["path", "content"]].itertuples(index=False):
                try:
                    kind, tpq, tracks = parse(bytes(content))
                except (ValueError, IndexError, KeyError):
                    if errors == "fail":
                        raise
                    continue
                rows = [(path, t, k, *event, tpq, kind) for t, track in enumerate(tracks) for k, event in enumerate(track)]
                yield pd.DataFrame(rows, columns=names).astype({"channel": "Int32", "data1": "Int32", "data2": "Int32"})

    return files.select("path", "content").mapInPandas(run, EVENTS)


def write_candidates(events: DataFrame) -> DataFrame:
    """(file, track_index, midi): every track's events as a one-track file of format 1, in (tick, seq) order.

    Realtime events cannot stand in a file and are left out; a track is bounded by its file.
    """
    columns = ["tick", "kind", "channel", "data1", "data2"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf[pdf["kind"] != "realtime"].sort_values(["tick", "seq"])
        track = [(int(t), k, *(None if pd.isna(v) else int(v) for v in (c, a, b)), None if p is None else bytes(p)) for t, k, c, a, b, p in rows[[*columns, "payload"]].itertuples(index=False)]
        return pd.DataFrame({"file": [key[0]], "track_index": [key[1]], "midi": [serialize(int(rows["tpq"].iloc[0]), [track])]})

    return events.groupBy("file", "track_index").applyInPandas(run, "file string, track_index int, midi binary")
