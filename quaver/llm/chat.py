"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A record's fingerprint is a hash of its nested field paths (arrays as `[]`, scalars by their
path only). MAPPINGS lists layouts by the paths they have; the first whose required paths are
all there handles a record, and says where role and text come from. Canonical turns are
(role, text). The template writes, for each turn,

    ### Role: text </turn>\\n

with a backslash before every backslash, `###` and `</turn>` inside texts, so that parse() gives the turns back.

Edge cases: null texts and roles are empty strings; rows are ordered by turn (nulls first), ties by role and text;
repeated rows are turns of their own; a record that no mapping handles has no turns; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaver.session import ship

OPEN, CLOSE = "### ", " </turn>\n"
_ESCAPED = re.compile(r"\\|###|</turn>")
_UNESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths it needs, and how turns are read.

    `turns` lists (role or None, path of the text); with `each` set, turns come from that array,
    and role and text are looked up in its items under the first of the given names. `named` gives
    the canonical role for a layout's own names of it; other roles stay as they are.
    """

    name: str
    needs: frozenset[str]
    turns: tuple[tuple[str, str], ...] = ()
    each: str = ""
    role: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    named: tuple[tuple[str, str], ...] = ()


def _layout(name: str, *turns: tuple[str, str], optional: tuple[str, ...] = ()) -> Mapping:
    return Mapping(name, frozenset(p for _, p in turns if p not in optional), turns)


#: Tried in this order; a more demanding layout stands before a simpler one.
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("rows", frozenset({"conv_id", "role", "text", "turn"}), each="", role=("role",), text=("text",)),
    Mapping("messages", frozenset({"messages[].role", "messages[].content"}), each="messages", role=("role",), text=("content",)),
    Mapping("message texts", frozenset({"messages[].role", "messages[].text"}), each="messages", role=("role",), text=("text",)),
    Mapping("conversations", frozenset({"conversations[].from", "conversations[].value"}), each="conversations", role=("from",), text=("value",), named=(("human", "user"), ("gpt", "assistant"))),
    _layout("instruction", ("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"), optional=("system", "input")),
    _layout("question", ("system", "system"), ("user", "question"), ("assistant", "answer"), optional=("system",)),
    _layout("prompt", ("system", "system"), ("user", "prompt"), ("assistant", "response"), optional=("system",)),
    _layout("completion", ("user", "prompt"), ("assistant", "completion")),
)

def paths(value, at: str = "") -> set[str]:
    """The nested field paths of a record."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items()), set())
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value), set())
    return {at}


def fingerprint(found: set[str]) -> str:
    """The hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


@dataclass
class Formatter:
    """Chooses a mapping once per schema fingerprint."""

    mappings: tuple[Mapping, ...] = MAPPINGS
    chosen: dict[str, Mapping | None] = field(default_factory=dict)

    def mapping(self, found: set[str]) -> Mapping | None:
        key = fingerprint(found)
        if key not in self.chosen:
            self.chosen[key] = next((m for m in self.mappings if m.needs <= found), None)
        return self.chosen[key]

    def turns(self, record: dict) -> list[tuple[str, str]]:
        """Canonical (role, text) turns of one record."""
        m = self.mapping(paths(record))
        if m is None:
            return []
        if m.turns:
            return [(role, str(record[path])) for role, path in m.turns if record.get(path)]
        items = record[m.each] if m.each else [record]
        first = lambda item, names: next((str(item[n]) for n in names if item.get(n) is not None), "")
        out = []
        for item in items:
            role = first(item, m.role)
            out.append((dict(m.named).get(role, role), first(item, m.text)))
        return out


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(lambda m: m[1], text)


def write(role: str, text: str) -> str:
    """One turn of the template."""
    return f"{OPEN}{escape(role).replace(':', chr(92) + ':')}: {escape(text)}{CLOSE}"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; formatted[start:end] is the escaped text."""
    out, at = [], 0
    while at < len(formatted):
        head = _TURN.match(formatted, at)
        if head is None:
            raise ValueError(f"no turn at {at}")
        # a backslash stands before every </turn> inside a text, so this one ends the turn
        end = formatted.index(CLOSE, head.end())
        out.append((unescape(head[1]), unescape(formatted[head.end() : end]), head.end(), end))
        at = end + len(CLOSE)
    return out


def format_record(record: dict, formatter: Formatter) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns of a record and the loss mask: the spans of assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in formatter.turns(record):
        part = write(role, text)
        if role == "assistant":
            spans.append((at + len(part) - len(CLOSE) - len(escape(text)), at + len(part) - len(CLOSE)))
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


FORMATTED = "formatted string, spans array<struct<start: int, end: int>>"


def _columns(made: list[tuple[str, list[tuple[int, int]]]]) -> list[pa.Array]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return [pa.array([x[0] for x in made], pa.string()), pa.array([[{"start": a, "end": b} for a, b in x[1]] for x in made], kind)]


def format_records(records: DataFrame, column: str = "record") -> DataFrame:
    """(record, formatted, spans) for a column of JSON objects in any of the mapped layouts; bad JSON has no turns."""
    ship(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter()
        for batch in batches:
            made = []
            for raw in batch.column(0).to_pylist():
                try:
                    value = json.loads(raw or "null")
                except ValueError:
                    value = None
                made.append(format_record(value, formatter) if isinstance(value, dict) else ("", []))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(made)], names=["record", "formatted", "spans"])

    return records.select(F.col(column).cast("string").alias("record")).mapInArrow(run, f"record string, {FORMATTED}")


def format_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, formatted, spans) for rows of (conv_id, turn, role, text): each row is a record of its own."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter()
        for batch in batches:
            made = [format_record(r, formatter) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_columns(made)], names=["conv_id", "turn", "role", "formatted", "spans"])

    return rows.select("conv_id", "turn", "role", "text").mapInArrow(run, f"conv_id long, turn long, role string, {FORMATTED}")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read the formatted turns of each conversation back; rows come sorted, so one conversation is open at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now: list | None = None

    def row(x: list) -> list:
        return [x[0], x[1], x[2].hexdigest(), x[3], x[4].hexdigest(), x[5]]

    for batch in batches:
        done = []
        for conv, formatted, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans")), strict=True):
            if now is None or now[0] != conv:
                if now is not None:
                    done.append(row(now))
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in parse(formatted):
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
            for s in spans:
                text = unescape(formatted[s["start"] : s["end"]])
                now[3] += len(text)
                now[4].update(text.encode())
            now[5] += len(formatted)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if k in (0, 1, 3, 5) else pa.string()) for k, x in enumerate(row(now))], names=names)


def query(conversations: DataFrame) -> DataFrame:
    """The digest columns of op3 for every conversation and conversation -7.

    A digest reads its conversation in order, so all turns of one go to one task, which streams them.
    """
    said = "\\### Assistant: </turn> ok"
    extra = conversations.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(extra)
    dealt = format_turns(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return dealt.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
