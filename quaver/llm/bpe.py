"""Byte-level BPE encoding and decoding with recursive relational queries, one DuckDB per task.

A text is split by the tokenizer's pattern; pieces that are tokens need no merging. Every other
distinct piece of a chunk of texts becomes rows (word, pos, tok), one per byte. A recursive
query lays the tokens of every word out by position, joins neighbours with the merge table
(a, b, c) and contracts, in each round, the leftmost pair of least rank of every word, until no
word has a pair. Decoding joins
(row, pos, id) with the vocabulary and aggregates the bytes in order.

No token reaches over two neighbours whose bytes stand together in no token, so pieces are cut
there into words of their own. A word of more than LONG tokens contracts all places of its
least pair in one round, from the left and without overlap, if no pair of the token made and what stands
beside it has a lesser rank (then these places are the next leftmost least ones anyway), and else the
leftmost only; after TURNS rounds it is cut anew, where its tokens by then can be.

The vocabulary is read once from the rank file (a parameter) and broadcast: its size is that of
the file. Edge cases: a null or empty text has no ids and decodes to nothing; texts are never
cut, whatever their length; repeated rows are encoded alike; an empty table gives an empty
result; other columns of encode() and decode() pass through, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, pairwise

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaver.llm.textvec import mix, slices
from quaver.session import ship, unused

LONG = 64
#: Text bytes whose new pieces share one recursive query.
CHUNK_BYTES = 2 << 20
#: Distinct pieces that a task remembers, bytes of words in one query, and ids decoded by one query.
REMEMBERED, QUERY_BYTES, DECODE_IDS = 100_000, 1 << 19, 1 << 18
TURNS = 8
#: Bits of the filter of neighbours; what it takes for neighbours wrongly is only not cut.
NEAR_BITS = 25

CONTRACT = """
with recursive state(word, toks, done) as (
  select word, toks, false from start
  union all
  select s.word, case when b.pos is null then s.toks else s.toks[:b.pos - 1] || [b.c] || s.toks[b.pos + 2:] end, b.pos is null
  from state s left join (
    select word, (min(rank) % 1000)::int as pos, (min(rank) // 1000)::int as c
    from (
      select p.word, m.c::bigint * 1000 + p.pos as rank
      from (select word, unnest(toks[:-2]) as a, unnest(toks[2:]) as b, unnest(range(1, len(toks))) as pos
            from state where not done and len(toks) > 1) p
      join merges m on m.a = p.a and m.b = p.b)
    group by word) b on s.word = b.word
  where not s.done)
select word, toks as ids from state where done
"""

CONTRACT_LONG = f"""
with recursive state(word, toks, turn, done) as (
  select word, toks, 0, false from start
  union all
  select s.word, coalesce(n.toks, s.toks), s.turn + 1, n.toks is null
  from state s left join (
    with tokens as (select word, unnest(toks) as tok, unnest(range(1, len(toks) + 1)) as pos from state where not done and turn < {TURNS}),
    pairs as (
      select word, pos, c, before, after
      from (select word, tok as a, pos, lead(tok) over w as b, lag(tok) over w as before, lead(tok, 2) over w as after from tokens window w as (partition by word order by pos)) join merges using (a, b)
      qualify c = min(c) over (partition by word)),
    one as (
      select distinct word from pairs p join lesser l on l.c < p.c and (l.a = p.before and l.b = p.c)
      union select distinct word from pairs p join lesser l on l.c < p.c and (l.a = p.c and l.b = p.after)
      union select distinct word from pairs p join lesser l on l.c < p.c and (l.a = p.c and l.b = p.c)),
    runs as (select *, pos - row_number() over (partition by word order by pos) as run from pairs),
    chosen as (
      select word, pos, c from runs
      qualify case when word in (select word from one) then row_number() over (partition by word order by pos) = 1 else row_number() over (partition by word, run order by pos) % 2 = 1 end)
    select tokens.word, list(coalesce(here.c, tok) order by tokens.pos) as toks
    from tokens left join chosen here on here.word = tokens.word and here.pos = tokens.pos
    left join chosen before on before.word = tokens.word and before.pos = tokens.pos - 1
    where before.word is null and tokens.word in (select word from chosen) group by tokens.word) n on s.word = n.word
  where not s.done and s.turn < {TURNS})
select word, arg_max(toks, turn) as ids, bool_or(done) as done from state group by word
"""

DECODE = """
select r, unhex(string_agg(hex, '' order by pos)) as bytes
from tokens join vocab using (id) group by r
"""


def _near_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) >> np.uint64(64 - NEAR_BITS)).astype(np.int64)


@dataclass
class Vocabulary:
    """Tokens by rank, the pairs that make one, and a filter of the token pairs whose bytes stand together in some token."""

    pattern: str
    ranks: dict[bytes, int]
    pairs: np.ndarray  # [a, b, c], one column per pair
    near: np.ndarray  # bits

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        # a pair that stands in a token stands, without what follows it, in a piece of that token
        pieces = {t[i:j] for t in ranks for i in range(len(t)) for j in range(i + 2, len(t) + 1)}
        rows = [(x, y, ranks.get(p, -1)) for p in pieces for k in range(1, len(p)) if (x := ranks.get(p[:k])) is not None and (y := ranks.get(p[k:])) is not None]
        a, b, c = np.array(rows, np.int32).reshape(-1, 3).T
        near = np.zeros(1 << NEAR_BITS, bool)
        near[_near_slot(a, b)] = True
        return cls(pattern, ranks, np.stack([x[c >= 0] for x in (a, b, c)]), np.packbits(near, bitorder="little"))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which neighbours a, b no token can ever reach over."""
        slot = _near_slot(a, b)
        return (self.near[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 0


@functools.lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary.read(path, pattern)


class Numbers(dict):
    """Strings numbered as they are met; `new` has those without ids yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


def pick(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the runs flat[bounds[k]:bounds[k + 1]] for every k of which, end to end, and their bounds)."""
    size = bounds[which + 1] - bounds[which]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(bounds[which] - (ends - size), size) + np.arange(total)], np.append(0, ends)


class Codec:
    """A task's tokenizer: its DuckDB, and the pieces met so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ranks, self.apart = vocabulary.ranks, vocabulary.apart
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.size[list(self.ranks.values())] = list(map(len, self.ranks))
        self.split = regex.compile(vocabulary.pattern).findall
        # queries are small; without a folder they would fail rather than write to the working directory
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        self._load("merges", pa.table(dict(zip("abc", vocabulary.pairs, strict=True))))
        self.con.execute("create table lesser as select * from merges where c < greatest(a, b)")
        self._load("vocab", pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]}))
        self.forget()

    def __enter__(self) -> Codec:
        return self

    def __exit__(self, *_) -> None:
        self.con.close()
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.text: list[str] = []
        self.flat, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _load(self, name: str, rows: pa.Table) -> None:
        self.con.register("incoming", rows)
        self.con.execute(f"create or replace table {name} as select * from incoming")
        self.con.unregister("incoming")

    def _contracted(self, flat: np.ndarray, bounds: np.ndarray, long: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words end to end, their bounds, which words have no pair left)."""
        self._load("start", pa.table({"word": pa.array(np.arange(len(bounds) - 1), pa.int32()), "toks": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))}))
        out = self.con.sql(CONTRACT_LONG if long else CONTRACT).to_arrow_table().combine_chunks()
        order = np.argsort(out.column("word").to_numpy())
        ids = out.column("ids").chunk(0)
        done = out.column("done").to_numpy()[order] if long else np.ones(len(order), bool)
        return *pick(ids.flatten().to_numpy(), ids.offsets.to_numpy().astype(np.int64) - ids.offsets[0].as_py(), order), done

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For pieces that are no tokens: their ids end to end, and the bounds of each piece's ids."""
        flat = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.append(0, np.cumsum([len(w) for w in words], dtype=np.int64))
        cut = np.zeros(len(flat) + 1, bool)
        cut[ends] = cut[0] = True
        over = np.zeros(len(flat), bool)  # tokens of words that have no pair left
        while not over.all():
            cut[1:-1] |= self.apart(flat[:-1], flat[1:])
            bounds = np.flatnonzero(cut)
            size = np.diff(bounds)
            over[bounds[:-1][size == 1]] = True
            live = np.flatnonzero(~over[bounds[:-1]])
            # a part is QUERY_BYTES of short words, or of long ones
            long = size[live] > LONG
            part = np.where(long, -1 - np.cumsum(size[live] * long) // QUERY_BYTES, np.cumsum(size[live] * ~long) // QUERY_BYTES)
            place, ids, sizes, done = [np.flatnonzero(over[bounds[:-1]])], [flat[over]], [size[over[bounds[:-1]]]], [np.ones(over.sum(), bool)]
            for k in np.unique(part).tolist():
                some = live[part == k]
                made, at, ended = self._contracted(*pick(flat, bounds, some), k < 0)
                place.append(some)
                ids.append(made)
                sizes.append(np.diff(at))
                done.append(np.repeat(ended, np.diff(at)))
            order = np.argsort(np.concatenate(place), kind="stable")
            all_sizes = np.concatenate(sizes)
            at = np.append(0, np.cumsum(all_sizes))
            flat, bounds = pick(np.concatenate(ids), at, order)
            over, _ = pick(np.concatenate(done), at, order)
            cut = np.zeros(len(flat) + 1, bool)
            cut[bounds] = True
        return flat, np.searchsorted(np.append(0, np.cumsum(self.size[flat])), ends)

    def learn(self, new: list[str]) -> None:
        """The ids of new pieces, in order: whole tokens, and pieces for the query."""
        raw = [p.encode() for p in new]
        known = np.array([-1 if (i := self.ranks.get(r)) is None else i for r in raw], np.int64)
        query = np.flatnonzero(known < 0)
        merged, at = self.merge([raw[k] for k in query.tolist()])
        sizes = np.ones(len(raw), np.int64)
        sizes[query] = np.diff(at)
        bounds = np.append(0, np.cumsum(sizes))
        ids = np.zeros(bounds[-1], np.int32)
        inner = np.repeat(known < 0, sizes)
        ids[inner], ids[~inner] = merged, known[known >= 0]
        digits = list(map(str, ids.tolist()))
        self.text += [digits[a] if b == a + 1 else ",".join(digits[a:b]) for a, b in pairwise(bounds.tolist())]
        self.flat = np.concatenate([self.flat, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])

    def encode(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(decimal list of each text's ids, ids of all texts, bounds of each text's ids)."""
        if len(self.number) > REMEMBERED:
            self.forget()
        numbers, counts = [], []
        for t in texts:
            pieces = self.split(t) if t else ()
            numbers.extend(map(self.number.__getitem__, pieces))
            counts.append(len(pieces))
        self.learn(self.number.new)
        self.number.new = []
        each = map(self.text.__getitem__, numbers)
        listed = [",".join(islice(each, n)) for n in counts]
        ids, bounds = pick(self.flat, self.bounds, np.array(numbers, np.int64))
        return listed, ids, bounds[np.append(0, np.cumsum(counts, dtype=np.int64))]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each run ids[bounds[k]:bounds[k + 1]]; a query reads DECODE_IDS ids, whatever runs they are of."""
        rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        parts: list[list[bytes]] = [[] for _ in range(len(bounds) - 1)]
        for at in range(0, len(ids), DECODE_IDS):
            some = slice(at, at + DECODE_IDS)
            self._load("tokens", pa.table({"r": pa.array(rows[some], pa.int32()), "pos": pa.array(np.arange(len(ids[some])), pa.int32()), "id": pa.array(ids[some], pa.int32())}))
            for r, raw in self.con.execute(DECODE).fetchall():
                parts[r].append(raw)
        return [x[0] if len(x) == 1 else b"".join(x) for x in parts]


def _vocabulary(docs: DataFrame, path: str | None, pattern: str | None):
    import public_tokenizers

    ship(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(vocabulary(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The columns of docs and `ids` (with underscores after it if that name is taken), the token ids of `text`."""
    shared = _vocabulary(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Codec(shared.value) as codec:
            for batch in slices(batches, limit=CHUNK_BYTES):
                _, ids, bounds = codec.encode(batch.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, name])

    name = unused("ids", docs.columns)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None, column: str = "ids") -> DataFrame:
    """The columns of encoded and `decoded` (with underscores after it if that name is taken), the bytes of the ids in `column` (null: no bytes)."""
    shared = _vocabulary(encoded, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Codec(shared.value) as codec:
            for batch in batches:
                lists = [x or [] for x in batch.column(column).to_pylist()]
                bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
                raw = codec.decode(np.array([i for x in lists for i in x], np.int32), bounds)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, name])

    name = unused("decoded", encoded.columns)
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(name, T.BinaryType())]))


def query(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The digest columns of op9 for every document: encode, then decode the ids, within one task."""
    shared = _vocabulary(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Codec(shared.value) as codec:
            for batch in slices(batches, limit=CHUNK_BYTES):
                listed, ids, bounds = codec.encode(batch.column("text").to_pylist())
                listed = [hashlib.sha256(x.encode()).hexdigest() for x in listed]
                decoded = [hashlib.sha256(x).hexdigest() for x in codec.decode(ids, bounds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(listed), pa.array(decoded)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
