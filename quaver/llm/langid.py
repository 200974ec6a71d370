"""Language identification by unigram pieces, marginalised over all segmentations.

The pieces are all of a public sentencepiece vocabulary (its path is a parameter); single bytes
without a piece use the vocabulary's byte pieces, so that every word has a segmentation. A word is
a space, then its bytes. Each language has piece probabilities, and the
forward algorithm sums the probabilities of all segmentations of a word; a text's likelihood is
the product over its words, and the score is the posterior under a uniform prior.

The probabilities are fitted by ROUNDS of expectation maximisation over the distinct words of at
most about TRAIN_ROWS documents per language (those of the smallest hash of doc_id, so the bound
holds in expectation), among documents with a language and crc32(doc_id as text) % 3 != 1. Words of
over TRAIN_BYTES bytes do not train.

The forward algorithm goes byte by byte through many words at once. In a word of over LONG bytes it goes
through many parts of the word at once, from every state that a part can begin in, and then from part to part.

Edge cases: a null text, or one without a letter, is `und` with score 0; without training
documents every text is `und`; ties go to the alphabetically first language; repeated rows are
alike; an empty table gives an empty result; only doc_id, text and (to learn) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaver.llm.textvec import _BYTE, Words, _power_tables, mix, slices, text_bytes
from quaver.llm.toxicity import distinct
from quaver.session import materialize, ship

FOLDS = 3
TRAIN_ROWS = 2000
ROUNDS = 3
#: Added to every expected piece count.
SMOOTH = 0.05
#: Words whose lattices are held at once.
WORDS_AT_ONCE = 60_000
#: Longest word that trains, longest that is scored byte by byte, bytes of a part of a longer one, and parts at once.
TRAIN_BYTES, LONG, PART, PARTS_AT_ONCE = 1000, 512, 128, 256
_LETTER = regex.compile(r"\p{L}").search


@dataclass
class Pieces:
    """Piece numbers by the hash of their bytes; numbers 0 to 255 are the byte pieces.

    tables[k] holds, by 20 bits of the hash, the place of a piece in `hashes`, or -1; a piece
    whose slot is taken goes to the next table, which reads other bits.
    """

    hashes: np.ndarray
    tables: list[np.ndarray]
    longest: int
    size: int

    @classmethod
    def read(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = set()
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                found.add(model.id_to_piece(i).replace("▁", " ").encode())
        pieces = sorted(p for p in found if p)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.append(0, ends[:-1])
        h = spans(prefix(data), starts, ends)
        tables, left = [], np.arange(len(h))
        while len(left):
            table = np.full(1 << 20, -1, np.int32)
            at = cls.slot(h[left], len(tables))
            table[at] = left
            left = left[table[at] != left]
            tables.append(table)
        return cls(h, tables, max(map(len, pieces)), 256 + len(pieces))

    @staticmethod
    def slot(h: np.ndarray, k: int) -> np.ndarray:
        return ((h >> np.uint64(44 - 7 * k)) & np.uint64((1 << 20) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, -1 where none has it."""
        out = np.full(len(h), -1, np.int32)
        ask = np.arange(len(h))
        for k, table in enumerate(self.tables):
            place = table[self.slot(h[ask], k)]
            taken = place >= 0
            ask, place = ask[taken], place[taken]
            same = self.hashes[place] == h[ask]
            out[ask[same]] = place[same] + 256
            ask = ask[~same]
        return out


def prefix(data: np.ndarray) -> np.ndarray:
    power, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return sums


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], from the sums of prefix(data)."""
    _, inverse = _power_tables(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Lattice:
    """The pieces of some words: arc[p, m - 1] is the piece that covers m bytes from byte p of the words, or -1.

    Words are sorted by length, longest first, so that step t concerns the first live[t] words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> None:
        size = np.diff(offsets)
        self.order = np.argsort(-size, kind="stable")
        size = size[self.order]
        self.length = size + 1
        ends = np.cumsum(self.length)
        self.start = ends - self.length
        self.data = np.full(int(ends[-1]), 32, np.uint8)
        at = np.repeat(offsets[:-1][self.order] - np.cumsum(size) + size, size) + np.arange(size.sum())
        inner = np.ones(len(self.data), bool)
        inner[self.start] = False
        self.data[inner] = data[at]
        n = len(self.data)
        room = np.repeat(ends, self.length) - np.arange(n)
        self.most = int(min(pieces.longest, self.length[0]))
        self.arc = np.full((n, self.most), -1, np.int32)
        here, sums = np.arange(n), prefix(self.data)
        for m in range(1, self.most + 1):
            here = here[room[here] >= m]
            self.arc[here, m - 1] = pieces.find(spans(sums, here, here + m))
        bare = self.arc[:, 0] < 0
        self.arc[bare, 0] = self.data[bare]
        steps = int(self.length[0])
        self.live = np.searchsorted(-self.length, -np.arange(1, steps + 1), "right")

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """log of the summed probability of every word per language, for p[piece, language] (last row zero)."""
        k, langs = len(self.length), p.shape[1]
        ring = np.zeros((self.most, k, langs))
        ring[0] = 1.0
        total = np.zeros((k, langs))
        for t in range(1, len(self.live) + 1):
            n = self.live[t - 1]
            end = self.start[:n] + t
            new = np.zeros((n, langs))
            for m in range(1, min(t, self.most) + 1):
                arc = self.arc[end - m, m - 1]
                some = np.flatnonzero(arc >= 0)
                new[some] += ring[(t - m) % self.most, some] * p[arc[some]]
            total[:n] += np.log(new)
            ring[:, :n] /= new
            ring[t % self.most, :n] = 1.0
        return total

    def _step(self, p: np.ndarray, end: np.ndarray, t: int, ring: np.ndarray, used: np.ndarray) -> np.ndarray:
        """What the arcs that end at the given bytes make of the states in the ring, [part, state, language]."""
        new = np.zeros(ring.shape[1:])
        for m in used.tolist():
            arc = np.where(end >= m, self.arc[np.maximum(end - m, 0), m - 1], -1)
            some = np.flatnonzero(arc >= 0)
            new[some] += ring[(t - m) % self.most, some] * p[arc[some]][:, None, :]
        return new

    def _transfer(self, p: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For parts of `size` bytes from `first`: [part, state after, state before, language], and the log of its scale.

        State i is the sum of all ways to the byte i before the part's bound.
        """
        parts, langs = len(first), p.shape[1]
        ring = np.zeros((self.most, parts, self.most, langs))
        for i in range(self.most):
            ring[-i % self.most, :, i] = 1.0
        scale = np.zeros((parts, langs))
        used = np.flatnonzero((self.arc >= 0).any(0)) + 1
        for t in range(1, size + 1):
            new = self._step(p, first + t, t, ring, used)
            ring[t % self.most] = new
            top = new.max(1)
            ring /= top[:, None, :]
            scale += np.log(top)
        return np.moveaxis(ring[[(size - i) % self.most for i in range(self.most)]], 0, 1), scale

    def whole(self, p: np.ndarray) -> np.ndarray:
        """forward() of the only word."""
        n, langs = int(self.length[0]), p.shape[1]
        state, total = np.zeros((self.most, langs)), np.zeros(langs)
        state[0] = 1.0
        rest = n % PART
        starts = [np.zeros(1, np.int64)] if rest else []
        starts += [first for first in np.array_split(np.arange(rest, n, PART), max(1, n // PART // PARTS_AT_ONCE)) if len(first)]
        for k, first in enumerate(starts):
            for transfer, scale in zip(*self._transfer(p, first, rest if rest and k == 0 else PART), strict=True):
                state = np.einsum("ijl,jl->il", transfer, state)
                top = state.max(0)
                state /= top
                total += np.log(top) + scale
        return total + np.log(state[0])

    def expected(self, p: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
        """Expected piece counts under one language's p, words weighted (in the order given to __init__)."""
        weight = weight[self.order]
        n, steps = len(self.data), len(self.live)
        # log-domain forward and backward values at every byte boundary of every word
        ahead = np.full(n + len(self.length), -np.inf)
        base = self.start + np.arange(len(self.length))
        logp = np.log(np.maximum(p, 1e-300))
        ahead[base] = 0.0
        for t in range(1, steps + 1):
            k = self.live[t - 1]
            acc = np.full(k, -np.inf)
            for m in range(1, min(t, self.most) + 1):
                arc = self.arc[self.start[:k] + t - m, m - 1]
                some = np.flatnonzero(arc >= 0)
                acc[some] = np.logaddexp(acc[some], ahead[base[some] + t - m] + logp[arc[some]])
            ahead[base[:k] + t] = acc
        back = np.full(len(ahead), -np.inf)
        back[base + self.length] = 0.0
        whole = ahead[base + self.length]
        out = np.zeros(size)
        for t in range(steps - 1, -1, -1):
            k = self.live[t]
            acc = np.full(k, -np.inf)
            for m in range(1, self.most + 1):
                arc = np.where(self.length[:k] - t >= m, self.arc[self.start[:k] + t, m - 1], -1)
                some = np.flatnonzero(arc >= 0)
                way = logp[arc[some]] + back[base[some] + t + m]
                acc[some] = np.logaddexp(acc[some], way)
                np.add.at(out, arc[some], weight[some] * np.exp(ahead[base[some] + t] + way - whole[some]))
            back[base[:k] + t] = acc
        return out


def lattices(data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> Iterator[tuple[int, int, Lattice]]:
    for a in range(0, len(offsets) - 1, WORDS_AT_ONCE):
        b = min(a + WORDS_AT_ONCE, len(offsets) - 1)
        yield a, b, Lattice(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], pieces)


@dataclass
class Model:
    pieces: Pieces
    langs: list[str]
    p: np.ndarray

    def likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log P(text | language) per text and language."""
        words = Words(data, offsets)
        d = distinct(words)
        by_word = np.zeros((len(d.offsets) - 1, len(self.langs)))
        size = np.diff(d.offsets)
        raw, bounds, short = d.data, d.offsets, np.flatnonzero(size <= LONG)
        if len(short) < len(size):
            raw, bounds = raw[np.repeat(size <= LONG, size)], np.append(0, np.cumsum(size[short]))
            for k in np.flatnonzero(size > LONG).tolist():
                by_word[k] = Lattice(d.data[d.offsets[k] : d.offsets[k + 1]], np.array([0, size[k]]), self.pieces).whole(self.p)
        for a, _, lattice in lattices(raw, bounds, self.pieces):
            by_word[short[a + lattice.order]] = lattice.forward(self.p)
        rows = len(offsets) - 1
        return np.column_stack([np.bincount(words.doc, by_word[d.which, k], rows) for k in range(len(self.langs))]) if len(d.which) else np.zeros((rows, len(self.langs)))


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS)) == 1


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of every slice."""
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        words = Words(data, offsets)
        d = distinct(words)
        names, code = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        raw = d.data.tobytes()
        for k, name in enumerate(names):
            n = np.bincount(d.which[code[words.doc] == k], minlength=len(d.offsets) - 1)
            some = np.flatnonzero((n > 0) & (np.diff(d.offsets) <= TRAIN_BYTES))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array([raw[d.offsets[i] : d.offsets[i + 1]] for i in some.tolist()], pa.binary()), pa.array(n[some], pa.int64())], names=["lang", "word", "n"])


def fit(docs: DataFrame, path: str | None = None, rows: int = TRAIN_ROWS) -> Model:
    import public_tokenizers

    spark = ship(docs.sparkSession)
    pieces = Pieces.read(path or public_tokenizers.path("piece_bpe_32k.model"))
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model(pieces, [], np.zeros((pieces.size + 1, 0)))
    share = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(min(1.0, rows / sizes[name])))])
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    counted = materialize(sample.select("lang", "text").mapInArrow(_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    p = np.full((pieces.size + 1, len(langs)), 1 / pieces.size)
    p[-1] = 0
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((pieces, p))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, p = shared.value
            total = np.zeros((pieces.size, len(langs)))
            for batch in batches:
                lang = np.array(batch.column("lang").to_pylist(), object)
                word, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy(zero_copy_only=False)
                for k, name in enumerate(langs):
                    mine = lang == name
                    if mine.any():
                        some = word[mine].tolist()
                        offsets = np.append(0, np.cumsum([len(w) for w in some]))
                        for a, b, lattice in lattices(np.frombuffer(b"".join(some), np.uint8), offsets, pieces):
                            total[:, k] += lattice.expected(p[:, k], n[mine][a:b].astype(float), pieces.size)
            piece, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[piece, k])], names=["k", "piece", "n"])

        count = np.full((pieces.size, len(langs)), SMOOTH)
        sums = counted.mapInArrow(run, "k int, piece int, n double").groupBy("k", "piece").agg(F.sum("n").alias("n")).toArrow()
        at = sums.column("piece").to_numpy(), sums.column("k").to_numpy()
        count[at] += sums.column("n").to_numpy()
        shared.unpersist()
        p = np.vstack([count / count.sum(0), np.zeros((1, len(langs)))])
    return Model(pieces, langs, p)


def predict(docs: DataFrame, path: str | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, path, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = model.value.langs
        # larger slices: a word that recurs in a slice is scored once
        for batch in slices(batches, limit=6 << 20):
            lettered = np.array([bool(t and _LETTER(t)) for t in batch.column("text").to_pylist()], bool)
            names, score = np.array(["und"] * batch.num_rows, object), np.zeros(batch.num_rows)
            if langs:
                ll = model.value.likelihoods(*text_bytes(batch.column("text")))
                best = ll.argmax(1)
                share = 1 / np.exp(ll - ll.max(1, keepdims=True)).sum(1)
                names[lettered] = np.array(langs, object)[best[lettered]]
                score[lettered] = share[lettered]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows_out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return rows_out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def query(docs: DataFrame) -> DataFrame:
    """The columns of op7 for every document."""
    return predict(docs)
