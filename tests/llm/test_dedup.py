"""Substring dedup and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from quaver.llm import linededup, substring
from quaver.llm.textvec import Words
from samples import ODD


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = [[f"s{k}w{j}" for j in range(rng.randrange(13, 60))] for k in range(6)]
    texts = []
    for k in range(n):
        words = [f"d{k}x{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(shared)
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return [*texts, texts[3], texts[3], *ODD]


def plain_substrings(rows, width=13):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            first[w] = min(i, first.get(w, i))
    out = []
    for i, words in split:
        gone = {k + j for k in range(len(words) - width + 1) if first[tuple(words[k : k + width])] < i for j in range(width)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substrings(make):
    texts = passages(1)
    got = sorted(map(tuple, substring.query(make(texts)).collect()))
    assert got == plain_substrings(list(enumerate(texts)))


def test_batches_runs_and_compaction_do_not_matter(spark, make):
    texts = passages(2, 40)
    docs = make(texts).select("doc_id", "text")
    want = plain_substrings(list(enumerate(texts)))
    for batches in (1, 7):
        rows = substring.dedup_substrings(docs, batches=batches, shards=3).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows) == want


def test_repeated_and_unordered_ids(make):
    base = " ".join(f"w{k}" for k in range(20))
    rows = [(5, base), (5, base), (9, base + " more"), (None, base)]
    got = substring.query(make([t for _, t in rows], ids=[i for i, _ in rows])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (5, 0), (5, 0), (9, 20)]
    assert substring.query(make(["x"]).where("false")).count() == 0


def thue_morse(n):
    """Two words of 2**n letters that collide under every polynomial modulo 2**64."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_built_collisions(make):
    a, b = thue_morse(10)
    texts = [" ".join([*"abcdefghijkl", w]) for w in (a, b, a)]
    assert sorted((r.doc_id, r.n_removed) for r in substring.query(make(texts)).collect()) == [(0, 0), (1, 0), (2, 13)]


def test_index_outlives_its_application(spark, make, tmp_path):
    texts = passages(7, 30)
    docs = make(texts).select("doc_id", "text")
    index = substring.SubstringIndex(spark, shards=3)
    first = index.ingest(docs.where("doc_id < 15"))
    index.save(str(tmp_path / "index"))
    index.drop()
    again = substring.SubstringIndex.load(spark, str(tmp_path / "index"))
    hits = first.union(again.ingest(docs.where("doc_id >= 15")))
    rows = again.remove(docs, hits).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows) == plain_substrings(list(enumerate(texts)))


def test_taken_names(make):
    docs = make(["a b", "a b"]).withColumnsRenamed({"fp": "Kept_Text", "key": "hit_id", "y": "hit_mark"})
    got = substring.dedup_substrings(docs).first()
    assert [got[c] for c in ("mark", "n_words", "Kept_Text", "kept_text_", "n_words_", "n_removed")] == [None, None, None, "a b", 2, 0]


def test_packing():
    x = np.unique(np.random.default_rng(1).integers(0, 2**64 - 1, 500, np.uint64))
    assert (substring.unpack(substring.pack(x), np.uint64) == x).all()


def merged(rows, runs=None):
    """What one shard finds among rows, and its run."""
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    out = substring._merge(pa.Table.from_batches(substring._deal(1, 13)(iter([batch]))), runs or pa.table({"blob": pa.array([], pa.binary())}))
    return sorted({r["doc_id"] for r in out.to_pylist() if r["kind"] == 0}), out.filter(pc.equal(out.column("kind"), 1))


def test_equal_fingerprints_are_verified(monkeypatch):
    hashes = Words.hashes
    monkeypatch.setattr(Words, "hashes", lambda self, kind=0: np.zeros(len(self.start), np.uint64) if kind == 0 else hashes(self, kind))  # every window has the same fingerprint
    a, b, c = (" ".join(f"{x}{k}" for k in range(13)) for x in "abc")
    found, run = merged([(1, a), (2, b), (3, a)])
    assert found == [3]
    assert merged([(4, c), (5, b), (6, a)], run)[0] == [5, 6]
    both = pa.concat_tables([run, merged([(4, c)], run)[1]])
    assert merged([(7, c), (8, "d " * 13), (9, a)], substring._compact(both))[0] == [7, 9]


def test_run_packing():
    h = np.unique(np.random.default_rng(2).integers(0, 2**64 - 1, 500, np.uint64))
    check = np.arange(len(h)).astype(np.uint16)
    assert all((x == y).all() for x, y in zip(substring.unpack_run(substring.pack_run(h, check)), (h, check), strict=True))


def lines_of(seed, n=40):
    rng = random.Random(seed)
    common = ["All rights reserved", "MENU", "a|b", "é line", " x "]
    texts = []
    for k in range(n):
        own = [f"line {k} {j}" for j in range(rng.randrange(0, 5))] + [rng.choice([" ", "\t", ""]) + rng.choice([c, c.upper(), c.lower()]) for c in rng.choices(common, k=3)]
        rng.shuffle(own)
        texts.append("\n".join(own + [""] * rng.randrange(2)))
    return [*texts, *ODD]


def plain_lines(texts, least):
    fold = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\r\x0b\x0c"))
    split = [(t or "").split("\n") for t in texts]
    count = {}
    for lines in split:
        for key in {fold(x) for x in lines}:
            count[key] = count.get(key, 0) + 1
    out = []
    for k, lines in enumerate(split):
        kept = [x for x in lines if not fold(x) or count[fold(x)] < least]
        out.append((k, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_lines(make):
    texts = lines_of(1)
    assert sorted(map(tuple, linededup.query(make(texts)).collect())) == plain_lines(texts, 10)


@pytest.mark.parametrize("limit", [linededup.BROADCAST_BYTES, 0])
def test_lines_come_and_go(spark, make, limit):
    first, more = lines_of(2), lines_of(3, 25)
    ids = list(range(1000, 1000 + len(more)))
    a, b = make(first).select("doc_id", "text"), make(more, ids=ids).select("doc_id", "text")
    index = linededup.LineIndex.empty(spark, min_docs=8, shards=4).insert(a).insert(b)
    both = plain_lines([*first, *more], 8)[: len(first)]
    digest = lambda df: sorted((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in df.collect())
    assert digest(index.apply(a, report=True, limit=limit)) == both
    back = index.delete(b)
    assert digest(back.apply(a, report=True, limit=limit)) == plain_lines(first, 8)
    assert sorted(map(tuple, back.refs.collect())) == sorted(map(tuple, linededup.LineIndex.empty(spark, 8, 4).insert(a).refs.collect()))
    with pytest.raises(Exception, match="never inserted"):
        back.delete(b).refs.collect()


def test_line_index_outlives_its_application(spark, make, tmp_path):
    first, more = lines_of(5), lines_of(6, 25)
    a, b = make(first).select("doc_id", "text"), make(more, ids=list(range(1000, 1000 + len(more)))).select("doc_id", "text")
    linededup.LineIndex.empty(spark, min_docs=8, shards=4).insert(a).insert(b).save(str(tmp_path / "index"))
    back = linededup.LineIndex.load(spark, str(tmp_path / "index")).delete(b)
    assert sorted((r.doc_id, r.n_dropped) for r in back.apply(a, report=True).collect()) == sorted((k, n) for k, _, n, _ in plain_lines(first, 8))


def test_shards_follow_the_keys(spark, make, monkeypatch):
    monkeypatch.setattr(linededup, "KEYS_EACH", 3)
    lines = [f"line {k}" for k in range(40)]
    docs = make(["\n".join(lines[:20]), "\n".join(lines[:20]), "\n".join(lines), "\n".join(lines)])
    small = linededup.LineIndex.empty(spark, min_docs=2, shards=1).insert(docs.where("doc_id < 2"))
    index = small.insert(docs.where("doc_id >= 2"))
    assert (small.shards, index.shards) == (8, 16)
    assert all(r.n_dropped == r.n_lines for r in index.apply(docs.select("doc_id", "text"), report=True).collect())


def test_full_filters_are_built_anew(spark, make):
    few, many = (["\n".join(f"line {k}" for k in range(n))] * 2 for n in (3, 500))
    index = linededup.LineIndex.empty(spark, min_docs=2, shards=1).insert(make(few)).insert(make(many))
    assert len(index.filters.first()["filter"]) >= 500 * 2
    assert all(r.n_dropped == 500 for r in index.apply(make(many).select("doc_id", "text"), report=True).collect())


@pytest.mark.parametrize("limit", [linededup.BROADCAST_BYTES, 0])
def test_taken_line_names(spark, make, limit):
    docs = make(lines_of(2)).withColumn("mark", F.lit(7)).withColumn("found", F.lit("f"))
    index = linededup.LineIndex.empty(spark, min_docs=8).insert(docs)
    for r in index.apply(docs, report=True, limit=limit).collect():
        assert (r.mark, r.found, r.n_lines) == (7, "f", None) and r["n_lines_"] >= r.n_dropped
    assert index.apply(docs, limit=limit).columns == docs.columns


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    hi, lo = rng.integers(-(2**63), 2**63 - 1, (2, 5000))
    f = linededup.Cuckoo.sized(5000)
    assert f.insert(hi, lo)
    probe = linededup.Probe([(0, f.tags.tobytes())], hi, lo, 1)
    key = np.stack([hi, lo], 1)
    assert probe.maybe(key).all() and probe.held(key).all()
    other = rng.integers(-(2**63), 2**63 - 1, (20000, 2))
    assert probe.maybe(other).mean() < 0.01 and not probe.held(other).any()
    f.delete(hi[:2500], lo[:2500])
    assert linededup.Probe([(0, f.tags.tobytes())], hi, lo, 1).maybe(key[2500:]).all()
    assert not linededup.Cuckoo.sized(4).insert(hi, lo)


def test_columns_and_empty(make):
    docs = make(lines_of(4))
    assert linededup.dedup_lines(docs).columns == docs.columns
    assert linededup.query(docs.where("false")).count() == 0
