import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quaver.llm import decontam
from quaver.llm.textvec import LOWER, text_bytes
from samples import ODD

ITEMS = "item_id long, text string"


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items):
    words, hit, names = split(text), set(), set()
    for item, t in items:
        w = split(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    names |= {str(item)} if item is not None else set()
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 30)))) for k in range(12)] + [(100, None), (101, "!!"), (None, "lonely words only here"), (3, "same id twice"), (102, "Short one")]
    texts = []
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            t = rng.choice(items)[1] or ""
            words[rng.randrange(len(words) + 1) : 0] = re.split(r"\s+", rng.choice([t, t.upper(), t.replace(" ", ", ")]))
        texts.append(" ".join(words))
    return [*texts, "a short ONE, twice: short one", "lonely-words only; HERE", *ODD], items


def test_against_brute_force(spark, make):
    texts, items = case(1)
    rows = decontam.query(make(texts), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(map(tuple, rows)) == sorted((k, *plain(t, items)) for k, t in enumerate(texts))


def test_large_benchmarks_go_in_parts(spark, make):
    texts, items = case(2)
    bench = spark.createDataFrame(items, ITEMS)
    docs = make(texts).select("doc_id", "text")
    flat = lambda df: sorted((r.doc_id, str(r.found)) for r in df.collect())
    assert flat(decontam.scan(docs, bench, limit=4000)) == flat(decontam.scan(docs, bench))


def test_removal(spark, make):
    texts, items = case(3)
    bench = spark.createDataFrame(items, ITEMS)
    docs = make(texts)
    clean = decontam.remove_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [k for k, t in enumerate(texts) if not plain(t, items)[4]]
    cut = decontam.remove_spans(docs, bench)
    for r in cut.collect():
        assert len(split(r.text)) == plain(texts[r.doc_id], items)[0] - plain(texts[r.doc_id], items)[1]


def test_the_bound_is_on_the_set():
    import pickle

    rng = random.Random(6)
    rows = [(str(k), " ".join(f"{rng.randrange(16**6):x}" for _ in range(2000))) for k in range(20)]
    rows += [("same", "a b c d e f g h i j " * 3000)] * 3
    grams = decontam.Grams(rows)
    bound = sum(len(t) + decontam.WINDOW_BYTES * len(split(t)) for _, t in rows)
    assert len(pickle.dumps(grams)) <= bound + (1 << 16)


def test_windows_of_one_hash_are_told_apart(spark, make, monkeypatch):
    from quaver.llm.textvec import Words

    monkeypatch.setattr(Words, "hashes", lambda self, kind=0: np.zeros(len(self.start), np.uint64))
    texts, items = case(4)
    grams = decontam.Grams([(str(i) if i is not None else None, t) for i, t in items])
    for text in texts:
        data, offsets = text_bytes(pa.array([text], pa.string()))
        words = Words(LOWER[data], offsets, decontam.STOP)
        hit = {j for i, w, _ in grams.scan(words) for j in range(i, i + w)}
        names = {x for _, _, some in grams.scan(words) for x in some}
        assert (len(hit), len(names)) == plain(text, items)[1:3]


def test_taken_names(spark, make):
    texts, items = case(5)
    docs = make(texts).withColumn("Found", F.lit(1))
    assert decontam.remove_documents(docs, spark.createDataFrame(items, ITEMS)).columns == docs.columns
    assert {r["Found"] for r in decontam.remove_spans(docs, spark.createDataFrame(items, ITEMS)).collect()} == {1}


def test_empty(spark, make):
    none = spark.createDataFrame([], ITEMS)
    assert [r.contaminated for r in decontam.query(make(["a b"]), none).collect()] == [False]
    assert decontam.query(make(["x"]).where("false"), none).count() == 0
