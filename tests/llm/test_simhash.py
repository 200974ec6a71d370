import random

import numpy as np
import xxhash

from quaver.llm import simhash
from samples import ODD


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def plain_components(pairs):
    label = {i: i for i, _ in pairs}
    changed = True
    while changed:
        changed = False
        for i, a in pairs:
            for j, b in pairs:
                if bin(a ^ b).count("1") <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_fingerprints(make):
    texts = [*ODD, "A b C", "one two three four", "one two three four five"]
    got = {r.doc_id: r.fingerprint for r in simhash.query(make(texts)).collect()}
    assert got == {k: f"{plain_fingerprint(t):016x}" for k, t in enumerate(texts)}


def clusters(seed, near=120, others=150):
    """Chains and balls around a few fingerprints, and loners."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(others)]
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(near // 6):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 7)))
            out.append(at)
    center = rng.getrandbits(64)
    return [*out, *(center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))) for _ in range(60))]


def check(spark, values, **options):
    values = sorted(set(values))
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    fps = spark.createDataFrame([(signed(x),) for x in values], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(fps, **options).collect()]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in links)
    want = plain_components([(k, x) for k, x in enumerate(values)])
    number = {x: k for k, x in enumerate(values)}
    label = {k: k for k in range(len(values))}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[number[a]], label[number[b]])
            for x in (a, b):
                if label[number[x]] != low:
                    label[number[x]], changed = low, True
    assert label == want


def test_links_join_what_is_near(spark):
    check(spark, clusters(1))


def test_crowded_buckets_and_whole_balls(spark):
    check(spark, clusters(2, others=30), crowd=3)
    check(spark, clusters(3, near=30, others=20), blocks=1)


def test_components_of_documents(make):
    base = " ".join(f"w{k}" for k in range(400))
    texts = [base, base + " tail", base.upper(), "other words here and there", None, "", None]
    rows = simhash.query(make(texts, ids=[9, 4, 12, 7, 3, 2, None])).collect()
    got = {r.doc_id: r.component_id for r in rows}
    assert got[12] == got[9] and got[7] == 7 and got[3] == got[2] == 2 and got[None] == 2
    kept = simhash.keep_one(make(texts, ids=[9, 4, 12, 7, 3, 2, None]))
    assert kept.columns == make(texts).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for i, c in got.items() if i is not None})


def test_one_row_of_each_component_stays(make):
    a, b, c = (" ".join(f"{x}{k}" for k in range(400)) for x in "abc")
    for rows, want in (
        ([(3, a), (5, a), (5, b)], [(3, a), (5, b)]),
        ([(5, b), (5, a), (3, a), (5, b)], [(3, a), (5, b)]),
        ([(5, a), (5, b), (7, a), (7, c)], [(5, a), (5, b), (7, c)]),
        ([(4, a), (4, a.upper()), (6, a)], 1),
    ):
        kept = simhash.keep_one(make([t for _, t in rows], ids=[i for i, _ in rows]))
        got = sorted((r.doc_id, r.text) for r in kept.collect())
        assert got == want if want != 1 else len(got) == 1 and got[0][0] == 4


def test_taken_names(make):
    from pyspark.sql import functions as F

    docs = make(["a b", "a b", "c d"]).withColumn("Kept_Id", F.lit(1)).withColumn("kept_mark", F.lit(2)).withColumn("root", F.lit(3))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r["Kept_Id"], r.kept_mark, r.root) for r in kept.collect()) == [(0, 1, 2, 3), (2, 1, 2, 3)]


def test_empty(make):
    assert simhash.query(make(["x"]).where("false")).count() == 0
