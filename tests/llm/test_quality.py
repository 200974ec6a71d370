import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quaver.llm import quality
from quaver.llm.textvec import Words, text_bytes
from samples import ODD

LABELS = "doc_id long, quality int, toxic int"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] >= 2 for j in (i, i + 1, i + 2)}
    n, r = len(words), len(hit)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n)


def test_base_counts(spark, make):
    rng = random.Random(1)
    texts = [*ODD, "a b c a b c", "x\nx\n x\n\nx", "#|<> $", *(" ".join(rng.choice("a b c dd é".split()) for _ in range(rng.randrange(1, 200))) for _ in range(20))]
    none = spark.createDataFrame([], LABELS)
    for r in quality.query(make(texts), none).collect():
        want = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept == (not want[5])  # nothing to learn from: the rules decide


def corpus(rng, n):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    good = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(60, 120)))
    return [(good(), 1) if k % 5 else (" ".join(w + "%%%" for w in good().split()), 0) for k in range(n)]


def test_held_out_accuracy(spark, make):
    rows = corpus(random.Random(2), 600)
    labels = spark.createDataFrame([(k, y, 0) for k, (_, y) in enumerate(rows) if k < 400] + [(None, 1, 0), (3, None, 0), (99999, 0, 0)], LABELS)
    got = {r.doc_id: r for r in quality.query(make([t for t, _ in rows]), labels).collect()}
    wrong = [k for k in range(400, 600) if not got[k].base_failed and got[k].kept != bool(rows[k][1])]
    assert len(wrong) <= 2
    kept = quality.filter_documents(make([t for t, _ in rows]), labels)
    assert kept.columns == make(["x"]).columns and kept.count() == sum(r.kept for r in got.values())


def test_calibration_cannot_run_off():
    near = np.array([3.5, 3.4, 3.6, 3.5, 3.45, 3.55])
    for score, y in ((near, [1, 1, 1, 1, 1, 0]), (np.array([9.0, 12, 17, 22, 26, 30, -15]), [1, 1, 1, 1, 1, 1, 0]), (near, [1] * 6), (near, [0] * 6), (np.array([2.0, 2, 2]), [1, 0, 1]), (-near, [1, 0, 1, 1, 0, 1])):
        y = np.array(y, float)
        a, b = quality._platt(score, y)
        p = 1 / (1 + np.exp(-(a * score + b)))
        assert a >= 0 and np.isfinite([a, b]).all()
        # no better than any other slope and intercept in sight, for the smoothed targets
        t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        loss = lambda p: -(t * np.log(p) + (1 - t) * np.log(1 - p)).sum()
        if a > 0:
            grid = min(loss(1 / (1 + np.exp(-np.clip(s * (score - c), -30, 30)))) for s in np.linspace(0.01, 20, 60) for c in np.linspace(score.min() - 5, score.max() + 5, 80))
            assert loss(p) <= grid + 1e-2
        else:
            assert np.allclose(p, (y.sum() + 1) / (len(y) + 2))


def test_one_class_nearly_absent(spark, make):
    rows = corpus(random.Random(5), 60)
    labels = spark.createDataFrame([(k, 1 if k > 1 else 0, 0) for k in range(26)], LABELS)
    got = quality.query(make([t for t, y in rows if y] * 2), labels).collect()
    assert sum(r.kept for r in got) >= 0.9 * sum(not r.base_failed for r in got) > 0


def test_labels_without_a_document_take_no_room(spark, make):
    rows = corpus(random.Random(2), 300)
    labels = spark.createDataFrame([(k, y, 0) for k, (_, y) in enumerate(rows)] + [(10**6 + k, k % 2, 0) for k in range(3000)], LABELS)
    model = quality.fit(make([t for t, _ in rows]), labels, rows=200)
    assert np.abs(model.weights).max() > 0 and model.a > 0


def test_jobs_do_not_grow_with_the_partitions(spark, make):
    rows = corpus(random.Random(2), 200)
    labels = spark.createDataFrame([(k, y, 0) for k, (_, y) in enumerate(rows)], LABELS)
    jobs = []
    for parts in (2, 40):
        spark.sparkContext.setJobGroup(f"fit-{parts}", "")
        quality.fit(make([t for t, _ in rows]).repartition(parts), labels)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{parts}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 3


def test_built_collisions_are_no_duplicates(spark, make):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    row = quality.query(make([f"{word}\n{other}", f"{word} x y {other} x y"]), spark.createDataFrame([], LABELS)).collect()
    assert {(r.n_dup_lines, r.n_repeat_words) for r in row} == {(0, 0)}


def test_character_grams():
    import pyarrow as pa

    texts = ["aé你😀b", "", "xy", "你好世界"]
    data, offsets = text_bytes(pa.array(texts))
    symbol, bounds = quality._symbols(data, offsets)
    assert np.diff(bounds).tolist() == [5, 0, 2, 4]
    words = Words(data, offsets)
    kinds = list(quality._slots(data, offsets, words, words.hashes()))
    assert [np.diff(b).tolist() for _, b in kinds[2:]] == [[3, 0, 0, 2], [2, 0, 0, 1]]
    # equal characters anywhere fall in one slot
    more, at = text_bytes(pa.array(["zz你好世界", "你好世界"]))
    w = Words(more, at)
    again = list(quality._slots(more, at, w, w.hashes()))
    for (slot, b), (slot2, b2) in zip(kinds[2:], again[2:], strict=True):
        assert slot[b[3] : b[4]].tolist() == slot2[b2[1] : b2[2]].tolist() == slot2[b2[0] : b2[1]].tolist()[2:]


def test_taken_names(spark, make):
    docs = make([t for t, _ in corpus(random.Random(1), 20)]).withColumn("Quality", F.lit(3)).withColumn("quality_", F.lit(4))
    kept = quality.filter_documents(docs, spark.createDataFrame([], LABELS))
    assert kept.columns == docs.columns and kept.count() > 0 and {r["Quality"] for r in kept.collect()} == {3}


def test_empty(spark, make):
    assert quality.query(make(["x"]).where("false"), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0
