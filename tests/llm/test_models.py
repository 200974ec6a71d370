"""Toxicity, language id and main-text extraction: held-out accuracy and odd inputs."""

import random
import zlib

import numpy as np

from quaver.llm import htmltext, langid, toxicity
from samples import ODD

LABELS = "doc_id long, quality int, toxic int"


def invented(seed, n=500):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(800)]
    bad = ["vilgroth", "smerkin", "quazzle"]
    rows = []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 150))]
        if k % 6 == 0:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(bad) + rng.choice(["", ",", "."]))
        rows.append((" ".join(text), int(k % 6 == 0)))
    return rows


def test_toxicity(spark, make):
    rows = invented(1)
    texts = [t for t, _ in rows] + ODD
    labels = spark.createDataFrame([(k, 1, y) for k, (_, y) in enumerate(rows)] + [(None, 1, 1), (5, 1, None), (10**9, 1, 1)], LABELS)
    got = {r.doc_id: r for r in toxicity.query(make(texts), labels).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    held = [k for k in range(len(rows)) if got[k].held_out]
    assert sum(got[k].predicted != rows[k][1] for k in held) <= 0.03 * len(held)
    # labels of held-out rows are not looked at
    flipped = spark.createDataFrame([(k, 1, 1 - y if got[k].held_out else y) for k, (_, y) in enumerate(rows)], LABELS)
    again = {r.doc_id: r.score for r in toxicity.query(make(texts), flipped).collect()}
    assert all(abs(again[k] - got[k].score) < 1e-9 for k in got)


def test_toxicity_without_classes(spark, make):
    rows = toxicity.query(make(["x", None]), spark.createDataFrame([(0, 1, 0)], LABELS)).collect()
    assert [(r.score, r.predicted) for r in rows] == [(0.0, 0)] * 2
    assert toxicity.query(make(["x"]).where("false"), spark.createDataFrame([], LABELS)).count() == 0


def test_ngram_keys():
    d = toxicity.Distinct(np.frombuffer(b"abcdefgh", np.uint8), np.array([0, 2, 8]), np.array([0, 1]))
    key, word = toxicity.keys(d)
    as_bytes = [int(k).to_bytes(8, "big").lstrip(b"\0") for k in key]
    assert as_bytes == [b"\1a", b"\1ab", b"\1ab\2", b"\1c", b"\1cd", b"\1cde", b"\1cdef", b"\1cdefg", b"\1cdefgh", b"\1cdefgh\2"]
    assert word.tolist() == [0] * 3 + [1] * 7


def test_counts_are_exact_and_grow(spark):
    rows = [(t, y) for seed in range(6) for t, y in invented(seed, 120)]
    counts = toxicity.count(spark.createDataFrame(rows, "text string, y int"))
    plain = ({}, {})
    for text, y in rows:
        for word in text.encode().replace(b",", b" ").replace(b".", b" ").split():
            symbols = b"\1" + word + b"\2"
            for k in range(1, len(symbols)):
                gram = symbols[max(0, k - 7) : k + 1]
                plain[y][gram] = plain[y].get(gram, 0) + 1
    grams = sorted(set(plain[0]) | set(plain[1]))
    four, four_context, two = {}, {}, {}
    for key in {int.from_bytes(g, "big") for g in grams}:
        four[key & 0xFFFFFFFF] = four.get(key & 0xFFFFFFFF, 0) + 1
    for key, n in four.items():
        four_context.setdefault(key >> 8, []).append(n)
        two[key & 0xFFFF] = two.get(key & 0xFFFF, 0) + 1
    context = [{}, {}]
    for c in (0, 1):
        for gram, n in plain[c].items():
            context[c].setdefault(int.from_bytes(gram, "big") >> 8, []).append(n)

    def log_p(key, c):
        after = [n for k, n in two.items() if k >> 8 == key >> 8 & 0xFF]
        p = (max(two.get(key & 0xFFFF, 0) - 0.75, 0) + 0.75 * len(after) / 256) / sum(after) if after else 1 / 256
        seen = four_context.get(key >> 8 & 0xFFFFFF, [])
        p = (max(four.get(key & 0xFFFFFFFF, 0) - 0.75, 0) + 0.75 * len(seen) * p) / sum(seen) if seen else p
        held = context[c].get(key >> 8, [])
        n = plain[c].get(key.to_bytes(8, "big").lstrip(b"\0"), 0)
        return np.log((max(n - 0.75, 0) + (0.75 * len(held) + 30) * max(p, 1e-9)) / (sum(held) + 30))

    ask = [int.from_bytes(g, "big") for g in grams]
    got = counts.difference(np.array(ask, np.uint64))
    assert len(ask) > 8000 and np.allclose(got, [log_p(k, 1) - log_p(k, 0) for k in ask], rtol=1e-4, atol=1e-5)


def test_all_rows_but_the_calibrating_ones_are_counted(spark, make, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 40)
    rows, seen = invented(1, 300), []
    count = toxicity.count
    monkeypatch.setattr(toxicity, "count", lambda labelled, *rest: (seen.append(labelled.count()), count(labelled, *rest))[1])
    labels = spark.createDataFrame([(k, 1, y) for k, (_, y) in enumerate(rows)], LABELS)
    toxicity.fit(make([t for t, _ in rows]), labels)
    assert seen == [sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(300)) - 40]


def test_toxicity_beyond_the_broadcast(spark, make):
    rows = invented(1, 200)
    docs = make([t for t, _ in rows] + ODD + [rows[0][0]], ids=[*range(200 + len(ODD)), None])
    labels = spark.createDataFrame([(k, 1, y) for k, (_, y) in enumerate(rows)], LABELS)
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    want = sorted(toxicity.score(docs, labels).collect(), key=key)
    got = sorted(toxicity.score(docs, labels, limit=0, common_words=50).collect(), key=key)
    assert [(r.doc_id, r.held_out) for r in got] == [(r.doc_id, r.held_out) for r in want]
    assert np.allclose([r.score for r in got], [r.score for r in want], rtol=1e-4, atol=1e-6)


def plain_forward(word, pieces, p):
    """Sum over all segmentations, one by one."""
    if not word:
        return 1.0
    return sum(p[pieces[word[:m]]] * plain_forward(word[m:], pieces, p) for m in range(1, len(word) + 1) if word[:m] in pieces)


def small_pieces():
    texts = [b" ", b"a", b"b", b"ab", b" a", b"ba", b" ab"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    h = langid.spans(langid.prefix(data), np.append(0, ends[:-1]), ends)
    table = np.full(1 << 20, -1, np.int32)
    table[langid.Pieces.slot(h, 0)] = np.arange(len(texts))
    return langid.Pieces(h, [table], 3, 256 + len(texts)), {t: 256 + k for k, t in enumerate(texts)}


def test_forward_sums_all_segmentations():
    pieces, number = small_pieces()
    p = np.random.default_rng(1).random((pieces.size + 1, 2))
    p[-1] = 0
    words = [b"ab", b"abba", b"b", b"aabab"]
    lattice = langid.Lattice(np.frombuffer(b"".join(words), np.uint8), np.append(0, np.cumsum([len(w) for w in words])), pieces)
    got = np.exp(lattice.forward(p))
    for row, k in zip(got, lattice.order, strict=True):
        assert np.allclose(row, [plain_forward(b" " + words[k], number, p[:, j]) for j in (0, 1)])
    counts = lattice.expected(p[:, 0], np.ones(len(words)), pieces.size)
    spelled = sum(c * len(t) for t, c in zip(number, counts[256:], strict=True))
    assert np.isclose(spelled, sum(len(w) + 1 for w in words))


def test_long_words_go_in_parts(monkeypatch):
    import public_tokenizers

    pieces = langid.Pieces.read(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(2)
    p = np.vstack([rng.random((pieces.size, 3)) ** 8 + 1e-9, np.zeros((1, 3))])
    for parts in (2, 256):
        monkeypatch.setattr(langid, "PARTS_AT_ONCE", parts)
        for n in (1, 40, 127, 128, 400, 3000):
            word = "".join(rng.choice(list("etaoinshrdü你"), n)).encode()
            lattice = langid.Lattice(np.frombuffer(word, np.uint8), np.array([0, len(word)]), pieces)
            assert np.allclose(lattice.whole(p), lattice.forward(p)[0], rtol=1e-9)
    model = langid.Model(pieces, ["a", "b", "c"], p)
    text = np.frombuffer(word + b" and more " + word[:600] + b" x", np.uint8)
    apart = [model.likelihoods(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0] for w in bytes(text).split()]
    assert np.allclose(model.likelihoods(text, np.array([0, len(text)]))[0], np.sum(apart, 0))


def test_every_piece_is_kept():
    import public_tokenizers

    pieces = langid.Pieces.read(public_tokenizers.path("piece_bpe_32k.model"))
    word = " населения".encode()
    lattice = langid.Lattice(np.frombuffer(word[1:], np.uint8), np.array([0, len(word) - 1]), pieces)
    assert pieces.size - 256 == 31741 and pieces.longest >= len(word) and lattice.arc[0, len(word) - 1] >= 256


def test_language(make):
    rng = random.Random(3)
    vocabulary = {"en": "the of and house water light never under small which".split(), "de": "der die und haus wasser nicht unter klein welche über".split(), "fr": "le la et maison eau lumière jamais sous petite très".split()}
    lang = [rng.choice(list(vocabulary)) for _ in range(240)]
    texts = [" ".join(rng.choice(vocabulary[x]) for _ in range(rng.randrange(3, 30))) for x in lang] + ODD + ["123 !?", None]
    lang += [None] * (len(texts) - len(lang))
    got = {r.doc_id: r for r in langid.query(make(texts, lang=lang)).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    assert sum(got[k].lang_pred != lang[k] for k in range(240)) <= 3
    assert [got[k].lang_pred for k in (240, 241, 242, 245, len(texts) - 2)] == ["und"] * 5 and got[246].lang_pred != "und"
    assert langid.query(make(["x"])).first().lang_pred == "und"
    assert langid.query(make(["x"]).where("false")).count() == 0


PAGE = "page_id long, url string, html string"


def test_extraction(spark):
    body = "<p>First &amp; last   words\n here.</p><p><b>Bold<br><p>Next one &eacute;</p><ul><li>point</li></ul>"
    page = f'<html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li><li><a>Two</a></li></ul></nav><div class="ad">Buy now</div><article><h1>Head</h1>{body}</article><div class="comments"><p>I like it</p></div><footer>&copy; us</footer></body></html>'
    cut = "<nav><a>m</a></nav><article><p>Whole text</p><p>cut &am"
    rows = htmltext.query(spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", cut), (4, "u", cut), (None, "u", "<")], PAGE)).collect()
    got = {r.page_id: r.text for r in rows}
    assert got[1] == "Head\nFirst & last words here.\nBold\nNext one é\npoint"
    assert got[2] == got[3] == "" and got[4] == "Whole text\ncut &am" and len(rows) == 6
    assert all(r.n_chars == len(r.text) for r in rows)
    assert htmltext.query(spark.createDataFrame([], PAGE)).count() == 0


def test_labeller_on_made_pages():
    maker = htmltext.Maker(np.random.default_rng(123))
    made = [htmltext.labelled(maker.page()) for _ in range(120)]
    found = htmltext.train().main([x for x, _ in made])
    wrong = sum(int((p != (y > 0)).sum()) for p, (_, y) in zip(found, made, strict=True))
    assert wrong <= 0.02 * sum(len(y) for _, y in made)
