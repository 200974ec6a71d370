import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from quaver.llm import bpe
from samples import ODD


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [*ODD, "don't  stop\n\n now", "x" * 3000, "1234567890" * 50, "naïve ＡＢＣ 你好世界 привет", "a\u00a0b\u2003c\x1cd\x85e", "aaaabbbb" * 40, "thhehaed oneentwh"]


def test_same_ids_as_the_library(make, reference):
    for r in bpe.query(make(TEXTS)).collect():
        text = TEXTS[r.doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_then_decode(make, reference):
    docs = make(TEXTS)
    encoded = bpe.encode(docs)
    assert encoded.columns == [*docs.columns, "ids"]
    for r in bpe.decode(encoded).collect():
        assert r.ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.query(docs.where("false")).count() == 0


def contract(piece, ranks):
    """The ids of one piece, by the rule as it is stated: the leftmost pair of least rank, until none is left."""
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_queries_follow_the_rule(reference):
    vocabulary = bpe.vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(3)
    words = [b" thhehaed", b"achlichkeiten", "réeuxvi".encode(), b"zzzzzzzzzzz", b"abcabcabcabd", b"hhhhhhhh"]
    words += ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 400))).encode() for letters in ("ab", "etaoinshr", "абвгде", "的一是", "aeio ") for _ in range(20)]
    words = [w for w in words if w not in vocabulary.ranks]
    with bpe.Codec(vocabulary) as codec:
        ids, at = codec.merge(words)
    for k, w in enumerate(words):
        assert ids[at[k] : at[k + 1]].tolist() == contract(w, vocabulary.ranks) == reference._core_bpe.encode_single_piece(w)


def small(tokens):
    """A vocabulary of all bytes and some tokens, in this order."""
    ranks = {bytes([k]): k for k in range(256)} | {t: 256 + k for k, t in enumerate(tokens)}
    return ranks


@pytest.mark.parametrize("tokens", [[b"ba", b"aba", b"ab", b"abab"], [b"abc", b"bc", b"ab", b"ca"], [b"aab", b"aa", b"ba", b"aaaa"], [b"xyx", b"xy", b"yx", b"xyxyx"]])
def test_ranks_in_any_order(tokens, tmp_path):
    ranks = small(tokens)
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for t, k in ranks.items()))
    rng = random.Random(4)
    words = ["".join(rng.choice("abcxy"[a:b]) for _ in range(n)).encode() for n in (5, 30, 64, 65, 200) for a, b in ((0, 2), (0, 3), (3, 5)) for _ in range(6)]
    with bpe.Codec(bpe.Vocabulary.read(str(path), r"\S+")) as codec:
        ids, at = codec.merge(words)
    assert [ids[at[k] : at[k + 1]].tolist() for k in range(len(words))] == [contract(w, ranks) for w in words]


def test_long_unbroken_words(make, reference):
    rng = random.Random(5)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("etaoinshrdlu", 100_000), ("a", 200_000), ("ab", 100_000), ("的一是了", 20_000))]
    for r in bpe.query(make(texts)).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_taken_names(make):
    docs = make(["a b"]).withColumn("IDS", F.lit(1)).withColumn("decoded", F.lit("x"))
    back = bpe.decode(bpe.encode(docs), column="ids_").first()
    assert bytes(back["decoded_"]) == b"a b" and back["IDS"] == 1 and back["decoded"] == "x"
