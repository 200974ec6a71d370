import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quaver.llm.textvec import Words, rolled, slices, text_bytes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x1f\u2003", max_size=40)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words = Words(data, offsets)
    found = [data[a:b].tobytes().decode() for a, b in zip(words.start, words.end, strict=True)]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert found == [w for x in want for w in x] and words.count.tolist() == [len(x) for x in want]
    h = words.hashes()
    assert len(set(h.tolist())) == len(set(found)) and all((a == b) == (x == y) for a, x in zip(h, found, strict=True) for b, y in zip(h, found, strict=True))
    at = words.windows(2)
    assert len(at) == sum(max(0, len(x) - 1) for x in want)
    pairs = [(found[i], found[i + 1]) for i in at]
    assert len(set(rolled(h, 2)[at].tolist())) == len(set(pairs))


def test_slices_are_whole_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 100, "", "c"])], names=["text"])
    parts = list(slices([batch, batch.slice(2, 2)], limit=12))
    assert [x for p in parts for x in p.column("text").to_pylist()] == [*batch.column("text").to_pylist(), "b" * 100, ""]
    assert np.concatenate([text_bytes(p.column("text"))[1] for p in parts if p.num_rows]).max() == 100
