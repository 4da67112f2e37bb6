import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sameitem.llm.common import batch_words, shingle_hashes

TEXT = st.text(alphabet="aAbZz \t\n\x0b.é -", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words_are_those_of_the_shared_rule(texts):
    found, names = [], {}
    for w in batch_words(pa.array(texts, pa.string())):
        at = w.bounds()
        for i in range(w.last - w.first):
            found.append([bytes(w.data[s:e]).lower() for s, e in zip(w.start[at[i]:at[i + 1]], w.end[at[i]:at[i + 1]])])
        for s, e, h in zip(w.start, w.end, w.hash):
            word = bytes(w.data[s:e]).lower()
            assert names.setdefault(word, h) == h
    want = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()) for t in texts]
    assert found == want
    assert len(set(names.values())) == len(names)


def test_shingles_of_short_and_long_sequences():
    w = np.arange(1, 8, dtype=np.uint64)
    assert len(shingle_hashes(w, 5)) == 3
    assert len(shingle_hashes(w[:5], 5)) == len(shingle_hashes(w[:3], 5)) == 1
    assert shingle_hashes(w[:4], 5)[0] != shingle_hashes(w[:5], 5)[0]
    assert len(shingle_hashes(w[:0], 5)) == 0
