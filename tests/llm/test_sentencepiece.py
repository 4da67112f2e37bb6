import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sameitem.llm import sentencepiece_codec as S
from tests.llm.helpers import documents, frame


@pytest.fixture(scope="module")
def vocab():
    return S.load_vocabulary()


def brute(vocab, text):
    """Best total score over all segmentations, by plain dynamic programming over a dictionary."""
    import sentencepiece
    sp = brute.sp = getattr(brute, "sp", None) or sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    if not hasattr(brute, "pieces"):
        brute.pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
                        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        brute.least = min(brute.pieces.values()) - S.UNKNOWN_PENALTY
    t = S.MARK + text.replace(" ", S.MARK)
    best = [0.0] + [float("-inf")] * len(t)
    for j in range(1, len(t) + 1):
        for i in range(max(0, j - 16), j):
            s = brute.pieces.get(t[i:j])
            if s is None and j - i == 1:
                s = brute.least
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def score(vocab, ids):
    total, k = 0.0, 0
    at = {int(b) for b in vocab.byte_ids if b >= 0}
    while k < len(ids):
        if ids[k] in at:
            lead = vocab.pieces[ids[k]][0]
            total += brute.least
            k += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        else:
            total += vocab.score[ids[k]]
            k += 1
    return total


TEXT = st.text(alphabet=st.one_of(st.sampled_from("the andoferinw ,.\n▁é"), st.characters(codec="utf-8")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_best_path_and_round_trip(text):
    vocab = S.load_vocabulary()
    ids = np.frombuffer(S.Encoder(vocab).encode([text])[0], np.int32)
    assert S.decode_ids(vocab, ids) == text.replace(S.MARK, " ")
    if text:
        assert score_after_brute(vocab, text, ids.tolist())


def score_after_brute(vocab, text, ids):
    want = brute(vocab, text)
    return abs(score(vocab, ids) - want) <= 1e-6 * max(1.0, abs(want))


def test_chunk_of_any_length_and_alone_agree(vocab):
    rng = random.Random(3)
    chunks = ["".join(rng.choice("therandé▁ni中") for _ in range(rng.randint(1, 60))).encode() for _ in range(200)]
    assert S.viterbi(vocab, chunks) == [S.viterbi_one(vocab, c) for c in chunks]


def test_trie_finds_each_piece_and_no_other():
    words = [b"a", b"ab", b"abc", b"b", b"bca", bytes([200, 1])]
    base, check, value = S.double_array(words)

    def find(w):
        s = 0
        for b in w:
            t = base[s] + b
            if check[t] != s:
                return -1
            s = t
        return value[s]

    assert [find(w) for w in words] == list(range(6))
    assert find(b"bc") == find(b"c") == find(b"abca") == -1


def test_documents(spark):
    rows = documents(20)
    out = S.encode_checked(spark, frame(spark, rows)).collect()
    assert len(out) == len(rows) and all(r.round_trip for r in out)
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (901, 902)} == {0}
    assert S.encode_checked(spark, frame(spark, [])).collect() == []
    both = S.decode_documents(spark, S.encode_documents(spark, frame(spark, rows))).collect()
    assert {(r.doc_id, r.decoded) for r in both} == {(r[0], r[1] or "") for r in rows}
