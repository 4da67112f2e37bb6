"""M1: Indel ratios against a plain dynamic-programming brute force."""
from hypothesis import given, settings, strategies as st

from sameitem.functions import fuzzy as Z

ALPHA = st.text(alphabet="ab c12", max_size=14)


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def sim(a, b):
    return 1.0 if not a and not b else 2 * lcs_dp(a, b) / (len(a) + len(b))


def partial_bf(a, b):
    """Best similarity of the shorter text with every window of the longer one, partial ends included."""
    if not a or not b:
        return float(not a and not b)
    best = 0.0
    for s, l in ((a, b), (b, a)):
        if len(s) <= len(l):
            wins = [l[:i] for i in range(1, len(s))] + [l[i:i + len(s)] for i in range(len(l))]
            best = max(best, *[sim(s, w) for w in wins])
    return best


def score_bf(a, b):
    sort = sim(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    wa, wb = set(a.split()), set(b.split())
    if not wa or not wb:
        words = 0.0
    else:
        x, p, q = (" ".join(sorted(s)) for s in (wa & wb, wa - wb, wb - wa))
        xp, xq = (f"{x} {y}" if x and y else x + y for y in (p, q))
        if x and (not p or not q):
            words = 1.0
        else:
            lead = len(x) + (1 if x else 0)
            words = 1 - (len(p) + len(q) - 2 * lcs_dp(p, q)) / (2 * lead + len(p) + len(q))
            if x:
                words = max(words, sim(x, xp) if xp.startswith(x) else 0, sim(x, xq) if xq.startswith(x) else 0)
    return (sort + words + partial_bf(a, b)) / 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(ALPHA, ALPHA), min_size=1, max_size=6))
def test_lcs_and_partial_equal_exhaustive_search(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    assert Z.lcs_many(a, b).tolist() == [lcs_dp(x, y) for x, y in pairs]
    got = Z.partial_many(a, b)
    assert all(abs(g - partial_bf(x, y)) < 1e-12 for g, (x, y) in zip(got, pairs))


def test_texts_longer_than_a_word():
    a = ["ab" * 70 + "c" * 9, "xyz" * 50, "q" * 64, "q" * 65, "é\U0001F600" * 40]
    b = ["ba" * 40 + "c" * 20, "zyx" * 60, "q" * 63 + "r", "q" * 129, "\U0001F600é" * 33]
    assert Z.lcs_many(a, b).tolist() == [lcs_dp(x, y) for x, y in zip(a, b)]
    assert all(abs(g - partial_bf(x, y)) < 1e-12 for g, x, y in zip(Z.partial_many(a, b), a, b))


def test_published_values():
    assert Z.partial_many(["this is a test", "", "", "ab"], ["this is a test!", "", "abc", "zabz"]).tolist() == [1, 1, 0, 1]
    assert round(sim("this is a test", "this is a test!") * 100, 2) == 96.55


def test_score_of_pairs(spark):
    pairs = [("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear"), ("fuzzy was a bear", "fuzzy fuzzy was a bear"), ("", "abc"), ("", ""),
             (None, "x"), ("same title", "same title"), ("samsung galaxy s21 128gb black", "galaxy s21 ultra samsung 128 gb"),
             ("a b c", "d e f"), ("sony wh1000xm4", "sony wh1000xm4 headphones new"), ("קפה apple", "apple קפה 2")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, l string, r string")
    got = {r.i: r.fuzzy for r in Z.with_fuzzy(df, "l", "r").collect()}
    for i, (a, b) in enumerate(pairs):
        assert abs(got[i] - score_bf(a or "", b or "")) < 1e-9, (a, b)
    assert abs(got[5] - 1.0) < 1e-12
