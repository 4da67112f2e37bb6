import random
import re

from sameitem.llm.decontamination import leaks
from tests.llm.helpers import documents, frame, sentence


def tokens(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))


def tiled(doc, item, least):
    """Greedy string tiling by its definition: the longest unmarked match first."""
    a, b = tokens(doc), tokens(item)
    least = min(least, len(b))
    if not least:
        return 0, 0
    ma, mb, tiles, total = [False] * len(a), [False] * len(b), 0, 0
    while True:
        best = None
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, j, i)
        if best is None:
            return tiles, total
        n, j, i = best
        ma[i:i + n] = [True] * n
        mb[j:j + n] = [True] * n
        tiles, total = tiles + 1, total + n


def test_against_brute_force(spark):
    rng = random.Random(5)
    items = [(k, " ".join(f"{rng.choice('abcde')}{rng.randint(0, 30)}" for _ in range(rng.randint(2, 30)))) for k in range(8)]
    items += [(8, items[0][1]), (9, None), (10, ""), (11, "Solo")]
    rows = documents(10)
    for n in range(25):
        _, text = items[rng.randrange(8)]
        w = text.split()
        cut = sorted(rng.sample(range(len(w) + 1), min(3, len(w))))
        parts = [w[x:y] for x, y in zip([0, *cut], [*cut, len(w)])]
        rng.shuffle(parts)
        mixed = ", ".join(" ".join(p).upper() for p in parts if rng.random() < 0.85)
        rows.append((100 + n, sentence(rng, 10) + "\n" + mixed + ". " + sentence(rng, 6) + rng.choice(["", " solo"]), "en", "s", 1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text, *_ in rows:
        if text and len(text) < 10000:
            for k, item in items:
                n, total = tiled(text, item, 5)
                if total and total >= 0.5 * len(tokens(item)):
                    want.add((d, k, total))
    for block in (1 << 24, 300):  # one block, and several
        out = leaks(spark, frame(spark, rows), bench, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id, r.tiled_tokens) for r in out} == want
    assert len(want) > 15


def test_driver_and_tasks_hold_one_block_at_a_time(spark, monkeypatch):
    live, most, made = set(), [0], [0]
    context = spark.sparkContext
    real = context.broadcast

    def broadcast(value):
        shared = real(value)
        destroy = shared.destroy
        live.add(id(shared))
        most[0], made[0] = max(most[0], len(live)), made[0] + 1
        shared.destroy = lambda *a, **k: (live.discard(id(shared)), destroy(*a, **k))
        return shared

    monkeypatch.setattr(context, "broadcast", broadcast)
    rng = random.Random(9)
    items = [(k, " ".join(f"{rng.choice('abcde')}{rng.randint(0, 99)}" for _ in range(20))) for k in range(60)]
    rows = [(k, "before it " + text + " after it", "en", "s", 1) for k, text in items if k % 3 == 0]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = leaks(spark, frame(spark, rows), bench, block_bytes=1000)
    assert made[0] > 5 and most[0] == 1 and not live
    found = {(r.doc_id, r.item_id) for r in out.collect()}
    assert found == {(r.doc_id, r.item_id) for r in leaks(spark, frame(spark, rows), bench).collect()}
    assert found >= {(k, k) for k, *_ in rows}


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert leaks(spark, frame(spark, []), bench).collect() == []
    assert leaks(spark, frame(spark, documents(3)), bench.limit(0)).collect() == []


def test_reordered_passage_is_caught_and_clean_text_left_alone(spark):
    item = " ".join(f"tok{i}" for i in range(40))
    w = item.split()
    rows = [(1, "so " + " ".join(w[20:] + w[:20]) + " end", "en", "s", 1), (2, " ".join(w[:10]) + " other words here", "en", "s", 1)]
    out = leaks(spark, frame(spark, rows), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.n_tiles, r.coverage) for r in out] == [(1, 7, 2, 1.0)]
