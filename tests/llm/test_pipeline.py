"""The pipeline's stages, each held against what it must do to planted rows."""

import random

import corpus_pipeline as P
from tests.llm.helpers import frame, odd_rows, sentence
from tests.llm.test_jaccard_join import components, near_copies
from tests.llm.test_models import labelled, spoken


def test_stages_on_planted_rows(spark, tmp_path):
    rng = random.Random(12)
    rows, labels = labelled(200)
    rows += [(10_000 + r[0], *r[1:5]) for r in spoken(160)] + odd_rows()
    rows += near_copies(rng, " ".join(f"c{rng.randint(0, 500)}" for _ in range(90)), 20, 20_000, 3)
    item = " ".join(f"bench{rng.randint(0, 500)}" for _ in range(30))
    rows += [(30_000 + k, sentence(rng, 30) + " " + item + " " + sentence(rng, 30), "en", "s", 1) for k in range(4)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs, names = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    for k, (name, apply) in enumerate(P.STAGES):
        before = docs
        docs = P.stage(spark, apply(spark, docs, str(tmp_path)), f"test-{name}")
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        given = [r.doc_id for r in before.select("doc_id").collect()]
        if k < 4:
            assert docs.columns == before.columns
            assert docs.exceptAll(before).count() == 0  # rows are kept or dropped, never changed
        if name == "toxicity":
            toxic = {i for i, _, t in labels if t}
            assert len(toxic & set(ids)) <= 1 and len(set(given) - set(ids) - toxic) <= 2
        if name == "language":
            assert not {901, 902, 903, 905} & set(ids) and len(ids) >= 0.95 * (len(given) - 5)
        if name == "near_duplicates":
            old = [tuple(r) for r in before.select("doc_id", "text").collect()]
            assert len(ids) == len({c for *_, c in components(old)} | {c for *_, c in components(old) if c is None})
            assert len([i for i in ids if i is not None and 20_000 <= i < 20_020]) <= len(components([r for r in old if r[0] and 20_000 <= r[0] < 20_020]))
        if name == "decontamination":
            assert set(given) - set(ids) == {30_000, 30_001, 30_002, 30_003}
    assert docs.columns == ["doc_id", "n_tokens", "ids", "round_trip", "decoded_crc32"]
    assert {r.doc_id for r in docs.where("not round_trip").collect()} == set()


def test_decontamination_judges_rows_of_one_id_each(spark, tmp_path):
    item = " ".join(f"bench{k}" for k in range(20))
    rows = [(i, text, "en", "s", 1) for i in (None, 5, 6) for text in (f"leaking {i} {item}", f"clean text of {i}", None)]
    rows += [(7, item, "en", "s", 1), (7, item, "en", "s", 2), (8, "clean text of None", "en", "s", 1)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = P.decontamination_stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    want = [r[:2] for r in rows if r[1] is None or "bench" not in r[1]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, want))


def test_empty_tables_pass_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_contract_of_the_module():
    assert [n for n, _ in P.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "tokens"]
    assert P.ORACLE_SQL is None
