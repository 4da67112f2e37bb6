"""What tasks hold at a time stays small, and results don't depend on how rows are cut into batches."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sameitem.llm import jaccard_join, toxicity
from sameitem.llm.common import small_batches
from sameitem.llm.sentencepiece_codec import Encoder, load_vocabulary, viterbi_one

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def peak(work) -> float:
    """MB that ``work`` holds at most, besides what was held before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_many_long_chunks_are_solved_in_little_memory():
    rng = np.random.default_rng(3)
    chunks = ["".join(x) for x in rng.choice(list("abcdefghij"), (8_000, 60))]
    encoder = Encoder(load_vocabulary())
    assert peak(lambda: encoder._solve(chunks)) < 30  # all chunks side by side: more than 40
    assert len(encoder.known) == len(set(chunks))
    for c in chunks[:5] + chunks[-5:]:
        assert encoder.known[c] == viterbi_one(encoder.vocab, c.encode())


def test_sets_of_a_batch_are_made_in_little_memory():
    texts = pa.array([" ".join(f"w{i}x{k}" for k in range(120)) for i in range(2000)], pa.string())

    def run():
        for _ in jaccard_join.text_sets(texts):
            pass

    run()
    assert peak(run) < 12


def test_common_tokens_are_counted_over_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([("a b c d e",)] * 3 + [("v w x y z",)] * 2, "text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        found = jaccard_join.common_tokens(docs)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found.tolist() == next(jaccard_join.text_sets(pa.array(["a b c d e"]))).tolist()


def test_counted_tokens_in_turns_agree_with_one_turn(spark, monkeypatch):
    docs = spark.createDataFrame([(f"one two three four five {i % 4} six",) for i in range(48)] + [("",), (None,)], "text string").coalesce(1)
    whole = jaccard_join.common_tokens(docs)
    monkeypatch.setattr(jaccard_join, "COUNTED", 40)
    assert set(jaccard_join.common_tokens(docs).tolist()) <= set(whole.tolist())
    assert len(whole) == 9


def test_wide_rows_go_to_python_in_small_batches(spark):
    docs = spark.range(10_000).select(F.repeat(F.lit("x"), 2000).alias("text")).coalesce(1)

    def sizes(records):
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes for b in records], pa.int64())], ["n"])

    before = spark.conf.get(BATCH)
    with small_batches(spark):
        most = max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect())
    assert most < 10e6
    assert spark.conf.get(BATCH) == before
    jaccard_join.representatives(spark, spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"))
    assert spark.conf.get(BATCH) == before


def test_a_kept_text_goes_to_the_tasks_once(spark):
    docs = spark.createDataFrame([(1, "hello there"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.scored(spark, docs, labels, F.lit(True), docs.columns)
    task = rows._jdf.queryExecution().analyzed()
    while "MapInArrow" not in task.nodeName():
        task = task.children().head()
    assert task.children().head().output().size() == 1
    assert sorted((r["row"]["doc_id"], r["row"]["text"], r["score"]) for r in rows.collect()) == [(1, "hello there", 0.0), (2, None, 0.0)]
