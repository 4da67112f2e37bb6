"""Small document tables for the operators' tests."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["anan", "erthe", "tion", "haou", "isst", "enver", "loma", "quelo", "schné", "óscar", "the", "of", "and", "is", "a",
         "Was", "that", "reti", "onha", "bleed"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def odd_rows():
    """Null, empty, blank, short, long, repeated rows."""
    long_ = " ".join(f"w{i % 97}x{i % 31}" for i in range(6000))
    return [
        (None, "a text without an id of its own here", "en", "s0", 5), (901, None, None, None, None), (902, "", "en", "s0", 0),
        (903, " \t\n", "en", "s0", 3), (904, "one", "en", "s1", 3), (905, "!!! 123 ...", "en", "s1", 11),
        (906, long_, "en", "s0", len(long_)), (907, "same row twice over and over again", "en", "s2", 1),
        (907, "same row twice over and over again", "en", "s2", 1), (908, "x" * 20000, "de", "s2", 20000),
        (909, "tab\tand nbsp \U0001F600 emoji", "fr", "s3", 4), (910, "same row twice over and over again", "en", "s2", 1),
    ]


def documents(n=40, seed=1, odd=True):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.choice([3, 8, 40, 120])), rng.choice(["en", "fr", "de", "es"]), f"s{i % 4}", 1) for i in range(n)]
    return rows + (odd_rows() if odd else [])


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, DOC)
    if extra:  # columns with names that operators use themselves
        from pyspark.sql import functions as F
        for c in ("score", "rank", "token", "k1", "shard", "_text", "bucket", "ids", "path", "held_out"):
            df = df.withColumn(c, F.lit("clash"))
    return df


def write(spark, path, rows, extra=True, **tables):
    frame(spark, rows, extra).write.parquet(f"{path}/documents.parquet")
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
