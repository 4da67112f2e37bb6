import math
import random
from collections import Counter

import duckdb
import pytest

from sameitem.llm import licenses as L
from tests.llm.helpers import documents, frame

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def cosine(text, template):
    idf, other = L.inverse_frequencies()
    vec = [{t: c * idf.get(t, other) for t, c in Counter(L.words(x)).items()} for x in (text, template)]
    norm = [math.sqrt(sum(x * x for x in v.values())) for v in vec]
    return sum(w * vec[1].get(t, 0) for t, w in vec[0].items()) / (norm[0] * norm[1]) if norm[0] else 0


def test_cosines(spark):
    units = [MIT, GPL, "Licensed under CC BY-NC 4.0.", "the license of a cat", "nothing", "Apache License Version 2.0 " * 40, ""]
    df = spark.createDataFrame([(u,) for u in units], "u string")
    got = {r.u: (r.license, r.cosine) for r in L.cosines(spark, df, "u", "u").collect()}
    for u in units:
        best = max((round(cosine(u, t), 9), s) for s, t in L.TEMPLATES)
        if best[0] > 0:
            assert abs(got[u][1] - best[0]) < 1e-6
        else:
            assert u not in got
    assert got[MIT][0] == "MIT" and got[GPL][0] == "GPL-3.0" and got[units[2]][0] == "CC-BY-NC-4.0"


def test_the_sql_asks_for_no_key_word():
    """Its lines and texts are all scored, like the query's; the test of both below holds prose without any such word."""
    assert "regexp_matches" not in L.oracle()


def test_narrowing_loses_nothing(spark):
    rng = random.Random(6)
    pool = [w for _, text in L.TEMPLATES for w in L.words(text)] + ["cat", "river", "zebra", "quelo"]
    units = ["Version 2.0, January 2004", "released into the public domain", "software released into the public domain",
             "in source and binary forms, with or without modification, are permitted provided that the following conditions are met"]
    units += [" ".join(rng.choice(pool) for _ in range(rng.choice([2, 5, 12, 60, 400]))) for _ in range(400)]
    units += [" ".join(rng.choice(text.split()) for _ in range(rng.choice([3, 8, 20])))  for _, text in L.TEMPLATES for _ in range(6)]
    units = sorted(set(units))
    df = spark.createDataFrame([(u,) for u in units], "u string")
    for least in (L.FILE_COSINE, L.HEADER_COSINE):
        want = {u: c for u in units if (c := round(max(cosine(u, t) for _, t in L.TEMPLATES), 9)) >= least}
        near = L.may_reach(df, "u", least)
        got = {r.u: r.cosine for r in L.row_cosines(spark, near, "u").where(f"cosine >= {least}").collect()}
        assert len(want) > 30 and not {u for u in want if abs(want[u] - least) > 1e-7} ^ {u for u in got if abs(got[u] - least) > 1e-7}
        assert all(abs(got[u] - want[u]) < 1e-6 for u in got)


def test_lines_and_texts_without_the_oracles_words(spark):
    body = "in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    files = [("a/x.txt", "prose of a day\n" + "word " * 90 + "\nsoftware released into the public domain"),
             ("b/y.txt", body), ("b/z.txt", "code"), ("c/two.txt", "the public domain"), ("c/two.txt", "software released into")]
    got = {r.path: (r.license, r.basis, r.from_path)
           for r in L.licenses(spark, spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["a/x.txt"] == ("Unlicense", "header", "a/x.txt")
    assert got["b/y.txt"] == ("BSD-3-Clause", "file", "b/y.txt") and got["b/z.txt"] == ("BSD-3-Clause", "inherited", "b/y.txt")
    assert got["c/two.txt"][1:] == ("file", "c/two.txt")


def test_inheritance_from_the_nearest_directory(spark):
    files = [("LICENSE", MIT), ("a/b/COPYING", GPL), ("a/b/c/x.py", "code"), ("a/b/c/d/y.py", None), ("a/z.py", "code"),
             ("w.py", ""), ("a/b/own.py", "# Licensed under the Apache License, Version 2.0\ncode here " + "word " * 50)]
    df = spark.createDataFrame(files, "path string, text string")
    got = {r.path: (r.license, r.basis, r.from_path) for r in L.licenses(spark, df).collect()}
    assert got["LICENSE"] == ("MIT", "file", "LICENSE") and got["a/b/COPYING"] == ("GPL-3.0", "file", "a/b/COPYING")
    assert got["a/b/c/x.py"] == got["a/b/c/d/y.py"] == ("GPL-3.0", "inherited", "a/b/COPYING")
    assert got["a/z.py"] == got["w.py"] == ("MIT", "inherited", "LICENSE")
    assert got["a/b/own.py"] == ("Apache-2.0", "header", "a/b/own.py")


@pytest.mark.parametrize("rows", ["full", "empty"])
def test_query_against_its_sql(spark, rows, tmp_path):
    data = documents(60)
    for k, i in enumerate((3, 9, 20, 33, 41, 58)):
        data[i] = (i, (data[i][1] if k % 2 else "short words") + "\n" + (MIT, GPL)[k % 3 == 0], data[i][2], data[i][3] if k else None, 1)
    data += [(3, data[3][1], data[3][2], data[3][3], 1), (200, "MIT License", "en", "s1", 1), (201, "plain", "en", "s1", 1)]
    data += [(202, "to any of the and this a person deals in the " * 20, "en", "s1", 1), (203, "The cat sat on the mat.\n" * 9, "en", "s1", 1)]
    data = data if rows == "full" else []
    frame(spark, data).drop("path").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(map(str, r)) for r in L.op6_licenses(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(tuple(map(str, r)) for r in con.execute(L.oracle()).fetchall())
    strip = lambda x: [(a, b, c, d, e if e == "None" else f"{float(e):.6f}", f) for a, b, c, d, e, f in x]
    assert strip(got) == strip(want)
    assert rows == "empty" or {"header", "file", "inherited", "none"} == {r[3] for r in got}


def test_corpus_weights_against_counting(spark):
    texts = ["The MIT License of the public", "the cat", None, "", "license license public", "of the"]
    by = L.corpus_weights(spark.createDataFrame([(t,) for t in texts], "text string"))
    n = 1 + L.PRIOR_FILES + sum(t is not None for t in texts)
    for term in by.idf:
        held = sum(term in L.words(t or "") for t in texts) + L.PRIOR_FILES * (term in L.COMMON)
        assert by.idf[term] == float((n // (1 + held)).bit_length())
    assert by.other == float(n.bit_length()) and by.idf["the"] < by.idf["mit"] < by.idf["gnu"]
    assert L.corpus_weights(spark.createDataFrame([], "text string")).other == float((1 + L.PRIOR_FILES).bit_length())


def test_prose_states_nothing_and_full_texts_state_their_own(spark):
    rng = random.Random(3)
    common = "the of and to a in is it that was for on with as be this any by or not are which person copy use may".split()
    rare = ["".join(rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n)) + "."

    files = [(f"p/{i}/x.txt", "\n".join(prose(rng.choice([6, 15, 60])) for _ in range(rng.choice([1, 5, 30])))) for i in range(150)]
    full = {s: max((t for k, t in L.TEMPLATES if k == s), key=len) for s in
            ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-1.1", "GFDL-1.3", "CC0-1.0")}
    for s, text in full.items():
        lines = text.replace(". ", ".\n").replace(", ", ",\n")
        files += [(f"repo/{s}/own.txt", f"Copyright (c) 2021 Some Person\n\n{lines}"), (f"repo/{s}/src/code.py", "x = 1")]
    got = {r.path: (r.license, r.basis) for r in L.licenses(spark, spark.createDataFrame(files, "path string, text string")).collect()}
    assert {v for p, v in got.items() if p.startswith("p/")} == {(None, "none")}
    for s in full:
        assert got[f"repo/{s}/own.txt"] == (s, "file") and got[f"repo/{s}/src/code.py"] == (s, "inherited"), s
