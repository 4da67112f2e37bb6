"""Word look-ups and gated regexes give what plain regexes over the whole text give."""
import random
import re

from pyspark.sql import functions as F

from sameitem.functions import titles as T

PIECES = ["samsung", "Apple", "iphone", "iphone15", "iphone 15", "iphone99", "air", "airpods", "2nd gen", "1st  gen", "gen 3", "gen", "general 4",
          "redmi", "redmi note", "redminote 13", "redmi.note", "note 12", "note7", "notebook 9", "watch", "watch 9", "series 10", "series",
          "sony", "wh-1000-xm4", "wh 1000 xm5", "wh1000xm3", "1000", "switch", "oled", "nintendo", "ideapad 5", "galaxy", "s23", "a54", "S9",
          "ultra", "pro", "pro+", "product", "plus", "fe", "feel", "gps", "cellular", "gps + cellular", "gpscellular", "cellularandgps",
          "cellular & gps", "used", "new", "renewed", "refurbished", "128gb", "512 gb", "64 g", "1tb", "2 tb", "256ssd", "512 ssd", "16 ram",
          "8gb ram", "8 gb ram", "program", "15 inch", "15.3inch", "16-inch", "13", "14", "17", "41mm", "45 ממ", "שחור", "סמסונג", "גלקסי",
          "128 גיגה", "black", "white", "mint", "Midnight", "natural titanium", "silver", "x_black", "_", "é", "\u00a0", "\u2003", "\t", ",", "/", "|",
          "(", ")", "-", ".", ":", "\u0663gb", "٣ tb", "\n", "gigabyte", "3 gigabyte", "g", "gig"]


def normalized(title):
    t = (title or "").lower().strip()
    for he, en in T.HEBREW_ALIASES:
        t = re.sub(rf"\b{he}\b", en, t)
    t = re.sub(T.STORAGE_UNITS[0], r"\1gb", t)
    t = re.sub(T.TERABYTES, lambda m: f"{int(m[1]) * 1024}gb", t)
    for pattern, spelling in T.SPELLINGS:
        t = re.sub(pattern, re.sub(r"\$(\d)", r"\\g<\1>", spelling), t)
    return re.sub(r"\s+", " ", re.sub(r"[\-\+\(\),/|]", " ", t)).strip()


def first(t, patterns):
    return next((v for v, ps in patterns if any(re.search(p, t) for p in ps)), None)


def group(t, patterns):
    return next((m[1] for p in patterns if (m := re.search(p, t))), None)


def expected(title):
    t = normalized(title)
    has = lambda w: re.search(rf"\b{w}\b", t) is not None
    family = first(t, T.FAMILY_PATTERNS)
    sizes = [int(x) for x in re.findall(T.STORAGE_GB, t) + re.findall(T.STORAGE_SSD, t)]
    ram = group(t, T.RAM_PATTERNS)
    prefix, numbers = T.NUMBER_PATTERNS.get(family, ("", []))
    number = group(t, numbers)
    return dict(normalized_title=t, brand=first(t, T.BRAND_PATTERNS), model_family=family, tier_variant=first(t, T.TIER_PATTERNS),
                display_variant="oled" if has("oled") else "standard" if has("switch") else None,
                connectivity="gps_cellular" if has("gps") and has("cellular") else first(t, T.CONNECTIVITY_PATTERNS),
                condition=next((v for v in T.CONDITION_ORDER if has(v)), None), storage=f"{max(sizes)}gb" if sizes else None,
                ram=ram and f"{ram}gb", screen_size=group(t, T.SCREEN_PATTERNS), color=first(t, T.COLOR_PATTERNS),
                model_number=number and prefix + number)


def test_against_plain_regexes(spark):
    rng = random.Random(11)
    titles = [rng.choice(["", " ", "\u2003"]) + "".join(rng.choice(PIECES) + rng.choice([" ", " ", " ", "  ", "", ", "])
              for _ in range(rng.choice([1, 2, 4, 8, 30]))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i long, title string")
    for r in T.with_attributes(df).collect():
        want = expected(titles[r.i])
        assert {k: r[k] for k in want} == want, titles[r.i]


def test_a_whole_word_is_looked_up_and_not_searched(spark):
    plan = T.with_attributes(spark.createDataFrame([("a",)], "title string"))._jdf.queryExecution().optimizedPlan().toString()
    for word in ("samsung", "titanium", "refurbished", "oled"):
        assert rf"\b{word}\b" not in plan
    assert "array_intersect" in plan


def test_long_texts(spark):
    words = "an ordinary sentence without any of the words that are looked for here " * 3000
    df = spark.createDataFrame([(words + "samsung galaxy s23 " + words + " 8gb " + words + "256gb",)], "title string")
    r = T.with_attributes(df).select("brand", "model_number", "ram", "storage", F.length("normalized_title").alias("n")).first()
    assert (r.brand, r.model_number, r.ram, r.storage) == ("samsung", "s23", "8gb", "256gb") and r.n > 600_000
