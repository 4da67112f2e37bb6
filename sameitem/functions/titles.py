"""Title normalisation and attribute extraction as Spark column expressions.

Everything here is a ``Column -> Column`` function of built-in expressions; no
Python UDF.  Whole-word patterns are looked up among a text's words, cut once
(:func:`known_words`); the other regexes run only where their literals occur.  Patterns carry ``(?U)`` so
``\\b``, ``\\w``, ``\\s`` and ``\\d`` are Unicode-aware like Python's ``re``.

The dictionaries are parameters with the reference values as defaults, so a
caller can bring another catalogue.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Hebrew -> English whole-word aliases, applied in this order.
HEBREW_ALIASES = [
    ("סמסונג", "samsung"),
    ("גלקסי", "galaxy"),
    ("אייפון", "iphone"),
    ("אפל", "apple"),
    ("איירפודס", "airpods"),
    ("שיאומי", "xiaomi"),
    ("שיואמי", "xiaomi"),
    ("רדמי", "redmi"),
    ("נוט", "note"),
    ("לנובו", "lenovo"),
    ("אידיאפד", "ideapad"),
    ("סוני", "sony"),
    ("אולטרה", "ultra"),
    ("פרו", "pro"),
    ("פלוס", "plus"),
    ("מחודש", "refurbished"),
    ("מחודשת", "refurbished"),
    ("משומש", "used"),
    ("חדש", "new"),
    ("גיגה", "gb"),
    ("דור", "gen"),
    ("ווטש", "watch"),
    ("סוויץ", "switch"),
    ("לבן", "white"),
    ("שחור", "black"),
    ("מנטה", "mint"),
    ("טבעי", "natural"),
    ("טיטניום", "titanium"),
    ("סלולר", "cellular"),
    ("מידנייט", "midnight"),
    ("כסוף", "silver"),
]

# Ordered first-match classifiers: value -> patterns (first value whose any
# pattern matches wins).
BRAND_PATTERNS = [
    ("samsung", [r"\bsamsung\b"]),
    ("apple", [r"\bapple\b", r"\biphone\b", r"\bairpods\b", r"\bwatch\b"]),
    ("xiaomi", [r"\bxiaomi\b", r"\bredmi\b"]),
    ("lenovo", [r"\blenovo\b", r"\bideapad\b"]),
    ("sony", [r"\bsony\b"]),
    ("nintendo", [r"\bnintendo\b", r"\bswitch\b"]),
]
FAMILY_PATTERNS = [
    ("galaxy", [r"\bgalaxy\b"]),
    ("iphone", [r"\biphone\b", r"\biphone\d{2}\b"]),
    ("airpods", [r"\bairpods\b"]),
    ("redmi_note", [r"\bredmi\s*note\b", r"\bredmi\s*note\d+\b"]),
    ("ideapad", [r"\bideapad\b"]),
    ("watch", [r"\bwatch\b"]),
    ("switch", [r"\bswitch\b"]),
    ("wh1000x", [r"\bwh1000xm[345]\b", r"\bwh\s*1000\s*xm[345]\b"]),
]
TIER_PATTERNS = [
    ("ultra", [r"\bultra\b"]),
    ("pro", [r"\bpro\b"]),
    ("plus", [r"\bplus\b"]),
    ("fe", [r"\bfe\b"]),
]
CONNECTIVITY_PATTERNS = [
    ("gps_cellular", [r"\bgps\s*(and|&|\+)?\s*cellular\b", r"\bcellular\s*(and|&|\+)?\s*gps\b"]),
    ("cellular", [r"\bcellular\b"]),
    ("gps", [r"\bgps\b"]),
]
CONDITION_ORDER = ["refurbished", "used", "new"]
COLOR_PATTERNS = [
    ("black", [r"\bblack\b"]),
    ("white", [r"\bwhite\b"]),
    ("mint", [r"\bmint\b"]),
    ("midnight", [r"\bmidnight\b"]),
    ("natural", [r"\bnatural\b"]),
    ("titanium", [r"\btitanium\b"]),
    ("silver", [r"\bsilver\b"]),
]
CATEGORY_BY_FAMILY = {
    "galaxy": "phone",
    "iphone": "phone",
    "redmi_note": "phone",
    "airpods": "earbuds",
    "ideapad": "laptop",
    "watch": "watch",
    "switch": "console",
    "wh1000x": "headphones",
}
SPECIAL_TIERS = ["pro", "ultra", "plus", "fe"]
# Noise terms that lower a title's chance to be canonical (substring test).
PROMO_TERMS = ["מבצע", "sale", "חדש", "original", "יבואן", "official"]
# Spellings made alike (pattern, replacement), in this order: N3, then N5 to N8.
STORAGE_UNITS = (r"(\d+)\s*(gb|g|gig|gigabyte)\b", "$1gb")
TERABYTES = r"(\d+)\s*tb\b"
SPELLINGS = [
    (r"(\d+)\s*ssd\b", "$1ssd"),
    (r"(\d+)\s*ram\b", "$1gb ram"),
    (r"(\d+)\s*ממ\b", "$1mm"),
    (r"(\d+)\s*inch\b", "$1 inch"),
    (r"\b1st\s*gen\b", "gen1"),
    (r"\b2nd\s*gen\b", "gen2"),
    (r"\b3rd\s*gen\b", "gen3"),
    (r"\bgen\s+(\d)\b", "gen$1"),
    (r"\biphone\s+(11|12|13|14|15|16)\b", "iphone $1"),
    (r"\bnote\s+(\d{1,2})\b", "note $1"),
    (r"\bseries\s+(\d{1,2})\b", "series $1"),
    (r"\bwh[\-\s]?1000[\-\s]?xm([345])\b", "wh1000xm$1"),
]
# What the extractors look for (group 1 is the value), tried in this order.
STORAGE_GB = r"\b(32|64|128|256|512|1024|2048)gb\b"
STORAGE_SSD = r"\b(128|256|512|1024|2048)ssd\b"
RAM_PATTERNS = [
    r"\b(4|8|16|24|32|64)gb\s+ram\b",
    r"\b(4|8|16|24|32|64)gb\b(?=.*\b(?:128ssd|256ssd|512ssd|1024ssd|128gb|256gb|512gb|1024gb)\b)",
]
SCREEN_PATTERNS = [
    r"\b(13|14|15|16|17)(?:\.3)?\s*inch\b",
    r"\b(13|14|15|16|17)\b(?=.*\b(?:8gb|16gb|512ssd|512gb)\b)",
    r"\b(41|45)mm\b",
]
# Model number by family: what goes before the value, and the patterns.
NUMBER_PATTERNS = {
    "galaxy": ("", [r"\b(s\d{2})\b", r"\b(a\d{2})\b"]),
    "iphone": ("", [r"\biphone\s(11|12|13|14|15|16)\b", r"\biphone(11|12|13|14|15|16)\b"]),
    "airpods": ("gen", [r"\bgen([123])\b"]),
    "redmi_note": ("", [r"\bnote\s(\d{1,2})\b", r"\bnote(\d{1,2})\b"]),
    "ideapad": ("", [r"\bideapad\s+(\d)\b"]),
    "watch": ("", [r"\bseries\s(\d{1,2})\b", r"\bwatch\s(7|8|9|10)\b"]),
    "wh1000x": ("xm", [r"\bwh1000xm([345])\b"]),
}
# The 11 extracted attributes, in output order.
ATTRIBUTES = ["brand", "model_family", "model_number", "tier_variant", "display_variant",
              "connectivity", "condition", "storage", "ram", "screen_size", "color"]
# Order used by completeness / agreement / group conflict checks.
SCORED_FIELDS = ["brand", "model_family", "model_number", "tier_variant", "display_variant",
                 "connectivity", "storage", "ram", "screen_size", "condition", "color"]
# ---------------------------------------------------------------------------

U = "(?U)"
# What \\s is under (?U).
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def _rx(p: str) -> str:
    return U + p


def _extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match group or null (``regexp_extract`` returns '' on no match)."""
    return F.nullif(F.regexp_extract(c, _rx(pattern), group), F.lit(""))


def _alias_words(t: Column, aliases=HEBREW_ALIASES) -> Column:
    """Whole-word aliases.

    Splitting on (?U)\\b yields alternating word and non-word runs; a run
    equal to an alias key is replaced.  Same result as one regex pass per
    alias (keys are whole words, values never match a later key), in a single
    pass.  Only text with a Hebrew letter is split.
    """
    amap = F.create_map(*[F.lit(x) for kv in aliases for x in kv])
    runs = F.split(t, r"(?U)\b")
    a = F.array_join(F.transform(runs, lambda r: F.coalesce(F.try_element_at(amap, r), r)), "")
    return F.when(t.rlike("[\u0590-\u05ff]"), a).otherwise(t)


def _lower_strip(title: Column) -> Column:
    """N1"""
    return F.trim(F.lower(title.cast("string")), F.lit(WHITE_SPACE))


def normalize_title(title: Column, aliases=HEBREW_ALIASES) -> Column:
    """N1-N9 as one expression."""
    return _normalize_rest(_alias_words(_lower_strip(title), aliases))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once (a bound lambda variable), however often it is used."""
    return F.transform(F.array(value), use)[0]


def times_1024(n: Column) -> Column:
    """Decimal text of a number of any length times 1024, without leading zeros."""
    ascii_digits = F.translate(n, "٠١٢٣٤٥٦٧٨٩"
                               "۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)

    def multiply(x: Column) -> Column:
        # Chunks of 14 digits from the right, each times 1024 plus the carry.
        parts = F.sequence(F.lit(0), F.floor((F.length(x) - 1) / 14).cast("int"))

        def add(acc: Column, k: Column) -> Column:
            end = F.length(x) - k * 14
            digits = F.substring(x, F.greatest(end - 13, F.lit(1)), F.least(end, F.lit(14)))
            product = digits.cast("long") * 1024 + acc["carry"]
            unit = F.lit(10 ** 14)
            return F.struct(((product - product % unit) / unit).cast("long").alias("carry"),
                            F.concat(F.lpad((product % unit).cast("string"), 14, "0"), acc["text"]).alias("text"))

        start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit("").alias("text"))
        total = F.aggregate(parts, start, add, lambda acc: F.concat(acc["carry"].cast("string"), acc["text"]))
        return F.regexp_replace(total, "^0+(?=.)", "")

    return _bind(ascii_digits, lambda x: F.when(x.rlike("^[0-9]+$"), _bind(x, multiply)).otherwise(x))


def _normalize_units(t: Column) -> Column:
    """Storage unit spellings."""
    return F.regexp_replace(t, _rx(STORAGE_UNITS[0]), STORAGE_UNITS[1])


def _respell(t: Column, pattern: str, spelling: str) -> Column:
    """``regexp_replace`` of a text that holds the pattern; others are only searched for its start.

    Without the leading boundary, a pattern that begins with a letter fails at the
    first letter of most positions, where a boundary test looks both ways.
    """
    first = pattern.removeprefix(r"\b")
    literals = re.findall("[a-z\u05d0-\u05ea]{2,}", re.sub(r"\([^)]*\)|\[[^\]]*\]|\\[a-z]", " ", pattern))
    return _bind(t, lambda x: F.when(
        reduce(lambda p, q: p & q, [x.contains(w) for w in literals], F.lit(True)) & x.rlike(_rx(first)),
        F.regexp_replace(x, _rx(pattern), spelling)).otherwise(x))


def _normalize_rest(t: Column) -> Column:
    """N3-N9 on lowercased, aliased text."""
    t = _normalize_units(t)

    # N tb -> N*1024 gb (computed replacement, one pass per distinct number).
    def to_gb(x: Column) -> Column:
        return F.when(~x.contains("tb"), x).otherwise(F.aggregate(
            F.array_distinct(F.regexp_extract_all(x, F.lit(_rx(TERABYTES)), 1)),
            x,
            lambda acc, n: F.regexp_replace(
                acc,
                F.concat(F.lit(U + r"(?<!\d)"), n, F.lit(r"\s*tb\b")),
                F.concat(times_1024(n), F.lit("gb"))),
        ))

    t = _bind(t, to_gb)
    for pattern, spelling in SPELLINGS:  # N5-N8
        t = _respell(t, pattern, spelling)
    # Separators and white space become one space; single spaces are left as they are.
    return F.trim(F.regexp_replace(t, _rx(r"[\s\-+(),/|]{2,}|[\s\-+(),/|&&[^ ]]"), " "))


# -- dictionary words -----------------------------------------------------------

def _plain(pattern: str) -> str | None:
    """The word of a pattern that is one whole word."""
    found = re.fullmatch(r"\\b([a-z0-9_]+)\\b", pattern)
    return found and found[1]


def _words(pattern: str) -> list[str]:
    """The words of a pattern that is a list of figures and one unit, as whole words."""
    found = re.fullmatch(r"\\b\(([0-9|]+)\)([a-z]*)\\b", pattern)
    return [n + found[2] for n in found[1].split("|")]


def _ahead(pattern: str) -> tuple[list[str], list[str]]:
    """Words that a pattern with a look-ahead begins with, and those it looks for."""
    head, tail = pattern.split("(?=", 1)
    return _words(head), re.search(r"\(\?:([^)]*)\)", tail)[1].split("|")


def dictionary() -> list[str]:
    """All words that the extractors look up."""
    plain = [_plain(p) for table in (BRAND_PATTERNS, FAMILY_PATTERNS, TIER_PATTERNS, CONNECTIVITY_PATTERNS, COLOR_PATTERNS)
             for _, patterns in table for p in patterns]
    figures = [*_words(STORAGE_GB), *_words(STORAGE_SSD), *_words(SCREEN_PATTERNS[2]),
               *[w for p in (RAM_PATTERNS[1], SCREEN_PATTERNS[1]) for part in _ahead(p) for w in part]]
    return list(dict.fromkeys([*filter(None, plain), *CONDITION_ORDER, "oled", "switch", "ram", "gps", "cellular", *figures]))


def known_words(t: Column) -> Column:
    """The dictionary words of a text, each once, in order of their first place.

    Word runs are cut once; a whole-word test is then a look-up in a short array.
    """
    return F.array_intersect(F.split(t, r"(?U)\W+"), F.array(*[F.lit(w) for w in dictionary()]))


def _any(words: Column, of: list[str]) -> Column:
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in of]))


def _matches(t: Column, words: Column, pattern: str) -> Column:
    """Whether a pattern is found: by look-up for a whole word, else by regex where its literals occur."""
    word = _plain(pattern)
    if word:
        return F.array_contains(words, word)
    bare = re.sub(r"\([^)]*\)\??|\[[^\]]*\]|\\[a-z]", " ", pattern)
    tests = [t.contains(w) for w in re.findall(r"[a-z0-9]{2,}", re.sub(r"\{\d+\}", " ", bare))]
    return reduce(lambda p, q: p & q, [*tests, t.rlike(_rx(pattern))])


def first_match(t: Column, words: Column, patterns) -> Column:
    """A0: value of the first entry whose any pattern matches, else null."""
    out = None
    for value, pats in patterns:
        # Look-ups come before regexes.
        cond = reduce(lambda p, q: p | q, [_matches(t, words, p) for p in sorted(pats, key=lambda p: not _plain(p))])
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(None).cast("string"))


def extract_display_variant(words: Column) -> Column:
    return (F.when(F.array_contains(words, "oled"), F.lit("oled"))
            .when(F.array_contains(words, "switch"), F.lit("standard")))


def extract_connectivity(t: Column, words: Column) -> Column:
    both = F.array_contains(words, "gps") & F.array_contains(words, "cellular")
    return F.when(both, F.lit("gps_cellular")).otherwise(first_match(t, words, CONNECTIVITY_PATTERNS))


def extract_condition(words: Column) -> Column:
    out = None
    for v in CONDITION_ORDER:
        cond = F.array_contains(words, v)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def extract_storage(words: Column) -> Column:
    """The largest storage figure among all ``NNgb`` and ``NNssd`` words."""
    own = F.filter(words, lambda w: w.isin(*_words(STORAGE_GB), *_words(STORAGE_SSD)))
    top = F.array_max(F.transform(own, lambda w: F.regexp_extract(w, "^[0-9]+", 0).cast("int")))
    return F.when(top.isNotNull(), F.concat(top.cast("string"), F.lit("gb")))


def _extract_ahead(t: Column, words: Column, pattern: str) -> Column:
    """A pattern with a look-ahead, tried only where a word of each of its lists occurs."""
    own, later = _ahead(pattern)
    return F.when(_any(words, own) & _any(words, later), _extract(t, pattern))


def extract_ram(t: Column, words: Column) -> Column:
    v = F.coalesce(F.when(F.array_contains(words, "ram"), _extract(t, RAM_PATTERNS[0])),
                   _extract_ahead(t, words, RAM_PATTERNS[1]))
    return F.when(v.isNotNull(), F.concat(v, F.lit("gb")))


def extract_screen_size(t: Column, words: Column) -> Column:
    sizes = F.filter(words, lambda w: w.isin(*_words(SCREEN_PATTERNS[2])))
    return F.coalesce(F.when(t.contains("inch"), _extract(t, SCREEN_PATTERNS[0])),
                      _extract_ahead(t, words, SCREEN_PATTERNS[1]),
                      F.regexp_extract(F.get(sizes, F.lit(0)), "^[0-9]+", 0))


def extract_model_number(t: Column, family: Column) -> Column:
    """A10: per-family number patterns, tried in order."""
    out = None
    for name, (prefix, patterns) in NUMBER_PATTERNS.items():
        v = F.coalesce(*[_extract(t, p) for p in patterns])
        v = F.concat(F.lit(prefix), v) if prefix else v
        out = F.when(family == name, v) if out is None else out.when(family == name, v)
    return out


def infer_category(family: Column, mapping=CATEGORY_BY_FAMILY) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.element_at(m, family)


def attribute_columns(t: Column, words: Column) -> dict[str, Column]:
    """The attributes of a normalised title and its :func:`known_words`."""
    return {
        "brand": first_match(t, words, BRAND_PATTERNS),
        "model_family": first_match(t, words, FAMILY_PATTERNS),
        "tier_variant": first_match(t, words, TIER_PATTERNS),
        "display_variant": extract_display_variant(words),
        "connectivity": extract_connectivity(t, words),
        "condition": extract_condition(words),
        "storage": extract_storage(words),
        "ram": extract_ram(t, words),
        "screen_size": extract_screen_size(t, words),
        "color": first_match(t, words, COLOR_PATTERNS),
    }


def with_attributes(df, title_col: str = "title", aliases=HEBREW_ALIASES):
    """Append ``normalized_title``, 11 attributes, ``category`` and 11 confidences.

    The title is normalised once and cut to words once; both are bound to lambda
    variables that all extractors read in one ``inline``.  As expressions of a
    projection they would copy the normalisation into each extractor and outgrow a
    generated method.
    """
    nt = normalize_title(F.coalesce(F.col(title_col), F.lit("")), aliases)
    rest = [k for k in ATTRIBUTES if k not in ("model_family", "model_number")]

    def extracted(t: Column) -> Column:
        return _bind(known_words(t), lambda words: F.struct(
            t.alias("normalized_title"), *[c.alias(k) for k, c in attribute_columns(t, words).items()]))

    rows = F.transform(F.transform(F.array(nt), extracted), lambda s: F.struct(
        s["normalized_title"].alias("normalized_title"), s["model_family"].alias("model_family"),
        *[s[k].alias(k) for k in rest],
        extract_model_number(s["normalized_title"], s["model_family"]).alias("model_number"),
        infer_category(s["model_family"]).alias("category")))
    df = df.select("*", F.inline(rows))
    return df.withColumns({f"{a}_confidence": F.when(F.col(a).isNotNull(), F.lit("high")).otherwise(F.lit("missing"))
                           for a in ATTRIBUTES})


def promo_penalty(title: Column, terms=PROMO_TERMS) -> Column:
    """Number of noise terms contained in the lowercased raw title."""
    low = F.lower(title.cast("string"))
    return sum((F.coalesce(F.instr(low, t), F.lit(0)) > 0).cast("int") for t in terms)


def completeness(fields=SCORED_FIELDS) -> Column:
    """Count of non-null attributes."""
    return sum(F.col(f).isNotNull().cast("int") for f in fields)
