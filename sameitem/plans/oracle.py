"""DuckDB SQL for the correctness oracle (independent re-statement of the rules).

DuckDB's RE2 has an ASCII-only ``\\b`` and no lookahead, so Python word
boundaries are written out: a boundary before a word is ``(^|[^\\p{L}\\p{N}_])``
and after it ``([^\\p{L}\\p{N}_]|$)``; replacements put the consumed
characters back and are applied twice where two matches can touch.  A
``\\bWORD\\b`` test on a plain word is a membership test on the text's
word runs.
"""

from __future__ import annotations

import re

from sameitem.functions import titles as TT
from sameitem.sources.fixture import GOLD_OFFSETS, LISTINGS_SQL

NW = r"[^\p{L}\p{N}_]"
LB = f"(?:^|{NW})"
RB = f"(?:{NW}|$)"
ATTRS = TT.ATTRIBUTES
# Field lists of the rules, written out again (a test compares them with the engine's).
CONFLICT = ["brand", "model_family", "model_number", "storage", "tier_variant",
            "display_variant", "connectivity", "ram", "condition"]
PHONE = ["brand", "model_family", "model_number", "storage", "tier_variant", "condition", "color"]
MODEL = ["brand", "model_family", "model_number", "tier_variant", "display_variant",
         "connectivity", "ram", "storage", "screen_size", "condition", "color"]
GROUP_CONFLICT = ["brand", "model_family", "model_number", "tier_variant", "display_variant",
                  "connectivity", "storage", "ram", "screen_size", "condition"]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _bounded(p: str) -> str:
    if p.startswith(r"\b"):
        p = LB + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + RB
    return p


def _rep(x: str, pattern: str, repl: str, twice: bool = False) -> str:
    out = f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"
    return f"regexp_replace({out}, {q(pattern)}, {q(repl)}, 'g')" if twice else out


def normalize_sql(x: str) -> str:
    """N1-N9 as one DuckDB expression over a text expression ``x``."""
    t = f"regexp_replace(lower({x}), '^\\s+|\\s+$', '', 'g')"
    for he, en in TT.HEBREW_ALIASES:
        t = _rep(t, f"(^|{NW}){he}({NW}|$)", f"\\1{en}\\2", twice=True)
    t = _rep(t, rf"(\d+)\s*(gb|g|gig|gigabyte)({NW}|$)", r"\1gb\3")
    tb = (f"list_reduce(list_distinct(regexp_extract_all(@T@, {q(rf'(\d+)\s*tb({NW}|$)')}, 1)), "
          f"lambda acc, n: regexp_replace(regexp_replace(acc, '(^|[^0-9])' || n || {q(rf'\s*tb({NW}|$)')}, "
          f"'\\1' || (n::HUGEINT * 1024)::VARCHAR || 'gb\\2', 'g'), '(^|[^0-9])' || n || {q(rf'\s*tb({NW}|$)')}, "
          f"'\\1' || (n::HUGEINT * 1024)::VARCHAR || 'gb\\2', 'g'), @T@)")
    t = f"(case when contains({t}, 'tb') then {tb.replace("@T@", t)} else {t} end)"
    t = _rep(t, rf"(\d+)\s*ssd({NW}|$)", r"\1ssd\2")
    t = _rep(t, rf"(\d+)\s*ram({NW}|$)", r"\1gb ram\2")
    t = _rep(t, rf"(\d+)\s*ממ({NW}|$)", r"\1mm\2")
    t = _rep(t, rf"(\d+)\s*inch({NW}|$)", r"\1 inch\2")
    t = _rep(t, rf"(^|{NW})1st\s*gen({NW}|$)", r"\1gen1\2", twice=True)
    t = _rep(t, rf"(^|{NW})2nd\s*gen({NW}|$)", r"\1gen2\2", twice=True)
    t = _rep(t, rf"(^|{NW})3rd\s*gen({NW}|$)", r"\1gen3\2", twice=True)
    t = _rep(t, rf"(^|{NW})gen\s+(\d)({NW}|$)", r"\1gen\2\3", twice=True)
    t = _rep(t, rf"(^|{NW})iphone\s+(11|12|13|14|15|16)({NW}|$)", r"\1iphone \2\3", twice=True)
    t = _rep(t, rf"(^|{NW})note\s+(\d{{1,2}})({NW}|$)", r"\1note \2\3", twice=True)
    t = _rep(t, rf"(^|{NW})series\s+(\d{{1,2}})({NW}|$)", r"\1series \2\3", twice=True)
    t = _rep(t, rf"(^|{NW})wh[-\s]?1000[-\s]?xm([345])({NW}|$)", r"\1wh1000xm\2\3", twice=True)
    t = _rep(t, r"[-+(),/|]", " ")
    t = _rep(t, r"\s+", " ")
    return f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"


_WORD = re.compile(r"^\\b([a-z0-9_]+)\\b$")


def _test(p: str) -> str:
    m = _WORD.match(p)
    if m:
        return f"list_contains(tok, {q(m.group(1))})"
    return f"regexp_matches(nt, {q(_bounded(p))})"


def _first_match(patterns) -> str:
    whens = " ".join(f"when {' or '.join(_test(p) for p in pats)} then {q(v)}" for v, pats in patterns)
    return f"(case {whens} end)"


def _extract(p: str) -> str:
    return f"nullif(regexp_extract(nt, {q(_bounded(p))}, 1), '')"


def _first_token(rx: str) -> str:
    return f"list_filter(tok, lambda x: regexp_full_match(x, {q(rx)}))[1]"


def attribute_ctes(src: str, text_col: str) -> str:
    """CTEs N (normalised title), T (tokens), A1/A (attributes) over ``src``."""
    conn = (f"(case when list_contains(tok, 'gps') and list_contains(tok, 'cellular') then 'gps_cellular' "
            f"else {_first_match(TT.CONNECTIVITY_PATTERNS)} end)")
    cond = "(case " + " ".join(f"when list_contains(tok, {q(v)}) then {q(v)}" for v in TT.CONDITION_ORDER) + " end)"
    storage = ("(list_max(list_concat("
               "list_transform(list_filter(tok, lambda x: regexp_full_match(x, '(32|64|128|256|512|1024|2048)gb')), "
               "lambda x: replace(x, 'gb', '')::INTEGER), "
               "list_transform(list_filter(tok, lambda x: regexp_full_match(x, '(128|256|512|1024|2048)ssd')), "
               "lambda x: replace(x, 'ssd', '')::INTEGER)))::VARCHAR || 'gb')")
    ram_tail = rf"(?:|.*{NW})(?:128ssd|256ssd|512ssd|1024ssd|128gb|256gb|512gb|1024gb){RB}"
    ram = (f"(case when coalesce({_extract(r'\b(4|8|16|24|32|64)gb\s+ram\b')}, "
           f"nullif(regexp_extract(nt, {q(LB + '(4|8|16|24|32|64)gb' + NW + ram_tail)}, 1), '')) is not null "
           f"then coalesce({_extract(r'\b(4|8|16|24|32|64)gb\s+ram\b')}, "
           f"nullif(regexp_extract(nt, {q(LB + '(4|8|16|24|32|64)gb' + NW + ram_tail)}, 1), '')) || 'gb' end)")
    scr_tail = rf"(?:|.*{NW})(?:8gb|16gb|512ssd|512gb){RB}"
    screen = (f"coalesce({_extract(r'\b(13|14|15|16|17)(?:\.3)?\s*inch\b')}, "
              f"nullif(regexp_extract(nt, {q(LB + '(13|14|15|16|17)' + NW + scr_tail)}, 1), ''), "
              f"replace({_first_token('(41|45)mm')}, 'mm', ''))")
    number = ("(case model_family "
              f"when 'galaxy' then coalesce({_first_token('s[0-9]{2}')}, {_first_token('a[0-9]{2}')}) "
              f"when 'iphone' then coalesce({_extract(r'\biphone\s(11|12|13|14|15|16)\b')}, "
              f"replace({_first_token('iphone(11|12|13|14|15|16)')}, 'iphone', '')) "
              f"when 'airpods' then {_first_token('gen[123]')} "
              f"when 'redmi_note' then coalesce({_extract(r'\bnote\s(\d{1,2})\b')}, "
              f"replace({_first_token('note[0-9]{1,2}')}, 'note', '')) "
              f"when 'ideapad' then {_extract(r'\bideapad\s+(\d)\b')} "
              f"when 'watch' then coalesce({_extract(r'\bseries\s(\d{1,2})\b')}, {_extract(r'\bwatch\s(7|8|9|10)\b')}) "
              f"when 'wh1000x' then 'xm' || replace({_first_token('wh1000xm[345]')}, 'wh1000xm', '') "
              "end)")
    category = "(case model_family " + " ".join(
        f"when {q(k)} then {q(v)}" for k, v in TT.CATEGORY_BY_FAMILY.items()) + " end)"
    conf = ", ".join(f"case when {a} is not null then 'high' else 'missing' end as {a}_confidence" for a in ATTRS)
    return f"""
N as (select *, {normalize_sql(f"coalesce({text_col}, '')")} as nt from {src}),
T as (select *, regexp_split_to_array(nt, {q(NW + '+')}) as tok from N),
A1 as (select *,
  {_first_match(TT.BRAND_PATTERNS)} as brand,
  {_first_match(TT.FAMILY_PATTERNS)} as model_family,
  {_first_match(TT.TIER_PATTERNS)} as tier_variant,
  (case when list_contains(tok, 'oled') then 'oled' when list_contains(tok, 'switch') then 'standard' end) as display_variant,
  {conn} as connectivity,
  {cond} as condition,
  {storage} as storage,
  {ram} as ram,
  {screen} as screen_size,
  {_first_match(TT.COLOR_PATTERNS)} as color
  from T),
A as (select * exclude (tok), nt as normalized_title, {number} as model_number, {category} as category, {conf} from A1)"""


PRICE_RX = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def blank_null(x: str) -> str:
    return f"case when regexp_matches({x}, '^\\s*$') then null else {x} end"


def listings_cte() -> str:
    return "L as (" + LISTINGS_SQL.format(part="part") + ")"


SRC = "coalesce(source, 'nan')"
CUR = "coalesce(currency, 'nan')"


def pipeline_ctes(mode: str = "drop") -> str:
    """SQL CTE list (no leading WITH): L, C, A, M, K (keyed), NODES."""
    price = f"case when regexp_matches(price, {q(PRICE_RX)}) then try_cast(trim(price) as double) end"
    keep = (f"where title is not null and {strip('title')} <> '' and lower({strip('title')}) <> 'nan' "
            f"and ({price}) is not null and ({price}) > 0") if mode == "drop" else ""
    c0 = (f"C0 as (select listing_id, listing_id as row_seq, true_product, {strip('title')} as title, "
          f"{strip(SRC)} as source, {strip(CUR)} as currency, "
          f"({price}) as price from L {keep})")
    c = ("C as (select listing_id, row_seq, true_product, "
         f"{blank_null('title')} as title, {blank_null('source')} as source, {blank_null('currency')} as currency, price, "
         "(title is null or title = '') as dq_missing_title, price is null as dq_missing_price, "
         "coalesce(price, 0) <= 0 as dq_nonpositive_price, coalesce(price, 0) < 200 as dq_suspicious_low_price from C0)")
    bf = "brand is not null and model_family is not null"
    toks = "string_split(normalized_title, ' ')"
    block = (f"case when {bf} then 'family|' || brand || '|' || model_family "
             f"when len({toks}) >= 2 and normalized_title <> '' then 'fallback|' || {toks}[1] || '|' || {toks}[2] end")
    cs = ("case when brand is not null and model_number is not null and storage is not null "
          "then 'core_storage|' || brand || '|' || model_number || '|' || storage end")
    m = f"M as (select *, {block} as block, {cs} as cs from A where not dq_missing_title and not dq_missing_price and not dq_nonpositive_price)"
    nodes = ("NODES as (select normalized_title, min(listing_id) as node_id, count(*) as n_listings, "
             "arg_min(title, listing_id) as rep_title, any_value(block) as block, any_value(category) as category, "
             + ", ".join(f"any_value({a}) as {a}" for a in ATTRS)
             + " from M where block is not null group by normalized_title)")
    return ",\n".join([listings_cte(), c0, c, attribute_ctes("C", "title").strip().rstrip(","), m, nodes])


def conflict_sql(a: str = "a", b: str = "b") -> str:
    whens = " ".join(f"when {a}.{f} is not null and {b}.{f} is not null and {a}.{f} <> {b}.{f} then '{f}_mismatch'"
                     for f in CONFLICT)
    special = (f"when ({a}.condition in ('refurbished','used') and {a}.condition is distinct from {b}.condition) "
               f"or ({b}.condition in ('refurbished','used') and {a}.condition is distinct from {b}.condition) "
               "then 'condition_mismatch'")
    return f"(case {whens} {special} end)"


def strong_sql(a: str = "a", b: str = "b") -> str:
    eq = lambda fs: " and ".join(f"{a}.{f} is not distinct from {b}.{f}" for f in fs)
    return (f"(case when {a}.normalized_title = {b}.normalized_title and {conflict_sql(a, b)} is null then 'exact_normalized_match' "
            f"when {a}.category = 'phone' and {b}.category = 'phone' and {eq(PHONE)} then 'strong_phone_identity_match' "
            f"when {eq(MODEL)} then 'strong_model_identity_match' end)")


def attr_score_sql(a: str = "a", b: str = "b") -> str:
    fs = TT.SCORED_FIELDS
    comp = " + ".join(f"({a}.{f} is not null and {b}.{f} is not null)::INT" for f in fs)
    mat = " + ".join(f"({a}.{f} is not null and {b}.{f} is not null and {a}.{f} = {b}.{f})::INT" for f in fs)
    return f"(case when ({comp}) > 0 then ({mat})::DOUBLE / ({comp}) else 0.0 end)"


def keys_sql() -> str:
    def key(name, *cols):
        ok = " and ".join(f"{c} is not null" for c in cols)
        return f"case when {ok} then '{name}|' || " + " || '|' || ".join(cols) + " end"
    ks = [key("core", "brand", "model_family", "model_number"),
          key("core_storage", "brand", "model_number", "storage"),
          key("family_storage", "brand", "model_family", "storage"),
          key("family_variant", "brand", "model_family", "tier_variant"),
          key("family_display", "brand", "model_family", "display_variant"),
          key("family_conn", "brand", "model_family", "connectivity"),
          key("family_ram", "brand", "model_family", "ram"),
          key("family_size", "brand", "model_family", "screen_size"),
          key("family_condition", "brand", "model_family", "condition"),
          key("family", "brand", "model_family"),
          "case when brand is not null and model_family is not null and model_number is not null "
          "then 'loose|' || brand || '|' || model_family || '|' || model_number "
          "when brand is not null and model_family is not null then 'loose|' || brand || '|' || model_family end"]
    lst = "list_filter([" + ", ".join(ks) + "], lambda x: x is not null)"
    toks = "string_split(normalized_title, ' ')"
    return (f"(case when len({lst}) > 0 then list_distinct({lst}) "
            f"when len({toks}) >= 2 and normalized_title <> '' then ['fallback|' || {toks}[1] || '|' || {toks}[2]] "
            "else []::VARCHAR[] end)")


def candidate_pairs_ctes() -> str:
    return (f"K as (select listing_id, {keys_sql()} as keys from M),\n"
            "E as (select listing_id, unnest(keys) as k from K),\n"
            "P as (select distinct x.listing_id as id1, y.listing_id as id2 from E x join E y "
            "on x.k = y.k and x.listing_id < y.listing_id)")


def compat_pairs_ctes() -> str:
    """VEC (title vectors), CP (compatible title pairs with rule columns)."""
    vec = ("VEC as (select n.node_id, e.embedding from NODES n join L on L.listing_id = n.node_id "
           "join embeddings e on e.vec_id = L.true_product % (select count(*) from embeddings))")
    cos = ("case when va.embedding is not null and vb.embedding is not null "
           "and list_dot_product(va.embedding::DOUBLE[], va.embedding::DOUBLE[]) > 0 "
           "and list_dot_product(vb.embedding::DOUBLE[], vb.embedding::DOUBLE[]) > 0 "
           "then list_dot_product(va.embedding::DOUBLE[], vb.embedding::DOUBLE[]) / "
           "(sqrt(list_dot_product(va.embedding::DOUBLE[], va.embedding::DOUBLE[])) * "
           "sqrt(list_dot_product(vb.embedding::DOUBLE[], vb.embedding::DOUBLE[]))) else 0.0 end")
    cp = (f"CP as (select a.node_id as listing_id_1, b.node_id as listing_id_2, a.n_listings * b.n_listings as n_pairs, "
          f"round({attr_score_sql()}, 4) as attribute_score, round({cos}, 4) as embedding_score, "
          f"{strong_sql()} as strong_reason "
          f"from NODES a join NODES b on a.block = b.block and a.node_id < b.node_id "
          f"left join VEC va on va.node_id = a.node_id left join VEC vb on vb.node_id = b.node_id "
          f"where {conflict_sql()} is null)")
    return vec + ",\n" + cp


def strong_component_ctes() -> str:
    """SE (strong title edges), RC (recursive reach), NC (node component), LC (listing component)."""
    return ("SE as (select listing_id_1 as a, listing_id_2 as b from CP where strong_reason is not null "
            "union all select listing_id_2, listing_id_1 from CP where strong_reason is not null),\n"
            "RC as (select node_id as node, node_id as comp from NODES union "
            "select SE.b, RC.comp from RC join SE on RC.node = SE.a),\n"
            "NC as (select node, min(comp) as comp from RC group by node),\n"
            "LC as (select M.*, coalesce(NC.comp, M.listing_id) as component from M "
            "left join NODES n on n.normalized_title = M.normalized_title and M.block is not null "
            "left join NC on NC.node = n.node_id)")


def with_recursive(ctes: str) -> str:
    return "with recursive " + ctes


def promo_sql(x: str = "title") -> str:
    return " + ".join(f"contains(lower({x}), {q(t)})::INT" for t in TT.PROMO_TERMS)


def completeness_sql() -> str:
    return " + ".join(f"({f} is not null)::INT" for f in TT.SCORED_FIELDS)


def groups_select() -> str:
    susp = ("LS as (select LC.*, count(price) over (partition by component) as np, "
            "median(price) over (partition by component) as med from LC),\n"
            "LF as (select *, coalesce(np >= 2 and price < 0.5 * med, false) as susp, "
            f"{completeness_sql()} as compl, {promo_sql()} as promo, length(title) as tlen from LS),\n"
            "CAN as (select component, title as canonical_title from (select component, title, row_number() over "
            "(partition by component order by susp, compl desc, promo, tlen desc, price, row_seq) as rn from LF) where rn = 1)")
    conflict = "(case " + " ".join(
        f"when count(distinct {f}) > 1 then 'group_{f}_conflict'" for f in GROUP_CONFLICT) + " else 'no_conflict' end)"
    agg = ("G as (select component, min(row_seq) as first_seq, count(*) as n_listings, "
           "coalesce(min(price) filter (where not susp), min(price)) as min_price, "
           "array_to_string(list_sort(list_distinct(list(source))), '|') as sources, "
           "arg_min(currency, row_seq) as currency, "
           f"{conflict} as group_conflict_reason, "
           "sum(dq_suspicious_low_price::INT)::BIGINT as n_suspicious_low_price from LF group by component)")
    return susp + ",\n" + agg


def gold_ctes() -> str:
    key = ("(q % 6)::VARCHAR || '|' || (case when q % 6 = 4 then 3 + ((floor(q/6)::BIGINT % 4) % 3) "
           "else floor(q/6)::BIGINT % 4 end)::VARCHAR || '|' || (floor(q/24)::BIGINT % 3)::VARCHAR || '|' || "
           "(floor(q/72)::BIGINT % 3)::VARCHAR || '|' || (floor(q/216)::BIGINT % 3)::VARCHAR")
    offs = ", ".join(str(d) for d in GOLD_OFFSETS)
    return (f"TK as (select listing_id, true_product as q, {key} as true_key from L),\n"
            f"OFF as (select listing_id, true_key, unnest([{offs}]) as d from TK),\n"
            "GOLD as (select a.listing_id as listing_id_1, b.listing_id as listing_id_2, "
            "(a.true_key = b.true_key)::INT as label from OFF a join TK b on b.listing_id = a.listing_id + a.d)")
