"""DuckDB SQL of the scored pipeline: ratios, decisions, verdicts, final groups, evaluation, analysis.

The ratios are re-stated from their definitions.  LCS lengths come from a
recursive query that advances every (pair, window start) by one character:
the state is a HUGEINT of one bit per character of the shorter text, so texts
of up to 120 characters are taken this way, and longer ones by a list of row
values (plain dynamic programming).
"""

from __future__ import annotations

from sameitem.plans import oracle as O

Q = O.q
#: Characters that a HUGEINT state holds.
WORD = 120


def pair_ctes() -> str:
    """PP: compatible title pairs with both sides' columns and the unrounded attribute and vector scores."""
    vec = ("VEC as (select n.node_id, min(e.embedding) as embedding from NODES n join L on L.listing_id = n.node_id "
           "join embeddings e on e.vec_id = L.true_product % (select count(*) from embeddings) group by n.node_id)")
    dot = lambda x, y: f"list_dot_product({x}.embedding::DOUBLE[], {y}.embedding::DOUBLE[])"
    cos = (f"case when va.embedding is not null and vb.embedding is not null and {dot('va', 'va')} > 0 and {dot('vb', 'vb')} > 0 "
           f"then {dot('va', 'vb')} / (sqrt({dot('va', 'va')}) * sqrt({dot('vb', 'vb')})) else 0.0 end")
    sides = ", ".join(f"a.{c} as {c}_1, b.{c} as {c}_2" for c in [*O.ATTRS, "category", "normalized_title"])
    return (vec + ",\n" + f"PP as materialized (select a.node_id as id1, b.node_id as id2, a.n_listings * b.n_listings as n_pairs, "
            f"a.rep_title as title_1, b.rep_title as title_2, {sides}, {O.attr_score_sql()} as att, {cos} as emb, "
            f"{O.strong_sql()} as strong_reason from NODES a join NODES b on a.block = b.block and a.node_id < b.node_id "
            "left join VEC va on va.node_id = a.node_id left join VEC vb on vb.node_id = b.node_id "
            f"where {O.conflict_sql()} is null)")


def fuzzy_ctes() -> str:
    """FZ: ``id1, id2, fuzzy`` of every row of PP."""
    words = lambda c: f"list_filter(string_split({c}, ' '), lambda w: w <> '')"
    rest = lambda x, y: f"array_to_string(list_sort(list_distinct(list_filter({x}, lambda w: not list_contains({y}, w)))), ' ')"
    return f"""
PW as (select id1, id2, normalized_title_1 as n1, normalized_title_2 as n2, {words('normalized_title_1')} as w1,
  {words('normalized_title_2')} as w2 from PP),
PS as materialized (select *, array_to_string(list_sort(w1), ' ') as s1, array_to_string(list_sort(w2), ' ') as s2,
  {rest('w1', 'w2')} as r1, {rest('w2', 'w1')} as r2,
  length(array_to_string(list_distinct(list_filter(w1, lambda w: list_contains(w2, w))), ' ')) as x from PW),
JOB as materialized (select row_number() over () as job, * from (
  select 's' as kind, id1, id2, s1 as a, s2 as b from PS union all select 'r', id1, id2, r1, r2 from PS
  union all select 'p', id1, id2, case when length(n1) <= length(n2) then n1 else n2 end,
    case when length(n1) <= length(n2) then n2 else n1 end from PS
  union all select 'p', id1, id2, n2, n1 from PS where length(n1) = length(n2))),
CHR as (select a, substr(a, i::INT, 1) as ch, sum((1::HUGEINT << (i - 1)::INT)) as m
  from (select a, unnest(range(1, length(a) + 1)) as i from (select distinct a from JOB where length(a) <= {WORD})) group by a, ch),
POS as (select job, a, i::INT as i, substr(b, i::INT, 1) as ch from (
  select job, a, b, unnest(range(1, length(b) + 1)) as i from JOB where length(a) <= {WORD})),
STEP as materialized (select job, i, m::HUGEINT as m from POS join CHR using (a, ch)),
RUN as materialized (select job, kind, start::INT as start, length(a)::INT as la,
  (case when kind = 'p' then least(length(a), length(b) - start) else length(b) end)::INT as steps from (
  select *, unnest(case when kind = 'p' then range(0, length(b)) else [0] end) as start from JOB where length(a) <= {WORD})),
LCS as (select job, kind, start, la, steps, 0 as t, ((1::HUGEINT << la) - 1)::HUGEINT as v from RUN
  union all select q.job, q.kind, q.start, q.la, q.steps, q.t + 1,
    (case when s.m is null then q.v else ((q.v + (q.v & s.m)) | (q.v - (q.v & s.m))) & ((1::HUGEINT << q.la) - 1) end)::HUGEINT
  from LCS q left join STEP s on s.job = q.job and s.i = q.start + q.t + 1 where q.t < q.steps),
HIT as (select job, kind, la, t, la - bit_count(v) as l from LCS where t = steps or (kind = 'p' and start = 0 and t > 0)),
BEST as (select id1, id2, j.kind, max(case when j.kind = 'p' then (case when h.la + h.t = 0 then 1.0 else 2.0 * l / (h.la + h.t) end)
  else l end) as v from HIT h join JOB j using (job) group by id1, id2, j.kind),
ONE as (select id1, id2, max(v) filter (where kind = 's') as ls, max(v) filter (where kind = 'r') as lr,
  max(v) filter (where kind = 'p') as pr from BEST group by id1, id2),
FM as (select id1, id2, ls, lr, pr, x, length(s1) as la, length(s2) as lb, length(r1) as ra, length(r2) as rb,
  (case when x > 0 then 1 else 0 end) as gap, len(w1) as c1, len(w2) as c2 from PS join ONE using (id1, id2)),
FZ as materialized (select id1, id2, ((case when la + lb = 0 then 100.0 else 200.0 * ls / (la + lb) end)
  + (case when c1 = 0 or c2 = 0 then 0.0 when x > 0 and (ra = 0 or rb = 0) then 100.0
     when x = 0 then 100.0 - 100.0 * (ra + rb - 2 * lr) / (ra + rb)
     else greatest(100.0 - 100.0 * (ra + rb - 2 * lr) / (2 * (x + gap) + ra + rb), 100.0 - 100.0 * (gap + ra) / (2 * x + gap + ra),
       100.0 - 100.0 * (gap + rb) / (2 * x + gap + rb)) end) + 100.0 * coalesce(pr, 0.0)) / 300.0::DOUBLE as fuzzy from FM)"""


def decision_ctes() -> str:
    """SC: scored title pairs with decision and reason before verdicts."""
    core = " and ".join(f"{c}_1 is not distinct from {c}_2" for c in ("brand", "model_family", "model_number"))
    special = "('pro', 'ultra', 'plus', 'fe')"
    one_null = lambda f: f"({f}_1 is null) <> ({f}_2 is null)"
    flags = ("array_to_string(list_filter(["
             f"case when core and ((tier_variant_1 in {special} and tier_variant_2 is null) or (tier_variant_2 in {special} and tier_variant_1 is null)) "
             "then 'base_vs_special_variant_missing_side' end, "
             f"case when core and score >= 0.9 and {one_null('display_variant')} then 'display_variant_partial_disagreement' end, "
             f"case when core and score >= 0.9 and {one_null('connectivity')} then 'connectivity_partial_disagreement' end, "
             f"case when core and score >= 0.8 and {one_null('color')} then 'color_missing_side' end], lambda f: f is not null), '|')")
    return f"""
S0 as (select PP.*, fuzzy, 0.5 * fuzzy + 0.35 * att + 0.15 * emb as score, ({core}) as core from PP join FZ using (id1, id2)),
S1 as (select *, {flags} as flags from S0),
SC as materialized (select *, round(fuzzy, 4) as fuzzy_score, round(emb, 4) as embedding_score, round(att, 4) as attribute_score,
  round(score, 4) as final_score,
  case when strong_reason is not null or (score >= 0.985 and flags = '') then 'merge' when flags <> '' then 'llm_verify'
       when score >= 0.78 and score < 0.985 then 'llm_review' else 'reject' end as decision,
  case when strong_reason is not null then strong_reason when score >= 0.985 and flags = '' then 'very_high_score_no_conflict'
       when flags <> '' then flags when score >= 0.78 and score < 0.985 then 'borderline_score_review'
       else 'low_or_insufficient_confidence' end as reason from S1)"""


PAYLOAD = ["title", "normalized_title", "brand", "model_family", "model_number", "tier_variant", "display_variant", "connectivity",
           "condition", "storage", "ram", "screen_size", "color", "category"]


def _json(parts: list[tuple[str, str]]) -> str:
    """SQL that writes a JSON object of (name, SQL of its JSON text)."""
    return "'{' || " + " || ',' || ".join(Q(f'"{k}":') + f" || {v}" for k, v in parts) + " || '}'"


def _text(x: str) -> str:
    return f"coalesce(to_json({x})::VARCHAR, 'null')"


def request_ctes(instruction: str, rules: list[str], output_format: dict) -> str:
    """RQ: one request per routed pair, its JSON text written field by field."""
    side = lambda s: _json([(c, _text(c + s)) for c in PAYLOAD])
    number = lambda c: f"{c}::VARCHAR"
    fixed = lambda v: "to_json(" + Q(v) + ")::VARCHAR"
    evidence = _json([("route", fixed_col("decision")), *[(c, number(c)) for c in
                      ("fuzzy_score", "embedding_score", "attribute_score", "final_score")],
                      ("rule_reason_before_llm", fixed_col("reason"))])
    body = _json([("task", fixed("product_match_decision")), ("prompt_version", fixed("v4_evidence_routed")),
                  ("instruction", fixed(instruction)),
                  ("rules", "'[' || " + " || ',' || ".join(fixed(r) for r in rules) + " || ']'"),
                  ("product_a", side("_1")), ("product_b", side("_2")), ("evidence", evidence),
                  ("output_format", _json([(k, fixed(v)) for k, v in output_format.items()]))])
    return (f"RQ as (select id1, id2, case when decision = 'llm_verify' then 'verify' else 'review' end as review_bucket, "
            f"{body} as request_json from SC where decision in ('llm_review', 'llm_verify'))")


def fixed_col(c: str) -> str:
    return f"to_json({c})::VARCHAR"


def verdict_ctes() -> str:
    """VD: replayed replies of the routed pairs, parsed: ``id1, id2, m, conf, r``."""
    yes = "(tier_variant_1 is not distinct from tier_variant_2 and color_1 is not distinct from color_2)"
    replies = ["""'{"match": "' || m || '", "confidence": "high", "reason": "' || r || '"}'""",
               """'```json' || chr(10) || '{"match": "' || m || '", "confidence": "medium", "reason": "' || r || '"}' || chr(10) || '```'""",
               """'Sure: {"match": "' || upper(m) || '", "confidence": "High", "reason": " ' || r || ' "} hope this helps'""",
               """'{"match": "' || m || '", "confidence": "low", "reason": "' || r || '"}'""",
               """'{"match": "' || m || '", "confidence": 0.9}'""", "'not json at all'", "''", """'[{"match": "' || m || '"}]'"""]
    shape = " ".join(f"when {i} then {x}" for i, x in enumerate(replies))
    get = lambda k, d: (f"trim(case when json_exists(obj, '$.{k}') then coalesce(json_extract_string(obj, '$.{k}'), 'None') "  # noqa: E731
                        f"else {Q(d)} end)")
    return f"""
V0 as (select id1, id2, case when {yes} then 'yes' else 'no' end as m,
  case when {yes} then 'same model and colour' else 'tier variant or colour differs' end as r,
  (id1 * 7 + id2 * 13) % 8 as shape, (id1 * 3 + id2 * 5) % 13 = 0 as failed from SC where decision in ('llm_review', 'llm_verify')),
V1 as (select id1, id2, case when failed then 'RateLimitError' end as error,
  case when not failed then case shape {shape} end end as raw from V0),
V2 as (select *, trim(case when starts_with(trim(coalesce(raw, '')), '```') then replace(replace(raw, '```json', ''), '```', '')
  else coalesce(raw, '') end, chr(10) || chr(9) || chr(13) || ' ') as t from V1),
V3 as (select *, case when json_valid(t) then t else regexp_extract(t, '\\{{.*\\}}', 0, 's') end as span from V2),
V4 as (select *, case when json_valid(span) and span <> '' and json_type(span) = 'OBJECT' then span::JSON end as obj,
  case when error is not null then 'provider_error_' || error when t = '' then 'invalid_json_response'
       when json_valid(t) and json_type(t) = 'ARRAY' then case when json_array_length(t) > 0 then 'provider_error_AttributeError' else 'invalid_json_response' end
       when span = '' or not json_valid(span) or len(json_keys(span)) = 0 then 'invalid_json_response' end as bad from V3),
V5 as (select id1, id2, bad, lower({get('match', 'no')}) as m, lower({get('confidence', 'low')}) as c, {get('reason', 'missing_reason')} as r from V4),
VD as materialized (select id1, id2, case when bad is null and m in ('yes', 'no') then m else 'no' end as m,
  case when bad is null then case c when 'high' then 0.9::DOUBLE when 'medium' then 0.6 else 0.3 end else 0.3 end::DOUBLE as conf,
  case when bad is null then case when r = '' then 'missing_reason' else r end else bad end as r from V5)"""


def resolution_ctes() -> str:
    """VD: one reply per title pair out of the messy table of the replies VD0, with the number of replies."""
    return """
LAST as (select n.node_id, max(M.listing_id) as last_id from NODES n join M using (normalized_title) group by n.node_id),
NODE as (select M.listing_id, n.node_id from M join NODES n using (normalized_title)),
MS as (select id1 as a, id2 as b, m, conf, r from VD0 where (id1 + id2) % 4 <> 1
  union all select id1, id2, m, conf, r from VD0 where (id1 + id2) % 7 = 3
  union all select id2, id1, m, conf, r from VD0 where (id1 + id2) % 3 = 0
  union all select y.last_id, x.last_id, m, conf, r from VD0 join LAST x on x.node_id = id1 join LAST y on y.node_id = id2 where (id1 + id2) % 4 = 1
  union all select id2, id1, 'no', 0.6, 'second opinion' from VD0 where (id1 + id2) % 5 = 2
  union all select id1, -id2, m, conf, r from VD0 where (id1 + id2) % 11 = 5),
MN as (select least(x.node_id, y.node_id) as id1, greatest(x.node_id, y.node_id) as id2, m, conf, r,
  r = 'invalid_json_response' or starts_with(r, 'provider_error_') as failed
  from MS join NODE x on x.listing_id = a join NODE y on y.listing_id = b where x.node_id <> y.node_id),
VD as materialized (select id1, id2, m, conf, r, n_replies from (select *, count(*) over (partition by id1, id2) as n_replies,
  row_number() over (partition by id1, id2 order by failed, m = 'yes', conf desc, r) as k from MN) where k = 1)"""


def final_ctes() -> str:
    """FP: final decision and reason of every scored title pair, with the verdict columns."""
    a, b = "nullif(lower(trim(tier_variant_1)), '')", "nullif(lower(trim(tier_variant_2)), '')"
    special = "('pro', 'ultra', 'plus', 'fe')"
    guard = f"coalesce(({a} <> {b}) or ({a} is null and {b} in {special}) or ({b} is null and {a} in {special}), false)"
    return f"""
F0 as (select SC.*, VD.m, VD.conf, VD.r, VD.m is not null as answered, VD.m = 'yes' and VD.conf >= 0.5 as yes_ok, {guard} as guard
  from SC left join VD using (id1, id2)),
FP as materialized (select * exclude (decision, reason), decision as route,
  case when not answered then decision when yes_ok and not guard then 'merge' else 'reject' end as decision,
  case when not answered then reason else (case when yes_ok and guard then 'guardrail_variant_after_llm_yes'
      when yes_ok then 'llm_merge: ' || r else 'llm_reject: ' || r end)
    || (case when m = 'no' and final_score > 0.9 then ' | llm_rule_disagreement' else '' end) end as reason from F0)"""


def weighted_ctes() -> str:
    """WD: all candidate listing pairs by decision and reason, conflicts and equal titles counted pair by pair."""
    return (O.candidate_pairs_ctes() + ",\n"
            f"CF as (select {O.conflict_sql()} as reason, P.id1, P.id2 from P join M a on a.listing_id = P.id1 "
            "join M b on b.listing_id = P.id2),\n"
            "WD as (select decision, reason, sum(n)::BIGINT as pairs from ("
            "select decision, reason, n_pairs as n from FP union all "
            "select 'merge', 'exact_normalized_match', n_listings * (n_listings - 1) // 2 from NODES where n_listings >= 2 union all "
            "select 'reject', reason, 1 from CF where reason is not null) group by decision, reason)")


def component_ctes() -> str:
    """LC: listings with the component that the final merges give."""
    return ("SE as (select id1 as a, id2 as b from FP where decision = 'merge' union all select id2, id1 from FP where decision = 'merge'),\n"
            "RC as (select node_id as node, node_id as comp from NODES union select SE.b, RC.comp from RC join SE on RC.node = SE.a),\n"
            "NC as (select node, min(comp) as comp from RC group by node),\n"
            "LC as (select M.*, coalesce(NC.comp, M.listing_id) as component from M "
            "left join NODES n on n.normalized_title = M.normalized_title and M.block is not null "
            "left join NC on NC.node = n.node_id)")


def metadata_ctes() -> str:
    """MD: match source and confidence per component, of its weakest merge."""
    any_attr = "(" + " or ".join(f"{c} is not null" for c in O.ATTRS) + ")"
    return (f"ED as (select id1, id2, final_score, reason from FP where decision = 'merge' union all "
            f"select n.node_id, n.node_id, round(0.5 * 1.0 + 0.35 * {any_attr}::INT + 0.15 * coalesce(list_dot_product(v.embedding::DOUBLE[], "
            "v.embedding::DOUBLE[]) > 0, false)::INT, 4), 'exact_normalized_match' from NODES n left join VEC v using (node_id) where n_listings >= 2),\n"
            "MD as (select comp as component, case when contains(reason, 'llm') then 'llm' else 'rules_scoring' end as match_source, "
            "round(final_score, 4) as confidence from (select ED.*, NC.comp, row_number() over (partition by NC.comp "
            "order by final_score, id1, id2) as k from ED join NC on NC.node = ED.id1) where k = 1)")


def prediction_ctes() -> str:
    """PD: labelled pairs with the final decision, reason, prediction and score."""
    candidate = ("coalesce(a.listing_id is not null and b.listing_id is not null and g.k1 <> g.k2 "
                 "and (coalesce(a.block = b.block, false) or coalesce(a.cs = b.cs, false)), false)")
    same = "a.normalized_title = b.normalized_title"
    return ("G0 as (select least(listing_id_1, listing_id_2) as k1, greatest(listing_id_1, listing_id_2) as k2, label from GOLD),\n"
            "NT as (select normalized_title, min(listing_id) as node from M group by normalized_title),\n"
            "PD as (select *, coalesce((decision = 'merge')::INT, 0) as pred_label from ("
            f"select g.k1 as listing_id_1, g.k2 as listing_id_2, label, "
            f"case when not {candidate} then null when {O.conflict_sql()} is not null then 'reject' when {same} then 'merge' else f.decision end as decision, "
            f"case when not {candidate} then null when {O.conflict_sql()} is not null then {O.conflict_sql()} when {same} then 'exact_normalized_match' else f.reason end as reason, "
            f"a.title as title_1, b.title as title_2, case when not ({same}) then f.final_score end as final_score "
            "from G0 g left join M a on a.listing_id = g.k1 left join M b on b.listing_id = g.k2 "
            "left join NT na on na.normalized_title = a.normalized_title left join NT nb on nb.normalized_title = b.normalized_title "
            "left join FP f on f.id1 = least(na.node, nb.node) and f.id2 = greatest(na.node, nb.node)))")


def variant_ctes() -> str:
    """VC: variant rejections, scored pairs and conflicts (by attribute tuple, from listing pairs)."""
    fields = ", ".join(O.CONFLICT)
    return (f"TP as (select block, {fields}, min(listing_id) as rep, arg_min(title, listing_id) as title from M where block is not null group by block, {fields}),\n"
            "TM as (select M.listing_id, TP.rep, TP.title from M join TP on M.block = TP.block and "
            + " and ".join(f"M.{f} is not distinct from TP.{f}" for f in O.CONFLICT) + "),\n"
            "VC as (select id1 as listing_id_1, id2 as listing_id_2, title_1, title_2, final_score, m as llm_raw_decision, "
            "conf as llm_confidence, reason, n_pairs::BIGINT as n_pairs from FP where contains(lower(reason), 'variant') and decision = 'reject' "
            "union all select least(x.rep, y.rep), greatest(x.rep, y.rep), case when x.rep < y.rep then x.title else y.title end, "
            "case when x.rep < y.rep then y.title else x.title end, null, null, null, reason, count(*)::BIGINT "
            "from CF join TM x on x.listing_id = CF.id1 join TM y on y.listing_id = CF.id2 where contains(reason, 'variant') "
            "group by all)")
