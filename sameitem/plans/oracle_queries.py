"""DuckDB oracle SQL per registered query (see :mod:`sameitem.plans.queries`)."""

from __future__ import annotations

from sameitem.functions.titles import ATTRIBUTES
from sameitem.plans import oracle as O
from sameitem.plans import oracle_full as X
from sameitem.sources.feeds import CHARSETS
from sameitem.sources.files import NA_VALUES
from sameitem.sources.fixture import feed_sql
from sameitem.operators.analysis import SUMMARY_REASON
from sameitem.operators.verdicts import INSTRUCTION, OUTPUT_FORMAT, RULES

DQ = "dq_missing_title, dq_missing_price, dq_nonpositive_price, dq_suspicious_low_price"
CONF = ", ".join(f"{a}_confidence" for a in ATTRIBUTES)
ATTR = ", ".join(ATTRIBUTES)


def _base(mode: str = "drop") -> str:
    return "with recursive " + O.pipeline_ctes(mode)


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["listings"] = ("with " + O.listings_cte() + " select listing_id, title, price, source, currency from L")
    na = ", ".join(O.q(v) for v in NA_VALUES)
    charset = " ".join(f"when {i} then {O.q(java)}" for i, (_, java) in enumerate(CHARSETS))
    sql["feed_listings"] = ("with " + O.listings_cte() + f",\nFE as ({feed_sql('L')}) "
                            "select listing_id, " + ", ".join(f"case when {c} in ({na}) then null else {c} end as {c}" for c in ("title", "price", "source", "currency"))
                            + f", case listing_id % 6 {charset} end as charset from FE")
    sql["clean_listings"] = _base() + f" select listing_id, title, price, source, currency, {DQ} from A"
    sql["dq_flags"] = _base("flag") + f" select listing_id, title, price, source, currency, {DQ} from A"
    sql["title_normalize"] = _base() + " select listing_id, normalized_title from A"
    sql["attributes"] = _base() + f" select listing_id, {ATTR}, category, {CONF} from A"
    sql["block_keys"] = (_base() + f", K as (select listing_id, {O.keys_sql()} as keys from M) "
                         "select listing_id, array_to_string(list_sort(keys), ';') as block_keys from K")
    sql["candidate_pair_count"] = (_base() + ",\n" + O.candidate_pairs_ctes()
                                   + " select count(*)::BIGINT as candidate_pairs from P")
    sql["conflict_counts"] = (_base() + ",\n" + O.candidate_pairs_ctes() + ",\n"
                              f"R as (select {O.conflict_sql()} as reason from P join M a on a.listing_id = P.id1 "
                              "join M b on b.listing_id = P.id2) "
                              "select reason, count(*)::BIGINT as pairs from R where reason is not null group by reason")
    sql["compatible_pairs"] = (_base() + ",\n" + O.compat_pairs_ctes()
                               + " select listing_id_1, listing_id_2, n_pairs, attribute_score, embedding_score, "
                                 "strong_reason from CP")
    tuples = ", ".join(["block", *ATTRIBUTES])
    sql["identity_classes"] = (
        _base() + ",\n" + O.compat_pairs_ctes() + f",\nCL as (select node_id, min(node_id) over (partition by {tuples}) as class_id from NODES) "
        "select least(x.class_id, y.class_id) as class_id_1, greatest(x.class_id, y.class_id) as class_id_2, strong_reason as reason, "
        "count(*)::BIGINT as n_links, sum(n_pairs)::BIGINT as n_pairs from CP join CL x on x.node_id = listing_id_1 "
        "join CL y on y.node_id = listing_id_2 where strong_reason is not null group by 1, 2, 3")
    sql["strong_components"] = (_base() + ",\n" + O.compat_pairs_ctes() + ",\n" + O.strong_component_ctes()
                                + " select listing_id, component from LC")
    sql["strong_groups"] = (_base() + ",\n" + O.compat_pairs_ctes() + ",\n" + O.strong_component_ctes() + ",\n"
                            + O.groups_select()
                            + " select row_number() over (order by first_seq)::BIGINT as group_id, first_seq, n_listings, "
                              "CAN.canonical_title, min_price, sources, currency, group_conflict_reason, "
                              "n_suspicious_low_price from G join CAN using (component)")
    sql["gold_pairs"] = "with " + O.listings_cte() + ",\n" + O.gold_ctes() + " select * from GOLD"
    pred = (f"PRED as (select g.label, case when a.listing_id is not null and b.listing_id is not null "
            f"and g.k1 <> g.k2 and (a.block = b.block or a.cs = b.cs) and {O.conflict_sql()} is null "
            f"and {O.strong_sql()} is not null then 1 else 0 end as pred_label from "
            "(select least(listing_id_1, listing_id_2) as k1, greatest(listing_id_1, listing_id_2) as k2, label from GOLD) g "
            "left join M a on a.listing_id = g.k1 left join M b on b.listing_id = g.k2)")
    metrics = ("select count(*)::BIGINT as evaluated_pairs, "
               "count(*) filter (where label = 1 and pred_label = 1)::BIGINT as tp, "
               "count(*) filter (where label = 0 and pred_label = 1)::BIGINT as fp, "
               "count(*) filter (where label = 0 and pred_label = 0)::BIGINT as tn, "
               "count(*) filter (where label = 1 and pred_label = 0)::BIGINT as fn")
    ratio = lambda n, d: f"coalesce(round(({n})::DOUBLE / nullif({d}, 0), 6), 0.0)"
    sql["strong_evaluation"] = (_base() + ",\n" + O.gold_ctes() + ",\n" + pred + ",\n"
                                f"MT as ({metrics} from PRED) select *, "
                                f"{ratio('tp', 'tp + fp')} as precision, {ratio('tp', 'tp + fn')} as recall, "
                                f"{ratio('tp + tn', 'evaluated_pairs')} as accuracy, "
                                f"{ratio('fp', 'tp + fp')} as false_merge_rate from MT")
    sql["document_attributes"] = ("with D as (select doc_id, text from documents),\n"
                                  + O.attribute_ctes("D", "text").strip()
                                  + f" select doc_id, length(normalized_title)::INT as normalized_length, {ATTR}, category from A")
    sql.update(_scored())
    return sql


def _scored() -> dict[str, str]:
    """Oracles of everything above the ratios."""
    scored = _base() + ",\n" + X.pair_ctes() + ",\n" + X.fuzzy_ctes().strip() + ",\n" + X.decision_ctes().strip()
    answered = scored + ",\n" + X.verdict_ctes().strip()
    final = answered + ",\n" + X.final_ctes().strip()
    resolved = answered.replace("VD as materialized", "VD0 as materialized") + ",\n" + X.resolution_ctes().strip()
    unanswered = scored + ",\nFP as (select case when decision like 'llm%' then 'reject' else decision end as decision, " \
        "case when decision like 'llm%' then 'llm_unavailable_conservative_reject' else reason end as reason, n_pairs from SC)"
    weighted = final + ",\n" + X.weighted_ctes()
    grouped = final + ",\n" + X.component_ctes()
    groups = grouped + ",\n" + X.metadata_ctes() + ",\n" + O.groups_select()
    predicted = final + ",\n" + O.gold_ctes() + ",\n" + X.prediction_ctes()
    routed = "answered"
    verdict = (f"conf as llm_confidence, m as llm_raw_decision, case when {routed} then 'v4_evidence_routed' end as llm_prompt_version, "
               f"case when {routed} then route end as llm_route, "
               f"case when {routed} then 'v2_routed_llm_verifier_guarded_yes_merge' end as pipeline_version, "
               f"case when {routed} then 'fuzzy50_attr35_embed15' end as score_version, "
               f"case when {routed} then case when route = 'llm_verify' then 'verify' else 'review' end end as review_bucket")
    numbered = ("GN as (select row_number() over (order by first_seq)::BIGINT as group_id, * from G join CAN using (component) "
                "left join MD using (component))")
    ratio = lambda n, d: f"coalesce(round(({n})::DOUBLE / nullif({d}, 0), 6), 0.0)"
    counts = ("select count(*)::BIGINT as evaluated_pairs, count(*) filter (where label = 1 and pred_label = 1)::BIGINT as tp, "
              "count(*) filter (where label = 0 and pred_label = 1)::BIGINT as fp, "
              "count(*) filter (where label = 0 and pred_label = 0)::BIGINT as tn, "
              "count(*) filter (where label = 1 and pred_label = 0)::BIGINT as fn")
    ratios = (f"{ratio('tp', 'tp + fp')} as precision, {ratio('tp', 'tp + fn')} as recall, "
              f"{ratio('tp + tn', 'evaluated_pairs')} as accuracy, {ratio('fp', 'tp + fp')} as false_merge_rate")
    variant = "(decision = 'reject' and contains(lower(reason), 'variant'))"
    return {
        "fuzzy_scores": scored + " select id1 as listing_id_1, id2 as listing_id_2, fuzzy_score, final_score from SC",
        "match_decisions": final + " select id1 as listing_id_1, id2 as listing_id_2, title_1, title_2, normalized_title_1, "
        "normalized_title_2, n_pairs::BIGINT as n_pairs, fuzzy_score, embedding_score, attribute_score, final_score, decision, reason, "
        + verdict + " from FP",
        "decision_counts": weighted + " select decision, sum(pairs)::BIGINT as pairs from WD group by decision "
        "union all select 'total', sum(pairs)::BIGINT from WD",
        "reason_counts": weighted + " select decision, reason, pairs from WD",
        "verdict_requests": scored + ",\n" + X.request_ctes(INSTRUCTION, RULES, OUTPUT_FORMAT)
        + " select id1 as listing_id_1, id2 as listing_id_2, review_bucket, request_json from RQ",
        "verdict_parse": answered + " select id1 as listing_id_1, id2 as listing_id_2, m as llm_match, conf as llm_confidence, "
        "r as llm_reason from VD",
        "verdict_resolution": resolved + " select id1 as listing_id_1, id2 as listing_id_2, m as llm_match, conf::DOUBLE as llm_confidence, "
        "r as llm_reason, n_replies from VD",
        "resolved_decisions": resolved + ",\n" + X.final_ctes().strip() + " select id1 as listing_id_1, id2 as listing_id_2, "
        "n_pairs::BIGINT as n_pairs, m as llm_raw_decision, conf::DOUBLE as llm_confidence, decision, reason from FP where answered",
        "unanswered_decisions": unanswered + ",\n" + X.weighted_ctes() + " select decision, reason, pairs from WD",
        "components": grouped + " select listing_id, component from LC",
        "product_groups": groups + ",\n" + numbered + " select group_id, canonical_title, n_listings, sources, min_price, currency, "
        "coalesce(match_source, 'singleton') as match_source, coalesce(confidence, 1.0) as confidence, "
        "group_conflict_reason <> 'no_conflict' as group_conflict, group_conflict_reason, n_suspicious_low_price from GN",
        "output_tables": groups + ",\n" + numbered + ",\n" + X.weighted_ctes() + ",\n"
        "OUT as (select 'decisions' as table_name, row_number() over (order by id1, id2) as row_no, id1::VARCHAR || '|' || id2::VARCHAR || '|' || "
        "n_pairs::BIGINT::VARCHAR || '|' || decision || '|' || reason as row_text from FP "
        "union all select 'groups', group_id, group_id::VARCHAR || '|' || canonical_title || '|' || n_listings::VARCHAR || '|' || "
        "'[\"' || replace(sources, '|', '\",\"') || '\"]' || '|' || min_price::VARCHAR from GN "
        "union all select 'attributes', row_number() over (order by row_seq), listing_id::VARCHAR || '|' || row_seq::VARCHAR || '|' || "
        "normalized_title || '|' || coalesce(brand, '') || '|' || coalesce(model_family, '') || '|' || coalesce(storage, '') from A "
        "union all select 'usage', 1, (select sum(pairs) from WD)::BIGINT::VARCHAR || '|' || coalesce((select sum(n_pairs) from FP where answered), 0)::BIGINT::VARCHAR "
        "|| '|' || coalesce(round(100.0 * coalesce((select sum(n_pairs) from FP where answered), 0)::DOUBLE / "
        "nullif((select sum(pairs) from WD)::DOUBLE, 0), 2), 0.0)::DOUBLE::VARCHAR "
        "union all select 'outbox', null, (case when decision = 'llm_verify' then 'verify' else 'review' end) || '|' || count(*)::VARCHAR "
        "from SC where decision in ('llm_review', 'llm_verify') group by decision) select table_name, row_no::BIGINT as row_no, row_text from OUT",
        "group_members": groups + ",\n" + numbered + " select group_id, listing_id, row_seq, title, price, source, susp as suspicious_price, "
        "dq_suspicious_low_price as suspicious_low_price from LF join GN using (component)",
        "evaluation_metrics": predicted + f", MT as ({counts} from PD) select *, {ratios} from MT",
        "evaluation_summary": predicted + ",\n" + X.component_ctes() + f", MT as ({counts} from PD) select *, {ratios}, "
        "(select count(distinct component) from LC)::BIGINT as total_groups from MT",
        "misclassified_pairs": predicted + " select *, case when label = 0 then 'false_positive' else 'false_negative' end as error_kind "
        "from PD where label <> pred_label",
        "verdict_usage": weighted + " select (select sum(pairs) from WD)::BIGINT as total_pairs, "
        "coalesce((select sum(n_pairs) from FP where answered), 0)::BIGINT as llm_used, "
        "coalesce(round(100.0 * coalesce((select sum(n_pairs) from FP where answered), 0)::DOUBLE / "
        "nullif((select sum(pairs) from WD)::DOUBLE, 0), 2), 0.0)::DOUBLE as llm_used_pct",
        "route_breakdown": final + " select route as llm_route, sum(n_pairs)::BIGINT as count from FP where answered group by route",
        "verdict_summary": final + " select decision, sum(n_pairs)::BIGINT as pairs, (select round(sum(conf * n_pairs)::DOUBLE / "
        "sum(n_pairs)::DOUBLE, 3) from FP where conf is not null) as mean_llm_confidence, coalesce((select sum(n_pairs) from FP "
        "where contains(reason, 'llm_rule_disagreement')), 0)::BIGINT as disagreements, coalesce((select sum(n_pairs) from FP where answered), 0)::BIGINT as llm_used "
        "from FP where starts_with(reason, 'llm_') group by decision",
        "variant_confusion": weighted + ",\n" + X.variant_ctes() + " select *, 'variant_confusion' as error_type from VC",
        "error_analysis": weighted + ",\n" + X.variant_ctes() + " select 'SUMMARY' as listing_id_1, 'total: ' || (select coalesce(sum(pairs), 0) "
        f"from WD where {variant})::VARCHAR as listing_id_2, '' as title_1, '' as title_2, '' as final_score, '' as llm_raw_decision, "
        f"'' as llm_confidence, '{SUMMARY_REASON}' as reason, (select coalesce(sum(pairs), 0) from WD where {variant})::VARCHAR "
        "as n_pairs, 'variant_confusion' as error_type union all select listing_id_1::VARCHAR, listing_id_2::VARCHAR, title_1, title_2, "
        "final_score::VARCHAR, llm_raw_decision, llm_confidence::VARCHAR, reason, n_pairs::VARCHAR, 'variant_confusion' from VC",
        "top_reject_reasons": weighted + f" select 'variant_confusion' as error_type, reason, pairs from WD where {variant} "
        "order by pairs desc, reason limit 5",
    }
