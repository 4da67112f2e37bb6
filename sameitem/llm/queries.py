"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sameitem.llm.decontamination import op8_decontamination
from sameitem.llm.html_extraction import op2_html_extraction
from sameitem.llm.importance_resampling import op13_resampling
from sameitem.llm.jaccard_join import op4_jaccard_join
from sameitem.llm.language_id import op3_language_id
from sameitem.llm.licenses import op6_licenses
from sameitem.llm.licenses import oracle as licenses_sql
from sameitem.llm.line_dedup import op11_line_dedup
from sameitem.llm.line_dedup import oracle as line_dedup_sql
from sameitem.llm.lm_scoring import op7_lm_scoring
from sameitem.llm.merkle_manifest import op12_merkle
from sameitem.llm.merkle_manifest import oracle as merkle_sql
from sameitem.llm.sentencepiece_codec import op9_sentencepiece
from sameitem.llm.sharding import op5_sharding
from sameitem.llm.spotsigs import op10_fingerprints
from sameitem.llm.toxicity import op1_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_html_extraction": op2_html_extraction,
    "op3_language_id": op3_language_id,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_sharding": op5_sharding,
    "op6_licenses": op6_licenses,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_decontamination": op8_decontamination,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_fingerprints": op10_fingerprints,
    "op11_line_dedup": op11_line_dedup,
    "op12_merkle": op12_merkle,
    "op13_resampling": op13_resampling,
}
ORACLE_SQL: dict[str, str] = {
    "op6_licenses": licenses_sql(),
    "op11_line_dedup": line_dedup_sql(),
    "op12_merkle": merkle_sql(),
}
