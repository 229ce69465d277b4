"""The registered queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from doseledger.llm import (
    conversation_repair,
    decontam,
    language_id,
    line_dedup,
    lm_scoring,
    quality_rules,
    resample,
    secret_tags,
    shards,
    simhash,
    source_mix,
    suffix_dedup,
    url_filter,
)

QUERIES = {
    "op1_lm_scoring": lm_scoring.op1_query,
    "op2_source_mix": source_mix.op2_query,
    "op3_secret_tags": secret_tags.op3_query,
    "op4_suffix_dedup": suffix_dedup.op4_query,
    "op5_line_dedup": line_dedup.op5_query,
    "op6_shards": shards.op6_query,
    "op7_quality_rules": quality_rules.op7_query,
    "op8_simhash": simhash.op8_query,
    "op9_url_filter": url_filter.op9_query,
    "op10_decontamination": decontam.op10_query,
    "op11_resample": resample.op11_query,
    "op12_language_id": language_id.op12_query,
    "op13_conversation_repair": conversation_repair.op13_query,
}

ORACLE = {
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op7_quality_rules": quality_rules.ORACLE_SQL,
    "op10_decontamination": decontam.ORACLE_SQL,
    "op11_resample": resample.ORACLE_SQL,
    "op13_conversation_repair": conversation_repair.ORACLE_SQL,
}
