"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from eventide.llm import (
    conversation_repair, decontamination, html_main_text, jaccard_join, packing, quality_rules, secret_scan, segmentation, spelling_variants, suffix_dedup, token_counts,
    toxicity, url_filter,
)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_token_packing": packing.op4_token_packing,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_segmentation": segmentation.op6_segmentation,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_html_text": html_main_text.op10_html_text,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_secret_scan": secret_scan.op12_secret_scan,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
}
ORACLE = {
    "op1_url_filter": url_filter.ORACLE, "op9_decontamination": decontamination.ORACLE, "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_secret_scan": secret_scan.ORACLE, "op13_spelling_variants": spelling_variants.ORACLE,
}
