"""The registered queries of this subpackage and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

from wordmill.llm import (byte_bpe, hard_negatives, language_id, license_scan, near_dups, packing, periodic_runs,
                          quality_classifier, quality_rules, syncmers, token_output, toxicity, url_filters)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_near_duplicates": near_dups.op4_near_duplicates,
    "op5_url_filters": url_filters.op5_url_filters,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_token_output": token_output.op7_token_output,
    "op8_language_id": language_id.op8_language_id,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_syncmer_fingerprints": syncmers.op10_syncmer_fingerprints,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op4_near_duplicates": near_dups.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
