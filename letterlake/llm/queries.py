"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from letterlake.llm import (
    alignment,
    conversation_trie,
    decontamination,
    exact_dedup,
    html_extraction,
    language,
    licenses,
    ngram_join,
    packing,
    pii,
    quality,
    repeats,
    toxicity,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_license_scans": licenses.op2_license_scans,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op4_benchmark_decontamination": decontamination.op4_benchmark_decontamination,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_suffix_array_dedup": repeats.op6_suffix_array_dedup,
    "op7_pii": pii.op7_pii,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_html_extraction": html_extraction.op9_html_extraction,
    "op10_language_id": language.op10_language_id,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_conversation_prefix_trie": conversation_trie.op12_conversation_prefix_trie,
    "op13_cross_tokenizer_alignment": alignment.op13_cross_tokenizer_alignment,
}
ORACLE_SQL = {
    "op4_benchmark_decontamination": decontamination.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op12_conversation_prefix_trie": conversation_trie.ORACLE,
}
