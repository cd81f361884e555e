"""Queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from . import bwt_dedup, divergence, html_text, language, merkle, mixing, near_dedup, packing, quality, substring_dedup, topk, vector_dedup, word_bpe

QUERIES = {
    "op4_suffix_dedup": bwt_dedup.op4,
    "op10_substring_dedup": substring_dedup.op10,
    "op5_minhash_dedup": near_dedup.op5,
    "op6_embedding_dedup": vector_dedup.op6,
    "op9_exact_topk": topk.op9,
    "op2_language_id": language.op2,
    "op3_quality_classifier": quality.op3,
    "op1_html_extraction": html_text.op1,
    "op8_best_fit_packing": packing.op8,
    "op7_source_mixing": mixing.op7,
    "op11_source_divergence": divergence.op11,
    "op12_bpe_round_trip": word_bpe.op12,
    "op13_merkle_manifest": merkle.op13,
}
ORACLES = {
    "op4_suffix_dedup": bwt_dedup.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op5_minhash_dedup": near_dedup.ORACLE,
    "op6_embedding_dedup": vector_dedup.ORACLE,
    "op9_exact_topk": topk.ORACLE,
    "op7_source_mixing": mixing.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
