"""Queries of the corpus operators, and DuckDB SQL where SQL expresses one."""

from __future__ import annotations

from . import bitmap_join, block_anchors, bpe, deleted_interpolation, entropy_balance, lang_viterbi, licence_rules, oracles, pii_crf, quality_trees, spelling, token_store, vector_codes, winnow

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_quality_trees": quality_trees.op2_quality_trees,
    "op3_winnowing": winnow.op3_winnowing,
    "op4_licence_rules": licence_rules.op4_licence_rules,
    "op5_pii_crf": pii_crf.op5_pii_crf,
    "op6_mixing_coder": token_store.op6_mixing_coder,
    "op7_block_anchors": block_anchors.op7_block_anchors,
    "op8_source_mix": entropy_balance.op8_source_mix,
    "op9_bitmap_join": bitmap_join.op9_bitmap_join,
    "op10_language_id": lang_viterbi.op10_language_id,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_deleted_interpolation": deleted_interpolation.op12_deleted_interpolation,
    "op13_spelling_variants": spelling.op13_spelling_variants,
    "op2_quality_trees_base": quality_trees.op2_quality_trees_base,
    "op5_pii_crf_base": pii_crf.op5_pii_crf_base,
    "op12_deleted_interpolation_base": deleted_interpolation.op12_deleted_interpolation_base,
}

ORACLE_SQL: dict[str, str] = dict(oracles.SQL)
