"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from trilayer.llm import (
    line_dedup,
    manifest,
    mixing,
    ngram_join,
    pieces,
    pii,
    quality_rules,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_files,
    toxicity,
    vectors,
)

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_vectors": vectors.op2_vectors,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_pieces": pieces.op5_pieces,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_mixing": mixing.op8_mixing,
    "op9_token_files": token_files.op9_token_files,
    "op10_pii": pii.op10_pii,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
}

SQL = {
    "op2_vectors": vectors.SQL,
    "op8_mixing": mixing.SQL,
    "op11_merkle_manifest": manifest.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_substring_dedup": substring_dedup.SQL,
}
