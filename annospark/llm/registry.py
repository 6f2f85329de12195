"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from annospark.llm import bpe, divergence, exact_dedup, hilbert_shards, jaccard_join, language_id, packing, quality, substring_dedup, token_counts, token_files, toxicity, whitening

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_language_id": language_id.op5_language_id,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_bpe": bpe.op8_bpe,
    "op9_token_files": token_files.op9_token_files,
    "op10_packing": packing.op10_packing,
    "op11_whitening": whitening.op11_whitening,
    "op12_sharding": hilbert_shards.op12_sharding,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLE_SQL = {
    "op1_quality": quality.OP1_SQL,
    "op2_substring_dedup": substring_dedup.OP2_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op7_jaccard_join": jaccard_join.OP7_SQL,
    "op12_sharding": hilbert_shards.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
