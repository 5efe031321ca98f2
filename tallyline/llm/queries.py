"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tallyline.llm import langid, lmscore, mixing, neardup, packing, prefixtrie, quality, substrings, suffixes, tokencounts, topk, vectorcodes, vectordup

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_exact_topk": topk.op4_exact_topk,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_minhash_neardup": neardup.op6_minhash_neardup,
    "op7_suffix_dedup": suffixes.op7_suffix_dedup,
    "op8_language_id": langid.op8_language_id,
    "op9_embedding_dedup": vectordup.op9_embedding_dedup,
    "op10_lm_scoring": lmscore.op10_lm_scoring,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_token_counts": tokencounts.op12_token_counts,
    "op13_vector_codes": vectorcodes.op13_vector_codes,
}

SQL = {
    "op2_substring_dedup": substrings.OP2_SQL,
    "op3_source_mix": mixing.OP3_SQL,
    "op4_exact_topk": topk.OP4_SQL,
    "op9_embedding_dedup": vectordup.OP9_SQL,
    "op11_prefix_trie": prefixtrie.OP11_SQL,
    "op13_vector_codes": vectorcodes.OP13_SQL,
}
