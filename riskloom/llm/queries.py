"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from riskloom.llm import alignment, kneser_ney, minhash, mixing, packing, pages, rules, secrets, simhash, suffix_dedup, topk, unigram, whitening

QUERIES = {
    "op7_token_counts": unigram.op7_token_counts,
    "op1_lm_scoring": kneser_ney.op1_lm_scoring,
    "op10_html_extraction": pages.op10_html_extraction,
    "op9_suffix_array_dedup": suffix_dedup.op9_suffix_array_dedup,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_exact_topk": topk.op3_exact_topk,
    "op4_quality_rules": rules.op4_quality_rules,
    "op5_source_mixing": mixing.op5_source_mixing,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
    "op13_minhash_near_dedup": minhash.op13_minhash_near_dedup,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
}

SQL: dict[str, str] = {"op3_exact_topk": topk.OP3_SQL, "op4_quality_rules": rules.OP4_SQL}
