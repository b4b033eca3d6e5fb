"""Queries of the training-data operators: key → (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations


def load_llm() -> dict:
    import corpus_pipeline
    from starmetrics.llm import bpe, byte_bpe, conversations, fingerprint, html, lm, minhash, mixing, quality, substring_dedup, suffix_dedup, urls, whitening

    return {
        "op7_quality_rules": (quality.op7, quality.sql()),
        "op1_mix_sources": (mixing.op1, mixing.sql()),
        "op9_bpe": (bpe.op9, None),
        "op8_fingerprints": (fingerprint.op8, None),
        "op10_html_text": (html.op10, None),
        "op6_suffix_dedup": (suffix_dedup.op6, None),
        "op2_substring_dedup": (substring_dedup.op2, substring_dedup.sql()),
        "op4_minhash_near_dedup": (minhash.op4, None),
        "op5_hmm_scores": (lm.op5, None),
        "op3_url_filters": (urls.op3, urls.sql()),
        "op11_embedding_whitening": (whitening.op11, None),
        "op12_byte_bpe": (byte_bpe.op12, None),
        "op13_conversation_repair": (conversations.op13, conversations.sql()),
        "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    }
