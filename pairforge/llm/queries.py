"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from . import bpe, chat, decontaminate, html_extract, jaccard, langid, periodic, pieces, quality, sharding, substring, toxicity, whitening

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_language_id": langid.op2_language_id,
    "op3_sharding": sharding.op3_sharding,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_substring_dedup": substring.op6_substring_dedup,
    "op7_bpe": bpe.op7_bpe,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_ngram_jaccard": jaccard.op9_ngram_jaccard,
    "op10_html_extract": html_extract.op10_html_extract,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_sentencepiece": pieces.op13_sentencepiece,
}

SQL = {
    "op1_chat_format": chat.OP1_SQL,
    "op4_quality_rules": quality.OP4_SQL,
    "op6_substring_dedup": substring.OP6_SQL,
    "op9_ngram_jaccard": jaccard.OP9_SQL,
    "op12_periodic_runs": periodic.OP12_SQL,
}
