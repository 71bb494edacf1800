"""Registered queries of this folder and the SQL that must agree with them."""

from __future__ import annotations

from editpulse.llm import (
    align, bpe, chat, decontaminate, line_dedup, merkle, minhash, piece_prefix, quality, suffixes, syncmers, toxicity, url_filter,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_minhash": minhash.op2_minhash,
    "op3_suffix_dedup": suffixes.op3_suffix_dedup,
    "op4_fingerprints": syncmers.op4_fingerprints,
    "op5_chat_formatting": chat.op5_chat_formatting,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op9_proximity": decontaminate.op9_proximity,
    "op10_url_filters": url_filter.op10_url_filters,
    "op11_alignment": align.op11_alignment,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_sentencepiece": piece_prefix.op13_sentencepiece,
}

ORACLE = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_minhash": minhash.OP2_SQL,
    "op5_chat_formatting": chat.OP5_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op10_url_filters": url_filter.OP10_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
}
