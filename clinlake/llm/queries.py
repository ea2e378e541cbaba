"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from clinlake.llm import bpe, chat, decontamination, exact_dedup, factorisation, language_model, line_quality, mixing, near_dedup, point_in_time, secrets, sharding, structure

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_bpe": bpe.query,
    "op3_source_mix": mixing.query,
    "op4_line_quality": line_quality.query,
    "op5_near_dedup": near_dedup.query,
    "op6_quality_classifier": factorisation.query,
    "op7_chat_format": chat.query,
    "op8_sharding": sharding.query,
    "op9_lm_score": language_model.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_conversation_repair": structure.query,
    "op12_decontamination": decontamination.query,
    "op13_point_in_time": point_in_time.query,
}

#: BPE, mixing, sharding and the trained models have no SQL: their tests compare them with brute force.
ORACLES = {
    "op4_line_quality": line_quality.ORACLE,
    "op5_near_dedup": near_dedup.ORACLE,
    "op7_chat_format": chat.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_conversation_repair": structure.ORACLE,
    "op12_decontamination": decontamination.ORACLE,
    "op13_point_in_time": point_in_time.ORACLE,
}
