"""Registered queries of this subpackage and their SQL (where SQL can express them)."""

from __future__ import annotations

from hirelens.llm import codes, decontam, lines, maxent, minhash, nndescent, personal, pieces, sharding, token_counts, toxicity, turns, urls

QUERIES = {
    "op1_toxicity": toxicity.op1,
    "op2_decontamination": decontam.op2,
    "op3_token_counts": token_counts.op3,
    "op4_embedding_near_dedup": nndescent.op4,
    "op5_line_dedup": lines.op5,
    "op6_minhash_near_dedup": minhash.op6,
    "op7_maxent_lm": maxent.op7,
    "op8_url_filters": urls.op8,
    "op9_sentencepiece": pieces.op9,
    "op10_sharding": sharding.op10,
    "op11_personal_data": personal.op11,
    "op12_vector_codes": codes.op12,
    "op13_conversation_repair": turns.op13,
}

ORACLE_SQL: dict[str, str] = {
    "op3_token_counts": token_counts.ORACLE,
    "op4_embedding_near_dedup": nndescent.ORACLE,
    "op5_line_dedup": lines.ORACLE,
    "op6_minhash_near_dedup": minhash.ORACLE,
    "op12_vector_codes": codes.ORACLE,
    "op13_conversation_repair": turns.ORACLE,
}
