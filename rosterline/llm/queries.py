"""Queries of the training-data operators: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from rosterline.llm import chat, decontam, langid, lines, negatives, packing, phrases, secrets, sharding, simhash, spotsigs, toxicity, urls

REGISTRY = {
    "op1_packing": (packing.op1, None),
    "op2_decontam": (decontam.op2, None),
    "op3_urls": (urls.op3, None),
    "op4_fingerprints": (spotsigs.op4, None),
    "op5_secrets": (secrets.op5, None),
    "op6_simhash": (simhash.op6, None),
    "op7_langid": (langid.op7, None),
    "op8_sharding": (sharding.op8, None),
    "op9_lines": (lines.op9, None),
    "op10_chat": (chat.op10, chat.OP10_SQL),
    "op11_phrases": (phrases.op11, phrases.OP11_SQL),
    "op12_toxicity": (toxicity.op12, None),
    "op13_negatives": (negatives.op13, negatives.OP13_SQL),
}


def queries() -> dict:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
