"""The operators' queries and, where SQL can express them, the SQL of their results."""

from __future__ import annotations

from . import chat, decontam, divergence, mixing, near_dup, pages, rules, search, secrets, sharding, substrings, suffix_dedup, toxicity

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_secrets": secrets.op2_secrets,
    "op3_html_text": pages.op3_html_text,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_decontamination": decontam.op9_decontamination,
    "op10_quality_rules": rules.op10_quality_rules,
    "op11_divergence": divergence.op11_divergence,
    "op12_sharding": sharding.op12_sharding,
    "op13_search": search.op13_search,
}
SQL = {
    "op1_chat_format": chat.OP1_SQL,
    "op6_substring_dedup": substrings.OP6_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op8_near_dup": near_dup.OP8_SQL,
    "op9_decontamination": decontam.OP9_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op12_sharding": sharding.OP12_SQL,
    "op13_search": search.OP13_SQL,
}
