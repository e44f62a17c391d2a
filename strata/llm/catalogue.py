"""Registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from strata.llm import (
    align_tokens,
    bpe_count,
    chat_format,
    decontaminate,
    exact_dedup,
    importance,
    jaccard_join,
    mix_sources,
    suffix_dedup,
    token_files,
    toxicity,
    url_rules,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_mix_sources": mix_sources.op4_mix_sources,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_warc": warc.op6_warc,
    "op7_chat_format": chat_format.op7_chat_format,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_url_rules": url_rules.op9_url_rules,
    "op10_token_counts": bpe_count.op10_token_counts,
    "op11_align_tokens": align_tokens.op11_align_tokens,
    "op12_importance": importance.op12_importance,
    "op13_token_files": token_files.op13_token_files,
}

ORACLE = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op6_warc": warc.OP6_SQL,
    "op7_chat_format": chat_format.OP7_SQL,
    "op9_url_rules": url_rules.OP9_SQL,
    "op12_importance": importance.OP12_SQL,
}
