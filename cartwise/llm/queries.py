"""Registered queries of the numbered operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from cartwise.llm import (bpe, chat_format, decontamination, lexical_search, ngram_join, quality_classifier, quality_rules, sharding, simhash,
                          source_audit, substring_dedup, toxicity, url_filters)

QUERIES = {
    "op1_ngram_join": ngram_join.query,
    "op2_toxicity": toxicity.query,
    "op3_byte_bpe": bpe.query,
    "op4_decontamination": decontamination.query,
    "op5_quality_rules": quality_rules.query,
    "op6_quality_classifier": quality_classifier.query,
    "op7_chat_format": chat_format.query,
    "op8_sharding": sharding.query,
    "op9_substring_dedup": substring_dedup.query,
    "op10_url_filters": url_filters.query,
    "op11_source_audit": source_audit.query,
    "op12_simhash": simhash.query,
    "op13_lexical_search": lexical_search.query,
}

ORACLE = {
    "op4_decontamination": decontamination.ORACLE,
    "op10_url_filters": url_filters.oracle(),
    "op11_source_audit": source_audit.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}
