"""The operators' queries over the tables, and the SQL that checks them."""

from __future__ import annotations

from folioflow.llm import bpe, decontaminate, licenses, quality_classifier, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, token_counts

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_quality_rules": quality_rules.query,
    "op3_quality_classifier": quality_classifier.query,
    "op4_sharding": sharding.query,
    "op5_token_counts": token_counts.query,
    "op6_bpe": bpe.query,
    "op7_decontaminate": decontaminate.query,
    "op8_suffix_dedup": suffix_dedup.query,
    "op9_licenses": licenses.query,
    "op10_simhash_near_dedup": simhash.query,
}

ORACLE_SQL = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op2_quality_rules": quality_rules.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op9_licenses": licenses.SQL,
}
