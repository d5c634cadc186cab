"""Queries of the training-data operators, by name."""

from __future__ import annotations

from . import queries_dedup, queries_rules, queries_scan

QUERIES = {
    "op1_quality": queries_scan.op1_quality,
    "op2_pii": queries_scan.op2_pii,
    "op3_suffix_dedup": queries_dedup.op3_suffix_dedup,
    "op4_quality_rules": queries_rules.op4_quality_rules,
    "op5_simhash": queries_dedup.op5_simhash,
    "op6_chaining": queries_dedup.op6_chaining,
    "op7_pieces": queries_scan.op7_pieces,
    "op8_decontaminate": queries_scan.op8_decontaminate,
    "op9_suffix_tree": queries_scan.op9_suffix_tree,
    "op10_section_tokens": queries_scan.op10_section_tokens,
}
ORACLE_SQL = {"op3_suffix_dedup": queries_dedup.OP3_SQL, "op4_quality_rules": queries_rules.OP4_SQL, "op8_decontaminate": queries_scan.OP8_SQL}
