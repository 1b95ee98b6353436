"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from quarrykit.llm import op1_mixing, op2_urls, op3_secrets, op4_pieces, op5_webp, op6_minhash, op7_suffixes, op8_rules, op9_orc, op10_toxicity

_MODULES = [op1_mixing, op2_urls, op3_secrets, op4_pieces, op5_webp, op6_minhash, op7_suffixes, op8_rules, op9_orc, op10_toxicity]

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
