"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

#: name -> module of cladeworks.llm
OPERATORS = {
    "op1_token_counts": "token_counts",
    "op2_substring_dedup": "substring_dedup",
    "op3_secrets": "secrets",
    "op4_language_id": "langid",
    "op5_sharding": "sharding",
    "op6_packing": "packing",
    "op7_line_dedup": "line_dedup",
    "op8_media": "media",
    "op9_simhash": "simhash",
    "op10_decontamination": "decontamination",
    "op11_ngram_join": "ngram_join",
    "op12_spelling": "spelling",
    "op13_conversation_repair": "conversation_repair",
}


def queries() -> dict:
    return {name: getattr(import_module(f"cladeworks.llm.{module}"), name) for name, module in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"cladeworks.llm.{module}"), "ORACLE_SQL", None) for name, module in OPERATORS.items()}
    return {name: sql for name, sql in found.items() if sql}
