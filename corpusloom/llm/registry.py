"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

import importlib

#: query -> (module, SQL's name in it or None)
_QUERIES = {
    "op1_secret_ownership": ("secrets", None),
    "op2_winnowing": ("fingerprints", None),
    "op3_warc_index_merge": ("warc", "OP3_SQL"),
    "op4_best_fit_packing": ("packing", None),
    "op5_suffix_dedup": ("substrings", None),
    "op6_license_diagonals": ("licenses", None),
    "op7_order_minhash": ("near_dedup", None),
    "op8_host_suffix_array": ("html_text", None),
    "op9_bpe_transducer": ("bpe", None),
    "op10_quality_rules": ("quality", None),
}


def _get(module: str, name: str):
    return getattr(importlib.import_module(f"{__package__}.{module}"), name)


def queries() -> dict:
    return {name: _get(module, name) for name, (module, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: _get(module, sql) for name, (module, sql) in _QUERIES.items() if sql}
