"""Operators for preparing training data: text, dialogue and vector corpora.

``all_queries`` and ``all_sql`` gather what the modules of this package declare.
"""

from __future__ import annotations

from importlib import import_module

from tabloom.llm.base import QUERIES, SQL

_MODULES = [
    "html_text",
    "sharding",
    "preferences",
    "mixing",
    "line_dedup",
    "decontamination",
    "near_dedup",
    "toxicity",
    "vector_search",
    "licences",
    "bpe",
    "product_codes",
    "collocations",
]


def _load() -> None:
    for module in _MODULES:
        import_module(f"tabloom.llm.{module}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
