"""Queries over the test tables, each with its SQL twin where one exists.

``all_queries`` and ``all_sql`` gather what the modules of this package declare.
"""

from __future__ import annotations

from importlib import import_module

from tabloom.queries.base import QUERIES, SQL

_MODULES = [
    "sources",
    "columns",
    "splits",
    "profiling",
    "evaluation",
    "features",
    "learning",
    "tuning",
    "boosting",
    "registry",
]


def _load() -> None:
    for module in _MODULES:
        import_module(f"tabloom.queries.{module}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
