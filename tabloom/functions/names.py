"""Rules for column, user and table names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_safe(name: str) -> str:
    """Spaces are not allowed in feature-table columns; underscores are."""
    return name.replace(" ", "_")


def column_safe_expr(col: Column | str) -> Column:
    """``column_safe`` for a column of names."""
    return F.replace(F.col(col) if isinstance(col, str) else col, F.lit(" "), F.lit("_"))


def account_prefix(col: Column | str) -> Column:
    """Part of an account address before ``@``, with dots turned to underscores."""
    col = F.col(col) if isinstance(col, str) else col
    return F.replace(F.split(col, "@").getItem(0), F.lit("."), F.lit("_"))


def unique_name(base: str) -> str:
    """``base`` with a short random suffix, so that reruns do not collide."""
    return f"{base}_{uuid.uuid4().hex[:6]}"
