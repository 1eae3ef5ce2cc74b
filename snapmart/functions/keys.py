"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's key macro ---------------------------------
# Placeholder for a NULL part, and the separator between parts.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"
# ---------------------------------------------------------------------------------------------


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the parts cast to text, NULL-safe, joined by '-' in the given order (32 hex chars)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(SEPARATOR))
        col = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(col.cast("string"), F.lit(NULL_PLACEHOLDER)))
    return F.md5(F.concat(*parts))


def surrogate_key_sql(*exprs: str) -> str:
    """The same key as a SQL expression (valid in Spark SQL and DuckDB)."""
    parts = [f"coalesce(cast({e} as string), '{NULL_PLACEHOLDER}')" for e in exprs]
    return "md5(" + f" || '{SEPARATOR}' || ".join(parts) + ")"
