"""Scalar cleaning expressions used by the staging layer.

All are built-in Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: ColumnOrName) -> Column:
    """CAST(x AS INTEGER): a wide integer; bad text fails under ANSI mode."""
    return _c(c).cast("bigint")


def as_float(c: ColumnOrName) -> Column:
    """CAST(x AS FLOAT): a double (never single precision)."""
    return _c(c).cast("double")


def clean_text(c: ColumnOrName) -> Column:
    """UPPER(TRIM(x)): spaces trimmed on both sides (tabs kept), then upper-cased; NULL stays NULL."""
    return F.upper(F.trim(_c(c)))


def zero_fill(c: ColumnOrName) -> Column:
    """COALESCE(x, 0), keeping the input's type."""
    return F.coalesce(_c(c), F.lit(0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / NULLIF(den, 0) in double: NULL when the divisor is 0 or NULL, never an error."""
    return as_float(num) / F.nullif(as_float(den), F.lit(0.0))


def round2(c: ColumnOrName) -> Column:
    """ROUND(x, 2), half away from zero."""
    return F.round(_c(c), 2)


def win_pct(win: ColumnOrName, played: ColumnOrName) -> Column:
    """ROUND(win / NULLIF(played, 0) * 100, 2)."""
    return round2(safe_ratio(win, played) * F.lit(100))


def goals_per_game(goals: ColumnOrName, appearances: ColumnOrName) -> Column:
    """ROUND(COALESCE(goals, 0) / NULLIF(appearances, 0), 2): the divisor is the raw value."""
    return round2(zero_fill(as_float(goals)) / F.nullif(as_float(appearances), F.lit(0.0)))


def goal_contributions(goals: ColumnOrName, assists: ColumnOrName) -> Column:
    """COALESCE(goals, 0) + COALESCE(assists, 0)."""
    return zero_fill(as_int(goals)) + zero_fill(as_int(assists))


def all_not_null(*cols: str) -> Column:
    """Conjunction of IS NOT NULL over the given columns."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def ntz_lit(t) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so neither the Python nor the session zone shifts it."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
