"""Declarative column checks, run as ONE aggregate pass per model.

A check's ``failures`` follows the usual column-test meaning:
* ``not_null``: rows where the column is NULL;
* ``accepted_values``: distinct non-NULL values outside the accepted set (NULL passes here; the
  not_null check covers it).

``failing_rows`` is the number of rows that fail: the same for ``not_null``, all rows of the bad values for
``accepted_values``.

All checks of a model are computed by a single global aggregate (partial per task, one tiny merge),
so a model is scanned once however many checks it has. The per-check numbers are then unpivoted to
``(model, column, check, failures, failing_rows, passed)``.

``quarantine`` stores the rows that fail, each with the names of its failed checks, in the one scan of the
model, and counts the stored rows for the report.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.schemas import LEAGUE_IDS


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # "not_null" | "accepted_values"
    values: tuple = ()


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def accepted_values(column: str, values: Sequence) -> Check:
    return Check(column, "accepted_values", tuple(values))


# --- the 13 column tests of the staging models (fixed by the reference) ---------------------------
STG_PLAYERS_CHECKS = (
    not_null("player_id"),
    not_null("team_id"),
    not_null("league_id"),
    accepted_values("league_id", LEAGUE_IDS),
    not_null("snapshot_date"),
    not_null("goals"),
    not_null("appearances"),
)
STG_STANDINGS_CHECKS = (
    not_null("team_id"),
    not_null("league_id"),
    accepted_values("league_id", LEAGUE_IDS),
    not_null("snapshot_date"),
    not_null("points"),
    not_null("rank"),
)


class CheckFailed(RuntimeError):
    pass


def failing(check: Check) -> Column:
    """Whether a row fails (false, not NULL, where the check does not apply)."""
    col = F.col(check.column)
    if check.kind == "not_null":
        return col.isNull()
    if check.kind == "accepted_values":
        return F.coalesce(~col.isin(list(check.values)), F.lit(False))
    raise ValueError(f"unknown check kind {check.kind}")


def _failures(check: Check, fails: Column) -> Column:
    return F.count_distinct(F.when(fails, F.col(check.column))) if check.kind == "accepted_values" else F.count_if(fails)


def _report(df: DataFrame, model: str, checks: Sequence[Check], fails: Callable[[Check], Column]) -> DataFrame:
    measures = df.agg(*[_failures(c, fails(c)).cast("bigint").alias(f"_c{i}") for i, c in enumerate(checks)],
                      *[F.count_if(fails(c)).cast("bigint").alias(f"_r{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"),
                 F.col(f"_c{i}").alias("failures"), F.col(f"_r{i}").alias("failing_rows"))
        for i, c in enumerate(checks)])
    out = measures.select(F.inline(rows))
    return out.withColumn("passed", F.col("failures") == 0)


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """One scan of ``df``: one report row per check."""
    return _report(df, model, checks, failing)


def failing_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The rows that fail a check, with ``failed_checks``: the names (column:kind) of those they fail."""
    names = F.array_compact(F.array(*[F.when(failing(c), F.lit(f"{c.column}:{c.kind}")) for c in checks]))
    return df.withColumn("failed_checks", names).where(F.size("failed_checks") > 0)


def quarantine(df: DataFrame, model: str, checks: Sequence[Check],
               store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Store the failing rows of a model (``store`` writes them and reads them back) and report on them: the
    report of ``run_checks``, and the stored rows. The model is scanned once; the counts come from what is stored."""
    stored = store(failing_rows(df, checks))
    report = _report(stored, model, checks, lambda c: F.array_contains("failed_checks", f"{c.column}:{c.kind}"))
    return report, stored


def check_report(models: Sequence[tuple[str, DataFrame, Sequence[Check]]]) -> DataFrame:
    """All checks of all models, one scan per model."""
    parts = [run_checks(df, name, checks) for name, df, checks in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_passed(report: DataFrame) -> None:
    """Raise if any check failed (the report is a handful of rows, so collecting it is safe)."""
    failed = [r.asDict() for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise CheckFailed(f"{len(failed)} checks failed: {failed}")


def require_rows(df: DataFrame, what: str) -> None:
    """Gate: raise when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise CheckFailed(f"no rows in {what}; nothing downstream runs")


def relationship(child: DataFrame, parent: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (a left-anti join)."""
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    orphans = child.select(*keys).where(nn).join(parent.select(*keys), list(keys), "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(",".join(keys)).alias("column"),
        F.lit("relationship").alias("check"), F.col("failures"), (F.col("failures") == 0).alias("passed"))


def unique(df: DataFrame, column: str, model: str) -> DataFrame:
    """Number of non-NULL key values that occur more than once."""
    dup = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit("unique").alias("check"),
        F.col("failures"), (F.col("failures") == 0).alias("passed"))


def fan_out(facts: DataFrame, dim: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    """Keys that the dimension holds several times, and what a join does to the facts there: model, keys,
    spellings (dimension rows), fact_rows, joined_rows, least_name, greatest_name.

    Both sides are counted per key before they meet, so the fanned-out rows are never made and a hot key is one
    row of each side. Keys with a NULL part join nothing and are left out.
    """
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    several = dim.where(known).groupBy(*keys).agg(
        F.count("*").alias("spellings"), F.min("team_name").alias("least_name"), F.max("team_name").alias("greatest_name")
    ).where("spellings > 1")
    counted = facts.where(known).groupBy(*keys).agg(F.count("*").alias("fact_rows"))
    rows = F.coalesce("fact_rows", F.lit(0).cast("bigint"))
    return several.join(counted, list(keys), "left").select(
        F.lit(model).alias("model"), *keys, "spellings", rows.alias("fact_rows"),
        (rows * F.col("spellings")).alias("joined_rows"), "least_name", "greatest_name")
