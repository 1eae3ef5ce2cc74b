"""Registered queries: data-quality checks and the gate (C1-C5, A1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.operators import checks as C
from snapmart.plans import analogs as A
from snapmart.plans import marts
from snapmart.plans import sql_models as Q
from snapmart.plans.queries_models import DIM, LABELS, RP, RS, STG_P, STG_S, _dim, _stg_p, _stg_s
from snapmart.plans.suite import register
from snapmart.session import scratch_path
from snapmart.sources.rawstore import append_table, read_table


def _pick(checks, kinds):
    return tuple(c for c in checks if c.kind in kinds)


def _report(spark, root, kinds):
    return C.check_report([
        ("stg_players", _stg_p(spark, root), _pick(C.STG_PLAYERS_CHECKS, kinds)),
        ("stg_standings", _stg_s(spark, root), _pick(C.STG_STANDINGS_CHECKS, kinds)),
    ])


def _report_sql(kinds):
    body = Q.with_passed(
        Q.checks_sql("stg_players", "stg_p", _pick(C.STG_PLAYERS_CHECKS, kinds))
        + "\n    UNION ALL " + Q.checks_sql("stg_standings", "stg_s", _pick(C.STG_STANDINGS_CHECKS, kinds)))
    return Q.ctes(RS, RP, STG_S, STG_P, body=body)


ALL = ("not_null", "accepted_values")


@register("check_not_null", _report_sql(("not_null",)))
def q_check_not_null(spark, root):
    return _report(spark, root, ("not_null",))


@register("check_accepted_values", _report_sql(("accepted_values",)))
def q_check_accepted_values(spark, root):
    return _report(spark, root, ("accepted_values",))


@register("check_report", _report_sql(ALL))
def q_check_report(spark, root):
    """The 13 column tests of the staging models, one scan per model."""
    return _report(spark, root, ALL)


def _names_sql(checks):
    cases = []
    for c in checks:
        bad = f"{c.column} IS NULL" if c.kind == "not_null" else f"{c.column} NOT IN ({', '.join(map(str, c.values))})"
        cases.append(f"CASE WHEN {bad} THEN '{c.column}:{c.kind}' END")
    return f"concat_ws(',', {', '.join(cases)})"


_Q_KEYS = ["snapshot_date", "team_id", "league_id"]


def _quarantine_sql(model, src, checks):
    names = _names_sql(checks)
    return f"""SELECT '{model}' AS model, {', '.join(_Q_KEYS)}, {names} AS failed_checks, CAST(count(*) AS BIGINT) AS n_rows
        FROM {src} WHERE {names} <> '' GROUP BY ALL"""


_STAGED = (("stg_players", C.STG_PLAYERS_CHECKS, _stg_p, "stg_p"), ("stg_standings", C.STG_STANDINGS_CHECKS, _stg_s, "stg_s"))


def _quarantined(spark, root):
    """The reports and the stored rows of both staging models."""
    def store(df):
        path = scratch_path(spark, "quarantine")
        append_table(df, path)
        return read_table(spark, path, df.schema)

    return [(name, *C.quarantine(model(spark, root), name, checks, store)) for name, checks, model, _ in _STAGED]


@register("check_quarantine", Q.ctes(RS, RP, STG_S, STG_P, body=" UNION ALL ".join(
    _quarantine_sql(name, src, checks) for name, checks, _, src in _STAGED)))
def q_check_quarantine(spark, root):
    """The stored failing rows of the staging models, counted by key and failed checks."""
    parts = [rows.groupBy(F.lit(name).alias("model"), *_Q_KEYS, F.array_join("failed_checks", ",").alias("failed_checks"))
             .agg(F.count("*").alias("n_rows")) for name, _, rows in _quarantined(spark, root)]
    return parts[0].unionByName(parts[1])


@register("check_quarantine_report", _report_sql(ALL))
def q_check_quarantine_report(spark, root):
    """The 13 column tests counted from the stored failing rows."""
    (_, players, _), (_, standings, _) = _quarantined(spark, root)
    return players.unionByName(standings)


def _fan_out_sql(model, src):
    return f"""SELECT '{model}' AS model, team_id, league_id, spellings, coalesce(n, 0) AS fact_rows,
        coalesce(n, 0) * spellings AS joined_rows, least_name, greatest_name
        FROM (SELECT team_id, league_id, count(*) AS spellings, min(team_name) AS least_name, max(team_name) AS greatest_name
              FROM dim GROUP BY ALL HAVING count(*) > 1)
        JOIN (SELECT team_id, league_id, count(*) AS n FROM {src} GROUP BY ALL) USING (team_id, league_id)
        WHERE team_id IS NOT NULL AND league_id IS NOT NULL
        UNION ALL
        SELECT '{model}', team_id, league_id, spellings, 0, 0, least_name, greatest_name
        FROM (SELECT team_id, league_id, count(*) AS spellings, min(team_name) AS least_name, max(team_name) AS greatest_name
              FROM dim WHERE team_id IS NOT NULL AND league_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1) d
        WHERE NOT EXISTS (SELECT 1 FROM {src} f WHERE f.team_id = d.team_id AND f.league_id = d.league_id)"""


@register("fan_out_report", Q.ctes(RS, RP, STG_S, STG_P, LABELS, DIM, body=
          f"{_fan_out_sql('fact_standings', 'stg_s')} UNION ALL {_fan_out_sql('fact_player_stats', 'stg_p')}"))
def q_fan_out_report(spark, root):
    """Teams spelled several ways in one league, and the fact rows that each of them multiplies."""
    keys, dim = ["team_id", "league_id"], _dim(spark, root)
    return C.fan_out(_stg_s(spark, root), dim, keys, "fact_standings").unionByName(
        C.fan_out(_stg_p(spark, root), dim, keys, "fact_player_stats"))


_FACTS = (("fs", Q.fact_standings_sql("stg_s", "dim")), ("fp", Q.fact_player_stats_sql("stg_p", "dim")))


def _rel_sql(model, src, keys):
    nn = " AND ".join(f"c.{k} IS NOT NULL" for k in keys)
    on = " AND ".join(f"c.{k} = d.{k}" for k in keys)
    return f"""SELECT '{model}' AS "model", '{",".join(keys)}' AS "column", 'relationship' AS "check",
        CAST(count(*) AS BIGINT) AS failures
        FROM {src} c WHERE {nn} AND NOT EXISTS (SELECT 1 FROM dim d WHERE {on})"""


def _uniq_sql(model, src, col):
    return f"""SELECT '{model}' AS "model", '{col}' AS "column", 'unique' AS "check",
        CAST(count(*) AS BIGINT) AS failures
        FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"""


@register("check_relationship", Q.ctes(RS, RP, STG_S, STG_P, LABELS, DIM, *_FACTS, body=Q.with_passed(
    " UNION ALL ".join([
        _rel_sql("fact_standings", "fs", ["team_id", "league_id"]),
        _uniq_sql("fact_standings", "fs", "standing_id"),
        _rel_sql("fact_player_stats", "fp", ["team_id", "league_id"]),
        _uniq_sql("fact_player_stats", "fp", "stat_id")]))))
def q_check_relationship(spark, root):
    """Fact keys without a dimension row, and duplicated surrogate keys (the fan-out shows here). Marts
    are stored once, as the build does; each check reads two or three columns of them."""
    def once(df, name):
        path = scratch_path(spark, name)
        append_table(df, path)
        return read_table(spark, path, df.schema)

    dim = once(_dim(spark, root), "dim_teams")
    fs = once(marts.fact_standings(_stg_s(spark, root), dim), "fact_standings")
    fp = once(marts.fact_player_stats(_stg_p(spark, root), dim), "fact_player_stats")
    keys = ["team_id", "league_id"]
    parts = [C.relationship(fs, dim, keys, "fact_standings"), C.unique(fs, "standing_id", "fact_standings"),
             C.relationship(fp, dim, keys, "fact_player_stats"), C.unique(fp, "stat_id", "fact_player_stats")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("gate_count", Q.ctes(RS, body="SELECT CAST(count(*) AS BIGINT) AS n_rows FROM rs"))
def q_gate_count(spark, root):
    """The row count the gate looks at (all history of RAW standings)."""
    rs = A.raw_standings(A.Tables(spark, root))
    C.require_rows(rs, "raw standings")
    return rs.agg(F.count(F.lit(1)).alias("n_rows"))
