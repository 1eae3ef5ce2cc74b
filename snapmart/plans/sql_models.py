"""The staging and mart models as SQL text over named relations.

These mirror ``staging.py`` / ``marts.py`` exactly. They serve two purposes: Spark SQL users run
them over temp views (``sql_views.register_models``), and DuckDB runs them as the independent oracle
the DataFrame plans are checked against. Every argument is the name of a relation (a table, view or
CTE). The model SQL is written in the subset both engines accept.
"""

from __future__ import annotations

import datetime as dt

from snapmart.functions.keys import surrogate_key_sql
from snapmart.schemas import LEAGUE_LABELS, UNKNOWN_LABEL


def ctes(*pairs: tuple[str, str], body: str) -> str:
    """WITH a AS (...), b AS (...) <body>."""
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in pairs) + "\n" + body


def _ts(t: dt.datetime, dialect: str = "duckdb") -> str:
    """A zone-less timestamp literal: TIMESTAMP is zone-less in DuckDB, TIMESTAMP_NTZ in Spark."""
    if dialect == "spark":
        return f"CAST('{t:%Y-%m-%d %H:%M:%S}' AS TIMESTAMP_NTZ)"
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def stg_standings_sql(src: str) -> str:
    return f"""
    SELECT snapshot_date,
           CAST(league_id AS BIGINT) AS league_id,
           CAST(season AS BIGINT) AS season,
           CAST(team_id AS BIGINT) AS team_id,
           upper(trim(team_name)) AS team_name,
           CAST(rank AS BIGINT) AS rank,
           CAST(points AS BIGINT) AS points,
           CAST(played AS BIGINT) AS matches_played,
           CAST(win AS BIGINT) AS wins,
           CAST(draw AS BIGINT) AS draws,
           CAST(lose AS BIGINT) AS losses,
           CAST(goals_for AS BIGINT) AS goals_for,
           CAST(goals_against AS BIGINT) AS goals_against,
           CAST(goal_diff AS BIGINT) AS goal_difference,
           upper(trim(form)) AS form,
           round(CAST(win AS DOUBLE) / NULLIF(CAST(played AS DOUBLE), 0) * 100, 2) AS win_pct,
           _loaded_at
    FROM {src}
    WHERE team_id IS NOT NULL AND league_id IS NOT NULL AND snapshot_date IS NOT NULL"""


def stg_players_sql(src: str) -> str:
    return f"""
    SELECT snapshot_date,
           CAST(player_id AS BIGINT) AS player_id,
           CAST(league_id AS BIGINT) AS league_id,
           CAST(season AS BIGINT) AS season,
           CAST(team_id AS BIGINT) AS team_id,
           upper(trim(player_name)) AS player_name,
           CAST(player_age AS BIGINT) AS player_age,
           upper(trim(nationality)) AS nationality,
           upper(trim(team_name)) AS team_name,
           COALESCE(CAST(appearances AS BIGINT), 0) AS appearances,
           COALESCE(CAST(goals AS BIGINT), 0) AS goals,
           COALESCE(CAST(assists AS BIGINT), 0) AS assists,
           COALESCE(CAST(yellow_cards AS BIGINT), 0) AS yellow_cards,
           COALESCE(CAST(red_cards AS BIGINT), 0) AS red_cards,
           COALESCE(CAST(rating AS DOUBLE), 0) AS rating,
           COALESCE(CAST(goals AS BIGINT), 0) + COALESCE(CAST(assists AS BIGINT), 0) AS goal_contributions,
           round(COALESCE(CAST(goals AS DOUBLE), 0) / NULLIF(CAST(appearances AS DOUBLE), 0), 2) AS goals_per_game,
           _loaded_at
    FROM {src}
    WHERE player_id IS NOT NULL AND team_id IS NOT NULL AND snapshot_date IS NOT NULL"""


def league_case_sql(col: str, field: int, mapping=LEAGUE_LABELS) -> str:
    whens = " ".join(f"WHEN {col} = {k} THEN '{v[field]}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE '{UNKNOWN_LABEL}' END"


def union_teams_sql(*srcs: str) -> str:
    return "\n    UNION\n".join(f"    SELECT team_id, team_name, league_id FROM {s}" for s in srcs)


def dim_teams_sql(stg_s: str, stg_p: str, created_at: dt.datetime, labels: str | None = None,
                  dialect: str = "duckdb") -> str:
    """``labels``: name of a (league_id, league_name, country) relation; None = the fixed CASE."""
    return dim_from_teams_sql(union_teams_sql(stg_s, stg_p), created_at, labels, dialect)


def dim_from_teams_sql(teams_sql: str, created_at: dt.datetime, labels: str | None = None,
                       dialect: str = "duckdb") -> str:
    teams = f"({teams_sql}) u"
    if labels is None:
        return f"""
    SELECT u.team_id, u.team_name, u.league_id,
           {league_case_sql('u.league_id', 0)} AS league_name,
           {league_case_sql('u.league_id', 1)} AS country,
           {_ts(created_at, dialect)} AS _created_at
    FROM {teams}"""
    return f"""
    SELECT u.team_id, u.team_name, u.league_id,
           COALESCE(l.league_name, '{UNKNOWN_LABEL}') AS league_name,
           COALESCE(l.country, '{UNKNOWN_LABEL}') AS country,
           {_ts(created_at, dialect)} AS _created_at
    FROM {teams} LEFT JOIN {labels} l ON u.league_id = l.league_id"""


def fact_standings_sql(stg: str, dim: str) -> str:
    return f"""
    SELECT {surrogate_key_sql('s.snapshot_date', 's.team_id', 's.league_id')} AS standing_id,
           s.team_id, s.league_id, s.snapshot_date, s.season,
           t.team_name, t.league_name, t.country,
           s.rank, s.points, s.matches_played, s.wins, s.draws, s.losses,
           s.goals_for, s.goals_against, s.goal_difference, s.form, s.win_pct,
           s._loaded_at
    FROM {stg} s LEFT JOIN {dim} t ON s.team_id = t.team_id AND s.league_id = t.league_id"""


def fact_player_stats_sql(stg: str, dim: str) -> str:
    return f"""
    SELECT {surrogate_key_sql('p.snapshot_date', 'p.player_id', 'p.league_id')} AS stat_id,
           p.player_id, p.team_id, p.league_id, p.snapshot_date,
           p.player_name, p.player_age, p.nationality, p.season,
           t.team_name, t.league_name, t.country,
           p.appearances, p.goals, p.assists, p.yellow_cards, p.red_cards, p.rating,
           p.goal_contributions, p.goals_per_game,
           p._loaded_at
    FROM {stg} p LEFT JOIN {dim} t ON p.team_id = t.team_id AND p.league_id = t.league_id"""


def upsert_sql(cols: list[str], keys: list[str], update_cols: list[str], tgt: str, bat: str,
               load_ts: dt.datetime, seq: str = "seq") -> str:
    """The row-by-row MERGE loop as one SQL statement: fold the batch (first/last by ``seq``),
    FULL JOIN on the keys, and pass NULL-key rows of both sides through."""
    ins = [c for c in cols if c not in keys and c not in update_cols and c != "_loaded_at"]
    upd = [c for c in update_cols if c in cols]
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    fold_cols = [f"arg_min_null({c}, {seq}) AS {c}" for c in ins] + [f"arg_max_null({c}, {seq}) AS {c}" for c in upd]
    fold = f"SELECT {', '.join(keys)}, {', '.join(fold_cols)} FROM {bat} WHERE {nn} GROUP BY {', '.join(keys)}"
    on = " AND ".join(f"t.{k} = f.{k}" for k in keys)
    k0 = keys[0]
    sel = []
    for c in cols:
        if c in keys:
            sel.append(f"COALESCE(t.{c}, f.{c}) AS {c}")
        elif c in ins:
            sel.append(f"CASE WHEN t.{k0} IS NOT NULL THEN t.{c} ELSE f.{c} END AS {c}")
        elif c in upd:
            sel.append(f"CASE WHEN f.{k0} IS NOT NULL THEN f.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN f.{k0} IS NOT NULL THEN {_ts(load_ts)} ELSE t.{c} END AS {c}")
    plain = ", ".join(cols)
    stamped = ", ".join(c if c != "_loaded_at" else f"{_ts(load_ts)} AS _loaded_at" for c in cols)
    return f"""
    SELECT {', '.join(sel)}
    FROM (SELECT * FROM {tgt} WHERE {nn}) t FULL OUTER JOIN ({fold}) f ON {on}
    UNION ALL SELECT {plain} FROM {tgt} WHERE NOT ({nn})
    UNION ALL SELECT {stamped} FROM {bat} WHERE NOT ({nn})"""


def checks_sql(model: str, src: str, checks) -> str:
    """One SELECT per check over ``src``, UNION ALL'ed (the oracle form of ``run_checks``)."""
    parts = []
    for c in checks:
        if c.kind == "not_null":
            m = n = f"count_if({c.column} IS NULL)"
        else:
            vals = ", ".join(str(v) for v in c.values)
            m = f"count(DISTINCT CASE WHEN {c.column} NOT IN ({vals}) THEN {c.column} END)"
            n = f"count_if({c.column} NOT IN ({vals}))"
        parts.append(f"""SELECT '{model}' AS "model", '{c.column}' AS "column", '{c.kind}' AS "check",
               CAST({m} AS BIGINT) AS failures, CAST({n} AS BIGINT) AS failing_rows FROM {src}""")
    return "\n    UNION ALL ".join(parts)


def with_passed(report_sql: str) -> str:
    return f"SELECT *, failures = 0 AS passed FROM ({report_sql})"
