"""Mart models: the team dimension and the two facts.

Plan shape at scale:
* dim_teams is ONE aggregate over the union of both staging inputs (the inner DISTINCTs of the
  model are redundant under UNION), so each side is pre-aggregated map-side and shuffled once.
* the facts are left equi-joins on (team_id, league_id). No broadcast hint is given: AQE measures the
  materialised dim and switches to a broadcast join only when it is under the threshold, otherwise a
  sort-merge join runs, with AQE's skew-join splitting any hot team partition of the fact side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.clean import ntz_lit
from snapmart.functions.keys import surrogate_key
from snapmart.functions.labels import with_league_labels
from snapmart.schemas import FACT_PLAYER_STATS_COLUMNS, FACT_STANDINGS_COLUMNS, LEAGUE_LABELS

TEAM_COLS = ["team_id", "team_name", "league_id"]
JOIN_KEYS = ["team_id", "league_id"]


def distinct_teams(stg: DataFrame) -> DataFrame:
    """SELECT DISTINCT team_id, team_name, league_id."""
    return stg.select(*TEAM_COLS).distinct()


def union_teams(*stgs: DataFrame) -> DataFrame:
    """UNION (set semantics, NULLs equal) of the team triples of all inputs, in one aggregate."""
    parts = [s.select(*TEAM_COLS) for s in stgs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def dim_teams(stg_standings: DataFrame, stg_players: DataFrame, created_at: dt.datetime,
              labels: Mapping[int, tuple[str, str]] | DataFrame = LEAGUE_LABELS) -> DataFrame:
    """Team dimension: (team_id, team_name, league_id, league_name, country, _created_at).

    Not unique on (team_id, league_id) when a team is spelled two ways; the facts then fan out.
    """
    return dim_from_teams(union_teams(stg_standings, stg_players), created_at, labels)


def dim_from_teams(teams: DataFrame, created_at: dt.datetime,
                   labels: Mapping[int, tuple[str, str]] | DataFrame = LEAGUE_LABELS) -> DataFrame:
    """Label a set of (team_id, team_name, league_id) triples and stamp the build time."""
    return with_league_labels(teams, labels).select(
        *TEAM_COLS, "league_name", "country", ntz_lit(created_at).alias("_created_at"))


def _dim_side(dim: DataFrame) -> DataFrame:
    return dim.select(
        F.col("team_id").alias("_d_team_id"), F.col("league_id").alias("_d_league_id"),
        F.col("team_name").alias("_d_team_name"), "league_name", "country")


def _join_dim(fact: DataFrame, dim: DataFrame) -> DataFrame:
    d = _dim_side(dim)
    cond = (fact["team_id"] == d["_d_team_id"]) & (fact["league_id"] == d["_d_league_id"])
    return fact.join(d, cond, "left")


def fact_standings(stg: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per standings row (times dim matches); team context from the dim side."""
    j = _join_dim(stg.drop("team_name"), dim)
    j = j.withColumn("standing_id", surrogate_key("snapshot_date", "team_id", "league_id"))
    j = j.withColumn("team_name", F.col("_d_team_name"))
    return j.select(*FACT_STANDINGS_COLUMNS)


def fact_player_stats(stg: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per player row (times dim matches); team context from the dim side."""
    j = _join_dim(stg.drop("team_name"), dim)
    j = j.withColumn("stat_id", surrogate_key("snapshot_date", "player_id", "league_id"))
    j = j.withColumn("team_name", F.col("_d_team_name"))
    return j.select(*FACT_PLAYER_STATS_COLUMNS)
