"""Staging models: clean, cast and rename RAW rows (lazy DataFrames, the 'view' layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.clean import (
    all_not_null, as_float, as_int, clean_text, goal_contributions, goals_per_game, win_pct, zero_fill,
)

STANDINGS_REQUIRED = ("team_id", "league_id", "snapshot_date")
PLAYERS_REQUIRED = ("player_id", "team_id", "snapshot_date")  # league_id is deliberately not required


def filter_standings(raw: DataFrame) -> DataFrame:
    """Drop standings rows with a NULL team_id, league_id or snapshot_date."""
    return raw.where(all_not_null(*STANDINGS_REQUIRED))


def filter_players(raw: DataFrame) -> DataFrame:
    """Drop player rows with a NULL player_id, team_id or snapshot_date (NULL league_id is kept)."""
    return raw.where(all_not_null(*PLAYERS_REQUIRED))


def stg_standings(raw: DataFrame) -> DataFrame:
    """17 columns: ids cast, names cleaned, counters renamed, win_pct derived."""
    return filter_standings(raw).select(
        F.col("snapshot_date"),
        as_int("league_id").alias("league_id"),
        as_int("season").alias("season"),
        as_int("team_id").alias("team_id"),
        clean_text("team_name").alias("team_name"),
        as_int("rank").alias("rank"),
        as_int("points").alias("points"),
        as_int("played").alias("matches_played"),
        as_int("win").alias("wins"),
        as_int("draw").alias("draws"),
        as_int("lose").alias("losses"),
        as_int("goals_for").alias("goals_for"),
        as_int("goals_against").alias("goals_against"),
        as_int("goal_diff").alias("goal_difference"),
        clean_text("form").alias("form"),
        win_pct("win", "played").alias("win_pct"),
        F.col("_loaded_at"),
    )


def stg_players(raw: DataFrame) -> DataFrame:
    """18 columns: counters zero-filled, names cleaned, contributions and per-game ratio derived."""
    return filter_players(raw).select(
        F.col("snapshot_date"),
        as_int("player_id").alias("player_id"),
        as_int("league_id").alias("league_id"),
        as_int("season").alias("season"),
        as_int("team_id").alias("team_id"),
        clean_text("player_name").alias("player_name"),
        as_int("player_age").alias("player_age"),
        clean_text("nationality").alias("nationality"),
        clean_text("team_name").alias("team_name"),
        zero_fill(as_int("appearances")).alias("appearances"),
        zero_fill(as_int("goals")).alias("goals"),
        zero_fill(as_int("assists")).alias("assists"),
        zero_fill(as_int("yellow_cards")).alias("yellow_cards"),
        zero_fill(as_int("red_cards")).alias("red_cards"),
        zero_fill(as_float("rating")).cast("double").alias("rating"),
        goal_contributions("goals", "assists").alias("goal_contributions"),
        goals_per_game("goals", "appearances").alias("goals_per_game"),
        F.col("_loaded_at"),
    )
