"""Fixed schemas of the RAW, staging and mart layers, and the reference's fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, DB = T.LongType(), T.StringType(), T.DateType(), T.DoubleType()
TS = T.TimestampNTZType()
V = T.VariantType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def described(schema: T.StructType, comments: dict[str, str]) -> T.StructType:
    """Attach column descriptions (``comment`` metadata, shown by DESCRIBE on a catalog table)."""
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable,
                                       {**(f.metadata or {}), "comment": comments[f.name]} if f.name in comments
                                       else f.metadata)
                         for f in schema.fields])


# --- fixed values that must equal the reference's -------------------------------------------
# League ids fetched per run, the season requested, and the league labels of the dimension.
LEAGUE_IDS = [39, 140]
SEASON = 2024
LEAGUE_LABELS = {
    39: ("Premier League", "England"),
    140: ("La Liga", "Spain"),
}
UNKNOWN_LABEL = "Unknown"
# ---------------------------------------------------------------------------------------------

RAW_FIXTURES = _schema(
    ("fixture_id", L), ("league_id", L), ("date", D),
    ("home_team_id", L), ("home_team_name", S), ("away_team_id", L), ("away_team_name", S),
    ("home_goals", L), ("away_goals", L), ("status", S), ("raw_json", V), ("_loaded_at", TS),
)

RAW_STANDINGS = _schema(
    ("snapshot_date", D), ("league_id", L), ("season", L), ("rank", L), ("team_id", L), ("team_name", S),
    ("played", L), ("win", L), ("draw", L), ("lose", L), ("goals_for", L), ("goals_against", L),
    ("goal_diff", L), ("points", L), ("form", S), ("raw_json", V), ("_loaded_at", TS),
)

RAW_PLAYERS = _schema(
    ("snapshot_date", D), ("league_id", L), ("season", L), ("player_id", L), ("player_name", S),
    ("player_age", L), ("nationality", S), ("team_id", L), ("team_name", S), ("appearances", L),
    ("goals", L), ("assists", L), ("yellow_cards", L), ("red_cards", L), ("rating", DB),
    ("raw_json", V), ("_loaded_at", TS),
)

STG_STANDINGS = _schema(
    ("snapshot_date", D), ("league_id", L), ("season", L), ("team_id", L), ("team_name", S),
    ("rank", L), ("points", L), ("matches_played", L), ("wins", L), ("draws", L), ("losses", L),
    ("goals_for", L), ("goals_against", L), ("goal_difference", L), ("form", S), ("win_pct", DB),
    ("_loaded_at", TS),
)

STG_PLAYERS = _schema(
    ("snapshot_date", D), ("player_id", L), ("league_id", L), ("season", L), ("team_id", L),
    ("player_name", S), ("player_age", L), ("nationality", S), ("team_name", S), ("appearances", L),
    ("goals", L), ("assists", L), ("yellow_cards", L), ("red_cards", L), ("rating", DB),
    ("goal_contributions", L), ("goals_per_game", DB), ("_loaded_at", TS),
)

DIM_TEAMS = _schema(
    ("team_id", L), ("team_name", S), ("league_id", L), ("league_name", S), ("country", S),
    ("_created_at", TS),
)

FACT_STANDINGS_COLUMNS = [
    "standing_id", "team_id", "league_id", "snapshot_date", "season", "team_name", "league_name",
    "country", "rank", "points", "matches_played", "wins", "draws", "losses", "goals_for",
    "goals_against", "goal_difference", "form", "win_pct", "_loaded_at",
]

FACT_PLAYER_STATS_COLUMNS = [
    "stat_id", "player_id", "team_id", "league_id", "snapshot_date", "player_name", "player_age",
    "nationality", "season", "team_name", "league_name", "country", "appearances", "goals",
    "assists", "yellow_cards", "red_cards", "rating", "goal_contributions", "goals_per_game",
    "_loaded_at",
]

CHECK_REPORT = _schema(
    ("model", S), ("column", S), ("check", S), ("failures", L), ("failing_rows", L), ("passed", T.BooleanType()),
)


# Column descriptions of the two declared RAW sources (the inputs of the staging models).
_COMMON = {
    "snapshot_date": "Day the cumulative feed was captured (the run date)",
    "league_id": "League the request was made for",
    "season": "Season the request was made for",
    "team_id": "Team identifier of the feed",
    "raw_json": "The feed element as received, kept as VARIANT",
    "_loaded_at": "When the row was last inserted or updated by a load",
}
RAW_STANDINGS = described(RAW_STANDINGS, {
    **_COMMON,
    "rank": "Position in the league table", "team_name": "Team name as received",
    "played": "Matches played", "win": "Matches won", "draw": "Matches drawn", "lose": "Matches lost",
    "goals_for": "Goals scored", "goals_against": "Goals conceded", "goal_diff": "Goals scored minus conceded",
    "points": "League points", "form": "Recent results, one letter per match",
})
RAW_PLAYERS = described(RAW_PLAYERS, {
    **_COMMON,
    "player_id": "Player identifier of the feed", "player_name": "Player name as received",
    "player_age": "Age in years", "nationality": "Nationality as received", "team_name": "Team name as received",
    "appearances": "Matches appeared in this season", "goals": "Goals this season",
    "assists": "Assists this season", "yellow_cards": "Yellow cards this season",
    "red_cards": "Red cards this season", "rating": "Average match rating",
})
