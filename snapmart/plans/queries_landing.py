"""Registered queries: landed feeds (S1-S12) and table storage (S13-S17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.operators import upsert as U
from snapmart.plans import analogs as A
from snapmart.plans import marts, staging
from snapmart.plans import sql_models as Q
from snapmart.plans.suite import register
from snapmart.session import scratch_path
from snapmart.sources import landing as L
from snapmart.sources import rawstore as R

FIX_FLAT = ["fixture_id", "league_id", "date", "home_team_id", "home_team_name", "away_team_id",
            "away_team_name", "home_goals", "away_goals", "status"]
STD_FLAT = ["snapshot_date", "league_id", "season", "rank", "team_id", "team_name", "played", "win", "draw",
            "lose", "goals_for", "goals_against", "goal_diff", "points", "form"]
PLY_FLAT = ["snapshot_date", "league_id", "season", "player_id", "player_name", "player_age", "nationality",
            "team_id", "team_name", "appearances", "goals", "assists", "yellow_cards", "red_cards", "rating"]


def _t(spark, root):
    return A.Tables(spark, root)


def _sel(cols, src):
    return f"SELECT {', '.join(cols)} FROM ({src})"


# ---- S1-S3 flatteners -----------------------------------------------------------------------------

@register("flatten_fixtures", _sel(FIX_FLAT, A.raw_fixtures_sql()))
def q_flatten_fixtures(spark, root):
    return L.flatten_fixtures(A.fixtures_feed(_t(spark, root))).select(*FIX_FLAT)


@register("flatten_standings", _sel(STD_FLAT, A.raw_standings_sql()))
def q_flatten_standings(spark, root):
    return L.flatten_standings(A.standings_feed(_t(spark, root))).select(*STD_FLAT)


@register("flatten_players", _sel(PLY_FLAT, A.raw_players_sql()))
def q_flatten_players(spark, root):
    return L.flatten_players(A.players_feed(_t(spark, root))).select(*PLY_FLAT)


# ---- S4 first block: the second standings group and second statistics block are ignored -----------

@register("first_block", f"""
    SELECT 'standings' AS feed, snapshot_date, team_id AS id, league_id, rank AS value FROM ({A.raw_standings_sql()})
    UNION ALL
    SELECT 'players' AS feed, snapshot_date, player_id AS id, league_id, team_id AS value FROM ({A.raw_players_sql()})""")
def q_first_block(spark, root):
    t = _t(spark, root)
    s = L.flatten_standings(A.standings_feed(t)).select(
        F.lit("standings").alias("feed"), "snapshot_date", F.col("team_id").alias("id"), "league_id",
        F.col("rank").alias("value"))
    p = L.flatten_players(A.players_feed(t)).select(
        F.lit("players").alias("feed"), "snapshot_date", F.col("player_id").alias("id"), "league_id",
        F.col("team_id").alias("value"))
    return s.unionByName(p)


# ---- S11 empty or absent responses contribute nothing ----------------------------------------------

@register("tolerate_empty_feed", f"""
    SELECT 'standings' AS feed, snapshot_date AS day, league_id, team_id AS id FROM ({A.raw_standings_sql()})
    UNION ALL
    SELECT 'fixtures' AS feed, date AS day, league_id, fixture_id AS id FROM ({A.raw_fixtures_sql()})""")
def q_tolerate_empty_feed(spark, root):
    t = _t(spark, root)
    sd = A.standings_feed(t)
    fd = A.fixtures_feed(t)
    s = L.flatten_standings(sd.unionByName(A.empty_feed_docs(sd))).select(
        F.lit("standings").alias("feed"), F.col("snapshot_date").alias("day"), "league_id",
        F.col("team_id").alias("id"))
    f = L.flatten_fixtures(fd.unionByName(A.empty_feed_docs(fd))).select(
        F.lit("fixtures").alias("feed"), F.col("date").alias("day"), "league_id", F.col("fixture_id").alias("id"))
    return s.unionByName(f)


# ---- S10 payload retained whole (fields read back from the kept variant) ----------------------------

@register("retain_payload", f"""
    SELECT snapshot_date, player_id, league_id,
           player_name AS payload_name, goals AS payload_goals, team_id + 1000000 AS payload_second_team,
           CAST(rating AS VARCHAR) IS NOT NULL AS payload_has_rating
    FROM ({A.raw_players_sql()})""")
def q_retain_payload(spark, root):
    r = F.col("raw_json")
    return L.flatten_players(A.players_feed(_t(spark, root))).select(
        "snapshot_date", "player_id", "league_id",
        F.variant_get(r, "$.player.name", "string").alias("payload_name"),
        F.variant_get(r, "$.statistics[0].goals.total", "bigint").alias("payload_goals"),
        F.variant_get(r, "$.statistics[1].team.id", "bigint").alias("payload_second_team"),
        F.variant_get(r, "$.statistics[0].games.rating", "string").isNotNull().alias("payload_has_rating"))


# ---- S12 strict paths: JSON nulls are values, the load succeeds --------------------------------------

@register("require_paths", f"""
    SELECT fixture_id, status, home_goals, away_goals, home_goals IS NULL AS goals_null
    FROM ({A.raw_fixtures_sql()})""")
def q_require_paths(spark, root):
    f = L.flatten_fixtures(A.fixtures_feed(_t(spark, root)), strict=True)
    return f.select("fixture_id", "status", "home_goals", "away_goals",
                    F.col("home_goals").isNull().alias("goals_null"))


# Every seventh page each: a path that is missing, a body that breaks off, a null response, a value of another type.
_NO_PATH, _BROKEN, _NULL, _TYPE = 1, 2, 3, 4


@register("reject_documents", f"""
    WITH docs AS (
      SELECT snapshot_date AS request_date, league_id, CAST(floor(player_id / {A.PAGE}.0) AS BIGINT) AS page,
             CAST(count(*) AS BIGINT) AS n
      FROM ({A.raw_players_sql()}) GROUP BY ALL
    ), kinds AS (SELECT *, ((page % 7) + 7) % 7 AS kind FROM docs)
    SELECT request_date, league_id, page,
           CASE WHEN kind IN ({_BROKEN}, {_NULL}, {_NO_PATH}, {_TYPE}) THEN 0 ELSE n END AS n_rows,
           CASE WHEN kind IN ({_NO_PATH}, {_TYPE}) THEN n WHEN kind IN ({_BROKEN}, {_NULL}) THEN 1 ELSE 0 END AS n_problems,
           CASE kind WHEN {_NO_PATH} THEN '[0] missing: $.player.nationality' WHEN {_BROKEN} THEN 'malformed JSON'
             WHEN {_NULL} THEN 'null: $.response'
             WHEN {_TYPE} THEN '[0] not a bigint: $.statistics[0].goals.assists' END AS problem
    FROM kinds""")
def q_reject_documents(spark, root):
    """Documents that load, with their rows, beside those that do not, with what is wrong with them."""
    kind, body = F.pmod("page", F.lit(7)), F.col("body")
    docs = A.players_feed(_t(spark, root)).withColumn(
        "body", F.when(kind == _NO_PATH, F.replace(body, F.lit('"nationality"'), F.lit('"nation"')))
        .when(kind == _BROKEN, F.expr("left(body, length(body) - 1)"))
        .when(kind == _NULL, F.lit('{"response": null}'))
        .when(kind == _TYPE, F.replace(body, F.lit('"assists":'), F.lit('"assists":"many","number":'))).otherwise(body))
    accepted, rejected = L.split_documents(docs, "players")
    rows = L.flatten_players(accepted)
    page, zero = F.col("_seq._page").alias("page"), F.lit(0).cast("bigint")
    loaded = rows.groupBy("_seq.request_date", "_seq.league_id", page).agg(F.count("*").alias("n_rows"))
    return loaded.select("request_date", "league_id", "page", "n_rows", zero.alias("n_problems"),
                         F.lit(None).cast("string").alias("problem")).unionByName(
        rejected.select("request_date", "league_id", "page", zero.alias("n_rows"),
                        F.size("problems").cast("bigint").alias("n_problems"), F.get("problems", F.lit(0)).alias("problem")))


# ---- S5-S7 feed selection ------------------------------------------------------------------------

LEAGUE_REGION = 1
SEASON_ANALOG = 1995
RUN_DATE = "1998-08-03"


@register("feed_by_league", f"""
    SELECT snapshot_date, league_id, team_id, rank FROM ({A.raw_standings_sql()})
    WHERE league_id IN (SELECT n_nationkey FROM nation WHERE n_regionkey = {LEAGUE_REGION})""")
def q_feed_by_league(spark, root):
    """Leagues of one region, given as a league table (semi-join) rather than a literal list."""
    t = _t(spark, root)
    leagues = t.nation.where(F.col("n_regionkey") == LEAGUE_REGION).select(
        F.col("n_nationkey").cast("bigint").alias("league_id"))
    docs = L.select_leagues(A.standings_feed(t), leagues)
    return L.flatten_standings(docs).select("snapshot_date", "league_id", "team_id", "rank")


@register("feed_by_season", f"""
    SELECT snapshot_date, league_id, team_id, points FROM ({A.raw_standings_sql()})
    WHERE season = {SEASON_ANALOG}""")
def q_feed_by_season(spark, root):
    """One of the seven seasons of the standings feed."""
    docs = L.select_season(A.standings_feed(_t(spark, root)), SEASON_ANALOG)
    return L.flatten_standings(docs).select("snapshot_date", "league_id", "team_id", "points")


@register("feed_by_day", f"""
    SELECT fixture_id, league_id, date, status FROM ({A.raw_fixtures_sql()})
    WHERE date = DATE '{RUN_DATE}' - INTERVAL 1 DAY""")
def q_feed_by_day(spark, root):
    """A fixtures run pulls the day before its run date."""
    docs = L.select_day(A.fixtures_feed(_t(spark, root)), RUN_DATE, days_back=1)
    return L.flatten_fixtures(docs).select("fixture_id", "league_id", "date", "status")


# ---- S8, S9, X12 stamps ----------------------------------------------------------------------------

@register("stamp_context", _sel(["fixture_id", "league_id", "date"], A.raw_fixtures_sql()))
def q_stamp_context(spark, root):
    """league_id and date come from the request context of each document, not from the payload."""
    return L.flatten_fixtures(A.fixtures_feed(_t(spark, root))).select("fixture_id", "league_id", "date")


SNAPSHOT_RUN_DATE = "2024-08-02"


@register("stamp_snapshot", f"""
    SELECT DATE '{SNAPSHOT_RUN_DATE}' AS snapshot_date, league_id, team_id, points FROM ({A.raw_standings_sql()})""")
def q_stamp_snapshot(spark, root):
    """A cumulative feed stamped with the run date becomes that day's snapshot."""
    rows = L.flatten_standings(A.standings_feed(_t(spark, root)))
    return L.stamp_snapshot(rows, SNAPSHOT_RUN_DATE).select("snapshot_date", "league_id", "team_id", "points")


@register("stamp_run_time", f"""
    SELECT snapshot_date, player_id, league_id, {A.sql_ts(A.T1)} AS _loaded_at FROM ({A.raw_players_sql()})""")
def q_stamp_run_time(spark, root):
    rows = L.flatten_players(A.players_feed(_t(spark, root)))
    return L.stamp_loaded_at(rows, A.T1).select("snapshot_date", "player_id", "league_id", "_loaded_at")


# ---- S13-S17 storage --------------------------------------------------------------------------------

_RS_NO_PAYLOAD = [f for f in U.STANDINGS.schema.fields if f.name != "raw_json"]


@register("ensure_table", A.raw_standings_sql())
def q_ensure_table(spark, root):
    """Create-if-missing, load, then ensure again: the second call must leave the table alone."""
    from pyspark.sql import types as T
    schema = T.StructType(_RS_NO_PAYLOAD)
    path = scratch_path(spark, "raw_standings")
    R.ensure_table(spark, path, schema, ["snapshot_date"])
    R.append_table(A.raw_standings(_t(spark, root)).select(*schema.fieldNames()), path, ["snapshot_date"])
    if R.ensure_table(spark, path, schema, ["snapshot_date"]):
        raise AssertionError("ensure_table re-created an existing table")
    return R.read_table(spark, path, schema)


@register("read_source", Q.ctes(("rs", A.raw_standings_sql()), body=Q.stg_standings_sql("rs")))
def q_read_source(spark, root):
    """A stored RAW table read back with its fixed schema feeds the staging model."""
    from pyspark.sql import types as T
    schema = T.StructType(_RS_NO_PAYLOAD)
    path = scratch_path(spark, "raw_standings")
    R.append_table(A.raw_standings(_t(spark, root)), path, ["snapshot_date"])
    return staging.stg_standings(R.read_table(spark, path, schema))


@register("materialize_table", Q.ctes(
    ("rs", A.raw_standings_sql()), ("rp", A.raw_players_sql()),
    ("stg_s", Q.stg_standings_sql("rs")), ("stg_p", Q.stg_players_sql("rp")), ("labels_t", A.NATION_LABELS_SQL),
    body=Q.dim_teams_sql("stg_s", "stg_p", A.RUN_TS, labels="labels_t")))
def q_materialize_table(spark, root):
    """The dimension is rebuilt as a new table version; readers get the newest committed version."""
    from snapmart.plans.jobs import build_version
    t = _t(spark, root)
    dim = marts.dim_teams(staging.stg_standings(A.raw_standings(t)), staging.stg_players(A.raw_players(t)),
                          A.RUN_TS, labels=A.nation_labels(t))
    path = scratch_path(spark, "dim_teams")
    R.publish_version(dim, path, build_version(A.RUN_TS))
    return R.read_latest(spark, path, dim.schema)
