"""Registered queries: staging and mart models, their projections, filters, functions and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.functions import clean
from snapmart.functions.keys import surrogate_key, surrogate_key_sql
from snapmart.functions.labels import league_case
from snapmart.plans import analogs as A
from snapmart.plans import marts, staging
from snapmart.plans import sql_models as Q
from snapmart.plans.suite import register

RS = ("rs", A.raw_standings_sql())
RP = ("rp", A.raw_players_sql())
STG_S = ("stg_s", Q.stg_standings_sql("rs"))
STG_P = ("stg_p", Q.stg_players_sql("rp"))
LABELS = ("labels_t", A.NATION_LABELS_SQL)
DIM = ("dim", Q.dim_teams_sql("stg_s", "stg_p", A.RUN_TS, labels="labels_t"))


def _stg_s(spark, root):
    return staging.stg_standings(A.raw_standings(A.Tables(spark, root)))


def _stg_p(spark, root):
    return staging.stg_players(A.raw_players(A.Tables(spark, root)))


def _dim(spark, root):
    t = A.Tables(spark, root)
    return marts.dim_teams(_stg_s(spark, root), _stg_p(spark, root), A.RUN_TS, labels=A.nation_labels(t))


# --- D1, D2: staging models -------------------------------------------------------------------

@register("stg_standings", Q.ctes(RS, STG_S, body="SELECT * FROM stg_s"))
def q_stg_standings(spark, root):
    return _stg_s(spark, root)


@register("stg_players", Q.ctes(RP, STG_P, body="SELECT * FROM stg_p"))
def q_stg_players(spark, root):
    return _stg_p(spark, root)


# --- D3-D5: marts -----------------------------------------------------------------------------

@register("dim_teams", Q.ctes(RS, RP, STG_S, STG_P, LABELS, body=f"SELECT * FROM ({DIM[1]})"))
def q_dim_teams(spark, root):
    return _dim(spark, root)


@register("fact_standings", Q.ctes(RS, RP, STG_S, STG_P, LABELS, DIM,
                                   body=Q.fact_standings_sql("stg_s", "dim")))
def q_fact_standings(spark, root):
    return marts.fact_standings(_stg_s(spark, root), _dim(spark, root))


@register("fact_player_stats", Q.ctes(RS, RP, STG_S, STG_P, LABELS, DIM,
                                      body=Q.fact_player_stats_sql("stg_p", "dim")))
def q_fact_player_stats(spark, root):
    return marts.fact_player_stats(_stg_p(spark, root), _dim(spark, root))


def _t(spark, root):
    return A.Tables(spark, root)


# --- F1, F2: not-null row filters -------------------------------------------------------------------

@register("filter_standings", Q.ctes(RS, body="""SELECT * FROM rs
    WHERE team_id IS NOT NULL AND league_id IS NOT NULL AND snapshot_date IS NOT NULL"""))
def q_filter_standings(spark, root):
    return staging.filter_standings(A.raw_standings(_t(spark, root)))


@register("filter_players", Q.ctes(RP, body="""SELECT * FROM rp
    WHERE player_id IS NOT NULL AND team_id IS NOT NULL AND snapshot_date IS NOT NULL"""))
def q_filter_players(spark, root):
    """league_id is not required: rows with a NULL league stay."""
    return staging.filter_players(A.raw_players(_t(spark, root)))


# --- X1-X10: scalar functions --------------------------------------------------------------------

@register("cast_int", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_int,
    CAST(user_id AS BIGINT) AS user_int FROM events""")
def q_cast_int(spark, root):
    e = _t(spark, root).events
    return e.select("event_id", clean.as_int(F.get_json_object("props", "$.k")).alias("k_int"),
                    clean.as_int("user_id").alias("user_int"))


@register("cast_float", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_float,
    CAST(event_id AS DOUBLE) AS id_float FROM events""")
def q_cast_float(spark, root):
    e = _t(spark, root).events
    return e.select("event_id", clean.as_float(F.get_json_object("props", "$.k")).alias("k_float"),
                    clean.as_float("event_id").alias("id_float"))


@register("clean_text", Q.ctes(RS, body="""SELECT snapshot_date, team_id,
    upper(trim(team_name)) AS team_name, upper(trim(form)) AS form FROM rs"""))
def q_clean_text(spark, root):
    rs = A.raw_standings(_t(spark, root))
    return rs.select("snapshot_date", "team_id", clean.clean_text("team_name").alias("team_name"),
                     clean.clean_text("form").alias("form"))


@register("zero_fill", Q.ctes(RP, body="""SELECT snapshot_date, player_id, COALESCE(goals, 0) AS goals,
    COALESCE(assists, 0) AS assists, COALESCE(red_cards, 0) AS red_cards,
    COALESCE(CAST(rating AS DOUBLE), 0) AS rating FROM rp"""))
def q_zero_fill(spark, root):
    rp = A.raw_players(_t(spark, root))
    return rp.select("snapshot_date", "player_id", clean.zero_fill("goals").alias("goals"),
                     clean.zero_fill("assists").alias("assists"), clean.zero_fill("red_cards").alias("red_cards"),
                     clean.zero_fill(clean.as_float("rating")).cast("double").alias("rating"))


@register("safe_ratio", Q.ctes(RP, body="""SELECT snapshot_date, player_id,
    CAST(goals AS DOUBLE) / NULLIF(CAST(appearances AS DOUBLE), 0) AS ratio FROM rp"""))
def q_safe_ratio(spark, root):
    rp = A.raw_players(_t(spark, root))
    return rp.select("snapshot_date", "player_id", clean.safe_ratio("goals", "appearances").alias("ratio"))


@register("win_pct", Q.ctes(RS, body="""SELECT snapshot_date, team_id, league_id,
    round(CAST(win AS DOUBLE) / NULLIF(CAST(played AS DOUBLE), 0) * 100, 2) AS win_pct FROM rs"""))
def q_win_pct(spark, root):
    rs = A.raw_standings(_t(spark, root))
    return rs.select("snapshot_date", "team_id", "league_id", clean.win_pct("win", "played").alias("win_pct"))


@register("goal_contributions", Q.ctes(RP, body="""SELECT snapshot_date, player_id,
    COALESCE(goals, 0) + COALESCE(assists, 0) AS goal_contributions,
    round(COALESCE(CAST(goals AS DOUBLE), 0) / NULLIF(CAST(appearances AS DOUBLE), 0), 2) AS goals_per_game
    FROM rp"""))
def q_goal_contributions(spark, root):
    rp = A.raw_players(_t(spark, root))
    return rp.select("snapshot_date", "player_id",
                     clean.goal_contributions("goals", "assists").alias("goal_contributions"),
                     clean.goals_per_game("goals", "appearances").alias("goals_per_game"))


# --- X11: league CASE with the reference's fixed labels ---------------------------------------------
# A league id derived from the customer key, so the labelled ids, other ids and NULL all occur.

@register("case_league", f"""SELECT o_orderkey AS fixture_id, NULLIF(o_custkey % 160, 0) AS league_id,
    {Q.league_case_sql('NULLIF(o_custkey % 160, 0)', 0)} AS league_name,
    {Q.league_case_sql('NULLIF(o_custkey % 160, 0)', 1)} AS country FROM orders""")
def q_case_league(spark, root):
    o = _t(spark, root).orders
    lid = F.nullif(F.col("o_custkey") % 160, F.lit(0))
    return o.select(F.col("o_orderkey").alias("fixture_id"), lid.alias("league_id"),
                    league_case(lid, field=0).alias("league_name"), league_case(lid, field=1).alias("country"))


# --- X16: surrogate key (NULL parts hashed through the placeholder) ----------------------------------

@register("surrogate_key", Q.ctes(RS, body=f"""SELECT snapshot_date, team_id, league_id,
    {surrogate_key_sql('snapshot_date', 'team_id', 'league_id')} AS standing_id FROM rs"""))
def q_surrogate_key(spark, root):
    rs = A.raw_standings(_t(spark, root))
    return rs.select("snapshot_date", "team_id", "league_id",
                     surrogate_key("snapshot_date", "team_id", "league_id").alias("standing_id"))


# --- A2, A3: DISTINCT and UNION ----------------------------------------------------------------------

@register("distinct_teams", Q.ctes(RP, STG_P, body="SELECT DISTINCT team_id, team_name, league_id FROM stg_p"))
def q_distinct_teams(spark, root):
    return marts.distinct_teams(_stg_p(spark, root))


@register("union_teams", Q.ctes(("sup", A.SUPPLIER_TEAMS_SQL), ("cus", A.CUSTOMER_TEAMS_SQL),
                                body=Q.union_teams_sql("sup", "cus")))
def q_union_teams(spark, root):
    t = _t(spark, root)
    return marts.union_teams(A.supplier_teams(t), A.customer_teams(t))


# --- J3, J4: join fan-out and NULL join keys ---------------------------------------------------------

_DIM2 = ("dim2", Q.dim_from_teams_sql(Q.union_teams_sql("sup", "cus"), A.RUN_TS, labels="labels_t"))


@register("join_fanout", Q.ctes(RS, STG_S, ("sup", A.SUPPLIER_TEAMS_SQL), ("cus", A.CUSTOMER_TEAMS_SQL), LABELS,
                                _DIM2, body=Q.fact_standings_sql("stg_s", "dim2")))
def q_join_fanout(spark, root):
    """A team spelled two ways in the dimension doubles its fact rows and their keys."""
    t = _t(spark, root)
    dim2 = marts.dim_from_teams(marts.union_teams(A.supplier_teams(t), A.customer_teams(t)), A.RUN_TS,
                                labels=A.nation_labels(t))
    return marts.fact_standings(_stg_s(spark, root), dim2)


@register("join_null_key", Q.ctes(RS, RP, STG_S, STG_P, LABELS, DIM, ("f", Q.fact_player_stats_sql("stg_p", "dim")),
                                  body="""SELECT league_id IS NULL AS null_league, CAST(count(*) AS BIGINT) AS n_rows,
    CAST(count(league_name) AS BIGINT) AS n_matched FROM f GROUP BY 1"""))
def q_join_null_key(spark, root):
    """A NULL league never matches the dimension: those fact rows carry no team context."""
    f = marts.fact_player_stats(_stg_p(spark, root), _dim(spark, root))
    return f.groupBy(F.col("league_id").isNull().alias("null_league")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("league_name").alias("n_matched"))
