"""Edge rows of the staging and mart models (FIXTURES.md section 4)."""

import datetime as dt
import hashlib

import pytest
from conftest import T0, d
from pyspark.sql import functions as F

from snapmart.functions.keys import surrogate_key
from snapmart.plans import marts, staging
from snapmart.schemas import RAW_PLAYERS, RAW_STANDINGS

RUN = dt.datetime(2024, 8, 2, 8, 0, 0)


def standings(spark, rows):
    full = []
    for r in rows:
        base = dict(snapshot_date=d("2024-08-01"), league_id=39, season=2024, rank=1, team_id=1,
                    team_name="Arsenal", played=3, win=1, draw=1, lose=1, goals_for=3, goals_against=2,
                    goal_diff=1, points=4, form="WDL", raw_json=None, _loaded_at=T0)
        base.update(r)
        full.append(tuple(base[f] for f in RAW_STANDINGS.fieldNames()))
    return spark.createDataFrame(full, RAW_STANDINGS)


def players(spark, rows):
    full = []
    for r in rows:
        base = dict(snapshot_date=d("2024-08-01"), league_id=39, season=2024, player_id=10, player_name="Saka",
                    player_age=22, nationality="England", team_id=1, team_name="Arsenal", appearances=4,
                    goals=2, assists=1, yellow_cards=0, red_cards=0, rating=7.5, raw_json=None, _loaded_at=T0)
        base.update(r)
        full.append(tuple(base[f] for f in RAW_PLAYERS.fieldNames()))
    return spark.createDataFrame(full, RAW_PLAYERS)


def test_goals_per_game_null_for_zero_or_null_appearances(spark):
    out = staging.stg_players(players(spark, [
        dict(player_id=1, appearances=0), dict(player_id=2, appearances=None),
        dict(player_id=3, goals=None, appearances=4)])).orderBy("player_id").collect()
    assert out[0].goals_per_game is None and out[0].appearances == 0
    assert out[1].goals_per_game is None and out[1].appearances == 0
    assert out[2].goals == 0 and out[2].goals_per_game == 0.0


def test_win_pct_paths(spark):
    out = staging.stg_standings(standings(spark, [
        dict(team_id=1, played=0), dict(team_id=2, played=None), dict(team_id=3, win=None),
        dict(team_id=4, played=3, win=1)])).orderBy("team_id").collect()
    assert [r.win_pct for r in out] == [None, None, None, 33.33]


def test_clean_text_trims_spaces_only_and_upper_cases(spark):
    out = staging.stg_standings(standings(spark, [
        dict(team_id=1, team_name="  arsenal "), dict(team_id=2, team_name="\tspurs"),
        dict(team_id=3, team_name=None)])).orderBy("team_id").collect()
    assert [r.team_name for r in out] == ["ARSENAL", "\tSPURS", None]


def test_required_columns_filter(spark):
    sp = staging.stg_players(players(spark, [
        dict(player_id=None), dict(player_id=2, team_id=None), dict(player_id=3, snapshot_date=None),
        dict(player_id=4, league_id=None)])).collect()
    assert [r.player_id for r in sp] == [4]
    ss = staging.stg_standings(standings(spark, [
        dict(team_id=None), dict(team_id=2, league_id=None), dict(team_id=3, snapshot_date=None),
        dict(team_id=4)])).collect()
    assert [r.team_id for r in ss] == [4]


def test_staging_column_order(spark):
    ss = staging.stg_standings(standings(spark, [{}]))
    assert ss.columns == ["snapshot_date", "league_id", "season", "team_id", "team_name", "rank", "points",
                          "matches_played", "wins", "draws", "losses", "goals_for", "goals_against",
                          "goal_difference", "form", "win_pct", "_loaded_at"]
    sp = staging.stg_players(players(spark, [{}]))
    assert len(sp.columns) == 18 and sp.columns[-3:] == ["goal_contributions", "goals_per_game", "_loaded_at"]


def test_league_labels(spark):
    s = staging.stg_standings(standings(spark, [dict(team_id=1, league_id=39), dict(team_id=2, league_id=140),
                                                dict(team_id=3, league_id=7)]))
    p = staging.stg_players(players(spark, [dict(player_id=1, team_id=4, league_id=None)]))
    dim = {r.team_id: (r.league_name, r.country) for r in marts.dim_teams(s, p, RUN).collect()}
    assert dim == {1: ("Premier League", "England"), 2: ("La Liga", "Spain"), 3: ("Unknown", "Unknown"),
                   4: ("Unknown", "Unknown")}


def test_dim_dedups_same_spelling_and_fans_out_on_two_spellings(spark):
    s = staging.stg_standings(standings(spark, [dict(team_id=1, team_name="Arsenal"),
                                                dict(team_id=2, team_name="Chelsea")]))
    p = staging.stg_players(players(spark, [dict(player_id=1, team_id=1, team_name=" arsenal"),
                                            dict(player_id=2, team_id=2, team_name="Chelsea FC")]))
    dim = marts.dim_teams(s, p, RUN)
    assert sorted((r.team_id, r.team_name) for r in dim.collect()) == [
        (1, "ARSENAL"), (2, "CHELSEA"), (2, "CHELSEA FC")]
    fact = marts.fact_standings(s, dim).where("team_id = 2").collect()
    assert len(fact) == 2 and fact[0].standing_id == fact[1].standing_id
    assert {r.team_name for r in fact} == {"CHELSEA", "CHELSEA FC"}


def test_fact_null_league_has_no_team_context(spark):
    s = staging.stg_standings(standings(spark, [dict(team_id=1)]))
    p = staging.stg_players(players(spark, [dict(player_id=5, team_id=1, league_id=None)]))
    dim = marts.dim_teams(s, p, RUN)
    f = marts.fact_player_stats(p, dim).collect()
    assert len(f) == 1 and f[0].team_name is None and f[0].league_name is None
    assert len(marts.fact_player_stats(p, dim).columns) == 21


def test_fact_team_name_comes_from_dim(spark):
    s = staging.stg_standings(standings(spark, [dict(team_id=1, team_name="Arsenal", league_id=39)]))
    p = staging.stg_players(players(spark, [dict(player_id=1, team_id=9, league_id=39)]))
    dim = marts.dim_teams(s, p, RUN).where("team_id = 9")  # no row for team 1
    f = marts.fact_standings(s, dim).collect()
    assert f[0].team_name is None and f[0].rank == 1


def test_surrogate_key(spark):
    df = spark.createDataFrame([(d("2024-01-01"), 5, 39), (d("2024-01-01"), 5, None)],
                               "d date, t bigint, l bigint")
    out = df.select(surrogate_key("d", "t", "l").alias("k"), surrogate_key("l", "t", "d").alias("k2")).collect()
    assert out[0].k == hashlib.md5(b"2024-01-01-5-39").hexdigest()
    assert out[1].k == hashlib.md5(b"2024-01-01-5-_dbt_utils_surrogate_key_null_").hexdigest()
    assert out[0].k != out[0].k2 and len(out[0].k) == 32


def test_no_python_udf_in_model_plans(spark):
    s = staging.stg_standings(standings(spark, [{}]))
    p = staging.stg_players(players(spark, [{}]))
    dim = marts.dim_teams(s, p, RUN)
    for df in (marts.fact_standings(s, dim), marts.fact_player_stats(p, dim)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_dim_is_one_aggregate_over_the_union(spark):
    s = staging.stg_standings(standings(spark, [{}]))
    p = staging.stg_players(players(spark, [{}]))
    plan = marts.dim_teams(s, p, RUN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" in plan


def test_sql_views_equal_dataframe_models(spark):
    from snapmart.plans.sql_views import register_models
    raw_s = standings(spark, [dict(team_id=1, team_name=" arsenal "), dict(team_id=2, league_id=140, played=0),
                              dict(team_id=3, league_id=None)])
    raw_p = players(spark, [dict(player_id=1, team_id=1, appearances=0), dict(player_id=2, team_id=2, league_id=None)])
    names = register_models(spark, raw_s, raw_p, RUN, prefix="t_sqlviews_")
    s, p = staging.stg_standings(raw_s), staging.stg_players(raw_p)
    dim = marts.dim_teams(s, p, RUN)
    for model, df in (("stg_standings", s), ("stg_players", p), ("dim_teams", dim),
                      ("fact_standings", marts.fact_standings(s, dim)),
                      ("fact_player_stats", marts.fact_player_stats(p, dim))):
        view = spark.table(names[model])
        assert view.columns == df.columns, model
        assert sorted(map(tuple, view.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr), model


def test_models_prune_the_payload_and_push_filters_into_the_scan(spark, tmp_path):
    from snapmart.sources.rawstore import append_table, read_table
    path = str(tmp_path / "raw_standings")
    raw = standings(spark, [dict(team_id=1), dict(team_id=2)]).withColumn(
        "raw_json", F.parse_json(F.lit('{"a": 1}')))
    append_table(raw, path, ["snapshot_date"])
    stg = staging.stg_standings(read_table(spark, path, RAW_STANDINGS))
    dim = marts.dim_teams(stg, staging.stg_players(players(spark, [{}])), RUN)
    for df in (stg, dim, marts.fact_standings(stg, dim)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
        assert scans and all("raw_json" not in s for s in scans), plan
        assert all("IsNotNull(team_id)" in s and "IsNotNull(league_id)" in s for s in scans), plan


def test_fact_join_leaves_the_broadcast_to_measured_sizes(spark):
    s = staging.stg_standings(standings(spark, [dict(team_id=1), dict(team_id=2)]))
    p = staging.stg_players(players(spark, [{}]))
    fact = marts.fact_standings(s, marts.dim_teams(s, p, RUN))
    assert "hint" not in fact._jdf.queryExecution().analyzed().toString().lower()
    assert fact.count() == 2


def test_labels_that_hold_an_id_twice_fail_the_job(spark):
    labels = spark.createDataFrame([(39, "A", "X"), (39, "B", "Y")], "league_id bigint, league_name string, country string")
    s = staging.stg_standings(standings(spark, [dict(team_id=1)]))
    with pytest.raises(Exception, match="twice"):
        marts.dim_teams(s, staging.stg_players(players(spark, [{}])), RUN, labels).collect()


def test_models_have_their_declared_columns_and_types(spark):
    from snapmart import schemas as S
    from snapmart.operators import checks as C

    stg_s, stg_p = staging.stg_standings(standings(spark, [{}])), staging.stg_players(players(spark, [{}]))
    report = C.check_report([("stg_players", stg_p, C.STG_PLAYERS_CHECKS)])
    for df, declared in ((stg_s, S.STG_STANDINGS), (stg_p, S.STG_PLAYERS),
                         (marts.dim_teams(stg_s, stg_p, RUN), S.DIM_TEAMS), (report, S.CHECK_REPORT)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]
