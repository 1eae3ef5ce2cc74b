"""Column checks, the gate, the layered build, and the incremental stream."""

import json

import pytest
from conftest import T0, d

from snapmart.operators import checks as C
from snapmart.operators import upsert as U
from snapmart.plans import jobs, staging
from snapmart.sources import landing as L
from snapmart.sources.rawstore import read_table
from snapmart.streaming.ingest import stream_upsert
from test_models import players, standings


def test_report_counts(spark):
    sp = staging.stg_players(players(spark, [dict(player_id=1, league_id=None), dict(player_id=2, league_id=7),
                                             dict(player_id=3, league_id=7), dict(player_id=4, league_id=8)]))
    ss = staging.stg_standings(standings(spark, [dict(team_id=1, points=None, rank=None)]))
    rep = {(r.model, r.column, r.check): (r.failures, r.passed) for r in C.check_report(
        [("stg_players", sp, C.STG_PLAYERS_CHECKS), ("stg_standings", ss, C.STG_STANDINGS_CHECKS)]).collect()}
    assert len(rep) == 13
    assert rep[("stg_players", "league_id", "not_null")] == (1, False)
    assert rep[("stg_players", "league_id", "accepted_values")] == (2, False)  # distinct values 7 and 8
    assert rep[("stg_players", "goals", "not_null")] == (0, True)
    assert rep[("stg_standings", "points", "not_null")] == (1, False)
    assert rep[("stg_standings", "league_id", "accepted_values")] == (0, True)


def test_checks_are_one_scan_per_model(spark):
    sp = staging.stg_players(players(spark, [{}]))
    plan = C.run_checks(sp, "stg_players", C.STG_PLAYERS_CHECKS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1, plan


def test_gate_and_failing_build(spark, tmp_dir):
    empty = standings(spark, []).limit(0)
    with pytest.raises(C.CheckFailed):
        C.require_rows(empty, "raw standings")
    with pytest.raises(C.CheckFailed):  # a failing check fails the build unless only the report is wanted
        jobs.build_from(standings(spark, [dict(league_id=7)]), players(spark, [{}]), f"{tmp_dir}/a", T0)
    out = jobs.build_from(standings(spark, [dict(league_id=7)]), players(spark, [{}]), tmp_dir, T0,
                          fail_on_check=False)
    assert out["fact_standings"].count() == 1
    with pytest.raises(C.CheckFailed):
        C.assert_passed(out["check_report"])
    from snapmart.sources.rawstore import complete_versions
    with pytest.raises(C.CheckFailed):
        jobs.build_from(standings(spark, [dict(league_id=7)]), players(spark, [{}]), f"{tmp_dir}/b", T0,
                        fail_on_check=True, checks_first=True)
    assert complete_versions(spark, f"{tmp_dir}/b/dim_teams") == []  # nothing published


def test_relationship_and_unique(spark):
    child = spark.createDataFrame([(1, 1, "a"), (2, 1, "a"), (None, 1, "b")], "team_id bigint, league_id bigint, k string")
    parent = spark.createDataFrame([(1, 1)], "team_id bigint, league_id bigint")
    assert C.relationship(child, parent, ["team_id", "league_id"], "m").first().failures == 1
    assert C.unique(child, "k", "m").first().failures == 1


def player_doc(pid, goals):
    return json.dumps({"response": [{"player": {"id": pid, "name": "P", "age": 20, "nationality": "X"},
                                     "statistics": [{"team": {"id": 1, "name": "A"},
                                                     "games": {"appearences": 1, "rating": None},
                                                     "goals": {"total": goals, "assists": 0},
                                                     "cards": {"yellow": 0, "red": 0}}]}]})


def test_stream_ingests_only_new_files(spark, tmp_dir):
    land, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/ckpt"
    docs = spark.createDataFrame([(player_doc(1, 1), d("2024-08-01"), 39, 2024)], L.DOC_SCHEMA)
    L.land(docs, land, "players")
    assert stream_upsert(spark, land, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=T0) == 1
    assert stream_upsert(spark, land, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=T0) == 0
    L.land(spark.createDataFrame([(player_doc(1, 5), d("2024-08-01"), 39, 2024)], L.DOC_SCHEMA), land, "players")
    assert stream_upsert(spark, land, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=T0) == 1
    rows = read_table(spark, table, U.PLAYERS.schema).collect()
    assert [(r.player_id, r.goals) for r in rows] == [(1, 5)]


def test_versioned_marts_keep_the_previous_version_until_commit(spark, tmp_dir):
    from snapmart.sources import rawstore as R
    df = spark.range(3).selectExpr("id", "id % 2 AS p")
    R.publish_version(df, f"{tmp_dir}/m", "v1", ["p"])
    R.publish_version(df.where("id > 0"), f"{tmp_dir}/m", "v2", ["p"])
    # a version without _SUCCESS (a build that died) is invisible
    import os
    os.makedirs(f"{tmp_dir}/m/_versions/v3")
    assert R.complete_versions(spark, f"{tmp_dir}/m") == ["v1", "v2"]
    assert R.read_latest(spark, f"{tmp_dir}/m", df.schema).count() == 2
    assert R.drop_old_versions(spark, f"{tmp_dir}/m", keep=1) == 1
    assert R.complete_versions(spark, f"{tmp_dir}/m") == ["v2"]


def test_stream_in_bounded_micro_batches_with_archiving(spark, tmp_dir):
    import os
    land, table, ckpt, arch = (f"{tmp_dir}/{x}" for x in ("landing", "raw", "ckpt", "archive"))
    for goals in (1, 2, 3):
        L.land(spark.createDataFrame([(player_doc(1, goals), d("2024-08-01"), 39, 2024)], L.DOC_SCHEMA), land,
               "players")
    n = stream_upsert(spark, land, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=T0,
                      max_files_per_trigger=1, archive_dir=arch)
    assert n == 3
    rows = read_table(spark, table, U.PLAYERS.schema).collect()
    assert [(r.player_id, r.goals) for r in rows] == [(1, 3)]  # landed last, applied last
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".txt")]
    assert len(archived) >= 2  # files of completed batches are moved out of the landing directory


def test_cluster_settings_are_known_runtime_settings(spark):
    from snapmart.session import CLUSTER_CONF
    for key in CLUSTER_CONF:
        assert spark.conf.isModifiable(key), key


def test_quarantine_holds_the_failing_rows_and_gives_the_same_report(spark, tmp_dir):
    sp = staging.stg_players(players(spark, [dict(player_id=1, league_id=None), dict(player_id=2, league_id=7),
                                             dict(player_id=3, league_id=7), dict(player_id=4, league_id=39)]))

    def store(rows):
        rows.write.parquet(f"{tmp_dir}/q")
        return spark.read.parquet(f"{tmp_dir}/q")

    report, rows = C.quarantine(sp, "stg_players", C.STG_PLAYERS_CHECKS, store)
    assert sorted(report.collect()) == sorted(C.run_checks(sp, "stg_players", C.STG_PLAYERS_CHECKS).collect())
    assert {(r.player_id, tuple(r.failed_checks)) for r in rows.collect()} == {
        (1, ("league_id:not_null",)), (2, ("league_id:accepted_values",)), (3, ("league_id:accepted_values",))}
    of = {(r.column, r.check): (r.failures, r.failing_rows) for r in report.collect()}
    assert of["league_id", "accepted_values"] == (1, 2) and of["league_id", "not_null"] == (1, 1)


def test_a_build_keeps_its_failing_rows_though_it_fails(spark, tmp_dir):
    from snapmart.sources.rawstore import complete_versions, read_latest
    with pytest.raises(C.CheckFailed):
        jobs.build_from(standings(spark, [dict(league_id=7)]), players(spark, [{}]), tmp_dir, T0, quarantine=True)
    assert len(complete_versions(spark, f"{tmp_dir}/quarantine_stg_standings")) == 1
    schema = C.failing_rows(staging.stg_standings(standings(spark, [{}])), C.STG_STANDINGS_CHECKS).schema
    assert [r.failed_checks for r in read_latest(spark, f"{tmp_dir}/quarantine_stg_standings", schema).collect()] \
        == [["league_id:accepted_values"]]


def test_fan_out_counts_without_joining_rows(spark):
    dim = spark.createDataFrame([(1, 39, "A"), (1, 39, "a fc"), (2, 39, "B"), (3, 39, "C"), (3, 39, "D"), (3, 39, "E"),
                                 (None, 39, "X"), (None, 39, "Y")], "team_id long, league_id long, team_name string")
    facts = spark.createDataFrame([(1, 39)] * 5 + [(2, 39)] * 7 + [(None, 39)] * 3, "team_id long, league_id long")
    out = C.fan_out(facts, dim, ["team_id", "league_id"], "m")
    assert {tuple(r) for r in out.collect()} == {("m", 1, 39, 2, 5, 10, "A", "a fc"), ("m", 3, 39, 3, 0, 0, "C", "E")}
    assert "BroadcastNestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_days_that_never_came_or_came_twice_are_told(spark, tmp_dir):
    land, table = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    for day in ("2024-08-01", "2024-08-02", "2024-08-04"):
        L.land(spark.createDataFrame([(player_doc(1, 1), d(day), 39, 2024)], L.DOC_SCHEMA), land, "players")
    run = [spark, land, "players", table, U.PLAYERS, L.flatten_players, f"{tmp_dir}/ckpt"]
    assert stream_upsert(*run, load_ts=T0, max_bytes_per_trigger=1) == 3  # a long history is several batches
    L.land(spark.createDataFrame([(player_doc(1, 2), d("2024-08-02"), 39, 2024),
                                  ('{"response": []}', d("2024-08-05"), 39, 2024)], L.DOC_SCHEMA), land, "players")
    assert stream_upsert(*run, load_ts=T0) == 1
    record = U.load_record(spark, table)
    assert {(r.day, r.loads, r.documents) for r in record.collect()} == {
        (d("2024-08-01"), 1, 1), (d("2024-08-02"), 2, 2), (d("2024-08-04"), 1, 1), (d("2024-08-05"), 1, 1)}
    gaps = U.load_gaps(record, "2024-08-01", "2024-08-06")
    assert {(r.day, r.loads, r.finding) for r in gaps.collect()} == {
        (d("2024-08-02"), 2, "repeated"), (d("2024-08-03"), 0, "missing"), (d("2024-08-06"), 0, "missing")}
    assert U.load_record(spark, f"{tmp_dir}/none").count() == 0


def test_the_backlog_is_bounded_unless_the_caller_says_otherwise(spark):
    from snapmart.streaming.ingest import MAX_BYTES
    assert isinstance(MAX_BYTES, int) and 0 < MAX_BYTES <= 1 << 40
