"""The whole flow on sports-shaped feeds: land -> load each run -> build -> checks."""

import datetime as dt
import json

from conftest import d

from snapmart.plans import jobs
from snapmart.schemas import RAW_FIXTURES, RAW_PLAYERS
from snapmart.sources import landing as L
from snapmart.sources.rawstore import read_latest, read_table


def fixture(fid, home, away, hg, ag, status):
    return {"fixture": {"id": fid, "status": {"short": status}},
            "teams": {"home": {"id": home, "name": f"Team {home}"}, "away": {"id": away, "name": f"Team {away}"}},
            "goals": {"home": hg, "away": ag}}


def team(tid, rank, played, win, draw, lose, name=None):
    return {"rank": rank, "team": {"id": tid, "name": name or f" team {tid} "},
            "all": {"played": played, "win": win, "draw": draw, "lose": lose,
                    "goals": {"for": win * 2, "against": lose}},
            "goalsDiff": win * 2 - lose, "points": 3 * win + draw, "form": "wdl"}


def player(pid, tid, goals, apps):
    return {"player": {"id": pid, "name": f" player {pid}", "age": 25, "nationality": "england"},
            "statistics": [{"team": {"id": tid, "name": f"team {tid}"},
                            "games": {"appearences": apps, "rating": "7.1"},
                            "goals": {"total": goals, "assists": None}, "cards": {"yellow": 1, "red": 0}}]}


def doc(day, league, body):
    return (json.dumps(body), d(day), league, 2024)


def test_land_load_build(spark, tmp_dir):
    land, raw, marts = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/marts"
    feeds = {
        "fixtures": [
            doc("2024-08-16", 39, {"response": [fixture(1, 33, 34, 1, 0, "FT"), fixture(2, 35, 36, None, None, "NS")]}),
            doc("2024-08-16", 140, {"response": []}),
            # the day after: fixture 2 is played; fixture 1 re-reported with a corrected score
            doc("2024-08-17", 39, {"response": [fixture(2, 35, 36, 2, 2, "FT"), fixture(1, 33, 34, 2, 0, "FT")]}),
        ],
        "standings": [
            doc(day, lg, {"response": [{"league": {"id": lg, "standings": [[team(33 + k, 1 + k, n, n - k, k, 0)
                                                                            for k in range(2)]]}}]})
            for day, n in (("2024-08-17", 1), ("2024-08-18", 2)) for lg in (39, 140)
        ],
        "players": [
            doc(day, 39, {"response": [player(900, 33, n, n), player(901, 34, 0, 0)]})
            for day, n in (("2024-08-17", 1), ("2024-08-18", 2))
        ],
    }
    for feed, rows in feeds.items():
        L.land(spark.createDataFrame(rows, L.DOC_SCHEMA), land, feed)

    loads = [("fixtures", "2024-08-17"), ("fixtures", "2024-08-18"),
             ("standings", "2024-08-17"), ("standings", "2024-08-18"),
             ("players", "2024-08-17"), ("players", "2024-08-18")]
    for i, (feed, run) in enumerate(loads):
        jobs.load_feed(spark, land, raw, feed, run, dt.datetime(2024, 8, 17, 6, i))

    fx = {r.fixture_id: r for r in read_table(spark, f"{raw}/raw_fixtures", RAW_FIXTURES).collect()}
    assert (fx[1].home_goals, fx[1].date) == (2, d("2024-08-16"))        # updated, keeps its first date
    assert (fx[2].home_goals, fx[2].status, fx[2].date) == (2, "FT", d("2024-08-16"))
    assert read_table(spark, f"{raw}/raw_players", RAW_PLAYERS).count() == 4   # 2 players x 2 snapshots

    out = jobs.build(spark, raw, marts, dt.datetime(2024, 8, 18, 8, 0), fail_on_check=True)
    report = {(r.model, r.column, r.check): r.passed for r in out["check_report"].collect()}
    assert len(report) == 13 and all(report.values())
    fs = read_latest(spark, f"{marts}/fact_standings", out["fact_standings"].schema)
    assert fs.count() == 8
    assert {r.league_name for r in fs.collect()} == {"Premier League", "La Liga"}
    fp = {(r.player_id, r.snapshot_date): r for r in out["fact_player_stats"].collect()}
    assert fp[(901, d("2024-08-17"))].goals_per_game is None
    assert fp[(900, d("2024-08-18"))].goals_per_game == 1.0
    assert fp[(900, d("2024-08-18"))].team_name == "TEAM 33"


def test_run_without_landed_documents_loads_nothing(spark, tmp_dir):
    from snapmart.sources.rawstore import path_exists
    L.land(spark.createDataFrame([doc("2024-08-16", 39, {"response": []})], L.DOC_SCHEMA), f"{tmp_dir}/l", "fixtures")
    assert jobs.load_feed(spark, f"{tmp_dir}/l", f"{tmp_dir}/raw", "fixtures", "2024-09-01",
                          dt.datetime(2024, 9, 1, 6, 0)) == 0
    assert not path_exists(spark, f"{tmp_dir}/raw/raw_fixtures")


def test_command_line_load_and_build(spark, tmp_dir, capsys):
    from snapmart.__main__ import main
    team_doc = {"response": [{"league": {"id": 39, "standings": [[team(33, 1, 1, 1, 0, 0)]]}}]}
    player_doc = {"response": [player(900, 33, 1, 1)]}
    L.land(spark.createDataFrame([doc("2024-08-17", 39, team_doc)], L.DOC_SCHEMA), f"{tmp_dir}/l", "standings")
    L.land(spark.createDataFrame([doc("2024-08-17", 39, player_doc)], L.DOC_SCHEMA), f"{tmp_dir}/l", "players")
    for feed in ("standings", "players"):
        assert main(["load", "--landing", f"{tmp_dir}/l", "--raw", f"{tmp_dir}/raw", "--feed", feed,
                     "--run-date", "2024-08-17"], spark=spark) == 0
    assert main(["build", "--raw", f"{tmp_dir}/raw", "--marts", f"{tmp_dir}/m", "--fail-on-check"], spark=spark) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert json.loads(out[-1])["checks"] and json.loads(out[0])["partitions_rewritten"] == 1
    assert main(["stream", "--landing", f"{tmp_dir}/l", "--raw", f"{tmp_dir}/raw2", "--feed", "players",
                 "--checkpoint", f"{tmp_dir}/ck"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["batches_applied"] == 1


def test_a_page_landed_again_later_wins(spark, tmp_dir):
    import time
    page = {"paging": {"current": 1}}
    first = {**page, "response": [fixture(1, 33, 34, 1, 0, "FT")]}
    corrected = {**page, "response": [fixture(1, 33, 34, 3, 0, "FT")]}
    L.land(spark.createDataFrame([doc("2024-08-16", 39, first)], L.DOC_SCHEMA), f"{tmp_dir}/l", "fixtures")
    time.sleep(1.1)  # landings are minutes apart in practice; keep the file times distinct here
    L.land(spark.createDataFrame([doc("2024-08-16", 39, corrected)], L.DOC_SCHEMA), f"{tmp_dir}/l", "fixtures")
    jobs.load_feed(spark, f"{tmp_dir}/l", f"{tmp_dir}/raw", "fixtures", "2024-08-17", dt.datetime(2024, 8, 17, 6))
    rows = read_table(spark, f"{tmp_dir}/raw/raw_fixtures", RAW_FIXTURES).collect()
    assert [(r.fixture_id, r.home_goals) for r in rows] == [(1, 3)]
