"""Landing: flatten edge cases and strictness (FIXTURES.md section 4)."""

import json

import pytest
from conftest import d
from pyspark.sql import functions as F

from snapmart.plans import jobs
from snapmart.sources import landing as L


def docs(spark, bodies, day="2024-08-02", league=39, season=2024):
    rows = [(b if isinstance(b, str) else json.dumps(b), d(day), league, season) for b in bodies]
    return spark.createDataFrame(rows, L.DOC_SCHEMA)


def fixture(fid, home=1, away=None):
    return {"fixture": {"id": fid, "status": {"short": "FT"}},
            "teams": {"home": {"id": 1, "name": "A"}, "away": {"id": 2, "name": "B"}},
            "goals": {"home": home, "away": away}}


def player(pid, stats=None):
    return {"player": {"id": pid, "name": "P", "age": 20, "nationality": "X"},
            "statistics": [{"team": {"id": 1, "name": "A"}, "games": {"appearences": 3, "rating": "7.25"},
                            "goals": {"total": 2, "assists": None}, "cards": {"yellow": 0, "red": 0}},
                           {"team": {"id": 99, "name": "Z"}, "games": {"appearences": 9, "rating": None},
                            "goals": {"total": 9, "assists": 9}, "cards": {"yellow": 9, "red": 9}}]
            if stats is None else stats}


def team(tid, rank=1):
    return {"rank": rank, "team": {"id": tid, "name": "T"}, "points": 3, "goalsDiff": 1, "form": "W",
            "all": {"played": 1, "win": 1, "draw": 0, "lose": 0, "goals": {"for": 2, "against": 1}}}


def test_fixtures_json_null_kept_and_empty_or_missing_response_gives_nothing(spark):
    out = L.flatten_fixtures(docs(spark, [{"response": [fixture(1, None, None), fixture(2, 3, 0)]},
                                          {"response": []}, {"errors": []}])).orderBy("fixture_id").collect()
    assert [(r.fixture_id, r.home_goals, r.away_goals, r.league_id, r.date) for r in out] == [
        (1, None, None, 39, d("2024-08-02")), (2, 3, 0, 39, d("2024-08-02"))]


def test_missing_required_field_fails(spark):
    bad = fixture(1)
    del bad["goals"]["away"]
    with pytest.raises(Exception, match="required field missing"):
        L.flatten_fixtures(docs(spark, [{"response": [bad]}])).collect()


def test_malformed_json_fails(spark):
    with pytest.raises(Exception):
        L.flatten_fixtures(docs(spark, ['{"response": ['])).collect()


def test_players_first_statistics_block_and_numeric_text_rating(spark):
    out = L.flatten_players(docs(spark, [{"response": [player(7)]}])).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.team_id, r.appearances, r.goals, r.assists, r.rating) == (1, 3, 2, None, 7.25)
    assert r.raw_json is not None


def test_players_empty_statistics_fails(spark):
    with pytest.raises(Exception, match="required field missing"):
        L.flatten_players(docs(spark, [{"response": [player(7, stats=[])]}])).collect()


def test_text_in_integer_field_fails(spark):
    p = player(7)
    p["statistics"][0]["goals"]["total"] = "two"
    with pytest.raises(Exception):
        L.flatten_players(docs(spark, [{"response": [p]}])).collect()


def test_standings_first_group_only_and_missing_path_skips_league(spark):
    good = {"response": [{"league": {"standings": [[team(1), team(2, 2)], [team(1, 9)]]}}]}
    out = L.flatten_standings(docs(spark, [good, {"response": []}, {"response": [{"league": {}}]},
                                           {"response": [{"league": {"standings": []}}]}]))
    assert sorted((r.team_id, r.rank) for r in out.collect()) == [(1, 1), (2, 2)]


def test_standings_null_on_path_fails(spark):
    with pytest.raises(Exception, match="null on the standings path"):
        L.flatten_standings(docs(spark, [{"response": [{"league": {"standings": None}}]}])).collect()


def test_batch_order_is_day_league_page_position(spark):
    rows = L.flatten_fixtures(docs(spark, [{"response": [fixture(5), fixture(4)], "paging": {"current": 2}}]))
    seqs = rows.select("fixture_id", F.col("_seq._page").alias("pg"), F.col("_seq._pos").alias("pos")).collect()
    assert sorted((r.fixture_id, r.pg, r.pos) for r in seqs) == [(4, 2, 1), (5, 2, 0)]


def test_leagues_are_applied_in_the_order_of_the_list(spark):
    two = docs(spark, [{"response": [fixture(1, 1)]}], day="2024-08-01", league=39).unionByName(
        docs(spark, [{"response": [fixture(1, 2)]}], day="2024-08-01", league=140))
    for leagues, last in (([39, 140], 2), ([140, 39], 1), (iter([140, 39]), 1)):
        rows = jobs.feed_rows(two, "fixtures", "2024-08-02", leagues)
        assert rows.orderBy(F.desc("_seq")).first().home_goals == last


def test_feed_rows_selects_league_season_and_day(spark):
    df = docs(spark, [{"response": [fixture(1)]}], day="2024-08-01").unionByName(
        docs(spark, [{"response": [fixture(2)]}], day="2024-08-02")).unionByName(
        docs(spark, [{"response": [fixture(3)]}], day="2024-08-01", league=7))
    out = jobs.feed_rows(df, "fixtures", "2024-08-02")
    assert [r.fixture_id for r in out.collect()] == [1]
    sd = docs(spark, [{"response": [{"league": {"standings": [[team(1)]]}}]}], day="2024-08-02")
    st = jobs.feed_rows(sd, "standings", "2024-08-02").collect()
    assert [(r.team_id, r.snapshot_date) for r in st] == [(1, d("2024-08-02"))]


def test_landed_feed_partitions_are_pruned(spark, tmp_dir):
    L.land(docs(spark, [{"response": [fixture(1)]}], day="2024-08-01"), tmp_dir, "fixtures")
    L.land(docs(spark, [{"response": [fixture(2)]}], day="2024-08-02", league=140), tmp_dir, "fixtures")
    sel = L.select_day(L.select_leagues(L.read_landed(spark, tmp_dir, "fixtures"), [39]), "2024-08-02")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "request_date" in plan
    assert [r.fixture_id for r in L.flatten_fixtures(sel).collect()] == [1]


def test_strictness_does_not_depend_on_ansi_mode(spark):
    p = player(7)
    p["statistics"][0]["goals"]["total"] = "two"
    bad = fixture(1)
    del bad["goals"]["home"]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            L.flatten_players(docs(spark, [{"response": [p]}])).collect()
        with pytest.raises(Exception, match="required field missing"):
            L.flatten_fixtures(docs(spark, [{"response": [bad]}])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_response_shape_errors_fail_as_the_loader_would(spark):
    with pytest.raises(Exception, match="feed response is null"):
        L.flatten_fixtures(docs(spark, [{"response": None}])).collect()
    with pytest.raises(Exception):
        L.flatten_fixtures(docs(spark, [{"response": {"a": 1}}])).collect()
    for body in ({"response": [1]}, {"response": [{"league": [1]}]}, {"response": [{"league": {"standings": 5}}]}):
        with pytest.raises(Exception, match="on the standings path"):
            L.flatten_standings(docs(spark, [body])).collect()
    # an object where the standings array should be is a missing index: the document is skipped
    assert L.flatten_standings(docs(spark, [{"response": [{"league": {"standings": {"a": 1}}}]}])).count() == 0
    # non-strict mode never raises on shape
    assert L.flatten_standings(docs(spark, [{"response": [1]}]), strict=False).count() == 0


# ---- documents that do not load -----------------------------------------------------------------------

def _bodies():
    import json
    p = {"player": {"id": 1, "name": "P", "age": 20, "nationality": "X"},
         "statistics": [{"team": {"id": 1, "name": "A"}, "games": {"appearences": 1, "rating": None},
                         "goals": {"total": 1, "assists": 0}, "cards": {"yellow": 0, "red": 0}}]}
    no_block = {**p, "statistics": []}
    no_team = {**p, "statistics": [{**p["statistics"][0], "team": {"id": 1}}]}
    text = {**p, "player": {**p["player"], "age": "old"}}
    return {
        "fine": json.dumps({"response": [p, p]}), "empty": '{"response": []}', "absent": '{"errors": 1}',
        "broken": json.dumps({"response": [p]})[:-1], "null": '{"response": null}', "object": '{"response": {"a": 1}}',
        "second": json.dumps({"response": [p, no_team]}), "no block": json.dumps({"response": [no_block]}),
        "type": json.dumps({"response": [text, p, no_team]}), "list": "[1]", "nothing": ""}


def test_problems_are_those_the_strict_flattener_fails_on(spark):
    bodies = _bodies()
    docs = spark.createDataFrame([(b, d("2024-08-01"), 39, 2024, n) for n, b in bodies.items()],
                                 "body string, request_date date, league_id long, season long, name string")
    found = {r["name"]: r["problems"] for r in L.with_problems(docs, "players").collect()}
    assert found["fine"] == found["empty"] == found["absent"] == []
    assert found["broken"] == ["malformed JSON"] and found["null"] == ["null: $.response"]
    assert found["object"] == ["not an array: $.response"]
    assert found["second"] == ["[1] missing: $.statistics[0].team.name"]
    assert found["type"] == ["[0] not a bigint: $.player.age", "[2] missing: $.statistics[0].team.name"]
    assert len(found["no block"]) == 8 and found["nothing"] == ["malformed JSON"] and found["list"] == ["not an object: $"]
    for name in ("fine", "empty", "absent", "broken", "null", "object", "second", "no block", "type"):
        one = spark.createDataFrame([(bodies[name], d("2024-08-01"), 39, 2024)], L.DOC_SCHEMA)
        rows = L.flatten_players(one)
        if found[name]:
            with pytest.raises(Exception):
                rows.collect()
        else:
            assert rows.count() == (2 if name == "fine" else 0)
    accepted, rejected = L.split_documents(docs, "players")
    assert L.flatten_players(accepted).count() == 2 and rejected.count() == len(bodies) - 3


def test_standings_problems_follow_the_path(spark):
    import json
    team = {"rank": 1, "team": {"id": 1, "name": "A"}, "points": 3, "goalsDiff": 1, "form": None,
            "all": {"played": 1, "win": 1, "draw": 0, "lose": 0, "goals": {"for": 1, "against": 0}}}
    bodies = [({"response": [{"league": {"standings": [[team]]}}]}, []),
              ({"response": [{"league": {"standings": []}}]}, []), ({"response": [{}]}, []),
              ({"response": [{"league": None}]}, ["null: response[0] $.league"]),
              ({"response": [{"league": {"standings": "x"}}]}, ["not an array: response[0] $.league.standings"]),
              ({"response": [{"league": {"standings": [None]}}]}, ["null: response[0] $.league.standings[0]"]),
              ({"response": [{"league": {"standings": [[{**team, "points": "many"}]]}}]}, ["[0] not a bigint: $.points"])]
    for body, want in bodies:
        docs = spark.createDataFrame([(json.dumps(body), d("2024-08-01"), 39, 2024)], L.DOC_SCHEMA)
        assert L.with_problems(docs, "standings").first().problems == want
        if want:
            with pytest.raises(Exception):
                L.flatten_standings(docs).collect()
        else:
            L.flatten_standings(docs).collect()


def test_a_load_puts_refused_documents_aside_loads_the_rest_and_fails(spark, tmp_dir):
    import datetime as dt

    from snapmart.plans import jobs
    from snapmart.schemas import RAW_PLAYERS
    from snapmart.sources.rawstore import read_table
    bodies = _bodies()
    docs = [(bodies[n], d("2024-08-01"), 39, 2024) for n in ("fine", "second", "null")]
    L.land(spark.createDataFrame(docs, L.DOC_SCHEMA), f"{tmp_dir}/l", "players")
    args = [spark, f"{tmp_dir}/l", f"{tmp_dir}/raw", "players", "2024-08-01", dt.datetime(2024, 8, 1, 6)]
    for _ in range(2):
        with pytest.raises(jobs.DocumentsRejected, match="2 documents"):
            jobs.load_feed(*args, errors_root=f"{tmp_dir}/errors")
        assert read_table(spark, f"{tmp_dir}/raw/raw_players", RAW_PLAYERS).count() == 1
    stored = spark.read.parquet(f"{tmp_dir}/errors/players")
    assert sorted(r.problems[0] for r in stored.collect()) == ["[1] missing: $.statistics[0].team.name", "null: $.response"]
    gaps = jobs.load_report(spark, f"{tmp_dir}/raw", "players", "2024-07-31", "2024-08-01")
    assert {(str(r.day), r.finding) for r in gaps.collect()} == {("2024-07-31", "missing"), ("2024-08-01", "repeated")}
