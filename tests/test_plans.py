"""The plan shapes the README claims, checked on executed (final adaptive) plans."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def final_plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def test_fact_join_is_broadcast_after_measuring_the_dimension(spark):
    plan = final_plan(spark, "fact_standings")
    assert re.search(r"BroadcastHashJoin \[team_id, league_id\]|BroadcastHashJoin \[team_id#\d+L, league_id#\d+L\]",
                     plan), plan
    assert "SortMergeJoin" not in plan


def test_upsert_shuffles_each_side_once_on_the_keys(spark):
    plan = final_plan(spark, "upsert_players")
    keyed = re.findall(r"Exchange hashpartitioning\(snapshot_date#\d+, player_id#\d+L, league_id#\d+L", plan)
    assert len(keyed) == 2, plan  # the target side, and the batch fold (reused by the join)
    assert plan.count("SortAggregate") == 2  # partial (map side) + final fold
    assert "FullOuter" in plan


def test_dimension_is_one_aggregate_over_the_union(spark):
    plan = final_plan(spark, "dim_teams")
    union_aggs = re.findall(r"HashAggregate\(keys=\[team_id#\d+L, team_name#\d+, league_id#\d+L\]", plan)
    assert len(union_aggs) == 2 and "Union" in plan  # partial + final of the single DISTINCT
