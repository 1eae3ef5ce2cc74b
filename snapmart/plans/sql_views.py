"""The models as Spark SQL views, for users who work in SQL (the reference's models are SQL).

``register_models`` registers RAW inputs and every staging and mart model as temp views, each
defined by the model's SQL text, so ``spark.sql("SELECT ... FROM fact_standings")`` reads them.
Catalyst plans these views exactly like the DataFrame models (same pruning, pushdown and joins).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from snapmart.plans import sql_models as Q

MODELS = ("raw_standings", "raw_players", "league_labels", "stg_standings", "stg_players", "dim_teams",
          "fact_standings", "fact_player_stats")


def register_models(spark: SparkSession, raw_standings: DataFrame, raw_players: DataFrame,
                    created_at: dt.datetime, labels: DataFrame | None = None, prefix: str = "") -> dict[str, str]:
    """Register the model chain as temp views named ``prefix + model``; returns model -> view name.

    ``labels`` is an optional (league_id, league_name, country) table; without it the dimension uses
    the fixed league CASE.
    """
    n = {m: f"{prefix}{m}" for m in MODELS}
    raw_standings.createOrReplaceTempView(n["raw_standings"])
    raw_players.createOrReplaceTempView(n["raw_players"])
    if labels is not None:
        labels.createOrReplaceTempView(n["league_labels"])
    views = [
        ("stg_standings", Q.stg_standings_sql(n["raw_standings"])),
        ("stg_players", Q.stg_players_sql(n["raw_players"])),
        ("dim_teams", Q.dim_teams_sql(n["stg_standings"], n["stg_players"], created_at,
                                      labels=n["league_labels"] if labels is not None else None, dialect="spark")),
        ("fact_standings", Q.fact_standings_sql(n["stg_standings"], n["dim_teams"])),
        ("fact_player_stats", Q.fact_player_stats_sql(n["stg_players"], n["dim_teams"])),
    ]
    for model, sql in views:
        spark.sql(sql).createOrReplaceTempView(n[model])
    return n
