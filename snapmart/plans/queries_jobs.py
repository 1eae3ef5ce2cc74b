"""Registered queries: the orchestrated build (C6) and the streaming ingest (I1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapmart.operators import checks as C
from snapmart.operators import upsert as U
from snapmart.plans import analogs as A
from snapmart.plans import jobs
from snapmart.plans import sql_models as Q
from snapmart.plans.queries_models import DIM, LABELS, RP, RS, STG_P, STG_S
from snapmart.plans.suite import register
from snapmart.session import scratch_path
from snapmart.sources import landing as L
from snapmart.sources.rawstore import read_table
from snapmart.streaming.ingest import stream_upsert


_REPORT_SQL = Q.with_passed(Q.checks_sql("stg_players", "stg_p", C.STG_PLAYERS_CHECKS)
                            + "\n    UNION ALL " + Q.checks_sql("stg_standings", "stg_s", C.STG_STANDINGS_CHECKS))


def _count_sql(name):
    return f"(SELECT CAST(count(*) AS BIGINT) FROM {name}) AS {name}_rows"


@register("build_marts", Q.ctes(
    RS, RP, STG_S, STG_P, LABELS, DIM, ("fact_s", Q.fact_standings_sql("stg_s", "dim")),
    ("fact_p", Q.fact_player_stats_sql("stg_p", "dim")), ("rep", _REPORT_SQL),
    body=f"SELECT rep.*, {_count_sql('dim')}, {_count_sql('fact_s')}, {_count_sql('fact_p')} FROM rep"))
def q_build_marts(spark, root):
    """Gate -> staging -> dim (stored) -> facts (stored, read back) -> checks, in layer order: the check
    report beside the row counts of the three published marts."""
    t = A.Tables(spark, root)
    out = jobs.build_from(A.raw_standings(t), A.raw_players(t), scratch_path(spark, "marts"), A.RUN_TS,
                          labels=A.nation_labels(t), fail_on_check=False)
    counts = {"dim_rows": "dim_teams", "fact_s_rows": "fact_standings", "fact_p_rows": "fact_player_stats"}
    return out["check_report"].withColumns({c: F.lit(out[mart].count()).cast("bigint") for c, mart in counts.items()})


_PLY = [c for c in U.PLAYERS.columns if c != "raw_json"]
_PLY_UPD = [c for c in U.PLAYERS.update_cols if c != "raw_json"]
_FLAT = [c for c in _PLY if c != "_loaded_at"]


@register("stream_upsert", Q.ctes(
    ("rp", A.raw_players_sql()),
    ("u1", f"SELECT {', '.join(_FLAT)}, {A.sql_ts(A.T1)} AS _loaded_at FROM rp"),
    ("bat", f"SELECT {', '.join(_FLAT)}, player_id AS seq FROM rp"),
    body=Q.upsert_sql(_PLY, list(U.PLAYERS.keys), _PLY_UPD, "u1", "bat", A.T2)))
def q_stream_upsert(spark, root):
    """Land the players feed and ingest it incrementally; then land the same documents again.

    Run 1 consumes the first landing (all rows inserted at T1); run 2 sees only the new files
    (a replay of the same feed) and applies them at T2: matched keys are updated, NULL-key rows are
    inserted a second time. A third run finds nothing new and changes nothing.
    """
    t = A.Tables(spark, root)
    landing, table = scratch_path(spark, "landing"), scratch_path(spark, "raw_players")
    ckpt = scratch_path(spark, "ingest-checkpoint")
    docs = A.players_feed(t).drop("page").persist()  # landed twice; computed once
    L.land(docs, landing, "players")
    stream_upsert(spark, landing, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=A.T1)
    L.land(docs, landing, "players")
    stream_upsert(spark, landing, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=A.T2)
    if stream_upsert(spark, landing, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=A.T2):
        raise AssertionError("a run without new files applied a batch")
    docs.unpersist()
    return read_table(spark, table, U.PLAYERS.schema).drop("raw_json")


_DAY_ROWS = f"""SELECT snapshot_date AS day, count(*) AS documents FROM (
      SELECT DISTINCT snapshot_date, league_id, floor(player_id / {A.PAGE}.0) AS page FROM ({A.raw_players_sql()})
    ) GROUP BY 1"""


@register("load_days", f"""
    WITH d AS ({_DAY_ROWS}),
    r AS (SELECT day, documents, day(day) % 5 <> 0 AS once, day(day) % 7 = 0 AS again FROM d),
    loads AS (
      SELECT day, CAST(once AS BIGINT) + CAST(again AS BIGINT) AS loads,
             CAST(documents * (CAST(once AS BIGINT) + CAST(again AS BIGINT)) AS BIGINT) AS documents FROM r),
    period AS (
      SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
    SELECT day, coalesce(loads, 0) AS loads, coalesce(documents, 0) AS documents,
           CASE WHEN coalesce(loads, 0) = 0 THEN 'missing' ELSE 'repeated' END AS finding
    FROM period LEFT JOIN loads USING (day) WHERE coalesce(loads, 0) <> 1""")
def q_load_days(spark, root):
    """The players feed without every fifth day of a month, and then every seventh day (again): the days that a
    table never loaded or loaded twice, from the records of its commits."""
    t = A.Tables(spark, root)
    landing, table, ckpt = (scratch_path(spark, x) for x in ("landing", "raw_players", "ingest-checkpoint"))
    docs = A.players_feed(t).drop("page").persist()
    day = F.dayofmonth("request_date")
    for some in (day % 5 != 0, day % 7 == 0):
        L.land(docs.where(some), landing, "players")
        stream_upsert(spark, landing, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=A.T1)
    first, last = docs.agg(F.min("request_date"), F.max("request_date")).first()
    docs.unpersist()
    return U.load_gaps(U.load_record(spark, table), first, last)


@register("sql_views", Q.ctes(RS, RP, STG_S, STG_P, LABELS, DIM, body=Q.fact_player_stats_sql("stg_p", "dim")))
def q_sql_views(spark, root):
    """The models registered as Spark SQL views and read with a plain SELECT (the analyst path)."""
    import uuid

    from snapmart.plans.sql_views import register_models
    t = A.Tables(spark, root)
    names = register_models(spark, A.raw_standings(t), A.raw_players(t), A.RUN_TS, labels=A.nation_labels(t),
                            prefix=f"sm_{uuid.uuid4().hex[:8]}_")
    return spark.sql(f"SELECT * FROM {names['fact_player_stats']}")
