"""Registered queries: the upsert operator (M1-M10) on analog targets and batches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators import upsert as U
from snapmart.plans import analogs as A
from snapmart.plans import sql_models as Q
from snapmart.plans.suite import register
from snapmart.session import scratch_path
from snapmart.sources import landing as L
from snapmart.sources.rawstore import append_table, read_table

# ---- column lists of the analog tables (the analogs carry no payload column) --------------------
FIX_COLS = ["fixture_id", "league_id", "date", "home_team_id", "home_team_name", "away_team_id",
            "away_team_name", "home_goals", "away_goals", "status"]
STD_COLS = [c for c in U.STANDINGS.columns if c != "raw_json"]
PLY_COLS = [c for c in U.PLAYERS.columns if c != "raw_json"]
STD_UPD = [c for c in U.STANDINGS.update_cols if c != "raw_json"]
PLY_UPD = [c for c in U.PLAYERS.update_cols if c != "raw_json"]
FIX_UPD = [c for c in U.FIXTURES.update_cols if c != "raw_json"]


def _sql(cols, spec, upd, tgt, bat, ts):
    return Q.upsert_sql(cols, list(spec.keys), upd, tgt, bat, ts)


# ---- M1 fixtures: landed JSON -> flatten -> upsert; raw_json is an update column -----------------

def _fixtures_upserted(spark, root):
    t = A.Tables(spark, root)
    target = L.stamp_loaded_at(L.flatten_fixtures(A.fixtures_feed_from(A.fixtures_target_rows(t))), A.T0)
    target = target.select(*U.FIXTURES.columns)
    batch = L.flatten_fixtures(A.fixtures_feed_from(A.fixtures_v2(t)))
    out = U.upsert_df(target, batch, U.FIXTURES, A.T1)
    return out.withColumn("raw_home", F.variant_get("raw_json", "$.goals.home", "bigint")).drop("raw_json")


_FIX_PAYLOAD_COLS = FIX_COLS + ["raw_home", "_loaded_at"]
_FIX_UPSERT_SQL = Q.ctes(
    ("tgt", f"SELECT {', '.join(FIX_COLS)}, home_goals AS raw_home, _loaded_at FROM ({A.fixtures_target_sql()})"),
    ("bat", f"SELECT {', '.join(FIX_COLS)}, home_goals AS raw_home, fixture_id AS seq FROM ({A.fixtures_v2_sql()})"),
    body=_sql(_FIX_PAYLOAD_COLS, U.FIXTURES, FIX_UPD + ["raw_home"], "tgt", "bat", A.T1))


@register("upsert_fixtures", _FIX_UPSERT_SQL)
def q_upsert_fixtures(spark, root):
    return _fixtures_upserted(spark, root)


_INSERT_ONLY = ["fixture_id", "league_id", "date", "home_team_id", "home_team_name", "away_team_id",
                "away_team_name"]


@register("upsert_insert_only", f"SELECT {', '.join(_INSERT_ONLY)} FROM ({_FIX_UPSERT_SQL})")
def q_upsert_insert_only(spark, root):
    """Rescheduled and renamed fixtures keep their first date and names."""
    return _fixtures_upserted(spark, root).select(*_INSERT_ONLY)


# ---- M2 standings: about seven batch rows per key ------------------------------------------------

@register("upsert_standings", Q.ctes(("tgt", A.standings_target_sql()), ("bat", A.standings_batch_sql()),
                                     body=_sql(STD_COLS, U.STANDINGS, STD_UPD, "tgt", "bat", A.T1)))
def q_upsert_standings(spark, root):
    t = A.Tables(spark, root)
    return U.upsert_df(A.standings_target(t), A.standings_batch(t), U.STANDINGS, A.T1)


# ---- M3 players, and the facets M5, M7, M8, M9, M10 ------------------------------------------------

_PLY_ONCE = _sql(PLY_COLS, U.PLAYERS, PLY_UPD, "tgt", "bat", A.T1)
_PLY_CTES = (("tgt", A.players_target_sql()), ("bat", A.players_batch_sql()))


def _players_once(spark, root):
    t = A.Tables(spark, root)
    return U.upsert_df(A.players_target(t), A.players_batch(t), U.PLAYERS, A.T1)


@register("upsert_players", Q.ctes(*_PLY_CTES, body=_PLY_ONCE))
def q_upsert_players(spark, root):
    return _players_once(spark, root)


_KEYS = ["snapshot_date", "player_id", "league_id"]


@register("upsert_load_stamp", Q.ctes(*_PLY_CTES, body=f"SELECT {', '.join(_KEYS)}, _loaded_at FROM ({_PLY_ONCE})"))
def q_upsert_load_stamp(spark, root):
    """Touched rows carry the batch's load time, untouched rows keep theirs."""
    return _players_once(spark, root).select(*_KEYS, "_loaded_at")


@register("upsert_null_overwrite", Q.ctes(
    ("tgt", A.raw_players_sql()), ("bat", A.players_null_batch_sql()),
    body=f"SELECT {', '.join(_KEYS)}, goals, rating, assists, _loaded_at FROM "
         f"({_sql(PLY_COLS, U.PLAYERS, PLY_UPD, 'tgt', 'bat', A.T1)})"))
def q_upsert_null_overwrite(spark, root):
    """A NULL in a matched batch row replaces the stored value (no COALESCE)."""
    t = A.Tables(spark, root)
    out = U.upsert_df(A.raw_players(t), A.players_null_batch(t), U.PLAYERS, A.T1)
    return out.select(*_KEYS, "goals", "rating", "assists", "_loaded_at")


_PLY_TWICE = Q.ctes(*_PLY_CTES, ("u1", _PLY_ONCE),
                    body=_sql(PLY_COLS, U.PLAYERS, PLY_UPD, "u1", "bat", A.T2))


def _null_key_summary_sql(src: str) -> str:
    return f"""
    SELECT (snapshot_date IS NULL OR player_id IS NULL OR league_id IS NULL) AS null_key,
           _loaded_at, CAST(count(*) AS BIGINT) AS n_rows
    FROM ({src}) GROUP BY 1, 2"""


@register("upsert_null_key", _null_key_summary_sql(_PLY_TWICE))
def q_upsert_null_key(spark, root):
    """Rows with a NULL key part never match: the same batch applied twice inserts them twice."""
    t = A.Tables(spark, root)
    b = A.players_batch(t)
    twice = U.upsert_df(U.upsert_df(A.players_target(t), b, U.PLAYERS, A.T1), b, U.PLAYERS, A.T2)
    nk = F.col("snapshot_date").isNull() | F.col("player_id").isNull() | F.col("league_id").isNull()
    return twice.groupBy(nk.alias("null_key"), "_loaded_at").agg(F.count(F.lit(1)).alias("n_rows"))


@register("upsert_empty", f"SELECT {', '.join(PLY_COLS)} FROM ({A.raw_players_sql()})")
def q_upsert_empty(spark, root):
    """Table form: an empty batch leaves the whole stored table exactly as it was."""
    t = A.Tables(spark, root)
    path = scratch_path(spark, "raw_players")
    spec = U.UpsertSpec("raw_players_analog", _analog_schema(U.PLAYERS, PLY_COLS), U.PLAYERS.keys,
                        tuple(PLY_UPD), partition_by="snapshot_date")
    append_table(A.raw_players(t).select(*PLY_COLS), path, ["snapshot_date"])
    if U.upsert_table(spark, path, A.players_batch(t).where(F.lit(False)), spec, A.T1):
        raise AssertionError("an empty batch rewrote partitions")
    return read_table(spark, path, spec.schema)


@register("upsert_rerun", _PLY_TWICE)
def q_upsert_rerun(spark, root):
    """Table form: write the target, apply the same batch twice with partition rewrites, read back."""
    t = A.Tables(spark, root)
    path = scratch_path(spark, "raw_players")
    spec = U.UpsertSpec("raw_players_analog", _analog_schema(U.PLAYERS, PLY_COLS), U.PLAYERS.keys,
                        tuple(PLY_UPD), partition_by="snapshot_date")
    append_table(A.players_target(t), path, ["snapshot_date"])
    b = A.players_batch(t)
    U.upsert_table(spark, path, b, spec, A.T1)
    U.upsert_table(spark, path, b, spec, A.T2)
    return read_table(spark, path, spec.schema)


def _analog_schema(spec, cols):
    return T.StructType([f for f in spec.schema.fields if f.name in cols])


# ---- M6 in-batch duplicates: one fixture per line item --------------------------------------------

_FIX_T0 = FIX_COLS + ["_loaded_at"]


@register("upsert_batch_dups", Q.ctes(
    ("tgt", A.dups_target_sql()), ("bat", A.fixture_lines_batch_sql()),
    body=_sql(_FIX_T0, U.FIXTURES, FIX_UPD, "tgt", "bat", A.T1)))
def q_upsert_batch_dups(spark, root):
    """New keys take insert-only columns from their first line and update columns from the last."""
    t = A.Tables(spark, root)
    return U.upsert_df(A.dups_target(t), A.fixture_lines_batch(t), U.FIXTURES, A.T1, scattered=True)


@register("upsert_fixtures_table", _FIX_UPSERT_SQL)
def q_upsert_fixtures_table(spark, root):
    """Table form of M1: the fixtures table is partitioned by its insert-only ``date``.

    The batch re-reports fixtures one day later; their stored rows are found by key in the partition
    of their first date, so only those days and the batch's own days are rewritten.
    """
    t = A.Tables(spark, root)
    path = scratch_path(spark, "raw_fixtures")
    first = L.flatten_fixtures(A.fixtures_feed_from(A.fixtures_target_rows(t)))
    U.upsert_table(spark, path, first, U.FIXTURES, A.T0)
    U.upsert_table(spark, path, L.flatten_fixtures(A.fixtures_feed_from(A.fixtures_v2(t))), U.FIXTURES, A.T1)
    out = read_table(spark, path, U.FIXTURES.schema)
    return out.withColumn("raw_home", F.variant_get("raw_json", "$.goals.home", "bigint")).drop("raw_json")
