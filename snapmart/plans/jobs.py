"""The two jobs of the warehouse: load a feed into RAW, and build the marts from RAW.

``load_feed``: landed documents of one run -> feed selection (league, season, day) -> flatten ->
upsert into the partitioned RAW table. ``build``: gate -> staging -> marts (materialised, dim first)
-> column checks. Layers run in that order; a failed gate stops the build before any mart is written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.clean import ntz_lit
from snapmart.operators import checks as C
from snapmart.operators.upsert import (FIXTURES, PLAYERS, STANDINGS, UpsertSpec, load_gaps, load_record,
                                       upsert_table)
from snapmart.plans import marts, staging
from snapmart.schemas import LEAGUE_IDS, LEAGUE_LABELS, RAW_PLAYERS, RAW_STANDINGS, SEASON
from snapmart.sources import landing as L
from snapmart.sources.files import literal
from snapmart.sources.rawstore import drop_old_versions, publish_version, read_table

FEEDS: dict[str, tuple[UpsertSpec, object, int | None]] = {
    # feed: (table spec, flattener, days back from the run date; None = stamp the run date as snapshot)
    "fixtures": (FIXTURES, L.flatten_fixtures, 1),
    "standings": (STANDINGS, L.flatten_standings, None),
    "players": (PLAYERS, L.flatten_players, None),
}


KEEP_VERSIONS = 3


def selected(docs: DataFrame, leagues: Iterable[int] | DataFrame = LEAGUE_IDS,
             season: int | None = SEASON) -> DataFrame:
    """The documents of the loaded leagues and season, for the batch and the streaming path alike."""
    if not isinstance(leagues, DataFrame):
        leagues = list(leagues)
        docs = L.number_leagues(docs, leagues)
    d = L.select_leagues(docs, leagues)
    return d if season is None else L.select_season(d, season)


def feed_rows(docs: DataFrame, feed: str, run_date: dt.date | str,
              leagues: Iterable[int] | DataFrame = LEAGUE_IDS, season: int | None = SEASON) -> DataFrame:
    """The rows one run of ``feed`` loads: its leagues, season and day, flattened and stamped."""
    spec, flatten, days_back = FEEDS[feed]
    d = selected(docs, leagues, season)
    if days_back is None:
        rows = L.stamp_snapshot(flatten(L.select_day(d, run_date, 0)), run_date)
    else:
        rows = flatten(L.select_day(d, run_date, days_back))
    return rows


class DocumentsRejected(RuntimeError):
    """Documents that could not be loaded lie in the error table; the others are loaded."""


def load_feed(spark: SparkSession, landing_root: str, raw_root: str, feed: str, run_date: dt.date | str,
              load_ts: dt.datetime, leagues: Iterable[int] | DataFrame = LEAGUE_IDS,
              season: int | None = SEASON, whole_files: bool = False, errors_root: str | None = None) -> int:
    """Extract-and-load of one feed for one run; returns the number of RAW partitions rewritten.

    A document that the feed's rules refuse fails the load. With ``errors_root`` it is put, with its problems, into
    the error table of its feed and day, the other documents are loaded, and then the load fails
    (``DocumentsRejected``). A load that is run again replaces the errors of its day.
    """
    spec, _, days_back = FEEDS[feed]
    day = dt.date.fromisoformat(str(run_date)) - dt.timedelta(days=days_back or 0)
    docs = L.read_landed(spark, landing_root, feed, day=day, whole_files=whole_files)
    chosen = L.select_day(selected(docs, leagues, season), run_date, days_back or 0)
    days = chosen.agg(F.count("*").alias("documents")).where("documents > 0").select(F.lit(day).alias("day"), "documents")
    errors = None
    if errors_root:
        docs, rejected = L.split_documents(chosen, feed)
        errors = f"{errors_root}/{feed}/request_date={day}"
        rejected.select("body", "league_id", "season", "problems", ntz_lit(load_ts).alias("_loaded_at")) \
            .write.mode("overwrite").parquet(errors)
    rows = feed_rows(docs, feed, run_date, leagues, season)
    loaded = upsert_table(spark, f"{raw_root}/{spec.name}", rows, spec, load_ts, days=days)
    if errors and (n := spark.read.parquet(literal(errors)).count()):
        raise DocumentsRejected(f"{n} documents of {feed} lie in {errors}")
    return loaded


def load_report(spark: SparkSession, raw_root: str, feed: str, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """The days of a period that a feed's table never loaded, or loaded more than once."""
    return load_gaps(load_record(spark, f"{raw_root}/{FEEDS[feed][0].name}"), first, last)


def build(spark: SparkSession, raw_root: str, out_root: str, run_ts: dt.datetime,
          labels: Mapping[int, tuple[str, str]] | DataFrame = LEAGUE_LABELS,
          fail_on_check: bool = True, checks_first: bool = False, quarantine: bool = False) -> dict[str, DataFrame]:
    """Gate, staging, marts, checks. Returns the stored marts and the check report."""
    raw_s = read_table(spark, f"{raw_root}/{STANDINGS.name}", RAW_STANDINGS)
    C.require_rows(raw_s, "raw standings")
    raw_p = read_table(spark, f"{raw_root}/{PLAYERS.name}", RAW_PLAYERS)
    return build_from(raw_s, raw_p, out_root, run_ts, labels, fail_on_check, checks_first, quarantine)


def build_version(run_ts: dt.datetime) -> str:
    """Version name of a build: sorts in build-time order, unique per build."""
    return f"v{run_ts:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"


def build_from(raw_s: DataFrame, raw_p: DataFrame, out_root: str, run_ts: dt.datetime,
               labels: Mapping[int, tuple[str, str]] | DataFrame = LEAGUE_LABELS,
               fail_on_check: bool = True, checks_first: bool = False,
               quarantine: bool = False) -> dict[str, DataFrame]:
    """Each mart is published as a new version (readers use ``rawstore.read_latest``), so a build
    that fails part-way leaves every mart at its previous complete version. The facts read the
    stored dimension, not the plan that built it.

    The checks run after the marts are published and fail the build, as in the job this replaces (a
    failing check leaves the new marts visible). ``checks_first`` runs them on staging before anything is
    written; with ``fail_on_check`` off the report is only returned. ``quarantine`` stores the failing rows of
    each staging model with the names of their failed checks, as one more versioned table a model, before
    anything can fail. Old versions but the last ``KEEP_VERSIONS`` are dropped at the end.
    """
    v = build_version(run_ts)
    stg_s, stg_p = staging.stg_standings(raw_s), staging.stg_players(raw_p)
    staged = [("stg_players", stg_p, C.STG_PLAYERS_CHECKS), ("stg_standings", stg_s, C.STG_STANDINGS_CHECKS)]
    tables = ["dim_teams", "fact_standings", "fact_player_stats"]
    if quarantine:
        report = None
        for model, df, checks in staged:
            tables.append(f"quarantine_{model}")
            part, _ = C.quarantine(df, model, checks, lambda rows: publish_version(rows, f"{out_root}/{tables[-1]}", v))
            report = part if report is None else report.unionByName(part)
    else:
        report = C.check_report(staged)
    if checks_first:
        C.assert_passed(report)
    # the facts join the stored dimension: AQE measures it and broadcasts it only if it is small
    dim = publish_version(marts.dim_teams(stg_s, stg_p, run_ts, labels), f"{out_root}/dim_teams", v)
    fs = publish_version(marts.fact_standings(stg_s, dim), f"{out_root}/fact_standings", v, ["snapshot_date"])
    fp = publish_version(marts.fact_player_stats(stg_p, dim), f"{out_root}/fact_player_stats", v,
                         ["snapshot_date"])
    if fail_on_check and not checks_first:
        C.assert_passed(report)
    for mart in tables:
        drop_old_versions(dim.sparkSession, f"{out_root}/{mart}", KEEP_VERSIONS)
    return {"dim_teams": dim, "fact_standings": fs, "fact_player_stats": fp, "check_report": report}
