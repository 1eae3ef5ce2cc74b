"""Landed API responses -> typed RAW rows.

A landed feed is a DataFrame of documents, one JSON response per row:

    body string, request_date date, league_id bigint, season bigint [, page bigint]

A paginated response carries its page in ``paging.current``; rows are ordered by
(request_date, league_id, page, landing file, position), the order a row-by-row loader applies them.

The context columns are the request parameters (they are not in the payload). On storage the feed
is text files under ``<root>/<feed>/request_date=.../league_id=.../season=...``, so the feed
selections below are partition filters and prune whole directories.

Parsing keeps every element as a VARIANT (parsed once, kept as ``raw_json``) and pulls typed fields
with ``variant_get``. Strict mode (the default) follows the loader it replaces:

* a missing ``response`` or an empty one yields no rows (standings: the league is skipped);
* inside an element, a missing required field fails the load, while a JSON ``null`` is a NULL value;
* malformed JSON fails the load (FAILFAST);
* text in an integer field fails (``variant_get`` casts strictly); numeric text in ``rating`` is read.

Everything is native Catalyst expressions; no Python runs per row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.clean import ntz_lit
from snapmart.sources.rawstore import literal, path_exists

DOC_SCHEMA = T.StructType([
    T.StructField("body", T.StringType()),
    T.StructField("request_date", T.DateType()),
    T.StructField("league_id", T.LongType()),
    T.StructField("season", T.LongType()),
])

RESPONSE_SCHEMA = "response array<variant>, paging struct<current: bigint>"
FAILFAST = {"mode": "FAILFAST"}
LANDING_DIR = "/landing=([^/]*)/"


# ------------------------------------------------------------------------------------------------
# reading and selecting landed documents
# ------------------------------------------------------------------------------------------------

def landed_text_schema() -> T.StructType:
    """Text-source schema of a landed feed: the document line plus the partition (context) columns."""
    return T.StructType([T.StructField("value", T.StringType())] + DOC_SCHEMA.fields[1:])


def read_landed(spark: SparkSession, root: str, feed: str, day: dt.date | str | None = None,
                whole_files: bool = False) -> DataFrame:
    """Landed documents of one feed; context columns come from the partition directories.

    With ``day`` only that day's directory is listed (a daily run never lists the whole landing
    history); a day with nothing landed gives an empty DataFrame. A document is a line, or with
    ``whole_files`` a file, whose body may then span several lines.
    """
    reader = spark.read.format("text").schema(landed_text_schema()).option("basePath", f"{root}/{feed}").option(
        "wholetext", whole_files)
    if day is None:
        return number_lines(with_landing_order(reader.load(literal(f"{root}/{feed}"))))
    path = f"{root}/{feed}/request_date={day}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], DOC_SCHEMA)
    return number_lines(with_landing_order(reader.load(literal(path))))


def with_landing_order(text: DataFrame) -> DataFrame:
    """Landed text rows as documents, with ``_file`` = (file modification time, path, block): when the
    same page of the same day and league is landed twice, the later landing is applied later. With
    ``number_lines`` the lines of one file are applied in their order. Where landings have ids
    (``land``), ``_landing`` holds them: all pages of a later landing are applied after all earlier ones."""
    return text.select(F.col("value").alias("body"), "request_date", "league_id", "season",
                       F.regexp_extract(F.col("_metadata.file_path"), LANDING_DIR, 1).alias("_landing"),
                       F.struct(F.col("_metadata.file_modification_time").alias("mtime"),
                                F.col("_metadata.file_path").alias("path"),
                                F.col("_metadata.file_block_start").alias("block")).alias("_file"))


def number_lines(docs: DataFrame) -> DataFrame:
    """Adds each document's line, in order within its file, to ``_file`` (before anything is shuffled)."""
    return docs.withColumn("_file", F.col("_file").withField("line", F.monotonically_increasing_id()))


def land(docs: DataFrame, root: str, feed: str, landing: str | None = None) -> None:
    """Write documents as text files partitioned by their request context (append).

    ``landing`` names this landing; ids are ordered as text. A feed's landings all have one, or none."""
    parts = ["request_date", "league_id", "season"]
    if landing is not None:
        docs, parts = docs.withColumn("landing", F.lit(landing)), [*parts, "landing"]
    (docs.select(F.col("body").alias("value"), *parts).hint("rebalance", *parts)
         .write.mode("append").partitionBy(*parts).text(f"{root}/{feed}"))


def select_leagues(docs: DataFrame, leagues: Iterable[int] | DataFrame) -> DataFrame:
    """Keep documents of the given leagues: a literal list (IN) or a league table (semi-join)."""
    if isinstance(leagues, DataFrame):
        return docs.join(leagues.select(F.col(leagues.columns[0]).alias("league_id")), "league_id", "left_semi")
    return docs.where(F.col("league_id").isin(list(leagues)))


def number_leagues(docs: DataFrame, leagues: Sequence[int]) -> DataFrame:
    """Adds ``_league_at``, the league's place in the list: leagues are applied in the order given."""
    given = F.array(*[F.lit(x).cast("bigint") for x in leagues])
    return docs.withColumn("_league_at", F.array_position(given, F.col("league_id")))


def select_season(docs: DataFrame, season: int) -> DataFrame:
    return docs.where(F.col("season") == F.lit(season))


def target_day(run_date: dt.date | str, days_back: int = 1) -> Column:
    """The incremental day of a run: run date minus ``days_back`` days (fixtures pull yesterday)."""
    return F.date_sub(F.lit(str(run_date)).cast("date"), days_back)


def select_day(docs: DataFrame, run_date: dt.date | str, days_back: int = 1) -> DataFrame:
    return docs.where(F.col("request_date") == target_day(run_date, days_back))


# ------------------------------------------------------------------------------------------------
# field access
# ------------------------------------------------------------------------------------------------

def _typed_fields(x: DataFrame, fields: list[tuple[str, str, str]], keep: list[Column],
                  strict: bool) -> DataFrame:
    """Pull typed fields out of the element variant ``_e``.

    ``fields`` = (name, path, type). In strict mode an absent path raises while a JSON null gives
    NULL. Each path is looked up once, into its own column, and the check and the cast read that
    column (the two projections are not collapsed because the lookup is not a cheap expression).
    Casting the looked-up variant is as strict as ``variant_get`` (text in an integer field fails).
    """
    e = F.col("_e")
    if not strict:
        return x.select(*keep, *[F.try_variant_get(e, p, t).alias(n) for n, p, t in fields], e.alias("raw_json"))
    looked = x.select(*keep, *[F.variant_get(e, p, "variant").alias(f"_v_{n}") for n, p, _ in fields],
                      e.alias("raw_json"))
    out = []
    for n, p, t in fields:
        v = F.col(f"_v_{n}")
        msg = F.lit(f"required field missing from feed element: {p}")
        out.append(F.when(v.isNull(), F.raise_error(msg)).otherwise(v.cast(t)).alias(n))
    return looked.select(*[c for c in looked.columns if not c.startswith("_v_")], *out)


def parse_response(docs: DataFrame, strict: bool = True) -> DataFrame:
    """Parse each body once: ``_resp`` is the ``response`` array of variants and ``_page`` the page
    of a paginated response (a ``page`` column wins over ``paging.current``).

    Malformed JSON fails. A missing ``response`` gives no elements; in strict mode a JSON null
    ``response`` fails, and so does a response that is not an array.
    """
    parsed = docs.withColumn("_doc", F.from_json("body", RESPONSE_SCHEMA, FAILFAST))
    arr = F.col("_doc.response")  # a response that is not an array already fails the parse
    if strict:
        # NULL means missing (no rows) or a JSON null (fail). Only that rare branch parses the body
        # a second time to tell the two apart.
        is_null = F.is_variant_null(F.variant_get(F.parse_json("body"), "$.response", "variant"))
        arr = F.when(arr.isNull(), F.when(is_null, F.raise_error(F.lit("feed response is null"))).otherwise(arr)) \
            .otherwise(arr)
    page = F.col("_doc.paging.current")
    if "page" in docs.columns:
        page = F.coalesce(F.col("page"), page)
    return parsed.withColumn("_resp", arr).withColumn("_page", page).drop("_doc")


def _explode(df: DataFrame, arr: Column, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(arr).alias("_pos", "_e"))


def _seq(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols]).alias("_seq")


def _ctx_cols(docs: DataFrame) -> list[str]:
    context = ("request_date", "league_id", "season", "_league_at", "_landing", "_file")
    return [c for c in context if c in docs.columns] + ["_page"]


def _seq_cols(docs: DataFrame) -> list[str]:
    """Batch order = the order a row loop meets the rows: day, league (as listed, if a list was given),
    landing, page, file, position."""
    order = ("request_date", "_league_at", "league_id", "_landing", "_page", "_file", "_pos")
    return [c for c in order if c in docs.columns or c in ("_page", "_pos")]


# ------------------------------------------------------------------------------------------------
# flatteners
# ------------------------------------------------------------------------------------------------

FIXTURE_FIELDS = [
    ("fixture_id", "$.fixture.id", "bigint"),
    ("home_team_id", "$.teams.home.id", "bigint"),
    ("home_team_name", "$.teams.home.name", "string"),
    ("away_team_id", "$.teams.away.id", "bigint"),
    ("away_team_name", "$.teams.away.name", "string"),
    ("home_goals", "$.goals.home", "bigint"),
    ("away_goals", "$.goals.away", "bigint"),
    ("status", "$.fixture.status.short", "string"),
]
FIXTURE_COLUMNS = ["fixture_id", "league_id", "date", "home_team_id", "home_team_name", "away_team_id",
                   "away_team_name", "home_goals", "away_goals", "status", "raw_json", "_seq"]


def flatten_fixtures(docs: DataFrame, strict: bool = True) -> DataFrame:
    """One row per ``response[*]``: RAW fixtures columns plus ``_seq`` (document order).

    ``date`` and ``league_id`` are the request context; fixtures carry no season.
    """
    x = _explode(parse_response(docs, strict), F.col("_resp"), _ctx_cols(docs))
    keep = [F.col("league_id"), F.col("request_date").alias("date"), _seq(_seq_cols(docs))]
    return _typed_fields(x, FIXTURE_FIELDS, keep, strict).select(*FIXTURE_COLUMNS)


STANDINGS_PATH = ("$.league", "$.league.standings", "$.league.standings[0]")
STANDING_FIELDS = [
    ("rank", "$.rank", "bigint"),
    ("team_id", "$.team.id", "bigint"),
    ("team_name", "$.team.name", "string"),
    ("played", "$.all.played", "bigint"),
    ("win", "$.all.win", "bigint"),
    ("draw", "$.all.draw", "bigint"),
    ("lose", "$.all.lose", "bigint"),
    ("goals_for", "$.all.goals.for", "bigint"),
    ("goals_against", "$.all.goals.against", "bigint"),
    ("goal_diff", "$.goalsDiff", "bigint"),
    ("points", "$.points", "bigint"),
    ("form", "$.form", "string"),
]
STANDING_COLUMNS = ["snapshot_date", "league_id", "season"] + [f[0] for f in STANDING_FIELDS] + ["raw_json", "_seq"]


def first_block(arr: Column, index: int = 0) -> Column:
    """``arr[index]`` that is NULL (not an error) when the array is shorter."""
    return F.get(arr, index)


def flatten_standings(docs: DataFrame, strict: bool = True) -> DataFrame:
    """One row per team of ``response[0].league.standings[0]``; other blocks are ignored.

    A document whose path is missing (empty or absent response, no league/standings key, no
    first group) contributes no rows. A JSON null on the path fails in strict mode.
    """
    ctx = _ctx_cols(docs)
    r0 = first_block(F.col("_resp"), 0)
    get_block = F.variant_get if strict else F.try_variant_get
    p = parse_response(docs, strict).select(
        *ctx, r0.alias("_r0"), get_block(r0, STANDINGS_PATH[-1], "array<variant>").alias("_block"))
    block = F.col("_block")
    if strict:
        # Only a document without a first group is looked at along the path (a rare, costlier
        # branch). A missing key or index skips the document. A null anywhere on the path fails,
        # and so does a value that cannot be indexed the way the path needs (response[0] and
        # league must be objects; standings must be an array, and an object there is a missing
        # index); a first group that is not an array already failed the cast above.
        guard = F.when(block.isNotNull(), block)
        levels = [("$", "object"), ("$.league", "object"), ("$.league.standings", "array or object"),
                  ("$.league.standings[0]", None)]
        for path, kind in levels:
            v = F.variant_get(F.col("_r0"), path, "variant")
            guard = guard.when(F.is_variant_null(v), F.raise_error(F.lit(f"null on the standings path at {path}")))
            if kind is not None:
                ok = F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
                if kind != "object":
                    ok = ok | F.try_variant_get(v, "$", "array<variant>").isNotNull()
                guard = guard.when(v.isNotNull() & ~ok,
                                   F.raise_error(F.lit(f"not an {kind} on the standings path at {path}")))
        block = guard.otherwise(F.lit(None))
    x = _explode(p, block, ctx)
    keep = [F.col("request_date").alias("snapshot_date"), F.col("league_id"), F.col("season"),
            _seq(_seq_cols(docs))]
    return _typed_fields(x, STANDING_FIELDS, keep, strict).select(*STANDING_COLUMNS)


_ST = "$.statistics[0]"
PLAYER_FIELDS = [
    ("player_id", "$.player.id", "bigint"),
    ("player_name", "$.player.name", "string"),
    ("player_age", "$.player.age", "bigint"),
    ("nationality", "$.player.nationality", "string"),
    ("team_id", f"{_ST}.team.id", "bigint"),
    ("team_name", f"{_ST}.team.name", "string"),
    ("appearances", f"{_ST}.games.appearences", "bigint"),  # the payload's spelling
    ("goals", f"{_ST}.goals.total", "bigint"),
    ("assists", f"{_ST}.goals.assists", "bigint"),
    ("yellow_cards", f"{_ST}.cards.yellow", "bigint"),
    ("red_cards", f"{_ST}.cards.red", "bigint"),
    ("rating", f"{_ST}.games.rating", "double"),
]
PLAYER_COLUMNS = ["snapshot_date", "league_id", "season"] + [f[0] for f in PLAYER_FIELDS] + ["raw_json", "_seq"]


def flatten_players(docs: DataFrame, strict: bool = True) -> DataFrame:
    """One row per ``response[*]``: ``player.*`` with the first ``statistics`` block.

    An element with an empty ``statistics`` array fails in strict mode (the first block is required).
    The payload spells the appearances key ``appearences``.
    """
    x = _explode(parse_response(docs, strict), F.col("_resp"), _ctx_cols(docs))
    keep = [F.col("request_date").alias("snapshot_date"), F.col("league_id"), F.col("season"),
            _seq(_seq_cols(docs))]
    return _typed_fields(x, PLAYER_FIELDS, keep, strict).select(*PLAYER_COLUMNS)


# ------------------------------------------------------------------------------------------------
# documents that would fail a load
# ------------------------------------------------------------------------------------------------

FEED_FIELDS = {"fixtures": FIXTURE_FIELDS, "standings": STANDING_FIELDS, "players": PLAYER_FIELDS}


def with_problems(docs: DataFrame, feed: str) -> DataFrame:
    """Documents with ``problems``: what the strict flattener of the feed would fail on, each with its path (and
    the element's number); empty for a document that loads. Nothing is raised and nothing shuffled."""
    parsed = docs.withColumn("_doc", F.try_parse_json("body"))
    response = F.variant_get("_doc", "$.response", "variant")
    elements = F.try_variant_get("_doc", "$.response", "array<variant>")
    whole = [F.when(F.col("_doc").isNull(), F.lit("malformed JSON")),
             F.when(F.try_variant_get("_doc", "$", "map<string,variant>").isNull(), F.lit("not an object: $")),
             F.when(F.is_variant_null(response), F.lit("null: $.response")),
             F.when(response.isNotNull() & elements.isNull(), F.lit("not an array: $.response"))]
    if feed == "standings":
        first = first_block(F.col("_elements"), 0)
        for path, kind in (("$", "object"), ("$.league", "object"), ("$.league.standings", "array"),
                           ("$.league.standings[0]", "array")):
            there = F.variant_get(first, path, "variant")
            whole += [F.when(F.is_variant_null(there), F.lit(f"null: response[0] {path}"))]
            fits = F.try_variant_get(there, "$", "map<string,variant>" if kind == "object" else "array<variant>").isNotNull()
            if path == "$.league.standings":  # an object there has no first group: no rows, no problem
                fits = fits | F.try_variant_get(there, "$", "map<string,variant>").isNotNull()
            whole += [F.when(there.isNotNull() & ~fits, F.lit(f"not an {kind}: response[0] {path}"))]
        parsed = parsed.withColumn("_elements", elements)
        elements = F.try_variant_get(first, STANDINGS_PATH[-1], "array<variant>")
    first_problem = F.coalesce(*whole)

    def of_element(e: Column, at: Column) -> Column:
        found = []
        for _, path, kind in FEED_FIELDS[feed]:
            v = F.variant_get(e, path, "variant")
            wrong = F.try_variant_get(e, path, kind).isNull() & ~F.is_variant_null(v)
            text = F.when(v.isNull(), F.lit(f"missing: {path}")).when(wrong, F.lit(f"not a {kind}: {path}"))
            found.append(F.when(text.isNotNull(), F.concat(F.lit("["), at.cast("string"), F.lit("] "), text)))
        return F.array_compact(F.array(*found))

    each = F.coalesce(F.flatten(F.transform(elements, of_element)), F.array().cast("array<string>"))
    problems = F.when(first_problem.isNotNull(), F.array(first_problem)).otherwise(each)
    return parsed.withColumn("problems", problems).drop("_doc", "_elements")


def split_documents(docs: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """The documents that load, and those that do not (with ``problems``)."""
    seen = with_problems(docs, feed)
    fine = F.size("problems") == 0
    # the body goes with its verdict: the optimiser may parse it before it applies the filter
    accepted = seen.where(fine).withColumn("body", F.when(fine, F.col("body"))).drop("problems")
    return accepted, seen.where(~fine)


# ------------------------------------------------------------------------------------------------
# context stamps
# ------------------------------------------------------------------------------------------------

def stamp_snapshot(rows: DataFrame, run_date: dt.date | str) -> DataFrame:
    """snapshot_date = the run date itself (cumulative feeds become daily history)."""
    return rows.withColumn("snapshot_date", F.lit(str(run_date)).cast("date"))


def stamp_loaded_at(rows: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """_loaded_at = the batch's load time (one value per batch, passed in explicitly)."""
    return rows.withColumn("_loaded_at", ntz_lit(loaded_at))
