"""Reference-shaped inputs derived from the driver's TPC-H-like tables.

The reference loads sports feeds; the test tables are TPC-H-like. Each function here derives a
RAW-shaped DataFrame from whole tables, and ``*_SQL`` holds the same derivation as SQL (DuckDB and
Spark SQL both accept it) so the oracle and the Spark plan describe the same rows.

* RS (standings): lineitem per (month of ship date, supplier) joined to supplier.
* RP (players):   events per (day, user).
* RF (fixtures):  orders, one fixture per order.

NULLs are injected with NULLIF where the test tables hold none, so every NULL path is exercised.
Aggregations group first and join after, so the join sees pre-aggregated rows; the supplier side of
RS is a plain equi-join that AQE broadcasts only when the measured side is small.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.clean import ntz_lit

# Fixed load stamps of the analog runs (deterministic, so results hash the same every run).
T0 = dt.datetime(2024, 1, 1, 6, 30, 0)   # first load of the RAW tables
T1 = dt.datetime(2024, 2, 1, 6, 30, 0)   # the upsert batch
T2 = dt.datetime(2024, 2, 2, 6, 30, 0)   # a re-run of the same batch
RUN_TS = dt.datetime(2024, 2, 1, 8, 0, 0)  # model build time (_created_at)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass
class Tables:
    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        raise AttributeError(name)


def ts_lit(t: dt.datetime):
    return ntz_lit(t)


def sql_ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _count_if(cond):
    return F.count_if(cond).cast("bigint")


# ------------------------------------------------------------------------------------------------
# RS: standings analog
# ------------------------------------------------------------------------------------------------

def raw_standings(t: Tables, loaded_at: dt.datetime = T0) -> DataFrame:
    li = t.lineitem
    month = F.trunc(F.to_date("l_shipdate"), "month")
    agg = li.groupBy(month.alias("snapshot_date"), F.col("l_suppkey").alias("team_id")).agg(
        F.count(F.lit(1)).cast("bigint").alias("played"),
        _count_if(F.col("l_returnflag") == "A").alias("n_a"),
        _count_if(F.col("l_returnflag") == "N").alias("n_n"),
        _count_if(F.col("l_returnflag") == "R").alias("n_r"),
        F.sum("l_linenumber").cast("bigint").alias("goals_for"),
        _count_if(F.col("l_linestatus") == "F").alias("goals_against"),
        _count_if(F.col("l_linenumber") == 1).alias("n_first"),
    )
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    j = agg.join(s, agg["team_id"] == s["s_suppkey"], "inner")
    win = F.nullif(F.col("n_a"), F.lit(0))
    form = F.concat(
        F.lit(" "),
        F.when(F.col("n_a") > 0, F.lit("w")).otherwise(F.lit("")),
        F.when(F.col("n_n") > 0, F.lit("d")).otherwise(F.lit("")),
        F.when(F.col("n_r") > 0, F.lit("l")).otherwise(F.lit("")),
        F.lit(" "))
    return j.select(
        "snapshot_date",
        F.nullif(F.col("s_nationkey"), F.lit(0)).cast("bigint").alias("league_id"),
        F.year("snapshot_date").cast("bigint").alias("season"),
        F.nullif(F.col("n_first"), F.lit(0)).alias("rank"),
        "team_id",
        F.concat(F.lit("  "), F.lower("s_name"), F.lit(" ")).alias("team_name"),
        "played",
        win.alias("win"),
        F.col("n_n").alias("draw"),
        F.col("n_r").alias("lose"),
        "goals_for", "goals_against",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_diff"),
        (F.lit(3) * win + F.col("n_n")).cast("bigint").alias("points"),
        form.alias("form"),
        ts_lit(loaded_at).alias("_loaded_at"),
    )


def raw_standings_sql(loaded_at: dt.datetime = T0) -> str:
    return f"""
    SELECT a.snapshot_date,
           CAST(NULLIF(s.s_nationkey, 0) AS BIGINT) AS league_id,
           CAST(year(a.snapshot_date) AS BIGINT) AS season,
           NULLIF(a.n_first, 0) AS rank,
           a.team_id,
           '  ' || lower(s.s_name) || ' ' AS team_name,
           a.played,
           NULLIF(a.n_a, 0) AS win,
           a.n_n AS draw,
           a.n_r AS lose,
           a.goals_for, a.goals_against,
           a.goals_for - a.goals_against AS goal_diff,
           CAST(3 * NULLIF(a.n_a, 0) + a.n_n AS BIGINT) AS points,
           ' ' || CASE WHEN a.n_a > 0 THEN 'w' ELSE '' END || CASE WHEN a.n_n > 0 THEN 'd' ELSE '' END
               || CASE WHEN a.n_r > 0 THEN 'l' ELSE '' END || ' ' AS form,
           {sql_ts(loaded_at)} AS _loaded_at
    FROM (
        SELECT CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS snapshot_date,
               l_suppkey AS team_id,
               CAST(count(*) AS BIGINT) AS played,
               CAST(count_if(l_returnflag = 'A') AS BIGINT) AS n_a,
               CAST(count_if(l_returnflag = 'N') AS BIGINT) AS n_n,
               CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_r,
               CAST(sum(l_linenumber) AS BIGINT) AS goals_for,
               CAST(count_if(l_linestatus = 'F') AS BIGINT) AS goals_against,
               CAST(count_if(l_linenumber = 1) AS BIGINT) AS n_first
        FROM lineitem
        GROUP BY 1, 2
    ) a
    JOIN supplier s ON a.team_id = s.s_suppkey
    """


# ------------------------------------------------------------------------------------------------
# RP: players analog
# ------------------------------------------------------------------------------------------------

def _player_cols_from(user, day, name_suffix=None):
    """Identity columns of a player analog row, shared by RP and the per-event batch."""
    pad = F.lpad((user % 100).cast("string"), 9, "0")
    suffix = F.lit("") if name_suffix is None else name_suffix
    return [
        day.alias("snapshot_date"),
        F.nullif(user % 5, F.lit(0)).cast("bigint").alias("league_id"),
        F.year(day).cast("bigint").alias("season"),
        user.cast("bigint").alias("player_id"),
        F.concat(F.lit(" player_"), user.cast("string"), suffix, F.lit(" ")).alias("player_name"),
        (F.lit(18) + user % 20).cast("bigint").alias("player_age"),
        F.concat(F.lit("nation_"), (user % 25).cast("string"), F.lit(" ")).alias("nationality"),
        F.nullif(user % 100, F.lit(0)).cast("bigint").alias("team_id"),
        F.concat(F.lit(" "), F.when(user >= 100, F.lit("supplier #")).otherwise(F.lit("supplier#")), pad)
         .alias("team_name"),
    ]


PLAYER_IDENT_SQL = """
           {day} AS snapshot_date,
           CAST(NULLIF({u} % 5, 0) AS BIGINT) AS league_id,
           CAST(year({day}) AS BIGINT) AS season,
           CAST({u} AS BIGINT) AS player_id,
           ' player_' || CAST({u} AS VARCHAR) || {suffix} || ' ' AS player_name,
           CAST(18 + {u} % 20 AS BIGINT) AS player_age,
           'nation_' || CAST({u} % 25 AS VARCHAR) || ' ' AS nationality,
           CAST(NULLIF({u} % 100, 0) AS BIGINT) AS team_id,
           ' ' || CASE WHEN {u} >= 100 THEN 'supplier #' ELSE 'supplier#' END
               || lpad(CAST({u} % 100 AS VARCHAR), 9, '0') AS team_name"""


def raw_players(t: Tables, loaded_at: dt.datetime = T0) -> DataFrame:
    e = t.events
    et = F.col("event_type")
    agg = e.groupBy(F.to_date("ts").alias("day"), F.col("user_id").alias("u")).agg(
        _count_if(et == "view").alias("n_view"),
        _count_if(et == "purchase").alias("n_buy"),
        _count_if(et == "click").alias("n_click"),
        _count_if(et == "error").alias("n_err"),
        _count_if(et == "signup").alias("n_sign"),
        F.max(F.when(et == "view", F.col("value"))).alias("rating"),
    )
    return agg.select(
        *_player_cols_from(F.col("u"), F.col("day")),
        F.col("n_view").alias("appearances"),
        F.nullif(F.col("n_buy"), F.lit(0)).alias("goals"),
        F.nullif(F.col("n_click"), F.lit(0)).alias("assists"),
        F.col("n_err").alias("yellow_cards"),
        F.nullif(F.col("n_sign"), F.lit(0)).alias("red_cards"),
        F.col("rating").cast("double").alias("rating"),
        ts_lit(loaded_at).alias("_loaded_at"),
    )


def raw_players_sql(loaded_at: dt.datetime = T0) -> str:
    ident = PLAYER_IDENT_SQL.format(u="a.u", day="a.day", suffix="''")
    return f"""
    SELECT {ident},
           a.n_view AS appearances,
           NULLIF(a.n_buy, 0) AS goals,
           NULLIF(a.n_click, 0) AS assists,
           a.n_err AS yellow_cards,
           NULLIF(a.n_sign, 0) AS red_cards,
           CAST(a.rating AS DOUBLE) AS rating,
           {sql_ts(loaded_at)} AS _loaded_at
    FROM (
        SELECT CAST(ts AS DATE) AS day, user_id AS u,
               CAST(count_if(event_type = 'view') AS BIGINT) AS n_view,
               CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_buy,
               CAST(count_if(event_type = 'click') AS BIGINT) AS n_click,
               CAST(count_if(event_type = 'error') AS BIGINT) AS n_err,
               CAST(count_if(event_type = 'signup') AS BIGINT) AS n_sign,
               max(CASE WHEN event_type = 'view' THEN value END) AS rating
        FROM events
        GROUP BY 1, 2
    ) a
    """


# ------------------------------------------------------------------------------------------------
# RF: fixtures analog
# ------------------------------------------------------------------------------------------------

def raw_fixtures(t: Tables, loaded_at: dt.datetime = T0) -> DataFrame:
    o = t.orders
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    unplayed = F.col("o_orderstatus") == "O"
    return o.select(
        k.alias("fixture_id"),
        (c % 5).cast("bigint").alias("league_id"),
        F.to_date("o_orderdate").alias("date"),
        c.alias("home_team_id"),
        F.concat(F.lit("customer#"), F.lpad(c.cast("string"), 9, "0")).alias("home_team_name"),
        (k % 100).alias("away_team_id"),
        F.concat(F.lit("team "), (k % 100).cast("string")).alias("away_team_name"),
        F.when(~unplayed, k % 7).alias("home_goals"),
        F.when(~unplayed, (c + k) % 5).alias("away_goals"),
        F.col("o_orderstatus").alias("status"),
        ts_lit(loaded_at).alias("_loaded_at"),
    )


def raw_fixtures_sql(loaded_at: dt.datetime = T0) -> str:
    return f"""
    SELECT o_orderkey AS fixture_id,
           CAST(o_custkey % 5 AS BIGINT) AS league_id,
           CAST(o_orderdate AS DATE) AS date,
           o_custkey AS home_team_id,
           'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS home_team_name,
           o_orderkey % 100 AS away_team_id,
           'team ' || CAST(o_orderkey % 100 AS VARCHAR) AS away_team_name,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderkey % 7 END AS home_goals,
           CASE WHEN o_orderstatus <> 'O' THEN (o_custkey + o_orderkey) % 5 END AS away_goals,
           o_orderstatus AS status,
           {sql_ts(loaded_at)} AS _loaded_at
    FROM orders
    """


# ------------------------------------------------------------------------------------------------
# Two-source team sets (supplier and customer), for the DISTINCT / UNION / fan-out operators
# ------------------------------------------------------------------------------------------------

def supplier_teams(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("team_id"),
        F.upper(F.trim("s_name")).alias("team_name"),
        F.col("s_nationkey").cast("bigint").alias("league_id"))


def customer_teams(t: Tables) -> DataFrame:
    # A customer's name re-spelled with the supplier prefix, so equal ids in equal nations collide
    # with the supplier spelling only sometimes: the source of the dimension fan-out.
    name = F.when(F.col("c_custkey") % 3 == 0,
                  F.concat(F.lit("supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")))
    name = name.otherwise(F.col("c_name"))
    return t.customer.select(
        F.col("c_custkey").alias("team_id"),
        F.upper(F.trim(name)).alias("team_name"),
        F.col("c_nationkey").cast("bigint").alias("league_id"))


SUPPLIER_TEAMS_SQL = """
    SELECT s_suppkey AS team_id, upper(trim(s_name)) AS team_name, CAST(s_nationkey AS BIGINT) AS league_id
    FROM supplier"""

CUSTOMER_TEAMS_SQL = """
    SELECT c_custkey AS team_id,
           upper(trim(CASE WHEN c_custkey % 3 = 0 THEN 'supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')
                           ELSE c_name END)) AS team_name,
           CAST(c_nationkey AS BIGINT) AS league_id
    FROM customer"""


def nation_labels(t: Tables) -> DataFrame:
    """League labels from the catalog tables: nation name as league, region name as country."""
    n, r = t.nation, t.region
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").cast("bigint").alias("league_id"),
        F.col("n_name").alias("league_name"),
        F.col("r_name").alias("country"))


NATION_LABELS_SQL = """
    SELECT CAST(n_nationkey AS BIGINT) AS league_id, n_name AS league_name, r_name AS country
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""


# ------------------------------------------------------------------------------------------------
# Landed JSON feeds built from the analogs (one response document per row)
# ------------------------------------------------------------------------------------------------
# A document holds at most PAGE elements: the page is the key divided by PAGE, and keys are unique
# within a (day, league), so no document grows with the data, however skewed a league or day is.

PAGE = 16
_JSON_OPTS = {"ignoreNullFields": "false"}


def _documents(rows: DataFrame, day: str, key: str, element, wrap) -> DataFrame:
    g = rows.groupBy(F.col(day).alias("request_date"), F.col("league_id"),
                     F.floor(F.col(key) / PAGE).cast("bigint").alias("page"))
    docs = g.agg(F.sort_array(F.collect_list(element)).alias("_els"))
    body = wrap(F.col("_els")).withField("paging", F.struct(F.col("page").alias("current")))
    return docs.select(
        F.to_json(body, _JSON_OPTS).alias("body"),
        "request_date", "league_id", F.year("request_date").cast("bigint").alias("season"), "page")


def fixtures_feed(t: Tables) -> DataFrame:
    return fixtures_feed_from(raw_fixtures(t))


def fixtures_feed_from(rf: DataFrame) -> DataFrame:
    el = F.struct(
        F.struct(F.col("fixture_id").alias("id"), F.struct(F.col("status").alias("short")).alias("status"))
         .alias("fixture"),
        F.struct(F.struct(F.col("home_team_id").alias("id"), F.col("home_team_name").alias("name")).alias("home"),
                 F.struct(F.col("away_team_id").alias("id"), F.col("away_team_name").alias("name")).alias("away"))
         .alias("teams"),
        F.struct(F.col("home_goals").alias("home"), F.col("away_goals").alias("away")).alias("goals"))
    return _documents(rf, "date", "fixture_id", el, lambda els: F.struct(els.alias("response")))


def standings_feed(t: Tables) -> DataFrame:
    rs = raw_standings(t)
    el = F.struct(
        F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name")).alias("team"),
        F.col("rank"),
        F.struct(F.col("played"), F.col("win"), F.col("draw"), F.col("lose"),
                 F.struct(F.col("goals_for").alias("for"), F.col("goals_against").alias("against")).alias("goals"))
         .alias("all"),
        F.col("goal_diff").alias("goalsDiff"), F.col("points"), F.col("form"))

    def wrap(els):
        # a second standings group that the loader must ignore
        other = F.transform(F.slice(els, 1, 1), lambda x: x.withField("rank", F.lit(-1).cast("bigint")))
        league = F.struct(F.lit(None).cast("bigint").alias("id"), F.array(els, other).alias("standings"))
        return F.struct(F.array(F.struct(league.alias("league"))).alias("response"))
    return _documents(rs, "snapshot_date", "team_id", el, wrap)


def players_feed(t: Tables) -> DataFrame:
    rp = raw_players(t)

    def block(team_shift):
        return F.struct(
            F.struct((F.col("team_id") + F.lit(team_shift)).alias("id"), F.col("team_name").alias("name")).alias("team"),
            F.struct(F.col("appearances").alias("appearences"), F.col("rating").cast("string").alias("rating"))
             .alias("games"),
            F.struct(F.col("goals").alias("total"), F.col("assists")).alias("goals"),
            F.struct(F.col("yellow_cards").alias("yellow"), F.col("red_cards").alias("red")).alias("cards"))
    el = F.struct(
        F.struct(F.col("player_id").alias("id"), F.col("player_name").alias("name"),
                 F.col("player_age").alias("age"), F.col("nationality")).alias("player"),
        # only the first statistics block is read; the second must be ignored
        F.array(block(0), block(1000000)).alias("statistics"))
    return _documents(rp, "snapshot_date", "player_id", el, lambda els: F.struct(els.alias("response")))


def empty_feed_docs(docs: DataFrame) -> DataFrame:
    """For every landed (day, league): one document with ``response: []`` and one without it."""
    ctx = docs.select("request_date", "league_id", "season").distinct()
    empty = ctx.select(F.lit('{"response": []}').alias("body"), "*", F.lit(-1).cast("bigint").alias("page"))
    absent = ctx.select(F.lit('{"errors": {"requests": "limit"}}').alias("body"), "*",
                        F.lit(-2).cast("bigint").alias("page"))
    return empty.unionByName(absent)


# ------------------------------------------------------------------------------------------------
# Upsert scenarios: a RAW target "as loaded so far" and a new batch that overlaps it
# ------------------------------------------------------------------------------------------------
# Each target holds the analog rows up to a cut-off day; each batch covers days from an earlier
# day onward, so part of the batch matches existing keys and part is new. Together they cover the
# whole source table. Batches carry the order in which a row-by-row loop would apply them (seq).

PLAYERS_TARGET_BEFORE = "2024-01-21"
PLAYERS_BATCH_FROM = "2024-01-15"
STANDINGS_TARGET_BEFORE = "1999-01-01"
STANDINGS_BATCH_FROM = "1998-01-01"
FIXTURES_TARGET_BEFORE = "1998-01-01"
FIXTURES_BATCH_FROM = "1997-01-01"
DUPS_TARGET_BEFORE = "1996-01-01"


def _d(s: str):
    return F.lit(s).cast("date")


def players_target(t: Tables) -> DataFrame:
    return raw_players(t).where(F.col("snapshot_date") < _d(PLAYERS_TARGET_BEFORE))


def players_target_sql() -> str:
    return f"SELECT * FROM ({raw_players_sql()}) WHERE snapshot_date < DATE '{PLAYERS_TARGET_BEFORE}'"


def players_batch(t: Tables) -> DataFrame:
    """One batch row per event (many per key); insert-only names vary per event, seq = event_id."""
    e = t.events.where(F.to_date("ts") >= _d(PLAYERS_BATCH_FROM))
    u, k, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    return e.select(
        *_player_cols_from(u, F.to_date("ts"), F.concat(F.lit("#"), k.cast("string"))),
        (k % 7).alias("appearances"),
        F.nullif(k % 4, F.lit(0)).alias("goals"),
        (k % 3).alias("assists"),
        F.when(et == "error", F.lit(1)).cast("bigint").alias("yellow_cards"),
        F.lit(0).cast("bigint").alias("red_cards"),
        F.col("value").cast("double").alias("rating"),
        k.alias("_seq"))


def players_batch_sql() -> str:
    ident = PLAYER_IDENT_SQL.format(u="user_id", day="CAST(ts AS DATE)", suffix="'#' || CAST(event_id AS VARCHAR)")
    return f"""
    SELECT {ident},
           event_id % 7 AS appearances,
           NULLIF(event_id % 4, 0) AS goals,
           event_id % 3 AS assists,
           CAST(CASE WHEN event_type = 'error' THEN 1 END AS BIGINT) AS yellow_cards,
           CAST(0 AS BIGINT) AS red_cards,
           CAST(value AS DOUBLE) AS rating,
           event_id AS seq
    FROM events WHERE CAST(ts AS DATE) >= DATE '{PLAYERS_BATCH_FROM}'"""


def players_null_batch(t: Tables) -> DataFrame:
    """Every RP row again, with goals and rating set to NULL on rows with an even appearance count."""
    even = F.col("appearances") % 2 == 0
    rp = raw_players(t)
    return rp.select(*[c for c in rp.columns if c not in ("goals", "rating", "_loaded_at")],
                     F.when(~even, F.col("goals")).alias("goals"),
                     F.when(~even, F.col("rating")).alias("rating"),
                     F.col("player_id").alias("_seq"))


def players_null_batch_sql() -> str:
    return f"""
    SELECT * EXCLUDE (goals, rating, _loaded_at),
           CASE WHEN appearances % 2 <> 0 THEN goals END AS goals,
           CASE WHEN appearances % 2 <> 0 THEN rating END AS rating,
           player_id AS seq
    FROM ({raw_players_sql()})"""


LINE_SEQ = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _line_seq(lead: tuple[str, ...] = ()):
    return F.struct(*[F.col(c) for c in lead + LINE_SEQ])


def _line_seq_sql(lead: tuple[str, ...] = ()) -> str:
    names = lead + LINE_SEQ
    return "{" + ", ".join(f"'{c}': {c}" for c in names) + "}"


def standings_target(t: Tables) -> DataFrame:
    return raw_standings(t).where(F.col("snapshot_date") < _d(STANDINGS_TARGET_BEFORE))


def standings_target_sql() -> str:
    return f"SELECT * FROM ({raw_standings_sql()}) WHERE snapshot_date < DATE '{STANDINGS_TARGET_BEFORE}'"


def standings_batch(t: Tables) -> DataFrame:
    """One batch row per line item (about seven per key); seq = the line item's columns."""
    li = t.lineitem.where(F.to_date("l_shipdate") >= _d(STANDINGS_BATCH_FROM))
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"], "inner")
    month = F.trunc(F.to_date("l_shipdate"), "month")
    k, p = F.col("l_orderkey"), F.col("l_partkey")
    return j.select(
        month.alias("snapshot_date"),
        F.nullif(F.col("s_nationkey"), F.lit(0)).cast("bigint").alias("league_id"),
        F.year(month).cast("bigint").alias("season"),
        F.col("l_linenumber").cast("bigint").alias("rank"),
        F.col("l_suppkey").alias("team_id"),
        F.concat(F.lit("  "), F.lower("s_name"), F.lit(" #"), k.cast("string")).alias("team_name"),
        (F.col("l_linenumber") + 10).cast("bigint").alias("played"),
        F.nullif(k % 3, F.lit(0)).alias("win"),
        (k % 2).alias("draw"),
        (p % 4).alias("lose"),
        (p % 50).alias("goals_for"),
        (k % 11).alias("goals_against"),
        (p % 50 - k % 11).alias("goal_diff"),
        (F.col("l_linenumber") * 3).cast("bigint").alias("points"),
        F.concat("l_returnflag", "l_linestatus").alias("form"),
        _line_seq(("l_orderkey",)).alias("_seq"))


def standings_batch_sql() -> str:
    return f"""
    SELECT CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS snapshot_date,
           CAST(NULLIF(s_nationkey, 0) AS BIGINT) AS league_id,
           CAST(year(CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE)) AS BIGINT) AS season,
           CAST(l_linenumber AS BIGINT) AS rank,
           l_suppkey AS team_id,
           '  ' || lower(s_name) || ' #' || CAST(l_orderkey AS VARCHAR) AS team_name,
           CAST(l_linenumber + 10 AS BIGINT) AS played,
           NULLIF(l_orderkey % 3, 0) AS win,
           l_orderkey % 2 AS draw,
           l_partkey % 4 AS lose,
           l_partkey % 50 AS goals_for,
           l_orderkey % 11 AS goals_against,
           l_partkey % 50 - l_orderkey % 11 AS goal_diff,
           CAST(l_linenumber * 3 AS BIGINT) AS points,
           l_returnflag || l_linestatus AS form,
           {_line_seq_sql(("l_orderkey",))} AS seq
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE CAST(l_shipdate AS DATE) >= DATE '{STANDINGS_BATCH_FROM}'"""


def fixtures_v2(t: Tables) -> DataFrame:
    """Orders re-reported later: rescheduled a day, renamed teams, new scores (NULL when postponed)."""
    o = t.orders.where(F.to_date("o_orderdate") >= _d(FIXTURES_BATCH_FROM))
    k, c, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    postponed = st == "P"
    return o.select(
        k.alias("fixture_id"),
        ((c + 1) % 5).cast("bigint").alias("league_id"),
        F.date_add(F.to_date("o_orderdate"), 1).alias("date"),
        c.alias("home_team_id"),
        F.concat(F.lit("CUSTOMER#"), F.lpad(c.cast("string"), 9, "0")).alias("home_team_name"),
        (k % 100).alias("away_team_id"),
        F.concat(F.lit("TEAM "), (k % 100).cast("string")).alias("away_team_name"),
        F.when(~postponed, (k * 3) % 5).alias("home_goals"),
        F.when(~postponed, c % 4).alias("away_goals"),
        F.when(st == "O", F.lit("FT")).otherwise(st).alias("status"),
        ts_lit(T1).alias("_loaded_at"))


def fixtures_v2_sql() -> str:
    return f"""
    SELECT o_orderkey AS fixture_id,
           CAST((o_custkey + 1) % 5 AS BIGINT) AS league_id,
           CAST(o_orderdate AS DATE) + 1 AS date,
           o_custkey AS home_team_id,
           'CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS home_team_name,
           o_orderkey % 100 AS away_team_id,
           'TEAM ' || CAST(o_orderkey % 100 AS VARCHAR) AS away_team_name,
           CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey * 3) % 5 END AS home_goals,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 4 END AS away_goals,
           CASE WHEN o_orderstatus = 'O' THEN 'FT' ELSE o_orderstatus END AS status,
           {sql_ts(T1)} AS _loaded_at
    FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{FIXTURES_BATCH_FROM}'"""


def fixtures_target_rows(t: Tables) -> DataFrame:
    return raw_fixtures(t).where(F.col("date") < _d(FIXTURES_TARGET_BEFORE))


def fixtures_target_sql() -> str:
    return f"SELECT * FROM ({raw_fixtures_sql()}) WHERE date < DATE '{FIXTURES_TARGET_BEFORE}'"


def fixture_lines_batch(t: Tables) -> DataFrame:
    """Fixtures reported once per line item, up to seven rows per fixture in line order. Those that are not in
    the target are first reported as their order says."""
    li = t.lineitem
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    lines = li.select(
        k.alias("fixture_id"),
        (s % 5).alias("league_id"),
        F.to_date("l_shipdate").alias("date"),
        p.alias("home_team_id"),
        F.concat(F.lit("part#"), p.cast("string")).alias("home_team_name"),
        s.alias("away_team_id"),
        F.concat(F.lit("supp#"), s.cast("string")).alias("away_team_name"),
        F.col("l_linenumber").cast("bigint").alias("home_goals"),
        F.nullif(p % 3, F.lit(0)).alias("away_goals"),
        F.col("l_returnflag").alias("status"),
        _line_seq().alias("_seq"))
    later = raw_fixtures(t).where(F.col("date") >= _d(DUPS_TARGET_BEFORE)).drop("_loaded_at")
    none = F.struct(*[(F.lit(0) if c == LINE_SEQ[0] else F.lit(None)).cast(li.schema[c].dataType).alias(c) for c in LINE_SEQ])
    return lines.unionByName(later.select(*[c for c in lines.columns if c != "_seq"], none.alias("_seq")))


def fixture_lines_batch_sql() -> str:
    before = ", ".join(f"'{c}': {'0' if c == LINE_SEQ[0] else 'NULL'}" for c in LINE_SEQ)
    return f"""
    SELECT l_orderkey AS fixture_id,
           l_suppkey % 5 AS league_id,
           CAST(l_shipdate AS DATE) AS date,
           l_partkey AS home_team_id,
           'part#' || CAST(l_partkey AS VARCHAR) AS home_team_name,
           l_suppkey AS away_team_id,
           'supp#' || CAST(l_suppkey AS VARCHAR) AS away_team_name,
           CAST(l_linenumber AS BIGINT) AS home_goals,
           NULLIF(l_partkey % 3, 0) AS away_goals,
           l_returnflag AS status,
           {_line_seq_sql()} AS seq
    FROM lineitem
    UNION ALL
    SELECT fixture_id, league_id, date, home_team_id, home_team_name, away_team_id, away_team_name, home_goals,
           away_goals, status, {{{before}}} AS seq
    FROM ({raw_fixtures_sql()}) WHERE date >= DATE '{DUPS_TARGET_BEFORE}'"""


def dups_target(t: Tables) -> DataFrame:
    return raw_fixtures(t).where(F.col("date") < _d(DUPS_TARGET_BEFORE))


def dups_target_sql() -> str:
    return f"SELECT * FROM ({raw_fixtures_sql()}) WHERE date < DATE '{DUPS_TARGET_BEFORE}'"
