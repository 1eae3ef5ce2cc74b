"""Set-based upsert with the exact semantics of a row-by-row MERGE loop.

The loop being replaced runs one ``MERGE ... ON key = key`` per batch row, in batch order:

* a new key is inserted with every column of its first occurrence; later occurrences in the same
  batch then match it and overwrite only the update columns -> insert-only columns come from the
  FIRST occurrence, update columns from the LAST (M4, M6);
* a matched key takes the update columns from the batch even when they are NULL (M5), keeps its
  insert-only columns (M4), and gets the new load time (M8); untouched rows keep theirs;
* a key with any NULL part never matches (``=`` on NULL), so every such row is inserted, again on
  every re-run (M7);
* an empty batch changes nothing (M9); replaying a batch is idempotent for non-NULL keys (M10).

Plan: the batch is folded to one row per key with ``min_by``/``max_by`` over the batch order (a
partial aggregate, so a hot key is pre-reduced on the map side), then full-outer-joined with the
target on the keys. Each side is scanned once. NULL-key rows carry a value of their own beside the key,
so they are spread over all tasks and never meet.

Where the rows of a key are few and far apart, a task meets hardly two of them. Its partial aggregates are then as
many as its rows and several times as wide, as each holds the row's place in the order six times, and the task has
sorted its rows to find that out. ``scattered`` batches send their rows as they are and are folded where the rows of a
key have met; keys of so many rows that one task should not get them all are counted first and keep the other way.

The fold needs an order without ties: rows that share the first or the last place of their key would make
the result depend on chance, so such a batch is refused (``TIED``). The check is part of the same aggregate.

``upsert_table`` applies this to a partitioned Parquet table and rewrites only the partitions the
batch touches, as one commit (``sources.commits``); see ``UpsertSpec.partition_by``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.clean import all_not_null, ntz_lit
from snapmart.operators.keyindex import LEAF_ROWS, KeyIndex
from snapmart.schemas import RAW_FIXTURES, RAW_PLAYERS, RAW_STANDINGS
from snapmart.sources import commits
from snapmart.sources.files import literal, partition_dir

LOAD_COL = "_loaded_at"
SPREAD = "_spread"
TIED = "the batch order has a tie: rows of one key share the first or the last place"
#: Rows of a key from which a scattered batch folds them before they are sent.
HOT_ROWS = 100_000
#: Rows of a partition that one task writes.
PIECE_ROWS = 1_000_000
#: Commits of a table that stay readable after newer ones.
KEEP_COMMITS = 10


@dataclass(frozen=True)
class UpsertSpec:
    """What a MERGE statement declares: the table, its key, and its update (SET) columns.

    ``partition_by`` names the storage partition column: a key column (a batch row can only match
    rows of its own partition) or an insert-only column (a stored row never moves, so its partition
    is found from its key; see ``touched_partitions``).
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    update_cols: tuple[str, ...]
    partition_by: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def insert_only(self, cols: list[str]) -> list[str]:
        return [c for c in cols if c not in self.keys and c not in self.update_cols and c != LOAD_COL]


FIXTURES = UpsertSpec(
    "raw_fixtures", RAW_FIXTURES, ("fixture_id",),
    ("home_goals", "away_goals", "status", "raw_json"),
    partition_by="date")  # insert-only: a rescheduled fixture keeps its first date

STANDINGS = UpsertSpec(
    "raw_standings", RAW_STANDINGS, ("snapshot_date", "team_id", "league_id"),
    ("rank", "played", "win", "draw", "lose", "goals_for", "goals_against", "goal_diff", "points",
     "form", "raw_json"),
    partition_by="snapshot_date")

PLAYERS = UpsertSpec(
    "raw_players", RAW_PLAYERS, ("snapshot_date", "player_id", "league_id"),
    ("goals", "assists", "appearances", "yellow_cards", "red_cards", "rating", "raw_json"),
    partition_by="snapshot_date")


def _seq_col(seq: str | Column) -> Column:
    return F.col(seq) if isinstance(seq, str) else seq


def fold_batch(batch: DataFrame, spec: UpsertSpec, cols: list[str], seq: str | Column = "_seq",
               beside: Sequence[str] = ()) -> DataFrame:
    """One row per key: insert-only columns of the first row, update columns of the last. Columns
    ``beside`` the key tell rows apart that must not be folded.

    ``seq`` orders the batch (the order the loop would have applied it). Of the rows of a key one must be first
    and one last in it; other ties change nothing. The rows that share a place are told apart by a number of
    their own: if the least and the greatest of these differ, there are several.
    """
    keys = [*spec.keys, *beside]
    ins = [c for c in spec.insert_only(cols) if c not in beside]
    upd = [c for c in spec.update_cols if c in cols]
    order = _seq_col(seq).alias("s")
    batch = batch.withColumn("_row", F.monotonically_increasing_id())
    up, down = F.struct(order, F.col("_row").alias("r")), F.struct(order, (-F.col("_row")).alias("r"))
    aggs = []
    if ins:
        aggs += [F.min_by(F.struct(*ins), order).alias("_first"), F.min(up).alias("_a"), F.min(down).alias("_b")]
    if upd:
        aggs += [F.max_by(F.struct(*upd), order).alias("_last"), F.max(up).alias("_c"), F.max(down).alias("_d")]
    folded = batch.groupBy(*keys).agg(*aggs)

    def picked(side: str, least: str, greatest: str, c: str) -> Column:
        tied = F.col(f"{least}.r") != -F.col(f"{greatest}.r")
        return F.when(tied, F.raise_error(F.lit(TIED))).otherwise(F.col(f"{side}.{c}")).alias(c)

    out = [F.col(k) for k in keys]
    out += [picked("_first", "_a", "_b", c) for c in ins]
    out += [picked("_last", "_c", "_d", c) for c in upd]
    return folded.select(*out)


def upsert_df(target: DataFrame, batch: DataFrame, spec: UpsertSpec, load_ts: dt.datetime,
              seq: str | Column = "_seq", scattered: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The table after applying ``batch`` to ``target`` (pure: nothing is written).

    ``target`` columns define the output (any subset of the spec's columns that includes the keys
    and ``_loaded_at``); ``batch`` must carry the same columns except ``_loaded_at``, plus ``seq``.

    A ``scattered`` batch has few rows a key, far apart. Its keys are counted at once, in a job that reads only them;
    the keys of more than ``hot_rows`` rows reach the driver. The result is the same for every batch.
    """
    keys = list(spec.keys)
    b = batch.select(*[c for c in target.columns if c != LOAD_COL], _seq_col(seq).alias("_seq"))
    if not scattered:
        return _merged(target, b, spec, load_ts, False)
    rows = b.select(*keys).where(all_not_null(*keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    found = rows.where(F.col("_n") > hot_rows).select(*keys)
    hot = found.collect()
    if not hot:
        return _merged(target, b, spec, load_ts, True)
    hot = F.broadcast(b.sparkSession.createDataFrame(hot, found.schema))
    rest, few = ([df.join(hot, keys, how) for df in (target, b)] for how in ("left_anti", "left_semi"))
    return _merged(*rest, spec, load_ts, True).unionByName(_merged(*few, spec, load_ts, False))


def _merged(target: DataFrame, batch: DataFrame, spec: UpsertSpec, load_ts: dt.datetime, scattered: bool) -> DataFrame:
    cols = [c for c in target.columns]
    keys = list(spec.keys)
    data_cols = [c for c in cols if c != LOAD_COL]
    ins = spec.insert_only(cols)
    upd = [c for c in spec.update_cols if c in cols]
    stamp = ntz_lit(load_ts)
    has_key = all_not_null(*keys)

    # NULL-key rows never match. They stay in the same pass, spread by a value of their own: they neither
    # merge in the fold nor meet in one task.
    spread = F.when(has_key, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1).alias(SPREAD)
    b = batch.select("*", spread)
    if scattered:
        b = b.repartition(*keys, SPREAD)
    folded = fold_batch(b, spec, data_cols, "_seq", [SPREAD])
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols if c not in keys],
                      F.lit(True).alias("_in_t"), spread)
    f = folded.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in data_cols if c not in keys],
                      F.lit(True).alias("_in_b"), SPREAD)
    j = t.join(f, [*keys, SPREAD], "full_outer")
    in_t, in_b = F.col("_in_t").isNotNull(), F.col("_in_b").isNotNull()
    merged = {k: F.col(k) for k in keys}
    for c in ins:
        merged[c] = F.when(in_t, F.col(f"_t_{c}")).otherwise(F.col(f"_b_{c}"))
    for c in upd:
        merged[c] = F.when(in_b, F.col(f"_b_{c}")).otherwise(F.col(f"_t_{c}"))
    merged[LOAD_COL] = F.when(in_b, stamp).otherwise(F.col(f"_t_{LOAD_COL}"))
    return j.select(*[merged[c].alias(c) for c in cols])


# ------------------------------------------------------------------------------------------------

def upsert_table(spark: SparkSession, path: str, batch: DataFrame, spec: UpsertSpec,
                 load_ts: dt.datetime, seq: str | Column = "_seq", name: str | None = None,
                 days: DataFrame | None = None, leaf_rows: int = LEAF_ROWS, keep: int = KEEP_COMMITS) -> int:
    """Apply ``batch`` to the Parquet table at ``path``; returns the number of partitions rewritten.

    Only partitions the batch can touch are read and written. When the partition column is part of the key,
    a batch row can only meet rows of its own partition. Otherwise the partition column is insert-only, so a
    stored row never leaves the partition it was first written to, and the key index tells where a key lives.
    What reaches the driver is the names of partitions and of index leaves.

    New partitions, the index's new leaves, the name of the batch and its days are one commit: a call that
    dies before has changed nothing, whatever is loaded next, and readers see all or nothing. A batch with a
    ``name`` is applied once. ``days`` (day, documents) are added to the table's record of loads. An empty batch
    without days returns before anything is written. Single writer per table. The last ``keep`` commits
    stay readable.
    """
    part = spec.partition_by
    if part is None or part in spec.update_cols:
        raise ValueError("the storage partition column must be a key or an insert-only column")
    state = commits.current(spark, path)
    if state.number:
        commits.record_batch(spark, state)  # a call that died between its commit and this
    if name is not None and commits.batch_applied(spark, path, name):
        return 0
    # The batch is read several times (touched partitions, index, upsert): keep it once.
    # A lost executor's cached blocks are recomputed from the batch's (deterministic) lineage.
    b = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        empty = b.isEmpty()
        if empty and (days is None or days.isEmpty()):
            return 0
        commit_id = commits.new_commit()
        index = KeyIndex(spark, state, spec.schema, spec.keys, part, leaf_rows) if part not in spec.keys else None
        touched, written, leaves = (0, {}, None) if empty else _write(spark, state, b, spec, load_ts, seq, commit_id, index)
        tables = {"days": _with_days(state.table(spark, "days", commits.DAYS), days)}
        if index:
            tables["leaves"] = spark.createDataFrame(index.leaves, index.leaf_type) if leaves is None else leaves
        commits.commit(spark, state, commit_id, written, tables, name)
    finally:
        b.unpersist()
    commits.drop_old_commits(spark, path, keep)
    return touched


def _write(spark: SparkSession, state: commits.Version, b: DataFrame, spec: UpsertSpec, load_ts: dt.datetime,
           seq: str | Column, commit_id: str, index: KeyIndex | None) -> tuple[int, dict[str, int], DataFrame | None]:
    """Write the partitions and index leaves a batch changes; nothing refers to them yet. Returns how many
    partitions it can touch, the rows of the directories written, and the leaves of the index."""
    part, keys, has_key = spec.partition_by, list(spec.keys), all_not_null(*spec.keys)
    own = b.select(part, F.lit(1).alias("n"))
    if index:
        stored = None
        if state.live and not index.leaves:  # a table from before the index: its keys are read once
            stored = commits.read_directories(spark, state, spec.schema).select(*keys, part).where(has_key).distinct()
        known = stored.join(b.select(*keys), keys, "left_semi") if stored else index.located(b)
        own = own.unionByName(known.select(part, F.lit(0).alias("n")))
    touched = own.groupBy(F.col(part).cast("string").alias("v"), partition_dir(part).alias("d")).agg(
        F.sum("n").alias("n")).collect()
    target = commits.read_directories(spark, state, spec.schema, [r["d"] for r in touched])
    pieces = {r["v"]: -(-(r["n"] + state.rows(r["d"])) // PIECE_ROWS) or 1 for r in touched}
    merged = dealt(upsert_df(target, b, spec, load_ts, seq).select(*spec.columns), part, keys, pieces)
    where = f"{state.path}/{commits.DATA}/commit={commit_id}"
    commits.writer(merged, part).parquet(where)
    # the partition column alone is counted from the files' footers
    written = spark.read.schema(spec.schema).parquet(literal(where)).groupBy(part).agg(F.count("*").alias("n"))
    written = {r["d"]: r["n"] for r in written.select(partition_dir(part).alias("d"), "n").collect()}
    if not index:
        return len(touched), written, None
    new = b.where(has_key).groupBy(*keys).agg(F.min_by(part, _seq_col(seq)).alias(part)).join(known, keys, "left_anti")
    return len(touched), written, index.updated(new.unionByName(stored) if stored else new, commit_id)


def dealt(rows: DataFrame, part: str, keys: Sequence[str], pieces: dict[str | None, int]) -> DataFrame:
    """Rows dealt to tasks by their partition, a partition of several ``pieces`` by its keys as well: a task writes
    whole small partitions, and a large one is written by as many tasks as it has pieces. (Left to itself Spark
    would gather thousands of small partitions in one task, as their bytes are few.)"""
    several = {v: n for v, n in pieces.items() if n > 1}
    cut = F.lit(0)
    if several:
        ways = F.create_map(*[F.lit(x) for v, n in several.items() for x in (v or "", n)])
        of = F.coalesce(ways[F.coalesce(F.col(part).cast("string"), F.lit(""))], F.lit(1))
        cut = F.pmod(F.hash(*keys, F.when(~all_not_null(*keys), F.monotonically_increasing_id())), of)
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(sum(pieces.values()), max(usual, sum(several.values())))
    return rows.repartition(tasks, F.col(part), cut)


def _with_days(days: DataFrame, more: DataFrame | None) -> DataFrame:
    if more is None:
        return days
    new = more.select("day", F.lit(1).cast("bigint").alias("loads"), F.col("documents").cast("bigint").alias("documents"))
    return days.unionByName(new).groupBy("day").agg(F.sum("loads").alias("loads"), F.sum("documents").alias("documents"))


def load_record(spark: SparkSession, path: str) -> DataFrame:
    """(day, loads, documents): the days a table's batches loaded, how often, and how many documents."""
    return commits.current(spark, path).table(spark, "days", commits.DAYS)


def load_gaps(record: DataFrame, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """(day, loads, documents, finding): the days of a period that were not loaded ('missing') or were
    loaded more than once ('repeated')."""
    period = record.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))).alias("day"))
    zero = F.lit(0).cast("bigint")
    every = period.join(record, "day", "left").select(
        "day", F.coalesce("loads", zero).alias("loads"), F.coalesce("documents", zero).alias("documents"))
    finding = F.when(F.col("loads") == 0, F.lit("missing")).when(F.col("loads") > 1, F.lit("repeated"))
    return every.withColumn("finding", finding).where(F.col("finding").isNotNull())
