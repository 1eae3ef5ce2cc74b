"""Upsert semantics: unit edge rows, a property test against a row-by-row MERGE model, table form."""

import os

import pytest

from conftest import T0, T1, T2, d
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.operators import upsert as U
from snapmart.operators.keyindex import KeyIndex
from snapmart.plans.queries_upsert import q_upsert_batch_dups
from snapmart.sources import commits
from snapmart.sources.rawstore import path_exists, read_table

SCHEMA = T.StructType([
    T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("i", T.LongType()),
    T.StructField("u", T.LongType()), T.StructField("v", T.StringType()), T.StructField("_loaded_at", T.TimestampNTZType()),
])
SPEC = U.UpsertSpec("t", SCHEMA, ("k1", "k2"), ("u", "v"))
COLS = SCHEMA.fieldNames()


def target_df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batch_df(spark, rows):
    return spark.createDataFrame([r + (n,) for n, r in enumerate(rows)],
                                 "k1 bigint, k2 bigint, i bigint, u bigint, v string, _seq bigint")


def merge_loop(target, batch, load_ts):
    """The loop being replaced: one MERGE statement per batch row, in order."""
    table = [dict(zip(COLS, r)) for r in target]
    for b in batch:
        row = dict(zip(COLS[:-1], b))
        matches = [t for t in table if row["k1"] is not None and row["k2"] is not None
                   and t["k1"] == row["k1"] and t["k2"] == row["k2"]]
        if matches:
            for t in matches:
                t["u"], t["v"], t["_loaded_at"] = row["u"], row["v"], load_ts
        else:
            table.append({**row, "_loaded_at": load_ts})
    return sorted((tuple(t[c] for c in COLS) for t in table), key=repr)


def run(spark, target, batch, ts=T1):
    out = U.upsert_df(target_df(spark, target), batch_df(spark, batch), SPEC, ts).collect()
    return sorted((tuple(r) for r in out), key=repr)


def test_batch_duplicates_first_insert_last_update(spark):
    out = run(spark, [], [(1, 1, 10, 100, "a"), (1, 1, 20, 200, "b"), (1, 1, 30, None, "c")])
    assert out == [(1, 1, 10, None, "c", T1)]


def test_matched_null_overwrites_and_insert_only_kept(spark):
    out = run(spark, [(1, 1, 10, 100, "a", T0)], [(1, 1, 99, None, None)])
    assert out == [(1, 1, 10, None, None, T1)]


def test_null_key_inserted_every_time(spark):
    once = U.upsert_df(target_df(spark, []), batch_df(spark, [(None, 1, 1, 1, "x")]), SPEC, T1)
    twice = U.upsert_df(once, batch_df(spark, [(None, 1, 1, 1, "x")]), SPEC, T2)
    assert sorted(r._loaded_at for r in twice.collect()) == [T1, T2]


def test_untouched_rows_keep_load_time_and_empty_batch_is_noop(spark):
    out = run(spark, [(1, 1, 1, 1, "a", T0), (2, 2, 2, 2, "b", T0)], [(2, 2, 9, 9, "z")])
    assert (1, 1, 1, 1, "a", T0) in out and (2, 2, 2, 9, "z", T1) in out
    assert run(spark, [(1, 1, 1, 1, "a", T0)], []) == [(1, 1, 1, 1, "a", T0)]


small = st.one_of(st.none(), st.integers(0, 2))
val = st.one_of(st.none(), st.integers(0, 9))
brow = st.tuples(small, small, val, val, st.sampled_from([None, "p", "q"]))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2)), unique=True, max_size=5),
       nullkeys=st.integers(0, 2), batch=st.lists(brow, max_size=12))
def test_property_matches_row_by_row_merge(spark, keys, nullkeys, batch):
    target = [(a, b, a * 10 + b, a + b, "t", T0) for a, b in keys]
    target += [(None, n, n, n, "n", T0) for n in range(nullkeys)]
    assert run(spark, target, batch) == merge_loop(target, batch, T1)


# ---- table form ------------------------------------------------------------------------------------

PSCHEMA = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("k", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("score", T.LongType()), T.StructField("_loaded_at", T.TimestampNTZType()),
])
PSPEC = U.UpsertSpec("p", PSCHEMA, ("day", "k"), ("score",), partition_by="day")


def pbatch(spark, rows):
    return spark.createDataFrame([r + (n,) for n, r in enumerate(rows)],
                                 "day date, k bigint, name string, score bigint, _seq bigint")


def files_of(path):
    out = {}
    for root, _, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.join(root, f)] = os.path.getmtime(os.path.join(root, f))
    return out


def test_table_rewrites_only_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/p"
    assert U.upsert_table(spark, path, pbatch(spark, []), PSPEC, T0) == 0
    assert not path_exists(spark, path)  # empty batch: table not even created
    U.upsert_table(spark, path, pbatch(spark, [(d("2024-01-01"), 1, "a", 1), (d("2024-01-02"), 1, "a", 2)]),
                   PSPEC, T0)
    before = files_of(path)
    day1 = {f: m for f, m in before.items() if "day=2024-01-01" in f}
    U.upsert_table(spark, path, pbatch(spark, [(d("2024-01-02"), 1, "b", 5), (None, 7, "n", 7)]), PSPEC, T1)
    after = files_of(path)
    assert {f: m for f, m in after.items() if "day=2024-01-01" in f} == day1
    rows = sorted((tuple(r) for r in read_table(spark, path, PSCHEMA).collect()), key=repr)
    assert rows == sorted([(d("2024-01-01"), 1, "a", 1, T0), (d("2024-01-02"), 1, "a", 5, T1),
                           (None, 7, "n", 7, T1)], key=repr)
    # the NULL-key row is inserted again on a re-run; the keyed row is just re-stamped
    U.upsert_table(spark, path, pbatch(spark, [(d("2024-01-02"), 1, "b", 5), (None, 7, "n", 7)]), PSPEC, T2)
    rows = read_table(spark, path, PSCHEMA).collect()
    assert len(rows) == 4 and sorted(r._loaded_at for r in rows if r.day is None) == [T1, T2]


def test_older_day_replayed_after_newer_wins(spark, tmp_dir):
    path = f"{tmp_dir}/f"
    # key without the partition column: the stored row keeps its first day and partition
    spec = U.UpsertSpec("f", PSCHEMA, ("k",), ("score",), partition_by="day")
    U.upsert_table(spark, path, pbatch(spark, [(d("2024-01-05"), 1, "a", 5), (d("2024-01-06"), 2, "x", 1)]),
                   spec, T1)
    day6 = {f: m for f, m in files_of(path).items() if "day=2024-01-06" in f}
    assert U.upsert_table(spark, path, pbatch(spark, [(d("2024-01-03"), 1, "b", 3)]), spec, T2) == 2
    rows = sorted((tuple(r) for r in read_table(spark, path, spec.schema).collect()), key=repr)
    assert rows == sorted([(d("2024-01-05"), 1, "a", 3, T2), (d("2024-01-06"), 2, "x", 1, T1)], key=repr)
    assert {f: m for f, m in files_of(path).items() if "day=2024-01-06" in f} == day6


def test_upsert_plan_shuffles_target_once_and_batch_once(spark):
    t = target_df(spark, [(1, 1, 1, 1, "a", T0)])
    b = batch_df(spark, [(1, 1, 2, 2, "b")])
    plan = U.upsert_df(t, b, SPEC, T1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2, plan


@pytest.mark.parametrize("hot_rows", [100, 3])
def test_a_scattered_batch_gives_the_same_and_sends_its_rows_as_they_are(spark, hot_rows):
    rows = [(None if i % 17 == 0 else i % 23 if i % 3 else 5, i % 2, i, i * 7 if i % 4 else None, str(i)) for i in range(300)]
    target = target_df(spark, [(5, 1, -1, -1, "old", T0), (5, 0, -2, -2, "old", T0), (99, 1, 0, 0, "kept", T0), (None, 1, 3, 3, "n", T0)])
    out = U.upsert_df(target, batch_df(spark, rows), SPEC, T1, scattered=True, hot_rows=hot_rows)
    want = merge_loop([tuple(r) for r in target.collect()], rows, T1)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    tied = batch_df(spark, rows).withColumn("_seq", F.when(F.col("_seq") == 299, 298).otherwise(F.col("_seq")))
    tied = tied.withColumn("k1", F.when(F.col("_seq") == 298, 1000).otherwise(F.col("k1"))).withColumn("k2", F.lit(0).cast("bigint"))
    with pytest.raises(Exception, match="the batch order has a tie"):
        U.upsert_df(target, tied, SPEC, T1, scattered=True, hot_rows=hot_rows).collect()


def test_lines_of_a_fixture_are_folded_where_they_meet(spark, tmp_dir):
    spark.range(40).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus",
                               "TIMESTAMP'1995-06-01 00:00:00' + make_interval(0, 0, 0, CAST(id * 30 AS INT)) AS o_orderdate") \
        .write.parquet(f"{tmp_dir}/orders.parquet")
    spark.range(160).selectExpr(
        "id % 40 AS l_orderkey", "id % 11 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id DIV 40 + 1 AS INT) AS l_linenumber",
        "1D AS l_quantity", "2D AS l_extendedprice", "0D AS l_discount", "0D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus",
        "TIMESTAMP'1996-01-01 00:00:00' AS l_shipdate").write.parquet(f"{tmp_dir}/lineitem.parquet")
    out = q_upsert_batch_dups(spark, tmp_dir)
    rows = {r.fixture_id: r for r in out.collect()}
    assert len(rows) == 40 and {r.home_goals for r in rows.values()} == {4}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    sent = plan[plan.index("REPARTITION_BY_COL"):]
    assert "Union" in sent and "Aggregate" not in sent  # no partial aggregates, several times as wide as the rows


def test_hot_key_holding_a_third_of_the_batch(spark):
    """One key with a third of 60k batch rows: folded exactly, pre-aggregated before the shuffle."""
    n = 60000
    b = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("k1"),
        F.lit(1).cast("bigint").alias("k2"),
        F.col("id").alias("i"), (F.col("id") * 2).alias("u"), F.col("id").cast("string").alias("v"),
        F.col("id").alias("_seq"))
    out = U.upsert_df(target_df(spark, [(7, 1, -1, -1, "old", T0)]), b, SPEC, T1)
    hot = out.where("k1 = 7").collect()
    assert [(r.i, r.u, r.v, r._loaded_at) for r in hot] == [(-1, 2 * (n - 3), str(n - 3), T1)]
    assert out.count() == 1 + (n - n // 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan or "partial_max_by" in plan or plan.count("SortAggregate") >= 2


def test_stored_keys_are_located_in_the_index_of_an_existing_table(spark, tmp_dir):
    path = f"{tmp_dir}/idx"
    spark.range(1000).selectExpr("date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) AS day", "id AS k", "'n' AS name",
                                 "id AS score", "CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) AS _loaded_at") \
        .write.partitionBy("day").parquet(path)
    spec = U.UpsertSpec("f", PSCHEMA, ("k",), ("score",), partition_by="day")
    batch = pbatch(spark, [(d("2024-03-01"), 5, "x", 1), (d("2024-03-01"), 77, "y", 2)])
    assert U.upsert_table(spark, path, batch, spec, T1, leaf_rows=100) == 3  # two stored days and the batch's own
    rows = read_table(spark, path, PSCHEMA)
    assert rows.count() == 1000 and {(r.day, r.k, r.score) for r in rows.where("_loaded_at > '2024-01-02'").collect()} \
        == {(d("2024-01-06"), 5, 1), (d("2024-01-18"), 77, 2)}
    index = KeyIndex(spark, commits.current(spark, path), PSCHEMA, ("k",), "day")
    assert sum(r["n"] for r in index.leaves) == 1000 and len(index.leaves) >= 10
    found = index.located(batch)
    assert sorted(r[1] for r in found.collect()) == [d("2024-01-06"), d("2024-01-18")]
    assert len(found.inputFiles()) <= 2, found.inputFiles()


day = st.sampled_from([d("2024-01-01"), d("2024-01-02"), d("2024-01-03")])
trow = st.tuples(day, st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b"]), val)


@pytest.mark.parametrize("keys", [("k",), ("day", "k")])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(st.lists(trow, max_size=6), min_size=1, max_size=3))
def test_property_table_path_matches_row_by_row_merge(spark, tmp_path_factory, keys, batches):
    """Batches applied one after another through upsert_table equal the MERGE loop, whether the
    partition column is insert-only (rows stay in the partition of their first day) or in the key
    (the touched partitions' directories are read directly)."""
    path = str(tmp_path_factory.mktemp("prop") / "t")
    spec = U.UpsertSpec("f", PSCHEMA, keys, ("score",), partition_by="day")
    model = []
    for n, batch in enumerate(batches):
        ts = [T0, T1, T2][n]
        U.upsert_table(spark, path, pbatch(spark, batch), spec, ts)
        for dday, k, name, score in batch:
            row = {"day": dday, "k": k}
            hits = [r for r in model if all(row[c] is not None and r[c] == row[c] for c in keys)]
            if hits:
                for r in hits:
                    r["score"], r["_loaded_at"] = score, ts
            else:
                model.append(dict(day=dday, k=k, name=name, score=score, _loaded_at=ts))
    expected = sorted((tuple(r[c] for c in PSCHEMA.fieldNames()) for r in model), key=repr)
    got = sorted((tuple(r) for r in read_table(spark, path, spec.schema).collect()), key=repr) \
        if model else []
    assert got == expected
