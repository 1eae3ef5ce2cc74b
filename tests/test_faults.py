"""Crashes, odd paths, old files and new checkpoints: no landed or stored row is lost or applied twice."""

import datetime as dt
import glob
import json
import os

import pytest
from conftest import T0, T1, d
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_checks_stream import player_doc

from snapmart.operators import upsert as U
from snapmart.operators.keyindex import KeyIndex
from snapmart.sources import commits
from snapmart.sources import landing as L
from snapmart.sources import rawstore as R
from snapmart.streaming.ingest import query_id, stream_upsert

TS_SPEC = U.UpsertSpec("t", T.StructType([
    T.StructField("at", T.TimestampNTZType()), T.StructField("id", T.LongType()), T.StructField("x", T.LongType()),
    T.StructField("_loaded_at", T.TimestampNTZType())]), ("at", "id"), ("x",), partition_by="at")
DAY_SPEC = U.UpsertSpec("t", T.StructType([
    T.StructField("day", T.DateType()), T.StructField("id", T.LongType()), T.StructField("x", T.LongType()),
    T.StructField("_loaded_at", T.TimestampNTZType())]), ("day", "id"), ("x",), partition_by="day")


def batch(spark, spec, rows):
    schema = T.StructType([f for f in spec.schema.fields if f.name != "_loaded_at"] + [T.StructField("_seq", T.LongType())])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


def stored(spark, path, spec):
    return sorted(((r.id, r.x) for r in R.read_table(spark, path, spec.schema).collect()), key=repr)


@pytest.mark.parametrize("folder", ["plain", "raw[prod]", "raw{a,b}", "raw*x"])
def test_timestamp_partitions_and_glob_characters_keep_stored_rows(spark, tmp_dir, folder):
    at = dt.datetime(2024, 1, 1, 6, 30)
    path = f"{tmp_dir}/{folder}"
    U.upsert_table(spark, path, batch(spark, TS_SPEC, [(at, 1, 1), (at, 2, 2)]), TS_SPEC, T0)
    U.upsert_table(spark, path, batch(spark, TS_SPEC, [(at, 1, 9)]), TS_SPEC, T1)
    assert stored(spark, path, TS_SPEC) == [(1, 9), (2, 2)]


ID_SPEC = U.UpsertSpec("t", DAY_SPEC.schema, ("id",), ("x",), partition_by="day")


class Died(Exception):
    pass


def dies(monkeypatch, at: str) -> None:
    """The next call dies at a step: before or after it writes data, index leaves, manifest, the commit itself."""
    def raising(*args, **kwargs):
        raise Died

    def after(owner, what):
        whole = getattr(owner, what)

        def run(*args, **kwargs):
            whole(*args, **kwargs)
            raise Died
        monkeypatch.setattr(owner, what, run)

    if at == "before the data":
        monkeypatch.setattr(U, "dealt", raising)
    elif at == "after the data":
        monkeypatch.setattr(KeyIndex, "updated", raising)
    elif at == "after the index":
        after(KeyIndex, "updated")
    elif at == "before the manifest":
        monkeypatch.setattr(commits, "commit", raising)
    elif at == "after the manifest":
        monkeypatch.setattr(commits, "committed", calls_then(commits.committed, 1, raising))
    elif at == "after the commit":
        monkeypatch.setattr(commits, "record_batch", calls_then(commits.record_batch, 1, raising))
    else:
        raise ValueError(at)


def calls_then(whole, n, other):
    left = [n]

    def run(*args, **kwargs):
        left[0] -= 1
        return (whole if left[0] >= 0 else other)(*args, **kwargs)
    return run


BEFORE = ["before the data", "after the data", "after the index", "before the manifest", "after the manifest"]


@pytest.mark.parametrize("at", [*BEFORE, "after the commit"])
def test_a_crash_at_any_step_and_then_another_batch_leaves_one_row_a_key(spark, tmp_dir, monkeypatch, at):
    path = f"{tmp_dir}/t"
    U.upsert_table(spark, path, batch(spark, ID_SPEC, [(d("2024-01-01"), 1, 10)]), ID_SPEC, T0)
    lost = batch(spark, ID_SPEC, [(d("2024-01-02"), 2, 1), (d("2024-01-05"), 1, 11), (d("2024-01-02"), None, 7)])
    with monkeypatch.context() as patched:
        dies(patched, at)
        with pytest.raises(Died):
            U.upsert_table(spark, path, lost, ID_SPEC, T0, name="q-1")
    committed = at == "after the commit"
    assert stored(spark, path, ID_SPEC) == ([(1, 11), (2, 1), (None, 7)] if committed else [(1, 10)])
    U.upsert_table(spark, path, batch(spark, ID_SPEC, [(d("2024-01-03"), 2, 2), (d("2024-01-03"), 3, 3)]), ID_SPEC, T1)
    U.upsert_table(spark, path, batch(spark, ID_SPEC, [(d("2024-01-04"), 2, 3)]), ID_SPEC, T1)
    rows = {(r.id, r.day, r.x) for r in R.read_table(spark, path, ID_SPEC.schema).where("id > 1").collect()}
    assert rows == {(2, d("2024-01-02" if committed else "2024-01-03"), 3), (3, d("2024-01-03"), 3)}
    # the batch that died is loaded again under its name: once in all
    U.upsert_table(spark, path, lost, ID_SPEC, T1, name="q-1")
    U.upsert_table(spark, path, lost, ID_SPEC, T1, name="q-1")
    want = [(1, 11), (2, 3 if committed else 1), (3, 3), (None, 7)]
    assert stored(spark, path, ID_SPEC) == sorted(want, key=repr)
    index = KeyIndex(spark, commits.current(spark, path), ID_SPEC.schema, ID_SPEC.keys, "day")
    assert sorted(r[0] for r in index.read(range(len(index.leaves))).collect()) == [1, 2, 3]


def test_a_reader_sees_the_table_before_or_after_an_upsert(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    days = [d(f"2024-01-{i:02d}") for i in range(1, 7)]
    U.upsert_table(spark, path, batch(spark, DAY_SPEC, [(x, 1, 1) for x in days]), DAY_SPEC, T0)
    open_ = R.read_table(spark, path, DAY_SPEC.schema)
    seen = []
    whole = commits.commit

    def look_first(*args, **kwargs):
        seen.append(stored(spark, path, DAY_SPEC))  # all files of the new state are written here
        return whole(*args, **kwargs)

    monkeypatch.setattr(commits, "commit", look_first)
    U.upsert_table(spark, path, batch(spark, DAY_SPEC, [(x, 1, 2) for x in days[1:]]), DAY_SPEC, T1)
    assert seen == [[(1, 1)] * 6]
    assert sorted((r.id, r.x) for r in open_.collect()) == [(1, 1)] * 6  # opened before, read after
    assert stored(spark, path, DAY_SPEC) == [(1, 1)] + [(1, 2)] * 5


def test_a_second_writer_is_refused(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    U.upsert_table(spark, path, batch(spark, DAY_SPEC, [(d("2024-01-01"), 1, 1)]), DAY_SPEC, T0)
    whole = U._write

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(U, "_write", whole)
        U.upsert_table(spark, path, batch(spark, DAY_SPEC, [(d("2024-01-01"), 2, 2)]), DAY_SPEC, T0)
        return whole(*args, **kwargs)

    monkeypatch.setattr(U, "_write", meanwhile)
    with pytest.raises(RuntimeError, match="another writer"):
        U.upsert_table(spark, path, batch(spark, DAY_SPEC, [(d("2024-01-01"), 3, 3)]), DAY_SPEC, T0)
    assert stored(spark, path, DAY_SPEC) == [(1, 1), (2, 2)]


def test_old_commits_go_and_the_last_ones_stay_readable(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    reads = []
    for i in range(5):
        U.upsert_table(spark, path, batch(spark, ID_SPEC, [(d("2024-01-01"), 1, i), (d(f"2024-01-{i + 2:02d}"), i + 2, i)]),
                       ID_SPEC, T0, keep=2)
        reads.append(R.read_table(spark, path, ID_SPEC.schema))
    assert len(commits.committed(spark, path)) == 2
    assert sorted((r.id, r.x) for r in reads[3].collect())[0] == (1, 3)
    assert stored(spark, path, ID_SPEC) == [(1, 4), (2, 0), (3, 1), (4, 2), (5, 3), (6, 4)]
    kept = glob.glob(f"{path}/_data/commit=*/day=2024-01-01")
    assert len(kept) == 2  # the day every batch rewrote, as of the last two commits
    index = KeyIndex(spark, commits.current(spark, path), ID_SPEC.schema, ID_SPEC.keys, "day")
    assert index.read(range(len(index.leaves))).count() == 6


def test_a_plain_table_is_taken_over(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = [(d("2024-01-01"), 1, 1, T0), (d("2024-01-02"), 2, 2, T0), (None, 3, 3, T0)]
    R.append_table(spark.createDataFrame(rows, DAY_SPEC.schema), path, ["day"])
    U.upsert_table(spark, path, batch(spark, ID_SPEC, [(d("2024-01-09"), 2, 9), (None, 4, 4)]), ID_SPEC, T1)
    got = {(r.id, r.day, r.x) for r in R.read_table(spark, path, ID_SPEC.schema).collect()}
    assert got == {(1, d("2024-01-01"), 1), (2, d("2024-01-02"), 9), (3, None, 3), (4, None, 4)}
    U.upsert_table(spark, path, batch(spark, ID_SPEC, [(d("2024-01-09"), 3, 8), (d("2024-01-09"), 1, 7)]), ID_SPEC, T1)
    assert stored(spark, path, ID_SPEC) == [(1, 7), (2, 9), (3, 8), (4, 4)]


def test_the_index_grows_by_splitting_leaves_and_a_batch_reads_its_own(spark, tmp_dir):
    path = f"{tmp_dir}/t"

    def load(lo, hi, step=1, day="2024-01-01"):
        rows = spark.range(lo, hi, step).selectExpr(f"DATE'{day}' AS day", "id", "id AS x", "id AS _seq")
        U.upsert_table(spark, path, rows, ID_SPEC, T0, leaf_rows=500)
        return KeyIndex(spark, commits.current(spark, path), ID_SPEC.schema, ID_SPEC.keys, "day", 500)

    first = load(0, 20_000, 2)
    assert 20 <= len(first.leaves) <= 60 and max(r["n"] for r in first.leaves) <= 750
    second = load(1, 20_000, 2, "2024-01-02")
    assert len(second.leaves) > len(first.leaves) and max(r["n"] for r in second.leaves) <= 750
    third = load(20_000, 20_010, 1, "2024-01-03")  # keys at the end touch one leaf
    assert len({(r["commit"], r["leaf"]) for r in third.leaves} - {(r["commit"], r["leaf"]) for r in second.leaves}) == 1
    assert sum(r["n"] for r in third.leaves) == 20_010
    lows = [r["least"][0] for r in third.leaves]
    assert lows == sorted(lows)
    near = third.located(spark.range(7000, 7200).toDF("id"))
    assert near.count() == 200 and len(near.inputFiles()) <= 4
    far = third.located(spark.createDataFrame([(-5,), (3,), (19_999,), (10 ** 9,)], "id long"))
    assert sorted((r[0], r[1]) for r in far.collect()) == [(3, d("2024-01-02")), (19_999, d("2024-01-02"))]
    assert len(far.inputFiles()) <= 4
    text = near._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in text.lower()  # the leaves' least keys are a constant


def test_a_cut_leaf_is_well_over_half_full(spark, tmp_dir):
    """Doubled, it is full however the cuts fell."""
    rows = spark.range(20_000).selectExpr("DATE'2024-01-01' AS day", "id", "id AS x", "id AS _seq")
    U.upsert_table(spark, f"{tmp_dir}/t", rows, ID_SPEC, T0, leaf_rows=500)
    leaves = KeyIndex(spark, commits.current(spark, f"{tmp_dir}/t"), ID_SPEC.schema, ID_SPEC.keys, "day", 500).leaves
    assert sum(r["n"] for r in leaves) == 20_000 and 300 < 20_000 / len(leaves) <= 340 and max(r["n"] for r in leaves) <= 500


def test_a_large_partition_is_written_by_several_tasks_and_small_ones_together(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(U, "PIECE_ROWS", 1000)
    path = f"{tmp_dir}/t"
    rows = spark.range(6000).selectExpr("IF(id < 4000, DATE'2024-01-01', date_add(DATE'2024-01-02', CAST(id % 20 AS INT))) AS day",
                                        "IF(id % 9 = 0, NULL, id) AS id", "id AS x", "id AS _seq")
    assert U.upsert_table(spark, path, rows, DAY_SPEC, T0) == 21
    assert 2 <= len(glob.glob(f"{path}/_data/commit=*/day=2024-01-01/*.parquet")) <= 4
    assert len(glob.glob(f"{path}/_data/commit=*/day=2024-01-02/*.parquet")) == 1
    assert commits.latest(spark, path).rows("day=2024-01-01") == 4000
    U.upsert_table(spark, path, batch(spark, DAY_SPEC, [(d("2024-01-01"), 1, -1), (None, 8, 8)]), DAY_SPEC, T1)
    got = R.read_table(spark, path, DAY_SPEC.schema)
    assert got.count() == 6001 and got.where("x = -1").count() == 1 and got.where("day IS NULL").count() == 1


@pytest.mark.parametrize("rows", [[(5, 1), (5, 2)], [(9, 1), (9, 2), (1, 5)], [(1, 1), (1, 2), (9, 5)]])
def test_a_tied_order_is_refused(spark, tmp_dir, rows):
    schema = "day date, id long, x long, _seq long"
    tied = spark.createDataFrame([(d("2024-01-01"), 1, x, s) for s, x in rows], schema)
    spec = U.UpsertSpec("t", DAY_SPEC.schema, ("id",), ("x",), partition_by="day")
    with pytest.raises(Exception, match="the batch order has a tie"):
        U.upsert_table(spark, f"{tmp_dir}/t", tied, spec, T0)
    assert commits.committed(spark, f"{tmp_dir}/t") == []


def test_a_tie_inside_a_hot_key_is_refused(spark):
    rows = spark.range(30_000).selectExpr(
        "DATE'2024-01-01' AS day", "IF(id % 3 = 0, 0L, id) AS id", "id AS x", "IF(id = 29997, 29994L, id) AS _seq")
    target = spark.createDataFrame([], DAY_SPEC.schema)
    with pytest.raises(Exception, match="the batch order has a tie"):
        U.upsert_df(target, rows, DAY_SPEC, T0).collect()
    whole = rows.withColumn("_seq", rows._seq + F.when(rows.x == 29997, 3).otherwise(0))
    assert U.upsert_df(target, whole, DAY_SPEC, T0).where("id = 0").first().x == 29997


def land(spark, root, pid, goals=1):
    L.land(spark.createDataFrame([(player_doc(pid, goals), d("2024-08-01"), 39, 2024)], L.DOC_SCHEMA), root, "players")


def test_a_second_checkpoint_on_the_same_table_applies_its_own_batches(spark, tmp_dir):
    table = f"{tmp_dir}/raw"
    for i, name in enumerate("ab"):
        land(spark, f"{tmp_dir}/{name}", i + 1)
        assert stream_upsert(spark, f"{tmp_dir}/{name}", "players", table, U.PLAYERS, L.flatten_players,
                             f"{tmp_dir}/ckpt-{name}", load_ts=T0) == 1
    assert sorted(r.player_id for r in R.read_table(spark, table, U.PLAYERS.schema).collect()) == [1, 2]
    assert query_id(spark, f"{tmp_dir}/ckpt-a") != query_id(spark, f"{tmp_dir}/ckpt-b")


def test_a_file_with_an_old_time_is_still_read(spark, tmp_dir):
    root, table, ckpt = f"{tmp_dir}/l", f"{tmp_dir}/raw", f"{tmp_dir}/c"
    land(spark, root, 1)
    assert stream_upsert(spark, root, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=T0) == 1
    before = set(glob.glob(f"{root}/players/**/*.txt", recursive=True))
    land(spark, root, 2)
    old = dt.datetime.now().timestamp() - 60 * 86400
    for f in set(glob.glob(f"{root}/players/**/*.txt", recursive=True)) - before:
        os.utime(f, (old, old))
    assert stream_upsert(spark, root, "players", table, U.PLAYERS, L.flatten_players, ckpt, load_ts=T0) == 1
    assert sorted(r.player_id for r in R.read_table(spark, table, U.PLAYERS.schema).collect()) == [1, 2]


def test_documents_of_one_file_are_applied_in_line_order(spark, tmp_dir):
    folder = f"{tmp_dir}/l/players/request_date=2024-08-01/league_id=39/season=2024"
    os.makedirs(folder)
    with open(f"{folder}/x.txt", "w") as f:
        f.write(player_doc(1, 1) + "\n" + player_doc(1, 2) + "\n" + player_doc(1, 3) + "\n")
    rows = L.stamp_snapshot(L.flatten_players(L.read_landed(spark, f"{tmp_dir}/l", "players")), "2024-08-01")
    assert rows.select("_seq").distinct().count() == 3
    U.upsert_table(spark, f"{tmp_dir}/raw", rows, U.PLAYERS, T0)
    assert [r.goals for r in R.read_table(spark, f"{tmp_dir}/raw", U.PLAYERS.schema).collect()] == [3]


def paged(player_id, goals, page):
    return json.dumps(json.loads(player_doc(player_id, goals)) | {"paging": {"current": page}})


@pytest.mark.parametrize("stream", [False, True])
def test_a_later_landing_wins_though_the_player_moves_to_an_earlier_page(spark, tmp_dir, stream):
    for landing, goals, page in (("2024-08-01T06", 1, 2), ("2024-08-01T18", 2, 1)):
        row = [(paged(1, goals, page), d("2024-08-01"), 39, 2024)]
        L.land(spark.createDataFrame(row, L.DOC_SCHEMA), f"{tmp_dir}/l", "players", landing)
    if stream:
        flatten = lambda docs: L.stamp_snapshot(L.flatten_players(docs), "2024-08-01")
        stream_upsert(spark, f"{tmp_dir}/l", "players", f"{tmp_dir}/raw", U.PLAYERS, flatten, f"{tmp_dir}/c", T0,
                      landing_ids=True)
    else:
        rows = L.stamp_snapshot(L.flatten_players(L.read_landed(spark, f"{tmp_dir}/l", "players")), "2024-08-01")
        U.upsert_table(spark, f"{tmp_dir}/raw", rows, U.PLAYERS, T0)
    assert [r.goals for r in R.read_table(spark, f"{tmp_dir}/raw", U.PLAYERS.schema).collect()] == [2]


def test_a_body_of_several_lines_is_one_document_of_a_whole_file(spark, tmp_dir):
    folder = f"{tmp_dir}/l/players/request_date=2024-08-01/league_id=39/season=2024"
    os.makedirs(folder)
    with open(f"{folder}/x.txt", "w") as f:
        f.write(json.dumps(json.loads(player_doc(1, 4)), indent=2))
    rows = L.flatten_players(L.read_landed(spark, f"{tmp_dir}/l", "players", d("2024-08-01"), whole_files=True))
    assert [r.goals for r in rows.collect()] == [4]


def test_a_rebuild_of_an_older_run_is_the_one_read(spark, tmp_dir):
    df = spark.range(3)
    R.publish_version(df, f"{tmp_dir}/m", "v20240802")
    R.publish_version(df.where("id > 0"), f"{tmp_dir}/m", "v20240801")
    assert R.read_latest(spark, f"{tmp_dir}/m", df.schema).count() == 2


def test_the_published_order_does_not_hang_on_file_times(spark, tmp_dir):
    df = spark.range(3)
    for n, v in enumerate(("b", "a", "c")):
        R.publish_version(df.where(f"id >= {n}"), f"{tmp_dir}/m", v)
    old = dt.datetime.now().timestamp() - 86400
    os.utime(f"{tmp_dir}/m/_versions/c/_SUCCESS", (old, old))
    os.makedirs(f"{tmp_dir}/m/_versions/dead")
    assert R.complete_versions(spark, f"{tmp_dir}/m") == ["b", "a", "c"]
    assert R.read_latest(spark, f"{tmp_dir}/m", df.schema).count() == 1
    assert R.drop_old_versions(spark, f"{tmp_dir}/m", keep=1) == 2
    R.publish_version(df, f"{tmp_dir}/m", "a")
    assert R.complete_versions(spark, f"{tmp_dir}/m") == ["c", "a"]
