"""Typed Parquet tables: ensure, read, append, publish versions.

Tables are plain Parquet directories read with an explicit schema (no inference). Partitioned
tables list their partition columns in ``partition_by``; readers prune on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snapmart.sources import commits
from snapmart.sources.files import file_system as _fs
from snapmart.sources.files import listed, literal, path_exists


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: Sequence[str] = ()) -> bool:
    """Create an empty typed table if none exists; an existing table is never altered.

    Returns True when the table was created.
    """
    if path_exists(spark, path):
        return False
    empty = spark.createDataFrame([], schema)
    w = empty.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Full typed scan (filters and projections applied later reach the Parquet reader). Of a table with
    commits it is the state of the newest one, whatever is committed while it is read."""
    state = commits.latest(spark, path)
    if state:
        return commits.read_directories(spark, state, schema)
    return spark.read.schema(schema).parquet(literal(path)).select(*schema.fieldNames())


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Cluster rows by the storage partition before a partitioned write.

    REBALANCE is an AQE-aware shuffle: partitions are cut to the advisory size, so a day that holds a
    third of the rows is split over several tasks, and small days are coalesced. Each task then writes
    few partition directories, instead of every task writing a small file into every directory.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = rebalanced(df, partition_by).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ------------------------------------------------------------------------------------------------
# versioned tables: a rebuild never exposes a half-written table
# ------------------------------------------------------------------------------------------------
# A full rebuild writes a new version directory under <path>/_versions/. Spark's job commit writes
# _SUCCESS into it last; then an empty file <path>/_versions/_order/<number>-<version> publishes it. Readers take
# the version published last, so a rebuild of an older run is read once it is published, and a copy of the table
# keeps its order whatever happens to file times; a job that dies before leaves the previous version in place.
# Versions from before such files existed come first, by the time of their _SUCCESS.

VERSIONS_DIR = "_versions"
ORDER_DIR = "_order"


def _published(spark: SparkSession, path: str) -> dict[str, int]:
    """The versions with an order file, and their numbers."""
    names = listed(spark, f"{path}/{VERSIONS_DIR}/{ORDER_DIR}")
    return {name.split("-", 1)[1]: int(name.split("-", 1)[0]) for name in names}


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed versions of a versioned table, in the order they were committed."""
    root, fs = _fs(spark, f"{path}/{VERSIONS_DIR}")
    if not fs.exists(root):
        return []
    jvm = spark.sparkContext._jvm
    numbers, found = _published(spark, path), []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
        if name != ORDER_DIR and st.isDirectory() and fs.exists(done):
            found.append((numbers.get(name, 0), fs.getFileStatus(done).getModificationTime(), name))
    return [name for *_, name in sorted(found)]


def publish_version(df: DataFrame, path: str, version: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a new version of the table at ``path`` and return a read of that version."""
    target = f"{path}/{VERSIONS_DIR}/{version}"
    w = rebalanced(df, partition_by).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    spark = df.sparkSession
    number = 1 + max(_published(spark, path).values(), default=0)
    order, fs = _fs(spark, f"{path}/{VERSIONS_DIR}/{ORDER_DIR}/{number:09d}-{version}")
    fs.create(order, False).close()
    return spark.read.schema(df.schema).parquet(literal(target)).select(*df.columns)


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest committed version of a versioned table."""
    versions = complete_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no committed version under {path}/{VERSIONS_DIR}")
    return read_table(spark, f"{path}/{VERSIONS_DIR}/{versions[-1]}", schema)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` committed versions; returns how many were removed."""
    versions = complete_versions(spark, path)
    old = versions[:-keep] if keep else versions
    numbers = _published(spark, path)
    for v in old:
        p, fs = _fs(spark, f"{path}/{VERSIONS_DIR}/{v}")
        fs.delete(p, True)
        if v in numbers:
            fs.delete(_fs(spark, f"{path}/{VERSIONS_DIR}/{ORDER_DIR}/{numbers[v]:09d}-{v}")[0], False)
    return len(old)
