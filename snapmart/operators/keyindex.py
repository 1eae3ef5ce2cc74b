"""A key index that grows with its table: which partition holds a key.

The index is a row of leaves, each a bounded number of keys next to each other in key order, with the least
key of every leaf in the commit's manifest. A key belongs to the last leaf that does not start above it,
found by binary search in the leaves' least keys (one number a leaf, so it travels as a constant). A batch
reads the leaves its keys belong to and no others. New keys are merged into their leaves, which are written
anew, and a leaf that became too large is split: there are no small files to gather later. Leaves belong to the
commit of the data they describe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.functions.clean import all_not_null
from snapmart.sources.commits import INDEX, Version, writer
from snapmart.sources.files import literal

LEAF_ROWS = 100_000
#: Steps of the binary search: 2**STEPS leaves at most.
STEPS = 24


class KeyIndex:
    """The index of one committed state of a table."""

    def __init__(self, spark: SparkSession, state: Version, schema: T.StructType, keys: Sequence[str], part: str,
                 leaf_rows: int = LEAF_ROWS):
        self.spark, self.state, self.keys, self.part, self.leaf_rows = spark, state, list(keys), part, leaf_rows
        self.key_type = T.StructType([schema[k] for k in keys])
        self.row_type = T.StructType([*self.key_type.fields, schema[part]])
        self.leaf_type = T.StructType([
            T.StructField("commit", T.StringType()), T.StructField("leaf", T.StringType()),
            T.StructField("least", self.key_type), T.StructField("n", T.LongType())])
        self.leaves = state.table(spark, "leaves", self.leaf_type).orderBy("least").collect()  # one row a leaf
        self._least = None

    def position(self) -> Column:
        """Number of the leaf that a row's key belongs to."""
        if self._least is None:
            leaves = self.spark.createDataFrame(self.leaves, self.leaf_type)
            text = leaves.agg(F.to_json(F.array_sort(F.collect_list("least")))).first()[0]
            self._least = F.from_json(F.lit(text), T.ArrayType(self.key_type))
        key = F.struct(*self.keys)
        steps = F.array(*[F.lit(1 << k) for k in range(min(STEPS, len(self.leaves).bit_length()), -1, -1)])
        starts = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= len(self.leaves)) & (F.get(self._least, at + step - 1) <= key), at + step).otherwise(at))
        return F.greatest(starts - 1, F.lit(0))

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows with a key, and the leaf they belong to."""
        at = self.position() if self.leaves else F.lit(0)
        return rows.where(all_not_null(*self.keys)).withColumn("_at", at)

    def read(self, positions: Sequence[int]) -> DataFrame:
        """The index rows of some leaves."""
        chosen = [self.leaves[i] for i in positions] if self.leaves else []
        if not chosen:
            return self.spark.createDataFrame([], self.row_type)
        base = f"{self.state.path}/{INDEX}"
        paths = [literal(f"{base}/commit={r['commit']}/leaf={r['leaf']}") for r in chosen]
        return self.spark.read.schema(self.row_type).option("basePath", base).parquet(*paths).select(*self.row_type.names)

    def located(self, batch: DataFrame) -> DataFrame:
        """(keys, partition) of the batch's keys that are stored."""
        wanted = self.placed(batch.select(*self.keys).distinct())
        at = [r[0] for r in wanted.select("_at").distinct().collect()]  # at most one row a leaf
        return self.read(at).join(wanted.select(*self.keys), self.keys, "left_semi")

    def updated(self, new: DataFrame, commit_id: str) -> DataFrame:
        """Write the leaves that ``new`` rows (keys that are not in the index, partition) belong to, and return
        the leaves of the whole index. Files go below ``commit_id`` and count when it is committed."""
        placed = self.placed(new.select(*self.row_type.names))
        grown = {r["_at"]: r["n"] for r in placed.groupBy("_at").agg(F.count("*").alias("n")).collect()}
        if not grown:
            return self.spark.createDataFrame(self.leaves, self.leaf_type)
        total = {at: n + (self.leaves[at]["n"] if self.leaves else 0) for at, n in grown.items()}
        # (cut to half its size, a leaf that then doubles would be full or not by the chance of the cuts)
        size = max(1, self.leaf_rows * 2 // 3)
        pieces = sum(-(-n // size) for n in total.values() if n > self.leaf_rows) + 1
        full = self.spark.createDataFrame([(at,) for at, n in total.items() if n > self.leaf_rows], "_at int") \
            .withColumn("_full", F.lit(True))
        rows = self.placed(self.read(sorted(grown))).unionByName(placed).join(F.broadcast(full), "_at", "left")
        # a leaf that is too large is cut where the key ranges of the tasks are cut
        leaf = F.concat_ws("-", "_at", F.when(F.col("_full"), F.spark_partition_id()))
        where = f"{self.state.path}/{INDEX}/commit={commit_id}"
        cut = rows.repartitionByRange(pieces, "_at", *self.keys).withColumn("leaf", leaf)
        writer(cut.select(*self.row_type.names, "leaf"), "leaf").parquet(where)
        written = self.spark.read.schema(T.StructType([*self.row_type.fields, T.StructField("leaf", T.StringType())])) \
            .parquet(literal(where)).groupBy("leaf").agg(F.min(F.struct(*self.keys)).alias("least"), F.count("*").alias("n"))
        kept = [r for i, r in enumerate(self.leaves) if i not in grown]
        return self.spark.createDataFrame(kept, self.leaf_type).unionByName(
            written.select(F.lit(commit_id).alias("commit"), "leaf", "least", "n"))
