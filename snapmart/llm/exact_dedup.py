"""Exact deduplication over an extendible-hash index on shared files, in DataFrame operations only.

1. Entries: each row's 64-bit key (the hash of its normalised text), digest and id, one shared table.
2. Directory: starting at depth ``MIN_DEPTH``, every bucket with more than ``capacity`` distinct keys is
   split by doubling the directory, one more leading key bit at a time. It has as many bits as the entries can
   need (``directory_bits``); slots of an unsplit bucket point to the same bucket. Up to 2 ** MAX_DEPTH slots
   are broadcast; a larger directory is joined like any other table.
3. Pages: the directory routes every text to its bucket. There texts are grouped by bucket, key and bytes, so
   equal keys are told apart by comparing bytes. Copies are combined before the shuffle; a hot text sends one
   row per task. Owner tasks then take ranges of buckets and keys, and chain texts whose keys collide.
4. Every entry finds its bucket in the directory and its page there by key and digest. The join's hot side is
   splittable. Of the rows of a page the one with the largest id, and of those the first, stays: an aggregate,
   however often a row is repeated.

Texts are equal when identical after lower-casing A-Z only. Defined results: a null text equals the
empty text; the row with the largest id stays (a null id only where no other is there); of rows that
repeat both id and text one stays; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import id_and_text, stored

MIN_DEPTH, MAX_DEPTH = 4, 16
#: Distinct keys above which a bucket is split.
CAPACITY = 1024


def normalised(text):
    """A-Z lower-cased, everything else as it is. Where all is ASCII the plain lower() does that."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = id_and_text(docs, id_col, text_col).withColumn("norm", normalised(F.col("text"))).drop("text")
    return texts.withColumn("key", F.xxhash64("norm"))


def directory_bits(rows: int, capacity: int = CAPACITY) -> int:
    """Leading key bits that tell buckets of this many entries apart. Keys are hashes, so a few bits more than
    even buckets would need are enough."""
    return max(MAX_DEPTH, (rows // max(1, capacity)).bit_length() + 3)


def slot(key, bits: int = MAX_DEPTH):
    return F.shiftrightunsigned(key, 64 - bits)


def entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, sha, and a number of its own for each row."""
    return stored(keyed(docs, id_col, text_col).select(
        "doc_id", "key", F.sha2("norm", 256).alias("sha"), F.monotonically_increasing_id().alias("row")), "dedup_entries")


def directory(index_entries: DataFrame, capacity: int = CAPACITY, bits: int = MAX_DEPTH) -> DataFrame:
    """slot -> bucket and its depth, 2 ** ``bits`` rows, after all splits."""
    cells = index_entries.select("key").distinct().groupBy(slot(F.col("key"), bits).alias("cell")).agg(
        F.count("*").alias("n"))
    levels = cells.select("n", "cell", F.explode(F.sequence(F.lit(MIN_DEPTH), F.lit(bits))).alias("depth"))
    filled = levels.groupBy("depth", F.expr(f"shiftright(cell, {bits} - depth)").alias("prefix")).agg(
        F.sum("n").alias("n"))
    filled = stored(filled, "dedup_levels")
    split = filled.where((F.col("n") > capacity) & (F.col("depth") < bits)).select(
        (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    reached = filled.withColumn("parent", F.shiftright("prefix", 1)).join(split, ["depth", "parent"], "left_semi")
    reached = reached.drop("parent").unionByName(filled.where(F.col("depth") == MIN_DEPTH))
    buckets = reached.where((F.col("n") <= capacity) | (F.col("depth") == bits))
    first = F.expr(f"shiftleft(prefix, {bits} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {bits} - depth) - 1")
    return stored(buckets.select(F.explode(F.sequence(first, last)).alias("slot"), first.alias("bucket"), "depth"),
                  "dedup_directory")


def routed(rows: DataFrame, slots: DataFrame, bits: int) -> DataFrame:
    """Rows with a key, and the bucket that the directory sends them to."""
    slots = slots.select("slot", "bucket")
    slots = F.broadcast(slots) if bits <= MAX_DEPTH else slots
    return rows.withColumn("slot", slot(F.col("key"), bits)).join(slots, "slot").drop("slot")


def pages(docs: DataFrame, slots: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          bits: int = MAX_DEPTH) -> DataFrame:
    """One row per distinct text: bucket, key, chain position, digest, the id that stays, rows."""
    grouped = routed(keyed(docs, id_col, text_col), slots, bits).groupBy("bucket", "key", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    owned = grouped.select("bucket", "key", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size") \
        .repartitionByRange("bucket", "key")
    chain = Window.partitionBy("bucket", "key").orderBy("sha")
    same = Window.partitionBy("bucket", "key", "sha")
    chained = owned.withColumn("chain", F.row_number().over(chain)).withColumn("n", F.count("*").over(same))
    # two texts of one key and one digest can't be looked up by them: stop rather than merge them
    sure = F.when(F.col("n") == 1, F.col("sha")).otherwise(F.raise_error(F.lit("two texts share key and digest")))
    return stored(chained.withColumn("sha", sure).drop("n"), "dedup_pages")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain."""
    found = entries(docs, id_col, text_col)
    bits = directory_bits(found.count(), capacity)
    slots = directory(found, capacity, bits)
    placed = routed(found, slots, bits)
    first = placed.groupBy("bucket", "key", "sha").agg(F.max(F.struct("doc_id", -F.col("row"))).alias("m"))
    index = pages(docs, slots, id_col, text_col, bits).join(
        first.select("bucket", "key", "sha", (-F.col("m.col2")).alias("first")), ["bucket", "key", "sha"])
    return placed.join(index, ["bucket", "key", "sha"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"),
        F.col("sha").alias("text_sha256"), "bucket", "chain")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns unchanged."""
    found = entries(docs, id_col, text_col)
    bits = directory_bits(found.count(), capacity)
    slots = directory(found, capacity, bits)
    index = pages(docs, slots, id_col, text_col, bits)
    norm = normalised(F.coalesce(F.col(text_col), F.lit("")))
    tag = F.struct(F.xxhash64(norm).alias("key"), F.sha2(norm, 256).alias("sha"))
    rows = docs.select(F.struct("*").alias("all"), F.col(id_col).alias("id"), tag.alias("tag"))
    rows = routed(rows.select("all", "id", "tag.key", "tag.sha"), slots, bits).alias("d")
    stays = index.select("bucket", "key", "sha", "keep_id").alias("p")
    same = [F.col(f"d.{c}") == F.col(f"p.{c}") for c in ("bucket", "key", "sha")]
    kept = rows.join(stays, [*same, F.col("d.id").eqNullSafe(F.col("p.keep_id"))], "left_semi")
    return kept.dropDuplicates(["id", "bucket", "key", "sha"]).select("all.*")
