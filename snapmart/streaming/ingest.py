"""Incremental ingest of landed feeds with Structured Streaming.

The landing directory is a file source: each run (``trigger(availableNow=True)``) consumes the
documents that arrived since the previous run, and the checkpoint records which files were consumed,
so it plays the role of the ingest watermark. Each micro-batch is flattened and upserted into the
RAW table with ``upsert_table`` (partition-local rewrite).

Exactly-once: a micro-batch's rows and the record that it was applied are one act of ``upsert_table``,
named by the query's own id (kept in its checkpoint) and the batch id. A batch that is replayed after a
failure is skipped or completed, never applied twice; a new checkpoint is a new query and shares no
names with an older one. Landed files never expire: however old their modification time, they are
read once. A deliberate re-landing of the same documents is new input and is applied again, as the
row-by-row loop would.

A micro-batch takes at most ``MAX_BYTES`` of documents, so a first run over a long history is several batches, each
committed by itself. The days of its documents are recorded with each batch (``upsert.load_record``): a day that
never came, or came twice, can be told from the table (``upsert.load_gaps``).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.upsert import UpsertSpec, upsert_table
from snapmart.sources import landing as L
from snapmart.sources.files import literal


#: The file source drops files this much older than the newest one; no landed file may be dropped.
MAX_FILE_AGE = "36500d"
#: Documents of a micro-batch unless the caller bounds files or bytes.
MAX_BYTES = 64 << 30


def stream_upsert(spark: SparkSession, landing_root: str, feed: str, table_path: str, spec: UpsertSpec,
                  flatten: Callable[[DataFrame], DataFrame], checkpoint: str,
                  load_ts: dt.datetime | None = None, query_name: str | None = None,
                  max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
                  archive_dir: str | None = None,
                  select: Callable[[DataFrame], DataFrame] | None = None,
                  landing_ids: bool = False, whole_files: bool = False) -> int:
    """Run one availableNow pass over the landing directory; returns the number of batches applied.

    ``select`` keeps the documents a run loads (the leagues and season of the batch path); none keeps all.
    ``max_files_per_trigger`` or ``max_bytes_per_trigger`` bounds each micro-batch, ``MAX_BYTES`` if neither is
    given (files are taken oldest first, so later landings still win). ``archive_dir`` moves consumed files out of the landing directory, which
    keeps the per-trigger listing small after years of landings; leave it unset when batch loads
    read the same landing directory. ``landing_ids``: whether the feed's landings have ids (``land``);
    ``whole_files``: whether a document is a file rather than a line.
    """
    schema = L.landed_text_schema()
    if landing_ids:
        schema = schema.add("landing", "string")
    reader = spark.readStream.format("text").schema(schema).option("maxFileAge", MAX_FILE_AGE).option(
        "wholetext", whole_files)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger or MAX_BYTES))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    docs = L.with_landing_order(reader.load(literal(f"{landing_root}/{feed}")))
    name = query_name or f"ingest_{spec.name}"
    applied = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        ts = load_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        batch = L.number_lines(batch)
        chosen = select(batch) if select else batch
        days = chosen.groupBy(F.col("request_date").alias("day")).agg(F.count("*").alias("documents"))
        if upsert_table(spark, table_path, flatten(chosen), spec, ts, days=days,
                        name=f"{query_id(spark, checkpoint)}-{batch_id}"):
            applied.append(batch_id)

    # the query name only has to be unique while it runs
    q = (docs.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).queryName(f"{name}-{uuid.uuid4().hex[:8]}").start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return len(applied)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query when it made this checkpoint."""
    return json.loads(spark.read.text(literal(f"{checkpoint}/metadata")).first()[0])["id"]
