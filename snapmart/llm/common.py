"""Shared helpers: reading documents, word splitting, shared scratch tables, per-batch Arrow maps.

Every operator reads only its id and text columns, so extra columns of any name are ignored. A null
text counts as the empty text. A null id is kept as a null id; rows are never dropped for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.session import scratch_path

#: Fixed value: the separators around words, space and U+0009 to U+000D. ``bytes.split()`` splits at
#: exactly these, so words are taken from the UTF-8 bytes.
SEPARATORS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is cut there, and the
    table survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` and ``text``; null text becomes ''."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def map_texts(docs: DataFrame, id_col: str, text_col: str, columns: str,
              measure: Callable[[Iterator[str]], Iterator[tuple]]) -> DataFrame:
    """One output row per document: its id and the tuple ``measure`` yields for its text.

    ``measure`` is a generator over the texts of a task, so it can keep caches between documents.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _text_mapper(measure), f"doc_id {id_type(docs, id_col)}, {columns}")


def _text_mapper(measure):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(measure(iter(batch.column(1).to_pylist())))
            columns = list(zip(*rows)) if rows else []
            if columns:
                yield _batch([batch.column(0), *columns])
    return run


def _batch(columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
