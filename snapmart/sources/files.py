"""Paths and directories through the file system that an address names."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return bool(fs.exists(p))


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a directory; nothing if it is not there. (A few calls an entry: for short lists.)"""
    p, fs = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def literal(path: str) -> str:
    """A path as Spark's readers take it literally: they would expand glob characters in it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def partition_dir(column: str) -> Column:
    """The name of the directory that Spark writes a row to when ``column`` partitions a table."""
    return F.reflect(F.lit("org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils"),
                     F.lit("getPartitionPathString"), F.lit(column), F.col(column).cast("string"))
