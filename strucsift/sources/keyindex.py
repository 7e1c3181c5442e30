"""Index of the entry keys of a table: what a batch must be checked against, without reading all keys.

The index lies beside the table, in partitions by a digest of the part of the key that names its file.
All keys of a file share a partition, so that a batch of a few files reads a few partitions, however
large the table is. A log tells which files of the table have been indexed. ``refresh`` adds those that
are not yet: nothing is lost or doubled when a run ends between writing rows and indexing them, and rows
that others appended are found too.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hex digits of a partition's digest: at most 4,096 partitions.
PREFIX_DIGITS = 3
KEY_SCHEMA, LOG_SCHEMA = "entry_key string, prefix string", "file string"


def key_prefix(key: Column) -> Column:
    """Partition of a key: a digest of the key without the number of its frame."""
    return F.substring(F.md5(F.regexp_replace(key, r"_\d+$", "").cast("binary")), 1, PREFIX_DIGITS)


def index_path(table: str) -> str:
    return f"{table.rstrip('/')}_keys"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``, none if there is nothing yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if (error.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        return None


def refresh(spark: SparkSession, table: str) -> int:
    """Index the files of the table that are not in the log and give their number.

    The driver holds names of files, as Spark's own listing of the table does. A run that ends
    before the log is written indexes some keys again, which does not matter.
    """
    rows, index = _read(spark, table, "entry_key string"), index_path(table)
    if rows is None:
        return 0
    log = _read(spark, f"{index}/log", LOG_SCHEMA)
    done = set() if log is None else {r.file for r in log.collect()}
    fresh = sorted(set(rows.inputFiles()) - done)
    if not fresh:
        return 0
    keys = spark.read.schema("entry_key string").parquet(*fresh).filter("entry_key IS NOT NULL")
    # Adaptive execution splits the partition of a dominant file.
    keys.withColumn("prefix", key_prefix(F.col("entry_key"))).hint("rebalance", "prefix").write.mode("append").partitionBy(
        "prefix").parquet(f"{index}/keys")
    spark.createDataFrame([(f,) for f in fresh], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{index}/log")
    return len(fresh)


def known_keys(incoming: DataFrame, table: str) -> DataFrame | None:
    """Indexed keys in the partitions that the keys of ``incoming`` (a written table) belong to; none if there are none."""
    spark = incoming.sparkSession
    # At most 16 ** PREFIX_DIGITS values.
    held = [r.prefix for r in incoming.select(key_prefix(F.col("entry_key")).alias("prefix")).distinct().collect()]
    keys = _read(spark, f"{index_path(table)}/keys", KEY_SCHEMA)
    return None if keys is None else keys.filter(F.col("prefix").isin([p for p in held if p is not None])).select("entry_key")
