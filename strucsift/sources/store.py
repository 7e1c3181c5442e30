"""Writing the query table and key sets: append with a key check, resume, merge."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.session import cut_lineage
from strucsift.sources import keyindex

Writer = Callable[[DataFrame, str], None]

# Folders of a table that is written by commits, and what its registry holds.
ROWS, REGISTRY = "rows", "registry"
COMMIT_SCHEMA = ("database_name string, split_name string, file_extension string, files_path string, batch string, "
                 "committed_at timestamp")


class KeyCollisionError(ValueError):
    """An incoming entry key is already in the table."""


def colliding_keys(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming keys that the table already holds."""
    return incoming.select("entry_key").join(existing.select("entry_key"), "entry_key", "left_semi")


def new_rows(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose key the table does not hold."""
    return incoming.join(existing.select("entry_key"), "entry_key", "left_anti")


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append(incoming: DataFrame, path: str, check_keys: bool = True, writer: Writer = _append,
           indexed: bool = False) -> None:
    """Append to the table at ``path``; any key that is there already rejects the whole batch.

    The batch is made once, into a scratch table, and checked there. An empty one writes nothing. With
    ``indexed`` the keys are looked up in the table's key index (``keyindex``) in place of the table,
    and a null key rejects the batch too.
    """
    spark = incoming.sparkSession
    incoming = cut_lineage(incoming, "incoming")
    if incoming.isEmpty():
        return
    if check_keys and indexed:
        if not incoming.filter(F.col("entry_key").isNull()).isEmpty():
            raise ValueError("rows without an entry key")
        keyindex.refresh(spark, path)
        known = keyindex.known_keys(incoming, path)
        if known is not None and not colliding_keys(incoming, known).isEmpty():
            raise KeyCollisionError(f"some keys are already in {path}")
    elif check_keys:
        try:
            existing = spark.read.schema("entry_key string").parquet(path)
        except AnalysisException as error:
            # A new table has no keys yet.
            if (error.getCondition() or "") != "PATH_NOT_FOUND":
                raise
            existing = None
        if existing is not None and not colliding_keys(incoming, existing).isEmpty():
            raise KeyCollisionError(f"some keys are already in {path}")
    writer(incoming, path)


def commit(rows: DataFrame, path: str, source: DataFrame, check_keys: bool = True) -> str:
    """Add a batch of rows and the descriptor of their source (one row) to the table at ``path`` at once.

    Rows go to a folder of their own, which no reader looks at until the registry names it. The
    registry's entry is one small file, written last: a run that fails before leaves the table and the
    registry as they were. Null keys, keys that repeat in the batch, and with ``check_keys`` keys that
    the table holds, reject the batch. Gives the batch's name; an empty batch registers the source alone.
    """
    spark = rows.sparkSession
    batch = uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/{ROWS}/{batch}"
    rows.write.parquet(folder)
    keys = spark.read.schema("entry_key string").parquet(folder)
    if not keys.filter(F.col("entry_key").isNull()).isEmpty():
        raise ValueError("rows without an entry key")
    if not keys.groupBy("entry_key").count().filter("count > 1").isEmpty():
        raise KeyCollisionError("keys repeat in the batch")
    existing = committed(spark, path, "entry_key string") if check_keys else None
    if existing is not None and not colliding_keys(keys, existing).isEmpty():
        raise KeyCollisionError(f"some keys are already in {path}")
    entry = source.withColumn("batch", F.lit(batch)).withColumn("committed_at", F.current_timestamp())
    entry.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/{REGISTRY}")
    return batch


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """All registered batches of the table at ``path`` with their sources; none if nothing was committed."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).json(f"{path.rstrip('/')}/{REGISTRY}")
    except AnalysisException as error:
        if (error.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        return None


def committed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The rows of all committed batches; none if nothing was committed."""
    registry = read_registry(spark, path)
    # One row per run that was committed.
    batches = [] if registry is None else sorted(r.batch for r in registry.select("batch").distinct().collect())
    if not batches:
        return None
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{ROWS}/{b}" for b in batches])


def save_keys(keys: DataFrame, path: str, settings: dict[str, str] | None = None) -> None:
    """Write a key set and, beside it, the settings of the query that made it.

    The keys are made once and checked before anything is written to ``path``.
    """
    spark = keys.sparkSession
    keys = cut_lineage(keys.select("entry_key"), "keys")
    if keys.isEmpty():
        raise ValueError("the query matched no entries")
    keys.write.parquet(path)
    if settings is not None:
        row = spark.range(1).select(F.to_json(F.create_map(
            *[F.lit(str(x)) for kv in settings.items() for x in kv])).alias("value"))
        row.write.text(f"{path.rstrip('/')}_settings")


def distinct_keys(keys: DataFrame) -> DataFrame:
    return keys.select("entry_key").distinct()


def merge_shards(*shards: DataFrame) -> DataFrame:
    """Union of disjoint shards; a key that occurs in two of them is an error at run time."""
    merged = shards[0]
    for shard in shards[1:]:
        merged = merged.unionByName(shard)
    repeated = merged.groupBy("entry_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    n_repeated = repeated.agg(F.count(F.lit(1))).scalar()
    guard = F.when(n_repeated > 0, F.raise_error(F.lit("shards share entry keys"))).otherwise(F.lit(True))
    return merged.filter(guard)
