"""The query table, allowlists, key sets and the source registry, as Spark reads them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.schema import QUERY_SCHEMA

REGISTRY_SCHEMA = T.StructType([
    T.StructField(c, T.StringType())
    for c in ("database_name", "split_name", "file_extension", "files_path")
])


def scan_query_table(spark: SparkSession, path: str, schema: T.StructType | None = QUERY_SCHEMA) -> DataFrame:
    """All Parquet files of the query table as one frame.

    With a schema, missing columns read as null and unknown ones are ignored.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        df = reader.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no query table at {path}") from error
    # The list of files is only asked for when there are no rows.
    if df.isEmpty() and not df.inputFiles():
        raise FileNotFoundError(f"no query table files at {path}")
    return df


def resolve_columns(columns: str | Sequence[str]) -> list[str]:
    """A non-empty list of column names from one name or several."""
    names = [columns] if isinstance(columns, str) else [str(c) for c in columns]
    if not names:
        raise ValueError("at least one allowlist column is needed")
    return names


def load_allowlist(source: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Exactly the identity columns of an allowlist table."""
    names = resolve_columns(columns)
    missing = [c for c in names if c not in source.columns]
    if missing:
        raise ValueError(f"allowlist lacks columns {missing}; it has {source.columns}")
    return source.select(*names)


def read_allowlist(spark: SparkSession, path: str, columns: str | Sequence[str]) -> DataFrame:
    """Allowlist from Parquet, or from CSV with a header."""
    if path.endswith(".csv"):
        source = spark.read.option("header", True).csv(path)
    elif path.endswith((".json", ".npy", ".npz", ".txt")):
        raise ValueError(f"unsupported allowlist type: {path}; use Parquet or CSV")
    else:
        source = spark.read.parquet(path)
    return load_allowlist(source, columns)


def load_keys(source: DataFrame, column: str = "entry_key") -> DataFrame:
    """A key set as one string column; keys nested in arrays are flattened."""
    kind = source.schema[column].dataType
    keys = F.col(column)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.ArrayType):
            keys = F.flatten(keys)
        source = source.select(F.explode(keys).alias("entry_key"))
        keys = F.col("entry_key")
    return source.select(keys.cast("string").alias("entry_key"))


def register_source(registry: DataFrame | None, entry: DataFrame) -> DataFrame:
    """The registry with one more source; the new descriptor replaces an equal pair."""
    entry = entry.select(*[F.col(c).cast("string") if c in entry.columns else F.lit(None).cast("string").alias(c)
                           for c in REGISTRY_SCHEMA.names])
    if registry is None:
        return entry
    kept = registry.join(entry, ["database_name", "split_name"], "left_anti")
    return kept.select(*REGISTRY_SCHEMA.names).unionByName(entry)


def source_registry(sources: DataFrame) -> DataFrame:
    """One descriptor per (database, split)."""
    return sources.groupBy("database_name", "split_name").agg(F.min("files_path").alias("files_path"))
