"""Raw structures landed as Parquet, the stand-in for the five database-file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strucsift.functions.keys import build_key, normalize_name
from strucsift.operators.ranking import rank_within
from strucsift.schema import STRUCTURE_SCHEMA

# Keys per numbering bucket when frames are numbered after landing.
FRAME_BUCKET = 65_536


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """Landed structures with normalised names and their entry key."""
    return with_entry_key(spark.read.schema(STRUCTURE_SCHEMA).parquet(path))


def with_entry_key(df: DataFrame) -> DataFrame:
    named = df.withColumns({c: normalize_name(F.col(c)) for c in ("database_name", "split_name")})
    return named.withColumn("entry_key", build_key(
        F.col("database_name"), F.col("split_name"), F.col("source_file_name"), F.col("frame_idx")))


def number_frames(df: DataFrame, order: str, file_columns: list[str], name: str = "frame_idx") -> DataFrame:
    """Position of each structure in its source file, by a unique integer ``order`` column.

    A file may hold a large part of all structures; see ``rank_within`` for how it is spread.
    """
    bucket = F.floor(F.col(order) / FRAME_BUCKET)
    return rank_within(df, file_columns, [bucket], [order], name)


def union_sources(*frames: DataFrame) -> DataFrame:
    """One table from several; a column that a source lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
