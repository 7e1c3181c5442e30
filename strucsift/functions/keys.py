"""Entry keys: self-describing pointers ``database_split_file_index``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_name(name: Column) -> Column:
    """Lower case, underscores to hyphens; used for database and split names."""
    return F.lower(F.translate(name, "_", "-"))


def build_key(database: Column, split: Column, file_name: Column, index: Column) -> Column:
    """Compose an entry key. Underscores of the file name become ``$``."""
    underscore = F.lit("_")
    return F.concat(
        database, underscore, split, underscore,
        F.translate(file_name, "_", "$"), underscore, index.cast("string"),
    )


def parse_key(key: Column, strict: bool = True) -> Column:
    """Struct ``(database_name, split_name, source_file_name, frame_idx)``.

    A key without exactly four parts, or with a non-integer index, raises in strict mode and
    is null otherwise. A ``$`` that was in the file name to begin with comes back as ``_``.
    """
    parts = F.split(key, "_")
    index = F.get(parts, F.lit(3)).try_cast("bigint")
    parsed = F.struct(
        F.get(parts, F.lit(0)).alias("database_name"),
        F.get(parts, F.lit(1)).alias("split_name"),
        F.translate(F.get(parts, F.lit(2)), "$", "_").alias("source_file_name"),
        index.alias("frame_idx"),
    )
    well_formed = (F.size(parts) == 4) & index.isNotNull()
    if not strict:
        return F.when(well_formed, parsed)
    problem = F.raise_error(F.concat(F.lit("not an entry key: "), key))
    return F.when(key.isNull(), None).when(well_formed, parsed).otherwise(problem)


def file_group(database: Column, split: Column, file_name: Column) -> Column:
    """Identifier of the source file an entry comes from."""
    return F.concat_ws("_", database, split, file_name)


def subset_from_name(database: Column, strict: bool = True) -> Column:
    """Split a raw name such as ``oc20_s2ef`` into ``(database_name, subset)``.

    The first alphanumeric token is the database; all others, joined by hyphens, the subset.
    """
    tokens = F.split(database, "[^a-zA-Z0-9]+")
    many = F.size(tokens) > 1
    parsed = F.struct(
        F.get(tokens, F.lit(0)).alias("database_name"),
        F.array_join(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1))), "-").alias("subset"),
    )
    if not strict:
        return F.when(many, parsed)
    problem = F.raise_error(F.concat(F.lit("no subset in database name: "), database))
    return F.when(database.isNull(), None).when(many, parsed).otherwise(problem)
