"""Export stage: entry keys back to raw structures, as training records in parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.functions.keys import file_group, parse_key
from strucsift.functions.vectors import voigt_to_full
from strucsift.operators.fields import EXPORT_MAPS
from strucsift.operators.info import typed_field
from strucsift.operators.ranking import rank_within
from strucsift.plans.select import fetch
from strucsift.session import cut_lineage

LOCATION = ["database_name", "split_name", "source_file_name", "frame_idx"]
SOURCE = ["database_name", "split_name"]
# Leading letters by which source files are ordered apart from each other.
PREFIX = 24


def locate(keys: DataFrame, strict: bool = True) -> DataFrame:
    """Distinct keys with the location each one spells out.

    A parsed key has all four parts. Saying so keeps the optimizer from repeating the parse in
    null checks that it would push down to where the key is made.
    """
    parsed = keys.select("entry_key").filter(F.col("entry_key").isNotNull()).distinct().withColumn(
        "at", parse_key(F.col("entry_key"), strict))
    if not strict:
        parsed = parsed.filter(F.col("at").isNotNull())
    return parsed.select(
        "entry_key",
        *[F.coalesce(F.col(f"at.{c}"), F.lit("")).alias(c) for c in LOCATION[:3]],
        F.coalesce(F.col("at.frame_idx"), F.lit(-1)).alias("frame_idx"))


def unregistered_keys(keys: DataFrame, registry: DataFrame) -> DataFrame:
    """Keys whose (database, split) no registered source provides."""
    return locate(keys).join(registry.select(*SOURCE).distinct(), SOURCE, "left_anti").select("entry_key", *SOURCE)


def lookup_records(keys: DataFrame, structures: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Raw structure of every key; a key without one fails the job.

    With a registry, a key of an unregistered source fails it as such.
    """
    located = locate(keys)
    if registry is not None:
        known = registry.select(*SOURCE).distinct().withColumn("__known", F.lit(True))
        problem = F.raise_error(F.concat(F.lit("no registered source for key "), F.col("entry_key")))
        located = located.join(known, SOURCE, "left").filter(
            F.when(F.col("__known"), F.lit(True)).otherwise(problem)).drop("__known")
    found = structures.drop("entry_key").withColumn("__found", F.lit(True))
    missing = F.raise_error(F.concat(F.lit("no structure for key "), F.col("entry_key")))
    return located.join(found, LOCATION, "left").filter(
        F.when(F.col("__found"), F.lit(True)).otherwise(missing)).drop("__found")


def retrieve_field(keys: DataFrame, structures: DataFrame, field: str) -> DataFrame:
    """One raw field of every key that the query table does not carry."""
    value = F.col(field) if field in structures.columns else F.col("info")[field]
    return lookup_records(keys, structures).select("entry_key", value.alias(field))


def attach_extras(records: DataFrame, table: DataFrame, columns: Sequence[str],
                  keys: DataFrame | None = None) -> DataFrame:
    """Attach query-table columns as the struct ``extras``; null where the table has no row.

    Should a key repeat in the table, one of its rows is taken. ``keys`` are the records' keys
    where they are at hand, so that the records need not be made twice.
    """
    names = [c for c in columns if c != "entry_key"]
    extras = (
        fetch(table, records if keys is None else keys, names)
        .select("entry_key", F.struct(*names).alias("extras"))
        .groupBy("entry_key").agg(F.max("extras").alias("extras"))
    )
    return records.join(extras, "entry_key", "left")


def stress_tensor(stress: Column) -> Column:
    """Always 3×3: six Voigt components are expanded, nine values reshaped."""
    rows = F.array(*[F.slice(stress, 3 * i + 1, 3) for i in range(3)])
    return F.when(F.size(stress) == 6, voigt_to_full(stress)).when(F.size(stress) == 9, rows)


def training_records(records: DataFrame, field_map: Mapping[str, str], typed: bool = False) -> DataFrame:
    """Structure rows as training records. A structure without forces fails the job.

    Mapped fields are texts, or with ``typed`` have the types of their format: integers, numbers and
    lists (``operators.info``). One that a structure lacks is null, as nothing is stored for it.
    """
    problem = F.raise_error(F.concat(F.lit("no forces for "), F.col("entry_key")))
    value = (lambda source: typed_field(records, source)) if typed else (lambda source: F.col("info")[source])
    mapped = [value(source).alias(target) for source, target in field_map.items() if source != "stress"]
    return records.select(
        "entry_key",
        F.col("numbers").alias("elements"), "positions",
        F.when(F.col("forces").isNull(), problem).otherwise(F.col("forces")).alias("forces"),
        F.transform("pbc", lambda p: p.cast("float")).alias("pbc"),
        "energy", stress_tensor(F.col("stress")).alias("stress"),
        *mapped,
        *([F.col("extras")] if "extras" in records.columns else []),
    )


def plan_parts(keys: DataFrame, n_parts: int) -> DataFrame:
    """Give each key its part: source files in order, cut into contiguous runs.

    Only the list of source files is ordered, those of one name prefix at a time; keys get their
    part by a join on the file.
    """
    located = locate(keys).withColumn(
        "file_group", file_group(*[F.col(c) for c in LOCATION[:3]]))
    files = located.select("file_group").distinct()
    # One row per source file.
    ranked = rank_within(files, [], [F.substring("file_group", 1, PREFIX)], ["file_group"], "rank").withColumn(
        "n_groups", files.agg(F.count(F.lit(1))).scalar())
    parts = F.least(F.lit(n_parts), F.col("n_groups"))
    # Part p starts at group floor(p * G / F); the last start at or before the rank is its part.
    part = F.ceil((F.col("rank") + 1) * parts / F.col("n_groups")) - 1
    return located.join(ranked.select("file_group", part.cast("int").alias("part")), "file_group").select(
        "entry_key", "file_group", "part")


def keys_by_file(keys: DataFrame) -> DataFrame:
    """Keys with the source file they come from."""
    return locate(keys).select(file_group(*[F.col(c) for c in LOCATION[:3]]).alias("file_group"), "entry_key")


def part_name(stem: str, part: Column) -> Column:
    return F.concat(F.lit(f"{stem}_part_"), F.lpad(part.cast("string"), 3, "0"))


def remaining_parts(planned: DataFrame, written: DataFrame) -> DataFrame:
    """Planned keys of the parts that have not been written yet."""
    return planned.join(written.select("part").distinct(), "part", "left_anti")


def write_parts(records: DataFrame, path: str, resume: bool = False) -> None:
    """Write one folder per part; a part too large for one task gets several files.

    Refuses to touch an existing output. With ``resume`` the parts that are there are skipped.
    """
    if resume:
        spark = records.sparkSession
        try:
            records = remaining_parts(records, spark.read.parquet(path))
        except AnalysisException as error:
            # Nothing has been written so far.
            if (error.getCondition() or "") != "PATH_NOT_FOUND":
                raise
    records.hint("rebalance", "part").write.mode("append" if resume else "errorifexists").partitionBy("part").parquet(path)


def export(keys: DataFrame, structures: DataFrame, table: DataFrame | None = None,
           extras: Sequence[str] = (), n_parts: int = 1, field_map: Mapping[str, str] | None = None,
           registry: DataFrame | None = None) -> DataFrame:
    """Training records of the selected keys with their part number."""
    records = lookup_records(keys, structures, registry)
    if table is not None and extras:
        records = attach_extras(records, table, extras, keys)
    parts = plan_parts(keys, n_parts).select("entry_key", "part")
    return training_records(records, field_map or {}).join(parts, "entry_key")


def export_format(keys: DataFrame, structures: DataFrame, fmt: str, registry: DataFrame, table: DataFrame | None = None,
                  extras: Sequence[str] = (), n_parts: int = 1) -> DataFrame:
    """Training records of one format: its field map, typed, for keys whose sources are all registered.

    The keys are made once and written, since lookup, extras and parts all start from them.
    """
    keys = cut_lineage(keys.select("entry_key").filter(F.col("entry_key").isNotNull()).distinct(), "keys")
    records = lookup_records(keys, structures, registry)
    if table is not None and extras:
        records = attach_extras(records, table, extras, keys)
    parts = plan_parts(keys, n_parts).select("entry_key", "part")
    return training_records(records, EXPORT_MAPS[fmt], typed=True).join(parts, "entry_key")
