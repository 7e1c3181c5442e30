"""Per-frame sidecar files: headerless CSV lines ``sid,frame_number,ref_energy``.

A line belongs to the frame at the same place in the structure file of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strucsift.operators.ranking import rank_within
from strucsift.session import ship_package
from strucsift.sources.extxyz import decoded_lines

# Lines of a compressed sidecar that are held at once.
PART_LINES = 100_000
SIDECAR_SCHEMA = "oc_sid string, frame_number string, ref_energy double"


def sidecar_name(file_name: str) -> str:
    """Name of the sidecar of a structure file."""
    for suffix, other in ((".extxyz.xz", ".txt.xz"), (".extxyz", ".txt"), (".aselmdb", ".txt")):
        if file_name.endswith(suffix):
            return file_name[: -len(suffix)] + other
    return file_name


def _fields(line: Column) -> list[Column]:
    parts = F.split(F.trim(line), ",")
    return [
        F.get(parts, F.lit(0)).alias("oc_sid"), F.get(parts, F.lit(1)).alias("frame_number"),
        F.get(parts, F.lit(2)).try_cast("double").alias("ref_energy"),
    ]


def number_lines(lines: DataFrame) -> DataFrame:
    """Sidecar rows with their frame index, from text lines ``(path, block, at, value)``.

    ``block`` is the offset of the split in the file and ``at`` increases within it.
    """
    kept = lines.filter(F.length(F.trim("value")) > 0)
    placed = rank_within(kept, ["path"], [F.col("block")], ["at"], "frame_idx")
    return placed.select("path", "frame_idx", *_fields(F.col("value")))


def read_sidecar(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """All plain sidecar files below ``path``; no files give no rows."""
    text = spark.read.option("pathGlobFilter", glob).text(path)
    return number_lines(text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value"))


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            lines, first = (t for t in decoded_lines(bytes(content)) if t.strip()), 0
            while part := list(islice(lines, PART_LINES)):
                yield pd.DataFrame({"path": path, "frame_idx": range(first, first + len(part)), "value": part})
                first += len(part)


def read_sidecar_xz(spark: SparkSession, path: str, glob: str = "*.txt.xz") -> DataFrame:
    """All compressed sidecar files below ``path``, one task per file, decoded as a stream."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    lines = files.select("path", "content").mapInPandas(_decode, "path string, frame_idx bigint, value string")
    return lines.select("path", "frame_idx", *_fields(F.col("value")))


def resolve_sids(sidecar: DataFrame, mapping: DataFrame, strict: bool = False) -> DataFrame:
    """Sidecar rows with the mapping's columns and ``known``, false where the sid is not mapped.

    With ``strict`` such a row fails the job that reads it, naming the sid and, if the sidecar has its
    ``path``, the file. That needs no look at the data beforehand.
    """
    marked = mapping.withColumn("known", F.lit(True))
    rows = sidecar.join(marked, "oc_sid", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if not strict:
        return rows
    where = F.coalesce(F.col("path"), F.lit("a sidecar")) if "path" in sidecar.columns else F.lit("a sidecar")
    problem = F.concat(F.lit("sid "), F.coalesce("oc_sid", F.lit("null")), F.lit(" of "), where, F.lit(" is not in the mapping"))
    # As a filter, the check stays when its columns are not read.
    return rows.filter(F.when(~F.col("known"), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))


def unknown_sids(sidecar: DataFrame, mapping: DataFrame) -> DataFrame:
    """Sidecar rows whose sid the mapping lacks."""
    return sidecar.join(mapping, "oc_sid", "left_anti")


def attach_sidecar(structures: DataFrame, sidecar: DataFrame, columns: list[str],
                   on: list[str], strict: bool = False) -> DataFrame:
    """Overwrite structure columns by the sidecar's, frame by frame.

    A frame without a sidecar row keeps its own values. With ``strict`` a file without a sidecar fails the
    job that reads its first frame: ``on`` then ends with the number of the frame in its file, and a
    sidecar numbers its lines from 0, so that frame 0 lacks a row only where the sidecar is absent or empty.
    """
    extra = sidecar.select(*on, F.lit(True).alias("__met"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = structures.join(extra, on, "left")
    if strict:
        file = F.concat_ws("/", *[F.col(c).cast("string") for c in on[:-1]])
        absent = (F.col(on[-1]) == 0) & F.col("__met").isNull()
        problem = F.raise_error(F.concat(F.lit("no sidecar for "), file)).cast("boolean")
        joined = joined.filter(F.when(absent, problem).otherwise(F.lit(True)))
    return joined.withColumns({
        c: F.coalesce(F.col(f"__{c}"), F.col(c)) if c in structures.columns else F.col(f"__{c}")
        for c in columns
    }).drop("__met", *[f"__{c}" for c in columns])


def files_without_sidecar(structures: DataFrame, sidecar: DataFrame, file_columns: list[str]) -> DataFrame:
    """Source files for which no sidecar row exists."""
    return structures.select(*file_columns).distinct().join(
        sidecar.select(*file_columns).distinct(), file_columns, "left_anti")
