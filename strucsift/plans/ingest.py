"""Raw files to the query table in one call: land, derive, append, register.

A format names its reader, and with it the fields to map and the functions that add more
(``transforms_for``). Frames become landed rows with the key their place spells out, rows are derived,
and both the rows and the descriptor of the source are committed together (``store.commit``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strucsift.operators.info import text_field
from strucsift.plans.formats import CATALYST_SOURCES, transforms_for
from strucsift.plans.process import process_landed
from strucsift.operators.atoms import explode_structures
from strucsift.schema import STRUCTURE_SCHEMA
from strucsift.session import cut_lineage
from strucsift.sources import extxyz, sidecar as sidecars, store
from strucsift.sources.landing import with_entry_key

# Info fields that the additional-field functions read, with their types.
REACTION_SOURCES = ("source", "reference_source")
CODES = {"class": "int", "anomaly": "int", "ref_energy": "double", "miller_index": "array<bigint>"}


def _read_parquet(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Landed Parquet files; a structure's number is its place in the file."""
    found = spark.read.schema(STRUCTURE_SCHEMA).option("pathGlobFilter", glob).parquet(path)
    own = [c for c in STRUCTURE_SCHEMA.names if c not in ("database_name", "split_name", "source_file_name", "frame_idx")]
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("frame_idx"), *own)


@dataclass(frozen=True)
class Format:
    """How files of a dataset format are found and read: ``read`` takes the session, the folder and a glob of
    file names, and gives path, frame_idx and a frame. ``written``: from a table that it has made, not from the files."""

    extension: str
    read: Callable[[SparkSession, str, str], DataFrame]
    written: bool = False


_PARQUET = Format("parquet", _read_parquet)
FORMATS = {
    "xyz": Format("extxyz", extxyz.read_extxyz, written=True),
    "xyz_oc": Format("extxyz.xz", extxyz.read_extxyz_xz),
    **{name: _PARQUET for name in ("aselmdb_omol", "aselmdb_omat", "aselmdb_odac", "aselmdb_omc", "aselmdb_oc")},
}


def format_of(name: str) -> Format:
    if name not in FORMATS:
        raise ValueError(f"unsupported database format: {name}; known: {sorted(FORMATS)}")
    return FORMATS[name]


def file_stem(path: Column, extension: str) -> Column:
    """The file's name without its folder and extension."""
    name = F.url_decode(F.element_at(F.split(path, "/"), -1))
    ending = F.lit(f".{extension}")
    return F.when(name.endswith(ending), F.substring(name, F.lit(1), F.length(name) - F.length(ending))).otherwise(name)


def land(frames: DataFrame, database_name: str, split_name: str, name: Column) -> DataFrame:
    """Frames (path, frame_idx, ...) as landed rows with their entry key, which is their ``sid`` too.

    ``name`` makes the name of the source file. An extended-XYZ frame keeps its other per-atom columns.
    """
    rows = frames.withColumns({
        "database_name": F.lit(database_name), "split_name": F.lit(split_name), "source_file_name": name})
    return with_entry_key(rows).drop("path").withColumn("sid", F.col("entry_key"))


def _catalyst_columns(df: DataFrame) -> DataFrame:
    """The slab's metadata as columns; those a sidecar or mapping gave already stay."""
    return df.withColumns({c: text_field(c, CODES.get(c, "string")) for c in CATALYST_SOURCES if c not in df.columns})


def _format_columns(fmt: str) -> list[Callable[[DataFrame], DataFrame]]:
    if fmt == "aselmdb_omol":
        return [lambda df: df.withColumns({c: text_field(c, "string") for c in REACTION_SOURCES})]
    return [_catalyst_columns] if fmt in ("aselmdb_oc", "xyz_oc") else []


def derive_frames(frames: DataFrame, fmt: str, database_name: str, split_name: str, name: Column | None = None,
                  metadata: Mapping[str, str] | None = None, sidecar: DataFrame | None = None, strict: bool = True,
                  graph: bool = False, atom_limit: int = 200, skip_subsets: Sequence[str] = (),
                  matches: DataFrame | None = None, written: bool = False) -> DataFrame:
    """Rows of the query table from frames of a format (path, frame_idx, numbers, positions, ...).

    Frames are read more than once and so written first, unless they come from a table already (``written``).
    ``sidecar`` (source_file_name, frame_idx, ...; see ``catalyst_sidecar``) gives columns that replace
    metadata of the same name. With ``strict`` a mapped field that a structure lacks fails the job and
    names those it has, and so does a file without a sidecar.
    """
    stem = name if name is not None else file_stem(F.col("path"), format_of(fmt).extension)
    landed = land(frames, database_name, split_name, stem)
    if not written:
        landed = cut_lineage(landed, "landed")
    atoms = explode_structures(landed, "sid").filter("z IS NOT NULL")
    before = _format_columns(fmt)
    if sidecar is not None:
        extra = [c for c in sidecar.columns if c not in ("source_file_name", "frame_idx")]
        before.append(lambda df: sidecars.attach_sidecar(
            df, sidecar, extra, ["source_file_name", "frame_idx"], strict))
    return process_landed(
        landed, fmt, metadata, [*before, *transforms_for(fmt, atoms, landed.select("sid", "cell"))],
        strict=strict, graph=graph, atom_limit=atom_limit, skip_subsets=skip_subsets, matches=matches)


def catalyst_sidecar(spark: SparkSession, path: str, mapping: DataFrame, strict: bool = True) -> DataFrame:
    """The compressed sidecars below ``path`` with the columns of ``mapping`` (oc_sid, ...), for ``derive_frames``.

    With ``strict`` a sid that the mapping lacks fails the job; else its row has the sidecar's columns only.
    """
    rows = sidecars.resolve_sids(sidecars.read_sidecar_xz(spark, path), mapping, strict)
    return rows.withColumn("source_file_name", file_stem(F.col("path"), "txt.xz")).drop("path", "known")


def process_files(spark: SparkSession, path: str, fmt: str, table: str, database_name: str, split_name: str,
                  check_keys: bool = True, glob: str | None = None, **options) -> None:
    """Process the files of one source below ``path`` into the table at ``table`` and register the source.

    Files are those with the format's extension, or of ``glob``. ``options`` go to ``derive_frames``. A run that fails leaves the table and its registry as they were.
    """
    how = format_of(fmt)
    frames = how.read(spark, path, glob or f"*.{how.extension}")
    rows = derive_frames(frames, fmt, database_name, split_name, written=how.written, **options)
    store.commit(rows, table, source_entry(spark, path, how.extension, database_name, split_name), check_keys)


def source_entry(spark: SparkSession, path: str, extension: str, database_name: str, split_name: str) -> DataFrame:
    """The descriptor of a source, by the names that its keys carry."""
    normal = lambda n: n.lower().replace("_", "-")
    return spark.createDataFrame([(normal(database_name), normal(split_name), extension, path)],
                                 "database_name string, split_name string, file_extension string, files_path string")
