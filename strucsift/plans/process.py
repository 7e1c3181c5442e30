"""Process stage: landed structures to rows of the query table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.operators import atoms as atom_ops
from strucsift.operators import motifs, rowwise
from strucsift.operators.fields import (
    FIELD_MAPS, Transform, apply_transforms, attach_metadata, derivation_error, graph_candidate,
)
from strucsift.operators.fingerprints import bit_array, circular_fingerprint
from strucsift.operators.geometry import (
    neighbour_list, structure_valid, structure_valid_periodic, water_count, water_count_periodic,
)
from strucsift.operators.info import required_field
from strucsift.schema import QUERY_SCHEMA, conform
from strucsift.session import cut_lineage

# Columns whose mapped value, where there is one, is not replaced by a derived one.
GIVEN_FIRST = ("composition", "num_atoms")
# Measures of a structure without atom rows; all others are null.
WITHOUT_ATOMS = {"num_atoms": 0, "num_water_molecules": 0, "is_molecular_structure_valid": False}


def derive(atoms: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """All per-structure measures of the atom table, one row per ``sid``.

    With ``cells`` (sid, cell, pbc) neighbours are searched across periodic borders as well; the
    atoms then need their ``idx``.
    """
    valid = structure_valid(atoms) if cells is None else structure_valid_periodic(atoms, cells)
    water = water_count(atoms) if cells is None else water_count_periodic(atoms, cells)
    return atom_ops.scalar_measures(atoms).join(valid, "sid").join(water, "sid")


def _settle(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Give the measures, held with two leading underscores, their names beside the mapped columns."""
    value = {c: F.coalesce(F.col(f"__{c}"), F.lit(WITHOUT_ATOMS[c])) if c in WITHOUT_ATOMS else F.col(f"__{c}") for c in measures}
    for c in GIVEN_FIRST:
        if c in rows.columns and c in value:
            value[c] = F.coalesce(F.col(c).cast(rows.schema[f"__{c}"].dataType), value[c])
    return rows.withColumns(value).drop(*[f"__{c}" for c in measures])


def _with_candidate(rows: DataFrame, atom_limit: int, skip_subsets: Sequence[str]) -> DataFrame:
    subset = F.col("subset").cast("string") if "subset" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("graph_properties_candidate", graph_candidate(F.col("num_atoms"), subset, atom_limit, skip_subsets))


def _with_graph_error(rows: DataFrame) -> DataFrame:
    # Only a candidate can lack its fingerprint by error.
    missing = F.col("graph_properties_candidate") & derivation_error(["fingerprint"])
    return rows.withColumn("error_graph_properties", F.coalesce(missing, F.lit(False)))


def _graph_properties(rows: DataFrame, atoms: DataFrame, atom_limit: int, skip_subsets: Sequence[str]) -> DataFrame:
    """``rows`` (sid, num_atoms, ...) with candidate and error flags and the candidates' fingerprints."""
    rows = cut_lineage(_with_candidate(rows, atom_limit, skip_subsets), "derived")
    chosen = atoms.join(rows.filter("graph_properties_candidate").select("sid"), "sid", "left_semi")
    bits = circular_fingerprint(chosen, neighbour_list(chosen)).select("sid", bit_array(F.col("set_bits")).alias("fingerprint"))
    return _with_graph_error(rows.join(bits, "sid", "left"))


def _graph_properties_in_row(rows: DataFrame, atom_limit: int, skip_subsets: Sequence[str], row_atoms: int) -> DataFrame:
    """The same of rows that hold their atoms, found inside the row."""
    rows = _with_candidate(rows, atom_limit, skip_subsets)
    rows = rowwise.with_fingerprint(rows, "__set_bits", row_atoms, F.col("graph_properties_candidate"))
    return _with_graph_error(rows.withColumn("fingerprint", bit_array(F.col("__set_bits"))).drop("__set_bits"))


def _motifs(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """``rows`` (sid, ...) with the motif columns counted from ``matches`` (id, code, pattern, s, e)."""
    found = motifs.motif_columns(matches).withColumnRenamed("id", "sid")
    # A structure without a match has none of each kind.
    filled = {c: F.coalesce(c, F.lit(False if c.startswith("is_") else 0)) for c in found.columns if c != "sid"}
    return rows.join(found, "sid", "left").withColumns(filled)


def process_landed(landed: DataFrame, fmt: str, metadata: Mapping[str, str] | None = None,
                   transforms: Sequence[Transform] = (), row_atoms: int = rowwise.ROW_ATOMS, strict: bool = False,
                   graph: bool = False, atom_limit: int = 200, skip_subsets: Sequence[str] = (),
                   matches: DataFrame | None = None) -> DataFrame:
    """Rows of the query table straight from landed structures of a format.

    The format's field map reads the source fields from ``info``; with ``strict`` a structure that lacks
    one fails the job. All measures are taken inside the row, so that nothing is shuffled but the
    structures of more than ``row_atoms`` atoms or with periodic images. ``graph`` adds fingerprints,
    ``matches`` the motif columns.
    """
    def source(name: str) -> Column:
        return required_field(landed, name) if strict else F.col("info")[name]

    columns = {f"__{name}": column for name, column in rowwise.scalar_columns().items() if name != "parity_spin"}
    flags = ("__is_molecular_structure_valid", "__num_water_molecules")
    # Measured before the transforms, so that large structures are looked for in the landed table alone.
    measured = rowwise.with_validity_and_water(landed, row_atoms, names=flags).withColumns(columns)
    mapped = measured.withColumns({target: source(name) for target, name in FIELD_MAPS[fmt].items()})
    rows = apply_transforms(attach_metadata(mapped, metadata or {}), transforms)
    rows = _settle(rows, [c.removeprefix("__") for c in (*columns, *flags)])
    if matches is not None:
        rows = _motifs(rows, matches)
    if graph:
        rows = _graph_properties_in_row(rows, atom_limit, skip_subsets, row_atoms)
    else:
        rows = rows.withColumn("graph_properties_candidate", F.lit(False))
    return conform(rows, QUERY_SCHEMA)


def process(structures: DataFrame, atoms: DataFrame, metadata: Mapping[str, str] | None = None,
            transforms: Sequence[Transform] = (), graph: bool = False, atom_limit: int = 200,
            skip_subsets: Sequence[str] = (), cells: DataFrame | None = None,
            matches: DataFrame | None = None) -> DataFrame:
    """Rows of the query table.

    ``structures`` has ``sid``, ``entry_key`` and the mapped columns. Metadata constants yield
    to mapped columns, those to the transforms, and those to the derived measures; only a formula
    or atom count that the source gives stays. A structure without atoms is kept, as invalid.
    ``matches`` (id, code, pattern, s, e) fills the motif columns.
    """
    mapped = apply_transforms(attach_metadata(structures, metadata or {}), transforms)
    derived = derive(atoms, cells).drop("parity_spin")
    measures = [c for c in derived.columns if c != "sid"]
    rows = _settle(mapped.join(derived.withColumnsRenamed({c: f"__{c}" for c in measures}), "sid", "left"), measures)
    if matches is not None:
        rows = _motifs(rows, matches)
    if graph:
        rows = _graph_properties(rows, atoms, atom_limit, skip_subsets)
    else:
        rows = rows.withColumn("graph_properties_candidate", F.lit(False))
    return conform(rows, QUERY_SCHEMA)
