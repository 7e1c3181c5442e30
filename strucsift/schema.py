"""The typed query table and the landing table of raw structures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Residue and nucleobase codes counted in a structure.
AMINO_ACID_CODES = (
    "ala arg asn asp cys gln glu gly his ile leu lys met phe pro ser thr trp tyr val"
).split()
NUCLEOBASE_CODES = "ade cyt gua thy ura".split()

FINGERPRINT_BITS = 1024
FINGERPRINT_PREFIX = "fingerprint_"
# Column name that stands for all fingerprint bits.
FINGERPRINT_PRESET = "fingerprint_bits"

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _fields(spec: str) -> list[T.StructField]:
    kinds = {"string": _S, "long": _L, "double": _D, "bool": _B, "longs": T.ArrayType(_L)}
    out = []
    for line in spec.strip().splitlines():
        kind, names = line.split(":")
        out += [T.StructField(name, kinds[kind.strip()]) for name in names.split()]
    return out


# Columns of the query table by group. Energies in eV, forces in eV/Å, masses in
# g/mol, dipoles in Debye.
BASE_COLUMNS = _fields("""
string: key entry_key database_name split_name basis_set functional correction_term subset composition
long: net_charge
double: spin_multiplicity
long: num_atoms
longs: atomic_numbers
double: energy
""")
CALCULATED_COLUMNS = _fields("""
double: dipole_moment_magnitude net_force_norm max_force_norm
string: atomic_symbols
double: molecular_weight
bool: is_molecular_structure_valid
long: num_water_molecules
""")
MOTIF_COLUMNS = (
    [T.StructField(f"num_{c}", _L) for c in AMINO_ACID_CODES] + [T.StructField("is_protein", _B)]
    + [T.StructField(f"num_{c}", _L) for c in NUCLEOBASE_CODES]
    + [T.StructField("is_nucleobase", _B)]
)
GRAPH_COLUMNS = _fields("""
bool: graph_properties_candidate error_graph_properties
double: logp tpsa
string: smiles
""")
REACTION_COLUMNS = _fields("""
string: reaction_id
long: reaction_pathway_id
bool: is_reactant is_product is_transition_state
long: reaction_step_idx
""")
CATALYST_COLUMNS = _fields("""
string: catalyst_bulk_id catalyst_adsorbate_id catalyst_bulk_symbols catalyst_adsorbate_symbols
string: catalyst_adsorbate_smiles
long: catalyst_num_adsorbate_atoms catalyst_num_bulk_atoms
double: catalyst_reference_energy
string: catalyst_class catalyst_anomaly
double: catalyst_substrate_height
longs: catalyst_miller_index
long: catalyst_relaxation_frame_idx
bool: catalyst_xyz_adsorbate_is_valid
""")

# The fingerprint is stored as one array of bits rather than 1,024 columns: it is read and
# decoded as a unit, and generated code stays below the field limit.
QUERY_SCHEMA = T.StructType(
    BASE_COLUMNS + CALCULATED_COLUMNS + MOTIF_COLUMNS + GRAPH_COLUMNS
    + [T.StructField("fingerprint", T.ArrayType(T.ByteType()))]
    + REACTION_COLUMNS + CATALYST_COLUMNS
)

# Raw structures as they land: one row per structure, per-atom arrays inside.
STRUCTURE_SCHEMA = T.StructType([
    T.StructField("database_name", _S), T.StructField("split_name", _S),
    T.StructField("source_file_name", _S), T.StructField("frame_idx", _L),
    T.StructField("numbers", T.ArrayType(T.IntegerType())),
    T.StructField("positions", T.ArrayType(T.ArrayType(_D))),
    T.StructField("forces", T.ArrayType(T.ArrayType(_D))),
    T.StructField("tags", T.ArrayType(T.IntegerType())),
    T.StructField("charges", T.ArrayType(_D)),
    T.StructField("cell", T.ArrayType(T.ArrayType(_D))),
    T.StructField("pbc", T.ArrayType(_B)),
    T.StructField("energy", _D), T.StructField("stress", T.ArrayType(_D)),
    T.StructField("info", T.MapType(_S, _S)),
])


def conform(df: DataFrame, schema: T.StructType = QUERY_SCHEMA) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null, unknown ones dropped, types cast."""
    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def pack_bits(df: DataFrame, name: str = "fingerprint") -> DataFrame:
    """Collapse ``fingerprint_<i>`` columns, ordered by their number, into one bit array."""
    bits = sorted(
        (c for c in df.columns if c.startswith(FINGERPRINT_PREFIX) and c[len(FINGERPRINT_PREFIX):].isdigit()),
        key=lambda c: int(c[len(FINGERPRINT_PREFIX):]),
    )
    if not bits:
        raise ValueError("no fingerprint_<i> columns to pack")
    return df.withColumn(name, F.array(*[F.col(c).cast("tinyint") for c in bits])).drop(*bits)


def unpack_bits(df: DataFrame, n_bits: int = FINGERPRINT_BITS, name: str = "fingerprint") -> DataFrame:
    """The inverse of :func:`pack_bits`."""
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, *[
        F.get(F.col(name), F.lit(i)).cast("bigint").alias(f"{FINGERPRINT_PREFIX}{i}")
        for i in range(n_bits)
    ])


def expand_presets(columns: list[str]) -> list[str]:
    """Replace the ``fingerprint_bits`` preset by the stored fingerprint column."""
    if not columns:
        raise ValueError("a custom sampler must name the columns it needs")
    return ["fingerprint" if c == FINGERPRINT_PRESET else c for c in columns]
