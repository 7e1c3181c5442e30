"""What each dataset format adds to its structures on the way into the query table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.functions.keys import subset_from_name
from strucsift.operators import atoms as atom_ops
from strucsift.operators import catalyst
from strucsift.operators.fields import Transform, charge_rule, reaction_fields, spin_rule

# Metadata columns the catalyst fields are read from, when a structure has them.
CATALYST_SOURCES = [
    "bulk_id", "ads_id", "bulk_symbols", "ads_symbols", "ref_energy", "class", "anomaly", "miller_index", "frame_number",
]


def charge_and_spin(fmt: str, parity: str | None = None) -> Transform:
    """Net charge and spin multiplicity by the rule of the format."""
    def transform(df: DataFrame) -> DataFrame:
        def given(name: str):
            return F.col(name) if name in df.columns else F.lit(None)

        return df.withColumns({
            "net_charge": charge_rule(F.lit(fmt), given("net_charge")),
            "spin_multiplicity": spin_rule(F.lit(fmt), given("spin_multiplicity"), F.col(parity) if parity else F.lit(None)),
        })

    return transform


def name_and_subset(df: DataFrame) -> DataFrame:
    """Database name and subset from the raw database name. The entry key keeps the raw name."""
    parsed = subset_from_name(F.col("database_name"))
    return df.withColumn("__name", parsed).withColumns(
        {"database_name": F.col("__name.database_name"), "subset": F.col("__name.subset")}).drop("__name")


def slab_fields(atoms: DataFrame, cells: DataFrame) -> Transform:
    """Everything known about a slab with an adsorbate, from its metadata and its atoms."""
    def transform(df: DataFrame) -> DataFrame:
        info = {c: F.col(c) for c in CATALYST_SOURCES if c in df.columns}
        counts = atoms.groupBy("sid").agg(
            F.count_if(F.col("tag") == catalyst.ADSORBATE).alias("catalyst_num_adsorbate_atoms"),
            F.count_if(F.col("tag").isin(catalyst.SLAB_TAGS)).alias("catalyst_num_bulk_atoms"),
            atom_ops.parity_spin().alias("__parity"))
        # A slab without atoms stays, with none of each kind.
        n_atoms = ("catalyst_num_adsorbate_atoms", "catalyst_num_bulk_atoms")
        out = df.select("*", *catalyst.catalyst_fields(info)).join(counts, "sid", "left").fillna(0, list(n_atoms))
        out = out.join(catalyst.substrate_height(atoms, cells), "sid", "left")
        out = out.join(catalyst.adsorbate_valid(atoms, cells), "sid", "left")
        return out

    return transform


def transforms_for(fmt: str, atoms: DataFrame | None = None, cells: DataFrame | None = None) -> list[Transform]:
    """The additional-field functions of a format, in order; a later one wins."""
    if fmt == "aselmdb_omol":
        return [reaction_fields("subset", "source", "reference_source")]
    if fmt in ("aselmdb_omc", "aselmdb_odac"):
        return [charge_and_spin(fmt)]
    if fmt == "aselmdb_omat":
        return [charge_and_spin(fmt), name_and_subset]
    if fmt in ("aselmdb_oc", "xyz_oc"):
        named = [name_and_subset] if fmt == "aselmdb_oc" else []
        return [slab_fields(atoms, cells), charge_and_spin(fmt, "__parity"), *named]
    if fmt == "xyz":
        return []
    raise ValueError(f"unsupported database format: {fmt}")
