"""Field mapping and dataset rules applied while a structure enters the query table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.functions.parsers import REACTION_FIELDS, parse_source
from strucsift.operators.atoms import any_null

# Query column <- source field, per dataset format.
FIELD_MAPS = {
    "aselmdb_omol": {
        "subset": "data_id", "net_charge": "charge", "num_atoms": "num_atoms",
        "spin_multiplicity": "spin", "composition": "composition",
    },
    "aselmdb_omat": {"subset": "task_type", "composition": "composition_reduced"},
    "aselmdb_odac": {},
    "aselmdb_omc": {},
    "aselmdb_oc": {"num_atoms": "num_atoms"},
    "xyz": {
        "subset": "config_type", "net_charge": "total_charge", "num_atoms": "num_atoms",
        "spin_multiplicity": "spin",
    },
    "xyz_oc": {"num_atoms": "num_atoms"},
}

# Source field -> exported field, per dataset format.
EXPORT_MAPS = {
    "aselmdb_omol": {
        "data_id": "subset", "charge": "charge", "spin": "spin_multiplicity",
        "num_atoms": "num_atoms", "mulliken_charges": "mulliken_charges",
        "lowdin_charges": "lowdin_charges",
    },
    "aselmdb_omat": {"task_type": "subset", "spin": "spin_multiplicity", "stress": "stress"},
    "aselmdb_odac": {},
    "aselmdb_omc": {"stress": "stress"},
    "aselmdb_oc": {"num_atoms": "num_atoms"},
    "xyz": {
        "config_type": "subset", "total_charge": "charge", "spin": "spin_multiplicity",
        "num_atoms": "num_atoms",
    },
    "xyz_oc": {"num_atoms": "num_atoms"},
}

Transform = Callable[[DataFrame], DataFrame]


def map_fields(df: DataFrame, mapping: Mapping[str, str], arrays: Mapping[str, str] | None = None) -> DataFrame:
    """Add each target column from its source field.

    A field is looked up among the structure's scalar columns first and then among the per-atom
    ones, which ``arrays`` names (field -> column).
    """
    arrays = arrays or {}
    missing = [s for s in mapping.values() if s not in df.columns and s not in arrays]
    if missing:
        available = sorted({*df.columns, *arrays})
        raise KeyError(f"fields {missing} not found; available fields: {available}")

    def source(field: str) -> Column:
        return F.col(field) if field in df.columns else F.col(arrays[field])

    return df.withColumns({target: source(field) for target, field in mapping.items()})


def attach_metadata(df: DataFrame, metadata: Mapping[str, str]) -> DataFrame:
    """Constant columns such as the functional. Columns already there win over them."""
    return df.withColumns({k: F.lit(v) for k, v in metadata.items() if k not in df.columns})


def apply_transforms(df: DataFrame, transforms: Sequence[Transform]) -> DataFrame:
    """Run additional-field functions in order; a later one may overwrite a column."""
    for transform in transforms:
        df = transform(df)
    return df


def rehydrate(df: DataFrame, calculated: str, stored: str) -> DataFrame:
    """Fill a missing calculator result from the stored copy of the same quantity."""
    return df.withColumn(calculated, F.coalesce(calculated, stored))


def charge_rule(fmt: Column, charge: Column) -> Column:
    """Net charge: neutral by construction for periodic datasets, else as given."""
    return F.when(fmt.isin("aselmdb_omc", "aselmdb_odac", "aselmdb_omat", "aselmdb_oc", "xyz_oc"),
                  F.lit(0)).otherwise(charge).cast("bigint")


def spin_rule(fmt: Column, spin: Column, parity: Column) -> Column:
    """Spin multiplicity: closed shell, unknown, parity of the electrons, or as given."""
    return (
        F.when(fmt.isin("aselmdb_omc", "aselmdb_odac"), F.lit(1))
        .when(fmt == "aselmdb_omat", F.lit(None))
        .when(fmt.isin("aselmdb_oc", "xyz_oc"), parity)
        .otherwise(spin).cast("double")
    )


def reaction_fields(subset: str, source: str, reference_source: str) -> Transform:
    """Transform that parses the source path and may override the subset."""
    def transform(df: DataFrame) -> DataFrame:
        parsed = parse_source(F.col(subset), F.col(source), F.col(reference_source))
        return df.withColumn("__parsed", parsed).withColumns(
            {name: F.col(f"__parsed.{name}") for name in REACTION_FIELDS}).drop("__parsed")

    return transform


def graph_candidate(num_atoms: Column, subset: Column, limit: int = 200,
                    skip: Sequence[str] = (), enabled: bool = True) -> Column:
    """Whether a structure is small enough, and not skipped, for graph properties.

    A structure without a subset is not skipped.
    """
    if not enabled:
        return F.lit(False)
    skipped = F.coalesce(subset.isin(list(skip)), F.lit(False)) if skip else F.lit(False)
    return (num_atoms <= limit) & ~skipped


def derivation_error(columns: list[str], enabled: bool = True) -> Column:
    """True when a derived value is missing; null when derivation is off."""
    return any_null(columns) if enabled else F.lit(None).cast("boolean")
