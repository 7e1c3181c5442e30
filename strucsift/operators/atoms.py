"""Per-structure scalars from the atom table ``(sid, idx, z, px..pz, fx..fz, charge, tag)``.

Every measure is an aggregate with a small mergeable state, so a structure that holds much
of the table is reduced before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.functions import elements
from strucsift.functions.vectors import norm

# Fixed value: one Debye in e·Å.
DEBYE = 0.20819433442462576
FORMULA_ELEMENTS_FIRST = ("C", "H")


def explode_structures(structures: DataFrame, id_column: str = "entry_key") -> DataFrame:
    """Landing rows to atom rows, numbered by their place in the arrays.

    Forces, charges and tags are null where the structures have no such column.
    """
    at = F.posexplode("numbers").alias("idx", "z")
    optional = {"forces": "array<array<double>>", "charges": "array<double>", "tags": "array<int>"}
    carried = [F.col(c) if c in structures.columns else F.lit(None).cast(kind).alias(c) for c, kind in optional.items()]
    rows = structures.select(F.col(id_column).alias("sid"), "positions", *carried, at)
    i = F.col("idx")

    def component(column: str, k: int) -> Column:
        return F.get(F.get(F.col(column), i), F.lit(k))

    return rows.select(
        "sid", i.cast("bigint").alias("idx"), "z",
        *[component("positions", k).alias(f"p{a}") for k, a in enumerate("xyz")],
        *[component("forces", k).alias(f"f{a}") for k, a in enumerate("xyz")],
        F.get("charges", i).alias("charge"), F.get("tags", i).alias("tag"),
    )


def _force() -> tuple[Column, Column, Column]:
    return tuple(F.col(f"f{a}") for a in "xyz")


def net_force_norm() -> Column:
    """Norm of the summed force vector."""
    return norm(tuple(F.sum(f) for f in _force()))


def max_force_norm() -> Column:
    """Largest force magnitude on one atom."""
    return F.max(norm(_force()))


def molecular_weight() -> Column:
    return F.sum(elements.mass(F.col("z")))


def dipole_moment() -> Column:
    """Dipole magnitude in Debye about the centre of mass; null without charges."""
    q, m = F.col("charge"), elements.mass(F.col("z"))
    corrected = []
    for axis in "xyz":
        p = F.col(f"p{axis}")
        corrected.append(F.sum(q * p) - F.sum(q) * (F.sum(m * p) / F.sum(m)))
    return norm(tuple(corrected)) / F.lit(DEBYE)


def atomic_symbols() -> Column:
    """Distinct element symbols in alphabetical order, joined."""
    return F.array_join(F.sort_array(F.collect_set(elements.symbol(F.col("z")))), "")


def parity_spin() -> Column:
    """One plus the parity of the electron count."""
    return F.lit(1) + F.pmod(F.sum("z"), F.lit(2))


def force_measures(atoms: DataFrame) -> DataFrame:
    return atoms.groupBy("sid").agg(
        net_force_norm().alias("net_force_norm"), max_force_norm().alias("max_force_norm"))


def composition(atoms: DataFrame) -> DataFrame:
    """Formula in Hill order: carbon then hydrogen when there is carbon, the rest alphabetical."""
    counted = (
        atoms.groupBy("sid", "z").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("symbol", elements.symbol(F.col("z")))
    )
    return counted.groupBy("sid").agg(*_formula_parts()).select("sid", _formula().alias("composition"))


def _formula_parts() -> list[Column]:
    """Aggregates over (structure, element) rows that :func:`_formula` spells out."""
    return [
        F.collect_list(F.struct("symbol", "n")).alias("entries"),
        F.bool_or(F.col("symbol") == "C").alias("has_carbon"),
    ]


def _formula() -> Column:
    first = F.array(*[F.lit(s) for s in FORMULA_ELEMENTS_FIRST])

    def place(entry: Column) -> Column:
        rank = F.array_position(first, entry["symbol"])
        leads = F.col("has_carbon") & (rank > 0)
        return F.struct(
            F.when(leads, rank).otherwise(F.lit(len(FORMULA_ELEMENTS_FIRST) + 1)).alias("rank"),
            entry["symbol"].alias("symbol"), entry["n"].alias("n"),
        )

    def spell(entry: Column) -> Column:
        count = F.when(entry["n"] > 1, entry["n"].cast("string")).otherwise(F.lit(""))
        return F.concat(entry["symbol"], count)

    return F.array_join(F.transform(F.sort_array(F.transform("entries", place)), spell), "")


def atom_counts(atoms: DataFrame) -> DataFrame:
    """Atom count and the atomic numbers in atom order.

    The list is a field of the structure record, so it is as long as the structure.
    """
    ordered = F.sort_array(F.collect_list(F.struct("idx", "z")))
    return atoms.groupBy("sid").agg(
        F.count(F.lit(1)).alias("num_atoms"),
        F.transform(ordered, lambda e: e["z"].cast("bigint")).alias("atomic_numbers"),
    )


def with_tags(atoms: DataFrame, tags: list[int]) -> DataFrame:
    """Atoms whose tag is one of ``tags``; untagged atoms never match."""
    return atoms.filter(F.col("tag").isin(tags))


def tag_counts(atoms: DataFrame, tag_sets: dict[str, list[int]]) -> DataFrame:
    """Number of atoms per structure in each named tag set."""
    return atoms.groupBy("sid").agg(*[
        F.count_if(F.col("tag").isin(tags)).alias(name) for name, tags in tag_sets.items()
    ])


def scalar_measures(atoms: DataFrame) -> DataFrame:
    """All scalar measures and the composition from one pass over the atoms.

    Sums are taken per (structure, element) first; a structure then has at most one row per
    element, from which its formula and every measure follow. Atoms with an ``idx`` also give the
    atomic numbers in order.
    """
    f, p, q = _force(), [F.col(f"p{a}") for a in "xyz"], F.col("charge")
    listed = "idx" in atoms.columns
    per_element = atoms.groupBy("sid", "z").agg(
        F.count(F.lit(1)).alias("n"), F.max(norm(f)).alias("f_max"), F.sum(q).alias("q"),
        *[F.sum(x).alias(f"f{a}") for a, x in zip("xyz", f)],
        *[F.sum(x).alias(f"p{a}") for a, x in zip("xyz", p)],
        *[F.sum(q * x).alias(f"qp{a}") for a, x in zip("xyz", p)],
        *([F.collect_list("idx").alias("at")] if listed else []),
    ).withColumns({"symbol": elements.symbol(F.col("z")), "mass": elements.mass(F.col("z"))})
    total_mass, total_charge = F.sum(F.col("n") * F.col("mass")), F.sum("q")
    dipole = tuple(
        F.sum(f"qp{a}") - total_charge * (F.sum(F.col("mass") * F.col(f"p{a}")) / total_mass) for a in "xyz")
    numbers = []
    if listed:
        placed = F.flatten(F.transform(F.collect_list(F.struct("at", "z")), lambda e: F.transform(
            e["at"], lambda i: F.struct(i.alias("idx"), e["z"].alias("z")))))
        numbers = [F.transform(F.sort_array(placed), lambda e: e["z"].cast("bigint")).alias("atomic_numbers")]
    return per_element.groupBy("sid").agg(
        F.sum("n").alias("num_atoms"),
        *numbers,
        norm(tuple(F.sum(f"f{a}") for a in "xyz")).alias("net_force_norm"),
        F.max("f_max").alias("max_force_norm"),
        (norm(dipole) / F.lit(DEBYE)).alias("dipole_moment_magnitude"),
        total_mass.alias("molecular_weight"),
        F.array_join(F.sort_array(F.collect_set("symbol")), "").alias("atomic_symbols"),
        (F.lit(1) + F.pmod(F.sum(F.col("n") * F.col("z")), F.lit(2))).alias("parity_spin"),
        *_formula_parts(),
    ).withColumn("composition", _formula()).drop("entries", "has_carbon")


# Weights of charge squared, charge and unpaired spin in the state score.
CHARGE_WEIGHT, CHARGE_TILT, SPIN_WEIGHT = 1.0, 0.3, 2.0


def lowest_state(states: DataFrame, atoms: DataFrame) -> DataFrame:
    """Best (charge, multiplicity) state of each structure by the score, first charge on ties.

    A structure without candidate states is neutral with parity spin.
    """
    q, m = F.col("net_charge"), F.col("spin_multiplicity")
    score = CHARGE_WEIGHT * q * q + CHARGE_TILT * q + SPIN_WEIGHT * (m - 1) / 2
    best = states.groupBy("sid").agg(
        F.min_by(F.struct("net_charge", "spin_multiplicity"), F.struct(F.round(score, 9), q, m)).alias("best"))
    parity = atoms.groupBy("sid").agg(parity_spin().alias("parity"))
    return parity.join(best, "sid", "left").select(
        "sid",
        F.coalesce(F.col("best.net_charge"), F.lit(0)).cast("bigint").alias("net_charge"),
        F.coalesce(F.col("best.spin_multiplicity"), F.col("parity")).cast("bigint").alias("spin_multiplicity"),
    )


def any_null(columns: list[str]) -> Column:
    """True when one of the columns is null, or when there is none."""
    if not columns:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
