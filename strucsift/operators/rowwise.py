"""Measures of a landed structure inside its own row.

A landed row holds all atoms of its structure as arrays, so that every measure is an expression over
them: nothing is exploded, grouped or exchanged. Pair searches compare all atoms of a row with each
other, many rows of an Arrow batch at a time; structures of more than ``ROW_ATOMS`` atoms, and those with periodic images, take the long form,
which places atoms in cells. They are written to the shared folder first: when there are none, no plan
of the long form is made and nothing is exchanged. Both forms give the same values. A structure whose ``numbers`` are null or empty has no atoms: it is
kept, as invalid with 0 atoms and waters, and its other measures are null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.functions import elements
from strucsift.functions.vectors import norm
from strucsift.operators import fingerprints, geometry
from strucsift.operators.atoms import DEBYE, FORMULA_ELEMENTS_FIRST, explode_structures
from strucsift.schema import FINGERPRINT_BITS
from strucsift.session import cut_lineage, ship_package

# Atoms up to which pairs are searched in the row.
ROW_ATOMS = 256
# Pairs of atoms that one vectorised step compares.
PAIRS = 500_000


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _axis(vectors: str, k: int) -> Column:
    return F.transform(vectors, lambda v: v[k])


def num_atoms() -> Column:
    return F.coalesce(F.size("numbers"), F.lit(0)).cast("bigint")


def _symbols() -> Column:
    return F.transform("numbers", elements.symbol)


def net_force_norm() -> Column:
    """Norm of the summed force vector."""
    return norm(tuple(_total(_axis("forces", k)) for k in range(3)))


def max_force_norm() -> Column:
    """Largest force magnitude on one atom."""
    return F.array_max(F.transform("forces", lambda f: norm((f[0], f[1], f[2]))))


def molecular_weight() -> Column:
    return _total(F.transform("numbers", elements.mass))


def dipole_moment() -> Column:
    """Dipole magnitude in Debye about the centre of mass; null without charges."""
    masses = F.transform("numbers", elements.mass)
    corrected = []
    for k in range(3):
        p = _axis("positions", k)
        centre = _total(F.zip_with(masses, p, lambda m, x: m * x)) / _total(masses)
        corrected.append(_total(F.zip_with("charges", p, lambda q, x: q * x)) - _total(F.col("charges")) * centre)
    return norm(tuple(corrected)) / F.lit(DEBYE)


def atomic_symbols() -> Column:
    """Distinct element symbols in alphabetical order, joined."""
    return F.array_join(F.array_sort(F.array_distinct(_symbols())), "")


def composition() -> Column:
    """Formula in Hill order: carbon then hydrogen when there is carbon, the rest alphabetical."""
    first = F.array(*[F.lit(s) for s in FORMULA_ELEMENTS_FIRST])

    def formula(symbols: Column) -> Column:
        def entry(symbol: Column) -> Column:
            rank = F.array_position(first, symbol)
            leads = F.array_contains(symbols, "C") & (rank > 0)
            count = F.size(F.filter(symbols, lambda s: s == symbol))
            return F.struct(
                F.when(leads, rank).otherwise(F.lit(len(FORMULA_ELEMENTS_FIRST) + 1)).alias("rank"), symbol.alias("symbol"),
                F.when(count > 1, count.cast("string")).otherwise(F.lit("")).alias("count"))

        entries = F.array_sort(F.transform(F.array_distinct(symbols), entry))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["symbol"], e["count"])), "")

    # The symbols are looked up once, as the only element of an outer array.
    return F.get(F.transform(F.array(_symbols()), formula), F.lit(0))


def parity_spin() -> Column:
    """One plus the parity of the electron count."""
    return F.lit(1) + F.pmod(F.aggregate("numbers", F.lit(0), lambda total, z: total + z), F.lit(2))


def scalar_columns() -> dict[str, Column]:
    """All scalar measures by name."""
    measures = {
        "atomic_numbers": F.transform("numbers", lambda z: z.cast("bigint")),
        "net_force_norm": net_force_norm(), "max_force_norm": max_force_norm(),
        "dipole_moment_magnitude": dipole_moment(), "molecular_weight": molecular_weight(),
        "atomic_symbols": atomic_symbols(), "composition": composition(), "parity_spin": parity_spin(),
    }
    return {"num_atoms": num_atoms(), **{name: F.when(num_atoms() > 0, c) for name, c in measures.items()}}


def scalars(landed: DataFrame, *keep: str) -> DataFrame:
    """All scalar measures of landed structures, with the columns ``keep``."""
    return landed.select(*keep, *[c.alias(name) for name, c in scalar_columns().items()])


def _atoms() -> Column:
    """The atoms of a row as structs: z, half-cutoff and position."""
    return F.zip_with("numbers", "positions", lambda z, p: F.struct(
        z.alias("z"), (F.lit(geometry.BOND_SCALE) * elements.covalent_radius(z)).alias("r"), p.alias("p")))


def _near(a: Column, b: Column) -> Column:
    """Whether two atoms are bonded; their distance is worked out once."""
    gap = norm(tuple(a["p"][k] - b["p"][k] for k in range(3)))
    return F.exists(F.array(gap), lambda d: geometry.within(d, a["r"] + b["r"]))


def _atoms_of(numbers: pa.Array, positions: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The atoms of a batch of structures: how many each has, atomic numbers (-1: null) and positions (NaN: null)."""
    counts = pc.list_value_length(numbers)
    plain = not numbers.null_count and not positions.null_count and counts.equals(pc.list_value_length(positions))
    z, p = numbers.flatten(), positions.flatten()
    if plain and not p.null_count and pc.all(pc.equal(pc.list_value_length(p), 3)).as_py() is not False:
        flat = p.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return np.asarray(counts, np.int64), pc.fill_null(z, -1).to_numpy(zero_copy_only=False).astype(np.int64), flat.reshape(-1, 3)
    sizes, all_z, all_p = [], [], []
    for zs, ps in zip(numbers.to_pylist(), positions.to_pylist(), strict=True):
        # A structure without positions cannot be judged, like one without atoms.
        zs, ps = ([], []) if zs is None or ps is None else (zs, ps)
        sizes.append(max(len(zs), len(ps)))
        all_z += [-1 if x is None else x for x in zs] + [-1] * (sizes[-1] - len(zs))
        for v in [*ps, *[None] * (sizes[-1] - len(ps))]:
            if v is not None and len(v) < 3:
                raise ValueError("a position of less than three numbers")
            all_p.append([np.nan] * 3 if v is None else [np.nan if x is None else x for x in v[:3]])
    return np.array(sizes, np.int64), np.array(all_z, np.int64), np.array(all_p, np.float64).reshape(-1, 3)


def _radii(z: np.ndarray) -> np.ndarray:
    known = (z >= 0) & (z < len(elements.COVALENT_RADII))
    scaled = geometry.BOND_SCALE * np.array(elements.COVALENT_RADII)
    return np.where(known, scaled[np.where(known, z, 0)], np.nan)


def _pairs(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ordered pairs of atoms of one structure, an atom with itself too, some ``PAIRS`` at a time."""
    first = np.cumsum(counts) - counts
    upto = np.cumsum(counts * counts)
    begin = done = 0
    while begin < len(counts):
        end = max(begin + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        n = np.repeat(counts[begin:end], counts[begin:end])
        atoms = first[begin] + np.arange(len(n))
        a = np.repeat(atoms, n)
        place = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        yield a, np.repeat(np.repeat(first[begin:end], counts[begin:end]), n) + place
        begin, done = end, int(upto[end - 1])


def _below(gap: np.ndarray, cutoff: np.ndarray) -> np.ndarray:
    """``geometry.within`` of arrays; NaN is never below."""
    below = gap < cutoff
    close = np.flatnonzero(np.abs(gap - cutoff) <= geometry.CLEAR)
    if len(close):
        values, back = np.unique(np.stack([gap[close], cutoff[close]]), return_inverse=True)
        digits = Decimal(1).scaleb(-geometry.PLACES)
        rounded = np.array([float(Decimal(repr(float(v))).quantize(digits, ROUND_HALF_UP)) for v in values])
        near, limit = rounded[back.reshape(2, -1)]
        below[close] = near < limit
    return below


def _gaps(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = p[a] - p[b]
    return np.sqrt(d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1] + d[:, 2] * d[:, 2])


def _judge(min_fragment: int) -> Callable[[Column, Column], Column]:
    """(valid, waters) of structures from their numbers and positions."""
    def judge(numbers: pa.Array, positions: pa.Array) -> pa.Array:
        counts, z, p = _atoms_of(numbers, positions)
        radius = _radii(z)
        degree, hydrogens = np.zeros(len(z), np.int64), np.zeros(len(z), np.int64)
        for a, b in _pairs(counts):
            gap = _gaps(p, a, b)
            degree += np.bincount(a[_below(gap, radius[a] + radius[b])], minlength=len(z))
            water = np.flatnonzero((z[a] == geometry.OXYGEN) & (z[b] == geometry.HYDROGEN))
            met = _below(gap[water], np.full(len(water), geometry.OH_CUTOFF))
            hydrogens += np.bincount(a[water[met]], minlength=len(z))
        # Every atom of a known element meets itself.
        degree = np.where(np.isnan(radius), 0, degree - 1)
        alone = (z < 0) | (degree < min_fragment - 1) | ((z == geometry.HYDROGEN) & (degree != 1))
        row = np.repeat(np.arange(len(counts)), counts)
        valid = (counts >= min_fragment) & (np.bincount(row[alone], minlength=len(counts)) == 0)
        is_water = (z == geometry.OXYGEN) & (hydrogens == geometry.WATER_HYDROGENS)
        return pa.StructArray.from_arrays(
            [pa.array(valid), pa.array(np.bincount(row[is_water], minlength=len(counts)), pa.int64())], ["valid", "water"])

    return F.arrow_udf(judge, "struct<valid: boolean, water: bigint>")


def with_validity_and_water(landed: DataFrame, row_atoms: int = ROW_ATOMS, min_fragment: int = geometry.MIN_FRAGMENT,
                            names: tuple[str, str] = ("is_molecular_structure_valid", "num_water_molecules")) -> DataFrame:
    """``landed`` (unique ``sid``) with both measures, for fragments of at most two atoms.

    Rows of more than ``row_atoms`` atoms, or with a periodic cell of the long form, are exploded.
    """
    if min_fragment > 2:
        raise ValueError("larger fragments need the component search of the long form")
    valid, water = names
    found = lambda measure, none: F.coalesce(F.when(num_atoms() > 0, measure), F.lit(none))
    long = num_atoms() > row_atoms
    if {"cell", "pbc"} <= set(landed.columns):
        long |= F.coalesce(geometry.has_images(), F.lit(False))
    ship_package(landed.sparkSession)
    small = landed.filter(~long).withColumn("__judged", _judge(min_fragment)("numbers", "positions")).withColumns({
        valid: found(F.col("__judged.valid"), False), water: found(F.col("__judged.water"), 0).cast("bigint")}).drop("__judged")
    large = cut_lineage(landed.filter(long), "large")
    if large.isEmpty():
        return small
    atoms = explode_structures(large, "sid")
    if {"cell", "pbc"} <= set(landed.columns):
        cells = large.select("sid", "cell", "pbc")
        measured = geometry.structure_valid_periodic(atoms, cells, min_fragment).join(geometry.water_count_periodic(atoms, cells), "sid")
    else:
        measured = geometry.structure_valid(atoms, min_fragment).join(geometry.water_count(atoms), "sid")
    measured = measured.withColumnsRenamed({"is_molecular_structure_valid": valid, "num_water_molecules": water})
    return small.unionByName(large.join(measured, "sid"))


def validity_and_water(landed: DataFrame, row_atoms: int = ROW_ATOMS, min_fragment: int = geometry.MIN_FRAGMENT) -> DataFrame:
    """(sid, is_molecular_structure_valid, num_water_molecules) of landed structures."""
    return with_validity_and_water(landed, row_atoms, min_fragment).select(
        "sid", "is_molecular_structure_valid", "num_water_molecules")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, as the only element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def set_bits(radius: int = fingerprints.RADIUS, n_bits: int = FINGERPRINT_BITS) -> Column:
    """Sorted set bits of the fingerprint of a row's structure; null without atoms.

    Each atom's bonded neighbours are an array of places. A round of hashing maps the identifiers of
    the round before; all rounds stay in one array of arrays.
    """
    def neighbours(atoms: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(atoms) - 1)
        near = lambda i, a: F.filter(places, lambda j: (j != i) & _near(a, F.get(atoms, j)))
        return F.transform(atoms, lambda a, i: F.struct(a["z"].alias("z"), near(i, a).alias("near")))

    def begin(atom: Column) -> Column:
        return fingerprints.digest(F.lit("atom"), atom["z"], F.size(atom["near"]))

    def advance(r: int, linked: Column, ids: Column) -> Column:
        def fresh(atom: Column, i: Column) -> Column:
            total = F.aggregate(atom["near"], F.lit(0).cast("bigint"), lambda acc, j: acc + F.get(ids, j))
            return fingerprints.digest(F.lit(r), F.get(ids, i), total, F.size(atom["near"]))

        return F.transform(linked, fresh)

    def rounds(r: int, linked: Column, ids: Column) -> Column:
        if r > radius:
            return ids
        return F.concat(ids, _bound(advance(r, linked, ids), lambda later: rounds(r + 1, linked, later)))

    ids = _bound(_atoms(), lambda atoms: _bound(neighbours(atoms), lambda linked: _bound(
        F.transform(linked, begin), lambda first: rounds(1, linked, first))))
    bits = F.array_sort(F.array_distinct(F.transform(ids, lambda i: F.pmod(i, F.lit(n_bits)).cast("int"))))
    return F.when(num_atoms() > 0, bits)


def with_fingerprint(landed: DataFrame, name: str = "set_bits", row_atoms: int = ROW_ATOMS,
                     where: Column | None = None) -> DataFrame:
    """``landed`` (unique ``sid``) with the sorted set bits of the structures that ``where`` chooses, else null.

    Structures without atoms have none either. Chosen rows of more than ``row_atoms`` atoms are written
    apart and take the long form; without such rows nothing is exchanged.
    """
    chosen = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    giant = chosen & (num_atoms() > row_atoms)
    small = landed.filter(~giant).withColumn(name, F.when(chosen, set_bits()))
    large = cut_lineage(landed.filter(giant), "large")
    if large.isEmpty():
        return small
    atoms = explode_structures(large, "sid")
    bits = fingerprints.circular_fingerprint(atoms, geometry.neighbour_list(atoms)).withColumnRenamed("set_bits", name)
    return small.unionByName(large.join(bits, "sid"))
