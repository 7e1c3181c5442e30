"""Slab-and-adsorbate fields. Atom tags: 0 bulk, 1 surface layer, 2 adsorbate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.functions import elements
from strucsift.functions.vectors import (
    Vector, cell_of, cross, dot, norm, surface_normal, z_axis,
)
from strucsift.operators.geometry import bond_radius, close_pairs, structure_valid
from strucsift.session import cut_lineage

SURFACE, ADSORBATE = 1, 2
SLAB_TAGS = [0, 1]

# Labels of the material class and anomaly codes.
MATERIAL_CLASSES = ["intermetallics", "metalloids", "non-metals", "halides"]
ANOMALIES = [
    "no_anomaly", "adsorbate_dissociation", "adsorbate_desorption",
    "surface_reconstruction", "uninteracting_hydrogen",
]


def decode(code: Column, labels: list[str]) -> Column:
    """Label at position ``code``; null for an unknown code."""
    return F.get(F.array(*[F.lit(label) for label in labels]), code.cast("int"))


def catalyst_fields(info: dict[str, Column]) -> list[Column]:
    """Catalyst columns from the per-structure metadata."""
    null = F.lit(None)
    frame = F.regexp_replace(info.get("frame_number", null).cast("string"), "frame", "")
    return [
        info.get("bulk_id", null).cast("string").alias("catalyst_bulk_id"),
        info.get("ads_id", null).cast("string").alias("catalyst_adsorbate_id"),
        info.get("bulk_symbols", null).cast("string").alias("catalyst_bulk_symbols"),
        info.get("ads_symbols", null).cast("string").alias("catalyst_adsorbate_symbols"),
        F.coalesce(info.get("ref_energy", null).cast("double"), F.lit(0.0)).alias("catalyst_reference_energy"),
        decode(info.get("class", null), MATERIAL_CLASSES).alias("catalyst_class"),
        decode(info.get("anomaly", null), ANOMALIES).alias("catalyst_anomaly"),
        info.get("miller_index", null).cast("array<bigint>").alias("catalyst_miller_index"),
        F.coalesce(frame.try_cast("bigint"), F.lit(0)).alias("catalyst_relaxation_frame_idx"),
    ]


def slab_frames(cells: DataFrame) -> DataFrame:
    """Per structure the surface normal ``n*``, the rows ``u*`` and ``v*`` that turn a position
    into in-plane fractions, and the lengths of the two in-plane lattice vectors.

    Worked out in steps, each a projection over the one before, so that no step repeats the
    formulas of an earlier one.
    """
    def named(prefix: str) -> Vector:
        return tuple(F.col(f"{prefix}{k}") for k in range(3))

    def columns(prefix: str, v: Vector) -> dict[str, Column]:
        return {f"{prefix}{k}": c for k, c in enumerate(v)}

    lattice = cell_of(F.col("cell"))
    step = cells.select("sid", *[c.alias(n) for p, v in zip("abc", lattice) for n, c in columns(p, v).items()])
    a, b, c = named("a"), named("b"), named("c")
    step = step.withColumns(columns("m", surface_normal((a, b, c))))
    step = step.withColumn("no_cell", F.col("m0").isNull()).withColumns(
        columns("n", tuple(F.coalesce(m, z) for m, z in zip(named("m"), z_axis()))))
    # A missing third vector is completed by the normal.
    step = step.withColumns(columns(
        "t", tuple(F.when(norm(c) > 1e-12, x).otherwise(y) for x, y in zip(c, named("n")))))
    step = step.withColumns({**columns("p", cross(b, named("t"))), **columns("q", cross(named("t"), a))})
    step = step.withColumn("volume", dot(a, named("p")))
    return step.select(
        "sid", "no_cell", *named("n"),
        *[(x / F.col("volume")).alias(f"u{k}") for k, x in enumerate(named("p"))],
        *[(x / F.col("volume")).alias(f"v{k}") for k, x in enumerate(named("q"))],
        norm(a).alias("len_a"), norm(b).alias("len_b"),
    )


def _oriented(atoms: DataFrame, cells: DataFrame) -> DataFrame:
    """Atoms with their height along the surface normal, the z-axis when there is no cell."""
    position = tuple(F.col(f"p{a}") for a in "xyz")
    no_cell = F.col("no_cell")

    def along(row: str) -> Column:
        return dot(position, tuple(F.col(f"{row}{k}") for k in range(3)))

    return atoms.join(slab_frames(cells), "sid").select(
        *atoms.columns, "no_cell", along("n").alias("height"),
        F.when(no_cell, position[0]).otherwise(along("u")).alias("u"),
        F.when(no_cell, position[1]).otherwise(along("v")).alias("v"),
        F.when(no_cell, F.lit(1.0)).otherwise(F.col("len_a")).alias("len_u"),
        F.when(no_cell, F.lit(1.0)).otherwise(F.col("len_b")).alias("len_v"),
    )


def substrate_height(atoms: DataFrame, cells: DataFrame) -> DataFrame:
    """Height of the adsorbate's centre of mass over the mean surface atom; 0 if one is absent."""
    tag, h, m = F.col("tag"), F.col("height"), elements.mass(F.col("z"))
    ads = F.when(tag == ADSORBATE, m)
    gap = F.sum(ads * h) / F.sum(ads) - F.avg(F.when(tag == SURFACE, h))
    return _oriented(atoms, cells).groupBy("sid").agg(
        F.coalesce(gap, F.lit(0.0)).alias("catalyst_substrate_height"))


def max_vdw_radius(atoms: DataFrame, name: str = "max_vdw_radius") -> DataFrame:
    return atoms.groupBy("sid").agg(F.max(elements.vdw_radius(F.col("z"))).alias(name))


def adsorbate_valid(atoms: DataFrame, cells: DataFrame) -> DataFrame:
    """Whether the adsorbate sits above the slab and inside its in-plane footprint.

    The footprint is compared in fractional coordinates with the nearest image of the adsorbate
    to the slab's centroid; both tests are padded by van der Waals radii. Null when the
    structure lacks a slab or an adsorbate.
    """
    placed = _oriented(with_parts(atoms), cells)
    slab, ads = F.col("is_slab"), F.col("is_ads")

    def wrapped(f: str) -> Column:
        once = F.pmod(F.col(f), F.lit(1.0))
        return F.when(F.col("no_cell"), F.col(f)).otherwise(F.pmod(once, F.lit(1.0)))

    slab_side = placed.groupBy("sid").agg(
        F.avg(F.when(slab, wrapped("u"))).alias("mid_u"), F.avg(F.when(slab, wrapped("v"))).alias("mid_v"))

    def nearest(f: str) -> Column:
        image = F.col(f) - F.bround(F.col(f) - F.col(f"mid_{f}"))
        return F.when(F.col("no_cell"), F.col(f)).otherwise(image)

    radius = elements.vdw_radius(F.col("z"))
    parts = placed.join(slab_side, "sid").select(
        "sid", "len_u", "len_v",
        F.when(slab, F.col("height")).alias("slab_h"), F.when(ads, F.col("height")).alias("ads_h"),
        F.when(slab, radius).alias("slab_r"), F.when(ads, radius).alias("ads_r"),
        *[F.when(slab, wrapped(x)).alias(f"slab_{x}") for x in "uv"],
        *[F.when(ads, nearest(x)).alias(f"ads_{x}") for x in "uv"],
    )
    ranges = parts.groupBy("sid").agg(
        F.max("slab_h").alias("slab_top"), F.min("ads_h").alias("ads_bottom"),
        F.max("slab_r").alias("slab_radius"), F.max("ads_r").alias("ads_radius"),
        *[f(f"{part}_{x}").alias(f"{part}_{n}_{x}")
          for part in ("slab", "ads") for x in "uv" for n, f in (("lo", F.min), ("hi", F.max))],
        F.max("len_u").alias("len_u"), F.max("len_v").alias("len_v"),
    )
    above = F.round(F.col("ads_bottom"), 9) > F.round(
        F.col("slab_top") - (F.col("slab_radius") + F.col("ads_radius")), 9)
    inside = F.lit(True)
    for x in "uv":
        pad = F.col("ads_radius") / F.col(f"len_{x}")
        inside = inside & (
            (F.round(F.col(f"ads_lo_{x}"), 9) >= F.round(F.col(f"slab_lo_{x}") - pad, 9))
            & (F.round(F.col(f"ads_hi_{x}"), 9) <= F.round(F.col(f"slab_hi_{x}") + pad, 9))
        )
    complete = F.col("ads_bottom").isNotNull() & F.col("slab_top").isNotNull()
    return ranges.select("sid", F.when(complete, above & inside).alias("catalyst_xyz_adsorbate_is_valid"))


def with_parts(atoms: DataFrame) -> DataFrame:
    """Flag slab and adsorbate atoms; an untagged atom is neither."""
    tag = F.col("tag")
    return atoms.withColumns({
        "is_slab": F.coalesce(tag.isin(SLAB_TAGS), F.lit(False)),
        "is_ads": F.coalesce(tag == ADSORBATE, F.lit(False)),
    })


def nearby_surface(atoms: DataFrame) -> DataFrame:
    """Surface atoms within bonding reach of an adsorbate atom, as ``(sid, idx)``."""
    pairs = close_pairs(
        atoms.filter(F.col("tag").isin(SURFACE, ADSORBATE)), bond_radius(),
        F.col("tag") == SURFACE, F.col("tag") == ADSORBATE, ["idx"])
    return pairs.select("sid", F.col("a_idx").alias("idx")).distinct()


def adsorbate_structure_valid(atoms: DataFrame) -> DataFrame:
    """Structure validity of the adsorbate together with the surface atoms it touches.

    The atoms that are judged are written once, as they follow from a search of their own.
    """
    touched = nearby_surface(atoms).withColumn("touched", F.lit(True))
    kept = (
        atoms.join(touched, ["sid", "idx"], "left")
        .filter((F.col("tag") == ADSORBATE) | F.col("touched"))
        .drop("touched")
    )
    return structure_valid(cut_lineage(kept, "touched")).withColumnRenamed(
        "is_molecular_structure_valid", "adsorbate_structure_valid")
