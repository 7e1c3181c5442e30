"""Neighbour search and what follows from it: validity, fragments, water, walks, valence.

Structures above ``GRID_ABOVE`` atoms are cut into cubic cells no smaller than their largest
cutoff, and an atom meets only the atoms of the 27 cells around it. The join key is (structure, cell),
so a huge structure spreads over many tasks. Smaller structures are one cell, and their atoms are paired in one row.
Where all points stand on both sides each pair is met once, in large structures over a cell and the 13 cells ahead of it.
Placed points are written once and everything that follows reads that table.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.functions import elements
from strucsift.functions.vectors import cell_of, cross, dot, norm
from strucsift.session import cut_lineage

GRID_ABOVE = 256
BOND_SCALE = 1.2
# O-H distance (Å) below which a hydrogen belongs to a water oxygen, and the
# number of such hydrogens.
OH_CUTOFF, WATER_HYDROGENS = 1.2, 2
# Distances and cutoffs are compared rounded to this many digits; of two that differ by more than
# CLEAR, rounding keeps the order.
PLACES, CLEAR = 9, 1e-8
HYDROGEN, OXYGEN = 1, 8
MIN_FRAGMENT = 2
# Structures up to this size have their fragments labelled inside their row.
LABEL_IN_ROW = 64

# Two atoms in a cube of this side (Å) are bonded whatever their elements.
CROWD_SIDE = 2 * BOND_SCALE * min(elements.COVALENT_RADII) / 3 ** 0.5

_AXES = "xyz"
_CELL = ["cx", "cy", "cz"]
_AROUND = list(product((-1, 0, 1), repeat=3))
# A cell and those ahead of it: of two cells side by side each is ahead of the other in one direction only.
_AHEAD = [offset for offset in _AROUND if offset >= (0, 0, 0)]


def bond_radius(scale: float = BOND_SCALE) -> Column:
    """Half-cutoff of an atom: its scaled covalent radius."""
    return F.lit(scale) * elements.covalent_radius(F.col("z"))


def fixed_radius(cutoff: float) -> Column:
    """Half-cutoff that makes every pair closer than ``cutoff`` neighbours."""
    return F.lit(cutoff / 2)


def _with_cells(points: DataFrame, radius: Column) -> DataFrame:
    """Attach the half-cutoff ``r`` and the cell of each point."""
    sized = points.withColumn("r", radius)
    large = (
        sized.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("r_max"))
        .filter(F.col("n") > GRID_ABOVE)
        # A hair wider than the cutoff, so rounded distances cannot skip a cell.
        .select("sid", (F.col("r_max") * 2.000001).alias("side"))
    )
    cells = {
        c: F.when(F.col("side").isNull(), F.lit(0)).otherwise(F.floor(F.col(f"p{a}") / F.col("side"))).cast("bigint")
        for c, a in zip(_CELL, _AXES)
    }
    return sized.join(large, "sid", "left").withColumns(cells)


def _place(points: DataFrame, radius: Column) -> DataFrame:
    """The points with their half-cutoff and cell, written once."""
    return cut_lineage(_with_cells(points, radius), "placed")


def _reach(points: DataFrame, offsets: list[tuple[int, int, int]]) -> DataFrame:
    """Repeat each point for the cells at ``offsets``; ``home`` marks the copy in its own cell."""
    def at(offset: tuple[int, int, int]) -> Column:
        return F.struct(*[F.lit(d).alias(c) for c, d in zip(_CELL, offset)])

    shift = F.explode(F.when(F.col("side").isNull(), F.array(at((0, 0, 0)))).otherwise(F.array(*map(at, offsets))))
    return points.withColumn("shift", shift).withColumns({
        "home": F.forall(F.array(*[F.col("shift")[c] for c in _CELL]), lambda d: d == 0),
        **{c: F.col(c) + F.col("shift")[c] for c in _CELL}}).drop("shift")


def close_pairs(points: DataFrame, radius: Column, left: Column, right: Column, carry: list[str]) -> DataFrame:
    """Ordered pairs of points of one structure closer than the sum of their half-cutoffs.

    ``left`` and ``right`` say which points may stand on each side. The result holds ``sid``,
    the carried columns as ``a_*`` and ``b_*``, and ``dist``.
    """
    return _matched(_place(points, radius), carry, left, right)


def within(gap: Column, cutoff: Column) -> Column:
    """Whether ``gap`` is below ``cutoff``, both rounded to ``PLACES`` digits.

    Rounding goes through decimal numbers, which takes longer than all else of a pair; values further apart
    than both can be rounded are compared as they are.
    """
    return F.when(F.abs(gap - cutoff) > F.lit(CLEAR), gap < cutoff).otherwise(F.round(gap, PLACES) < F.round(cutoff, PLACES))


def _matched(placed: DataFrame, carry: list[str], left: Column | None = None, right: Column | None = None,
             once: list[str] | None = None) -> DataFrame:
    """The pairs of points that :func:`_with_cells` has placed, of a table that can be read repeatedly.

    ``left`` and ``right`` say which points may stand on each side. With ``once`` instead, columns that
    tell the points of a structure apart, every pair of different points is given in one order only.
    Points of a structure of one cell are gathered in a row and paired there; those of others are joined by cell.
    """
    fields = list(dict.fromkeys([*carry, *(once or []), "px", "py", "pz", "r"]))
    left, right = (F.lit(True) if side is None else side for side in (left, right))
    known = placed.filter(F.col("r").isNotNull() & F.col("sid").isNotNull())
    grid = known.filter(F.col("side").isNotNull())
    met = _met_in_row(known.filter(F.col("side").isNull()), fields, left, right, once)
    if not grid.isEmpty():
        met = met.unionByName(_met_by_cell(grid.filter(left), grid.filter(right), fields, once))
    gap = norm(tuple(F.col(f"a_p{x}") - F.col(f"b_p{x}") for x in _AXES))
    return (
        met.filter(within(gap, F.col("a_r") + F.col("b_r")))
        .select("sid", *[f"{s}_{c}" for c in carry for s in "ab"], F.round(gap, PLACES).alias("dist"))
    )


def _ordered(once: list[str]) -> Column:
    first, second = (F.struct(*[F.col(f"{s}_{c}").alias(c) for c in once]) for s in "ab")
    return first < second


def _met_in_row(points: DataFrame, fields: list[str], left: Column, right: Column, once: list[str] | None) -> DataFrame:
    """All pairs of the points of each structure. A structure has at most ``GRID_ABOVE`` points here."""
    point = F.struct(*fields, F.coalesce(left, F.lit(False)).alias("__left"), F.coalesce(right, F.lit(False)).alias("__right"))
    rows = points.groupBy("sid").agg(F.collect_list(point).alias("points"))
    a = rows.select("sid", "points", F.explode("points").alias("a")).filter("a.__left")
    met = a.select("sid", "a", F.explode("points").alias("b")).filter("b.__right").select(
        "sid", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in fields])
    return met.filter(_ordered(once)) if once else met


def _met_by_cell(left: DataFrame, right: DataFrame, fields: list[str], once: list[str] | None) -> DataFrame:
    """The pairs of points in cells side by side."""
    a = left.select("sid", *_CELL, *[F.col(c).alias(f"a_{c}") for c in fields])
    moved = _reach(right.withColumnsRenamed({c: f"b_{c}" for c in fields}), _AHEAD if once else _AROUND)
    b = moved.select("sid", *_CELL, *[f"b_{c}" for c in fields], F.col("home").alias("b__home"))
    met = a.join(b, ["sid", *_CELL])
    if once:
        met = met.filter(~F.col("b__home") | _ordered(once))
    return met.select("sid", *[f"{s}_{c}" for s in "ab" for c in fields])


def neighbour_list(atoms: DataFrame, radius: Column | None = None) -> DataFrame:
    """Neighbour pairs ``i < j`` with both atomic numbers and the distance."""
    placed = _place(atoms, bond_radius() if radius is None else radius)
    pairs = _matched(placed, ["idx", "z"], once=["idx"])
    forward = F.col("a_idx") < F.col("b_idx")
    return pairs.select(
        "sid", F.least("a_idx", "b_idx").alias("i"), F.greatest("a_idx", "b_idx").alias("j"),
        F.when(forward, F.col("a_z")).otherwise(F.col("b_z")).alias("zi"),
        F.when(forward, F.col("b_z")).otherwise(F.col("a_z")).alias("zj"), "dist")


def periodic_neighbour_list(atoms: DataFrame, cells: DataFrame, radius: Column | None = None) -> DataFrame:
    """Neighbour pairs under periodic boundary conditions, nearest image of each pair.

    ``cells`` gives ``(sid, cell)``, and ``pbc`` where some axes are not periodic. Atoms are wrapped into the cell and the right-hand side is
    completed with the images that can reach it, as many along each lattice vector as the cutoff
    spans, so the search itself stays the open one. An atom is its own neighbour (``i = j``) when
    images of it are close enough; ``images`` counts all of them.
    """
    radius = bond_radius() if radius is None else radius
    a, b, c = cell_of(F.col("cell"))
    volume = dot(a, cross(b, c))
    # Worked out once per structure: lattice, reciprocal rows, and one fraction per Å of height.
    reciprocal = [cross(b, c), cross(c, a), cross(a, b)]
    along = [F.col("pbc")[i] if "pbc" in cells.columns else F.lit(True) for i in range(3)]
    lattice = cells.select(
        "sid", *[periodic.alias(f"on{i}") for i, periodic in enumerate(along)],
        *[v[k].alias(f"l{i}{k}") for i, v in enumerate((a, b, c)) for k in range(3)],
        *[(v[k] / volume).alias(f"g{i}{k}") for i, v in enumerate(reciprocal) for k in range(3)],
        *[(norm(v) / F.abs(volume)).alias(f"per{i}") for i, v in enumerate(reciprocal)],
    )
    position = tuple(F.col(f"p{x}") for x in _AXES)
    fraction = [dot(position, tuple(F.col(f"g{i}{k}") for k in range(3))) for i in range(3)]
    rows = {f"w{i}": F.when(F.col(f"on{i}"), F.pmod(x, F.lit(1.0))).otherwise(x) for i, x in enumerate(fraction)}
    sized = atoms.withColumn("r", radius)
    reach = sized.groupBy("sid").agg((2 * F.max("r")).alias("reach"))
    wrapped = sized.join(lattice.join(reach, "sid"), "sid").withColumns(rows)

    def shifts(i: int) -> Column:
        """The images of an atom along one lattice vector that come within reach of the cell."""
        margin = F.col("reach") * F.col(f"per{i}")
        # Atoms of unknown elements reach nobody.
        most = F.coalesce(F.ceil(margin), F.lit(0)).cast("bigint") + 1
        return F.filter(
            F.transform(F.sequence(-most, most), lambda d: d.cast("double")),
            lambda d: (d == 0) | F.col(f"on{i}") & (F.col(f"w{i}") + d).between(-margin, 1 + margin))

    for i in range(3):
        wrapped = wrapped.withColumn(f"d{i}", F.explode(shifts(i)))
    moved = [F.col(f"w{i}") + F.col(f"d{i}") for i in range(3)]
    cartesian = [
        sum((moved[i] * F.col(f"l{i}{k}") for i in range(1, 3)), moved[0] * F.col(f"l0{k}")).alias(f"p{x}")
        for k, x in enumerate(_AXES)
    ]
    is_home = (F.col("d0") == 0) & (F.col("d1") == 0) & (F.col("d2") == 0)
    points = wrapped.select("sid", "idx", "z", "r", *cartesian, is_home.alias("home"))
    pairs = close_pairs(points, F.col("r"), F.col("home"), F.lit(True), ["idx", "z", "home"])
    return (
        pairs.filter("a_idx < b_idx OR (a_idx = b_idx AND NOT b_home)").groupBy("sid", F.col("a_idx").alias("i"), F.col("b_idx").alias("j"))
        .agg(F.min("dist").alias("dist"), F.count(F.lit(1)).alias("images"))
    )


def coordination(atoms: DataFrame, radius: Column | None = None) -> DataFrame:
    """Neighbour count per distinct site ``(sid, z, position)`` with ``n`` coinciding atoms.

    Atoms at one place are merged first and count each other as neighbours.
    """
    radius = bond_radius() if radius is None else radius
    site = ["sid", "z", "px", "py", "pz"]
    placed = _place(atoms.groupBy(*site).agg(F.count(F.lit(1)).alias("n")), radius)
    pairs = _matched(placed, [*site[1:], "n"], once=site[1:])

    def end(own: str, other: str) -> Column:
        return F.struct(*[F.col(f"{own}_{c}").alias(c) for c in (*site[1:], "n")], F.col(f"{other}_n").alias("met"))

    both = pairs.select("sid", F.explode(F.array(end("a", "b"), end("b", "a"))).alias("e")).select("sid", "e.*")
    # An atom of an unknown element has no cutoff and so meets nobody, itself included.
    alone = placed.select(*site, "n", F.when(F.col("r").isNull(), F.lit(0)).otherwise(F.col("n") - 1).cast("bigint").alias("met"))
    return both.unionByName(alone).groupBy(*site, "n").agg(F.sum("met").alias("degree"))


def _contacts(atoms: DataFrame) -> DataFrame:
    """Per site ``(sid, z, n)`` the neighbour count, exact up to one and at least two beyond.

    In a large structure, three atoms in a cell too small for two of them to be apart have two
    neighbours each. Such crowds are settled by counting, so a dense heap of atoms is never
    paired up; only atoms outside of crowds look for their neighbours.
    """
    site = ["sid", "z", "px", "py", "pz"]
    sites = atoms.groupBy(*site).agg(F.count(F.lit(1)).alias("n"))
    fine = {f"g{a}": F.floor(F.col(f"p{a}") / CROWD_SIDE) for a in _AXES}
    judged = placed = cut_lineage(_with_cells(sites, bond_radius()).withColumns(fine), "placed")
    known, in_grid = F.col("r").isNotNull(), placed.filter(F.col("side").isNotNull() & F.col("r").isNotNull())
    if in_grid.isEmpty():
        settled, open_site = None, F.lit(True)
    else:
        crowds = in_grid.groupBy("sid", *fine).agg(F.sum("n").alias("crowd")).filter("crowd > 2")
        judged = cut_lineage(placed.join(crowds, ["sid", *fine], "left"), "judged")
        crowded = F.col("crowd").isNotNull() & known
        settled = judged.filter(crowded).select("sid", "z", "n", (F.col("crowd") - 1).alias("degree"))
        open_site = ~crowded
    met = (
        _matched(judged, ["z", "px", "py", "pz", "n"], left=open_site)
        .groupBy("sid", *[f"a_{c}" for c in site[1:]], "a_n").agg((F.sum("b_n") - 1).alias("degree"))
        .select("sid", F.col("a_z").alias("z"), F.col("a_n").alias("n"), "degree")
    )
    # An atom of an unknown element has no cutoff and so meets nobody, itself included.
    unknown = placed.filter(~known).select("sid", "z", "n", F.lit(0).cast("bigint").alias("degree"))
    counted = met.unionByName(unknown)
    return counted if settled is None else counted.unionByName(settled)


def has_images(pbc: bool = True) -> Column:
    """Whether the cell has images: all nine entries are other than zero, and some axis is periodic."""
    full = F.forall(F.flatten("cell"), lambda x: x != 0) & (F.size(F.flatten("cell")) == 9)
    return full & F.exists("pbc", lambda p: p) if pbc else full


def _boxed(cells: DataFrame) -> DataFrame:
    """The cells that have images."""
    return cells.filter(has_images("pbc" in cells.columns))


def structure_valid_periodic(atoms: DataFrame, cells: DataFrame, min_fragment: int = MIN_FRAGMENT) -> DataFrame:
    """``structure_valid`` with image neighbours where :func:`_boxed` tells of a cell.

    Neighbours are counted once, however many images of them are bonded; an atom bonded to an image
    of itself counts as its own neighbour, but no atom belongs to a fragment of more for that.
    """
    boxed = _boxed(cells)
    inside = atoms.join(boxed.select("sid"), "sid", "left_semi")
    bonds = periodic_neighbour_list(inside, boxed)
    degrees = both_ways(bonds).distinct().groupBy("sid", F.col("u").alias("idx")).agg(
        F.count(F.lit(1)).alias("degree"), F.count_if(F.col("u") != F.col("v")).alias("others"))
    judged = inside.select("sid", "idx", "z").join(degrees, ["sid", "idx"], "left").fillna(0, ["degree", "others"])
    verdict = judged.groupBy("sid").agg(
        (F.count(F.lit(1)) >= min_fragment).alias("enough"), F.min("others").alias("least"),
        F.bool_and((F.col("z") != HYDROGEN) | (F.col("degree") == 1)).alias("hydrogens_ok"))
    whole = F.col("least") >= min_fragment - 1
    if min_fragment > 2:
        smallest = fragments(inside, bonds.filter("i <> j")).groupBy("sid").agg(F.min("n_atoms").alias("smallest"))
        verdict, whole = verdict.join(smallest, "sid"), F.col("smallest") >= min_fragment
    closed = verdict.select("sid", (F.col("enough") & whole & F.col("hydrogens_ok")).alias("is_molecular_structure_valid"))
    return closed.unionByName(structure_valid(atoms.join(boxed.select("sid"), "sid", "left_anti"), min_fragment))


def water_count_periodic(atoms: DataFrame, cells: DataFrame) -> DataFrame:
    """``water_count`` where images of hydrogens count as well, in the cells of :func:`_boxed`."""
    boxed = _boxed(cells)
    inside = atoms.join(boxed.select("sid"), "sid", "left_semi")
    near = periodic_neighbour_list(inside.filter(F.col("z").isin(HYDROGEN, OXYGEN)), boxed, fixed_radius(OH_CUTOFF))
    ends = F.explode(F.array(F.struct(F.col("i").alias("u"), F.col("j").alias("v")), F.struct(F.col("j").alias("u"), F.col("i").alias("v"))))
    met = near.select("sid", "images", ends.alias("e")).select("sid", "images", "e.u", "e.v")
    kind = lambda z, name: inside.filter(F.col("z") == z).select("sid", F.col("idx").alias(name))
    waters = (
        met.join(kind(OXYGEN, "u"), ["sid", "u"], "left_semi").join(kind(HYDROGEN, "v"), ["sid", "v"], "left_semi")
        .groupBy("sid", "u").agg(F.sum("images").alias("h")).filter(F.col("h") == WATER_HYDROGENS)
        .groupBy("sid").agg(F.count(F.lit(1)).alias("waters"))
    )
    closed = inside.select("sid").distinct().join(waters, "sid", "left").select(
        "sid", F.coalesce("waters", F.lit(0)).cast("bigint").alias("num_water_molecules"))
    return closed.unionByName(water_count(atoms.join(boxed.select("sid"), "sid", "left_anti")))


def structure_valid(atoms: DataFrame, min_fragment: int = MIN_FRAGMENT) -> DataFrame:
    """Whether every fragment has ``min_fragment`` atoms and every hydrogen one neighbour.

    For the default of two, a fragment is large enough exactly when none of its atoms is alone,
    so no component search is needed.
    """
    sites = _contacts(atoms)
    hydrogens_ok = F.bool_and((F.col("z") != HYDROGEN) | (F.col("degree") == 1))
    judged = sites.groupBy("sid").agg(
        F.sum("n").alias("n_atoms"),
        F.min("degree").alias("min_degree"),
        hydrogens_ok.alias("hydrogens_ok"),
    )
    if min_fragment <= 2:
        verdict = (F.col("n_atoms") >= min_fragment) & (F.col("min_degree") >= min_fragment - 1) & F.col("hydrogens_ok")
        return judged.select("sid", verdict.alias("is_molecular_structure_valid"))
    smallest = (
        fragments(atoms, neighbour_list(atoms)).groupBy("sid").agg(F.min("n_atoms").alias("smallest"))
    )
    verdict = (F.col("smallest") >= min_fragment) & F.col("hydrogens_ok")
    return judged.join(smallest, "sid").select("sid", verdict.alias("is_molecular_structure_valid"))


def water_count(atoms: DataFrame) -> DataFrame:
    """Oxygens with exactly two hydrogens within 1.2 Å, per structure (zero included)."""
    site = ["sid", "z", "px", "py", "pz"]
    sites = (
        atoms.filter(F.col("z").isin(HYDROGEN, OXYGEN)).groupBy(*site).agg(F.count(F.lit(1)).alias("n"))
    )
    pairs = close_pairs(
        sites, fixed_radius(OH_CUTOFF), F.col("z") == OXYGEN, F.col("z") == HYDROGEN, ["px", "py", "pz", "n"])
    waters = (
        pairs.groupBy("sid", "a_px", "a_py", "a_pz", "a_n").agg(F.sum("b_n").alias("h"))
        .filter(F.col("h") == WATER_HYDROGENS)
        .groupBy("sid").agg(F.sum("a_n").alias("waters"))
    )
    return (
        atoms.select("sid").distinct().join(waters, "sid", "left")
        .select("sid", F.coalesce("waters", F.lit(0)).cast("bigint").alias("num_water_molecules"))
    )


def both_ways(bonds: DataFrame) -> DataFrame:
    """Each bond ``i < j`` in both directions as ``(sid, u, v)``."""
    ends = F.explode(F.array(
        F.struct(F.col("i").alias("u"), F.col("j").alias("v")),
        F.struct(F.col("j").alias("u"), F.col("i").alias("v")),
    ))
    return bonds.select("sid", ends.alias("e")).select("sid", "e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of an atom to the smallest atom around it."""
    around = both_ways(edges.select("sid", F.col("u").alias("i"), F.col("v").alias("j")))
    root = around.groupBy("sid", "u").agg(F.min("v").alias("m"))
    return (
        around.join(root, ["sid", "u"]).filter("v > u")
        .select("sid", F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of an atom, and the atom, to the smallest of them."""
    down = edges.select("sid", F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    root = down.groupBy("sid", "u").agg(F.min("v").alias("m"))
    moved = down.join(root, ["sid", "u"]).select("sid", F.col("v").alias("u"), F.col("m").alias("v"))
    kept = root.select("sid", "u", F.col("m").alias("v"))
    return moved.unionByName(kept).filter("u <> v").distinct()


def component_roots(bonds: DataFrame) -> DataFrame:
    """Smallest atom of the component of each bonded atom, as ``(sid, u, v)`` with v the root.

    Alternating large-star and small-star contraction: the number of rounds grows with the
    logarithm of the component size, and each round is a handful of keyed shuffles.
    """
    edges = cut_lineage(bonds.select("sid", F.col("j").alias("u"), F.col("i").alias("v")).distinct(), "edges")
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)), "edges")
        if _all_stars(edges):
            return edges


def _all_stars(edges: DataFrame) -> bool:
    """Whether every atom hangs on one root only and no root hangs on another."""
    twice = edges.groupBy("sid", "u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chained = edges.join(edges.select("sid", F.col("u").alias("v")), ["sid", "v"], "left_semi")
    return twice.isEmpty() and chained.isEmpty()


def _label_small(sizes: DataFrame, bonds: DataFrame) -> DataFrame:
    """Root of every atom of structures of at most ``LABEL_IN_ROW`` atoms, as ``(sid, root)``.

    The few bonds of such a structure fit in its row. Each bond merges two labels, so one walk
    over them is enough.
    """
    edges = bonds.groupBy("sid").agg(F.collect_list(F.struct("i", "j")).alias("edges"))

    def merge(labels: Column, edge: Column) -> Column:
        u, v = F.get(labels, edge["i"].cast("int")), F.get(labels, edge["j"].cast("int"))
        return F.transform(labels, lambda one: F.when(one == F.greatest(u, v), F.least(u, v)).otherwise(one))

    start = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    labels = F.when(F.col("edges").isNull(), start).otherwise(F.aggregate("edges", start, merge))
    return sizes.join(edges, "sid", "left").select("sid", F.explode(labels).alias("root"))


def fragments(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Connected fragments: root atom and atom count of each, lone atoms included.

    Structures whose atoms are numbered from 0 and few are labelled in their own row; only the
    others, if there are any, go through rounds of contraction.
    """
    sizes = atoms.groupBy("sid").agg(
        F.count(F.lit(1)).alias("n"), F.min("idx").alias("lo"), F.max("idx").alias("hi"))
    in_row = (F.col("n") <= LABEL_IN_ROW) & (F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1)
    small, large = sizes.filter(in_row).select("sid", "n"), sizes.filter(~in_row).select("sid")
    labels = _label_small(small, bonds.join(small.select("sid"), "sid", "left_semi"))
    if not large.isEmpty():
        kept = atoms.select("sid", "idx").join(large, "sid", "left_semi")
        roots = component_roots(bonds.join(large, "sid", "left_semi"))
        labels = labels.unionByName(
            kept.join(roots.select("sid", F.col("u").alias("idx"), F.col("v").alias("root")), ["sid", "idx"], "left")
            .select("sid", F.coalesce("root", "idx").alias("root")))
    return labels.groupBy("sid", "root").agg(F.count(F.lit(1)).alias("n_atoms"))


def n_hop_walks(bonds: DataFrame, starts: DataFrame, n_atoms: int) -> DataFrame:
    """Walks of exactly ``n_atoms`` atoms along bonds from each start ``(sid, idx)``.

    A walk may come back to an atom it has already passed. Bonds are never broadcast: how many there are is not known
    when the walks are planned, and a plan takes pairs made from atoms for no more than the atoms.
    """
    step = both_ways(bonds).hint("merge")
    walks = starts.select(
        "sid", F.col("idx").alias("start"), F.col("idx").alias("at"), F.array("idx").alias("path"))
    if n_atoms < 2:
        return walks.filter(F.lit(False))
    for _ in range(n_atoms - 1):
        walks = (
            walks.withColumnRenamed("at", "u").join(step, ["sid", "u"])
            .select("sid", "start", F.col("v").alias("at"), F.array_append("path", F.col("v")).alias("path"))
        )
    return walks


def degrees(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Bond count of every atom, zero included."""
    met = both_ways(bonds).groupBy("sid", F.col("u").alias("idx")).agg(F.count(F.lit(1)).alias("degree"))
    return (
        atoms.select("sid", "idx", "z").join(met, ["sid", "idx"], "left")
        .withColumn("degree", F.coalesce("degree", F.lit(0)))
    )


def valence_difference(atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Degree minus the usual valence; zero for elements without one."""
    usual = elements.default_valence(F.col("z"))
    gap = F.coalesce(F.col("degree") - usual, F.lit(0)).cast("bigint")
    return degrees(atoms, bonds).withColumn("valence_diff", gap).withColumn(
        "has_expected_valence", F.col("valence_diff") == 0)
