"""Three-vector arithmetic over columns.

A vector is a Python triple of columns, a cell is a triple of vectors, so every formula
expands to plain arithmetic inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]
Cell = tuple[Vector, Vector, Vector]


def z_axis() -> Vector:
    return F.lit(0.0), F.lit(0.0), F.lit(1.0)


def vector(array: Column) -> Vector:
    """The three entries of an array column."""
    return tuple(F.get(array, F.lit(i)) for i in range(3))


def cell_of(array: Column) -> Cell:
    """The three lattice vectors of a nested array column."""
    return tuple(vector(F.get(array, F.lit(i))) for i in range(3))


def dot(u: Vector, v: Vector) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def norm(u: Vector) -> Column:
    return F.sqrt(dot(u, u))


def cross(u: Vector, v: Vector) -> Vector:
    return (
        u[1] * v[2] - u[2] * v[1],
        u[2] * v[0] - u[0] * v[2],
        u[0] * v[1] - u[1] * v[0],
    )


def surface_normal(cell: Cell) -> Vector:
    """Unit normal of the plane of the first two lattice vectors, on the side of the third.

    Its entries are null when the two vectors are (nearly) parallel.
    """
    raw = cross(cell[0], cell[1])
    length = norm(raw)
    side = F.when(dot(raw, cell[2]) < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return tuple(F.when(length >= 1e-8, c * side / length) for c in raw)


def voigt_to_full(stress: Column) -> Column:
    """Six Voigt components (xx, yy, zz, yz, xz, xy) as a symmetric 3×3 array; null otherwise."""
    s = [F.get(stress, F.lit(i)) for i in range(6)]
    return F.when(F.size(stress) == 6, F.array(
        F.array(s[0], s[5], s[4]),
        F.array(s[5], s[1], s[3]),
        F.array(s[4], s[3], s[2]),
    ))
