"""Element constants as array literals indexed by atomic number.

Index 0 is the dummy element ``X``. Looking a constant up is an array access inside
generated code, so no per-atom query joins a dimension table.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element symbols by atomic number.
SYMBOLS = """
X H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As
Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd
Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am
Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og
""".split()

# Standard atomic masses (g/mol, IUPAC 2016) by atomic number.
MASSES = [float(v) for v in """
1.0 1.008 4.002602 6.94 9.0121831 10.81 12.011 14.007 15.999 18.998403163 20.1797
22.98976928 24.305 26.9815385 28.085 30.973761998 32.06 35.45 39.948 39.0983 40.078
44.955908 47.867 50.9415 51.9961 54.938044 55.845 58.933194 58.6934 63.546 65.38 69.723
72.630 74.921595 78.971 79.904 83.798 85.4678 87.62 88.90584 91.224 92.90637 95.95 97.90721
101.07 102.90550 106.42 107.8682 112.414 114.818 118.710 121.760 127.60 126.90447 131.293
132.90545196 137.327 138.90547 140.116 140.90766 144.242 144.91276 150.36 151.964 157.25
158.92535 162.500 164.93033 167.259 168.93422 173.054 174.9668 178.49 180.94788 183.84
186.207 190.23 192.217 195.084 196.966569 200.592 204.38 207.2 208.98040 208.98243 209.98715
222.01758 223.01974 226.02541 227.02775 232.0377 231.03588 238.02891 237.04817 244.06421
243.06138 247.07035 247.07031 251.07959 252.0830 257.09511 258.09843 259.1010 262.110 267.122
268.126 271.134 270.133 269.1338 278.156 281.165 281.166 285.177 286.182 289.190 289.194
293.204 293.208 294.214
""".split()]

# Covalent radii (Å, Cordero et al. 2008) by atomic number; elements without a
# published radius use 0.2.
COVALENT_RADII = [float(v) for v in """
0.2 0.31 0.28 1.28 0.96 0.84 0.76 0.71 0.66 0.57 0.58 1.66 1.41 1.21 1.11 1.07 1.05 1.02 1.06
2.03 1.76 1.70 1.60 1.53 1.39 1.39 1.32 1.26 1.24 1.32 1.22 1.22 1.20 1.19 1.20 1.20 1.16
2.20 1.95 1.90 1.75 1.64 1.54 1.47 1.46 1.42 1.39 1.45 1.44 1.42 1.39 1.39 1.38 1.39 1.40
2.44 2.15 2.07 2.04 2.03 2.01 1.99 1.98 1.98 1.96 1.94 1.92 1.92 1.89 1.90 1.87 1.87 1.75
1.70 1.62 1.51 1.44 1.41 1.36 1.36 1.32 1.45 1.46 1.48 1.40 1.50 1.50 2.60 2.21 2.15 2.06
2.00 1.96 1.90 1.87 1.80 1.69 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2 0.2
0.2 0.2 0.2 0.2 0.2 0.2 0.2
""".split()]

# Van der Waals radii (Å, Bondi 1964) of the elements that have one.
VDW_RADII = {
    "H": 1.20, "He": 1.40, "Li": 1.82, "C": 1.70, "N": 1.55, "O": 1.52, "F": 1.47, "Ne": 1.54,
    "Na": 2.27, "Mg": 1.73, "Si": 2.10, "P": 1.80, "S": 1.80, "Cl": 1.75, "Ar": 1.88, "K": 2.75,
    "Ni": 1.63, "Cu": 1.40, "Zn": 1.39, "Ga": 1.87, "As": 1.85, "Se": 1.90, "Br": 1.85,
    "Kr": 2.02, "Pd": 1.63, "Ag": 1.72, "Cd": 1.58, "In": 1.93, "Sn": 2.17, "Te": 2.06,
    "I": 1.98, "Xe": 2.16, "Pt": 1.75, "Au": 1.66, "Hg": 1.55, "Tl": 1.96, "Pb": 2.02, "U": 1.86,
}
DEFAULT_VDW_RADIUS = 1.7

# Default valences of the elements that have a single usual one; all others
# (metals) have none.
DEFAULT_VALENCES = {
    "H": 1, "He": 0, "Li": 1, "Be": 2, "B": 3, "C": 4, "N": 3, "O": 2, "F": 1, "Ne": 0, "Na": 1,
    "Mg": 2, "Al": 3, "Si": 4, "P": 3, "S": 2, "Cl": 1, "Ar": 0, "K": 1, "Ca": 2, "Ga": 3,
    "Ge": 4, "As": 3, "Se": 2, "Br": 1, "Kr": 0, "Rb": 1, "Sr": 2, "In": 3, "Sn": 2, "Sb": 3,
    "Te": 2, "I": 1, "Xe": 0, "Cs": 1, "Ba": 2, "Pb": 2, "Bi": 3, "Po": 2, "At": 1, "Rn": 0,
}


@cache
def _sql_array(kind: str) -> str:
    if kind == "symbol":
        return "array(" + ",".join(f"'{s}'" for s in SYMBOLS) + ")"
    if kind == "mass":
        values = MASSES
    elif kind == "covalent":
        values = COVALENT_RADII
    elif kind == "vdw":
        values = [VDW_RADII.get(s, DEFAULT_VDW_RADIUS) for s in SYMBOLS]
    else:
        return "array(" + ",".join(
            str(DEFAULT_VALENCES[s]) if s in DEFAULT_VALENCES else "cast(null as int)"
            for s in SYMBOLS) + ")"
    return "array(" + ",".join(f"{v!r}D" for v in values) + ")"


def _lookup(kind: str, z: Column) -> Column:
    return F.get(F.expr(_sql_array(kind)), z.cast("int"))


def symbol(z: Column) -> Column:
    """Element symbol; null when ``z`` is not an element."""
    return _lookup("symbol", z)


def mass(z: Column) -> Column:
    """Standard atomic mass in g/mol."""
    return _lookup("mass", z)


def covalent_radius(z: Column) -> Column:
    """Covalent radius in Å."""
    return _lookup("covalent", z)


def vdw_radius(z: Column) -> Column:
    """Van der Waals radius in Å, 1.7 for elements without a tabulated one."""
    return F.coalesce(_lookup("vdw", z), F.lit(DEFAULT_VDW_RADIUS))


def default_valence(z: Column) -> Column:
    """Usual valence; null for metals and unknown elements."""
    return _lookup("valence", z)
