"""Statistics, histograms and density curves of the numeric and boolean columns of a frame."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.operators.ranking import SKETCH_ACCURACY
from strucsift.session import cut_lineage

logger = logging.getLogger(__name__)

QUANTILES = (0.25, 0.5, 0.75)
# Brackets around a quartile: from so many values on, so wide a share on either side holds the sketch's
# error and two ranks more. Fewer values than the last are ordered as a whole.
BRACKETS = [(200_000, 3.0 / SKETCH_ACCURACY), (20_000, 3e-4), (2_000, 3e-3), (200, 3e-2)]
HISTOGRAM_BINS = 100
CURVE_POINTS = 500
# A Gaussian further away than this many bandwidths adds nothing in double precision.
KERNEL_REACH = 9.0


def supported_columns(schema: T.StructType, columns: Sequence[str]) -> list[str]:
    """The known integer, floating and boolean columns among ``columns``; others are reported."""
    kinds = {f.name: f.dataType for f in schema.fields}
    kept = []
    for name in columns:
        if name not in kinds:
            logger.warning("column %s is not in the schema", name)
        elif not isinstance(kinds[name], (T.LongType, T.IntegerType, T.DoubleType, T.BooleanType)):
            logger.warning("column %s is not numeric or boolean", name)
        else:
            kept.append(name)
    return kept


def _number(df: DataFrame, name: str) -> Column:
    """A column as a double; booleans become 0 and 1."""
    value = F.col(name).cast("int") if dict(df.dtypes)[name] == "boolean" else F.col(name)
    return value.cast("double")


def unpivot(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form ``(by…, column, value)``; booleans become 0 and 1."""
    return df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _number(df, c).alias("value")) for c in columns
    ])).alias("s")).select(*by, "s.*")


def describe(df: DataFrame, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """Count, nulls, mean, deviation, extremes and quartiles, one row per column.

    A boolean has a mean and extremes but no deviation or quartiles. Quartiles are exact, at
    the nearest rank. ``label``, which must not be null, splits the figures by one more column.

    ``df`` is read twice, whatever the number of columns: one wide aggregate gives all moments and a
    bracket around every quartile, a second one counts the values below each bracket and the few
    inside it. What is left are small tables of their own.
    """
    booleans = [c for c in columns if dict(df.dtypes)[c] == "boolean"]
    ranked = [c for c in columns if c not in booleans]
    wide = df.select(F.col(label).alias("__label") if label else F.lit(0).alias("__label"),
                     *[_number(df, c).alias(f"__v{i}") for i, c in enumerate(columns)])
    figures = cut_lineage(wide.groupBy("__label").agg(
        *[_moments(F.col(f"__v{i}"), c in ranked).alias(f"__f{i}") for i, c in enumerate(columns)]), "figures")
    moments = figures.select("__label", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"__f{i}")[k].alias(k) for k in ("count", "null_count", "mean", "std", "min", "max")])
        for i, c in enumerate(columns)])).alias("f")).select("__label", "f.*")
    names = [f"p{int(q * 100)}" for q in QUANTILES]
    if ranked:
        found = _quartiles(wide, figures, {i: c for i, c in enumerate(columns) if c in ranked})
        moments = moments.join(found, ["__label", "column"], "left")
    else:
        moments = moments.withColumns({n: F.lit(None).cast("double") for n in names})
    shown = [F.col("__label").alias(label)] if label else []
    is_boolean = F.col("column").isin(booleans)
    return moments.select(*shown, "column", "count", "null_count", "mean", F.when(~is_boolean, F.col("std")).alias("std"),
                          "min", *names, "max")


def _moments(v: Column, ranked: bool) -> Column:
    """All figures of one column as a struct, with the edges of its brackets where it is ranked."""
    edges = [e for _, slack in BRACKETS for q in QUANTILES for e in (max(0.0, q - slack), min(1.0, q + slack))]
    sketch = F.percentile_approx(v, edges, SKETCH_ACCURACY) if ranked else F.lit(None).cast("array<double>")
    return F.struct(
        F.count(v).alias("count"), F.count_if(v.isNull()).alias("null_count"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), sketch.alias("edges"))


def _bracket(figure: Column, which: int, side: int) -> Column:
    """The lower (0) or upper (1) edge of the bracket of one quartile, by the number of values."""
    edge = F.when(F.lit(False), F.lit(None).cast("double"))
    for level, (least, _) in enumerate(BRACKETS):
        edge = edge.when(figure["count"] >= least, F.get(figure["edges"], F.lit(2 * (level * len(QUANTILES) + which) + side)))
    return edge.otherwise(figure["max"] if side else figure["min"])


def _quartiles(wide: DataFrame, figures: DataFrame, ranked: dict[int, str]) -> DataFrame:
    """(__label, column, p25, p50, p75): exact quartiles at the nearest rank ``round(q * (n - 1))``.

    A value inside a bracket is a row of its own, counted with its equals; a row's comparisons with the
    brackets' lower edges ride on its first such row, or on one without a value.
    """
    cells = [(i, k) for i in ranked for k in range(len(QUANTILES))]
    name = lambda kind, i, k: f"__{kind}{i}_{k}"
    edges = figures.select("__label", *[
        _bracket(F.col(f"__f{i}"), k, side).alias(name(kind, i, k))
        for i, k in cells for side, kind in enumerate(("lo", "hi"))])
    v = lambda i: F.col(f"__v{i}")
    inside = F.array_compact(F.array(*[
        F.when(v(i).between(F.col(name("lo", i, k)), F.col(name("hi", i, k))),
               F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), v(i).alias("value"))) for i, k in cells]))
    rows = wide.join(edges, "__label").select(
        "__label", *[(v(i) < F.col(name("lo", i, k))).alias(name("low", i, k)) for i, k in cells],
        F.posexplode_outer(inside).alias("at", "found"))
    first = F.coalesce("at", F.lit(0)) == 0
    # Rows for the distinct values in brackets, and one without a value.
    counted = cut_lineage(rows.groupBy("__label", "found").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(first & F.col(name("low", i, k))).alias(name("low", i, k)) for i, k in cells]), "brackets")
    below = counted.groupBy("__label").agg(*[F.sum(name("low", i, k)).alias(name("low", i, k)) for i, k in cells])
    targets = figures.join(below, "__label").select("__label", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), F.col(name("low", i, k)).alias("before"),
                 F.round(F.lit(QUANTILES[k]) * (F.col(f"__f{i}")["count"] - 1)).cast("bigint").alias("rank"))
        for i, k in cells])).alias("t")).select("__label", "t.*")
    upto = (
        Window.partitionBy("__label", "i", "k").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    names = F.create_map(*[F.lit(x) for i, c in ranked.items() for x in (i, c)])
    return (
        counted.filter(F.col("found").isNotNull()).select("__label", "found.*", "n")
        .withColumn("upto", F.sum("n").over(upto)).join(targets, ["__label", "i", "k"])
        .filter(F.col("before") + F.col("upto") > F.col("rank"))
        .groupBy("__label", names[F.col("i")].alias("column"))
        .agg(*[F.min(F.when(F.col("k") == k, F.col("value"))).alias(f"p{int(q * 100)}") for k, q in enumerate(QUANTILES)])
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS,
              label: str | None = None) -> DataFrame:
    """Equal-width bins over each column's range, empty bins included, the last one closed.

    With ``label`` the bins span the column's range over all labels and are counted per label.
    Null and NaN values are in no bin.
    """
    by = [label] if label else []
    long = unpivot(df, columns, by).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    flat = F.col("lo") == F.col("hi")
    ranges = (
        long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        .select("column", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    )
    # One row per requested column, so always small enough to broadcast.
    place = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = (
        long.join(F.broadcast(ranges), "column")
        .groupBy(*by, "column", place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    frame = counts.select(*by, "column").distinct().join(ranges, "column") if by else ranges
    slots = frame.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    return slots.join(counts, [*by, "column", "bin"], "left").select(
        *by, "column", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def density_curve(df: DataFrame, column: str, points: int = CURVE_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth by Scott's rule.

    Every row adds its kernel to the grid points within reach; the sums are combined per grid
    point before the shuffle, which moves only ``points`` rows per task. The bandwidth shrinks
    with the row count, and with it the number of points a row touches.
    """
    kind = dict(df.dtypes)[column]
    value = (F.col(column).cast("int") if kind == "boolean" else F.col(column)).cast("double")
    values = df.select(value.alias("x")).filter(F.col("x").isNotNull())
    figures = values.agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"))
    lo = figures.select("lo").scalar()
    step = figures.select((F.col("hi") - F.col("lo")) / (points - 1)).scalar()
    h = figures.select(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).scalar()
    n = figures.select("n").scalar()
    located = values.withColumns({"lo": lo, "step": step, "h": h})
    first = F.greatest(F.lit(0), F.floor((F.col("x") - KERNEL_REACH * F.col("h") - F.col("lo")) / F.col("step"))).cast("int")
    last = F.least(F.lit(points - 1), F.ceil((F.col("x") + KERNEL_REACH * F.col("h") - F.col("lo")) / F.col("step"))).cast("int")
    u = (F.col("lo") + F.col("point") * F.col("step") - F.col("x")) / F.col("h")
    sums = (
        located.withColumn("point", F.explode(F.sequence(first, last)))
        .groupBy("point").agg(F.sum(F.exp(-u * u / 2)).alias("total"))
    )
    root = (2 * 3.141592653589793) ** 0.5
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    return grid.join(sums, "point", "left").select(
        "point", (lo + F.col("point") * step).alias("x"),
        (F.coalesce("total", F.lit(0.0)) / (n * h * root)).alias("density"))
