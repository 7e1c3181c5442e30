"""Order statistics that never sort one group, or the whole table, in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strucsift.session import cut_lineage

# Up to this many rows a sample is a plain top-n, whose last task receives n rows per partition.
# Beyond it the sample is cut at a score.
PLAIN_TOP_N = 1_000
# Leading hex digits of a digest that name its bucket: at most 65,536 buckets.
BUCKET_DIGITS = 4
# Rank error of the quantile sketch is at most 1 / SKETCH_ACCURACY of the rows.
SKETCH_ACCURACY = 100_000
# Parts of a bracket of scores that are ordered apart from each other.
BRACKET_PARTS = 1_024
# Rows of a group that one task orders.
GROUP_ROWS = 65_536


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    bucket: Sequence[Column],
    order: Sequence[Column | str],
    name: str,
) -> DataFrame:
    """Append the 0-based position of each row in its group.

    ``bucket`` holds coarse expressions that never decrease along ``order`` (an integer key
    divided by a width, a digest prefix). Rows are numbered inside a (group, bucket) pair and
    shifted by the sizes of the earlier buckets, so a group that holds much of the table is
    spread over many tasks. Group and bucket values must not be null.
    """
    tags = [f"__bucket{i}" for i in range(len(bucket))]
    keys = [*group, *tags]
    tagged = df.withColumns(dict(zip(tags, bucket)))
    earlier = (
        Window.partitionBy(*group).orderBy(*tags)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
        .select(*keys, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
    )
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        tagged.withColumn("__local", local)
        .join(offsets, keys)
        .withColumn(name, (F.col("__before") + F.col("__local") - 1).cast("bigint"))
        .drop(*tags, "__local", "__before")
    )


def rank_in_groups(
    df: DataFrame,
    group: Sequence[str],
    bucket: Sequence[Column],
    order: Sequence[Column | str],
    name: str,
    most: int = GROUP_ROWS,
) -> DataFrame:
    """As ``rank_within``, for groups that are small as a rule.

    Groups of at most ``most`` rows are numbered by one window over the group; only larger ones, if
    there are any, are spread by bucket. Rows whose group or bucket is null have no place and are left out, as there.
    """
    known = df.dropna(subset=list(group))
    filled = reduce(and_, [b.isNotNull() for b in bucket])
    place = (F.row_number().over(Window.partitionBy(*group).orderBy(*bucket, *order)) - 1).cast("bigint")
    large = cut_lineage(
        known.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most).select(*group), "large-groups")
    if large.isEmpty():
        return known.withColumn(name, place).filter(filled)
    # At most one row per ``most`` rows of the table.
    small = known.join(F.broadcast(large), list(group), "left_anti").withColumn(name, place).filter(filled)
    return small.unionByName(rank_within(known.join(F.broadcast(large), list(group), "left_semi"), group, bucket, order, name))


def row_at(df: DataFrame, order: Sequence[str], position: Callable[[Column], Column]) -> DataFrame:
    """The row at the 0-based ``position(total)``, where ``order`` begins with a hex digest.

    Sizes of digest-prefix buckets tell which one holds the position; only that one is ordered.
    """
    tagged = df.withColumn("__bucket", F.substring(order[0], 1, BUCKET_DIGITS))
    sizes = tagged.groupBy("__bucket").agg(F.count(F.lit(1)).alias("size"))
    upto = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("size").over(upto) - F.col("size")
    target = position(sizes.agg(F.sum("size")).scalar())
    # At most one row.
    edge = (
        sizes.select("__bucket", "size", before.alias("before"))
        .filter((F.col("before") <= target) & (target < F.col("before") + F.col("size")))
        .select(F.col("__bucket").alias("__edge"), (target - F.col("before")).alias("__need"))
    )
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order)) - 1
    return (
        tagged.join(F.broadcast(edge), F.col("__bucket") == F.col("__edge"))
        .withColumn("__place", place).filter(F.col("__place") == F.col("__need"))
        .drop("__bucket", "__edge", "__need", "__place")
    )


def smallest_n(df: DataFrame, n: int, score: Column, ties: Sequence[str], total: int,
               plain_top_n: int = PLAIN_TOP_N) -> DataFrame:
    """The ``n`` rows of lowest ``score`` (ties by ``ties``) out of ``total``.

    Small ``n`` is a top-n. Beyond it the n-th score is bracketed with a quantile sketch: rows
    below the bracket pass in a plain filter and only the few inside it are ordered, part by part.
    ``total`` counts the rows whose score is known; rows with a null score are never taken.
    """
    df = df.filter(score.isNotNull())
    if n >= total:
        return df
    if n <= plain_top_n:
        return df.orderBy(score, *ties).limit(n)
    scored = df.withColumn("__score", score)
    slack = 3.0 / SKETCH_ACCURACY + 2.0 / total
    bounds = [max(0.0, n / total - slack), min(1.0, n / total + slack)]
    sketch = scored.agg(
        F.percentile_approx("__score", bounds, SKETCH_ACCURACY).alias("b")
    )
    low = sketch.select(F.col("b")[0]).scalar()
    high = sketch.select(F.col("b")[1]).scalar()
    passed = scored.filter(F.col("__score") < low)
    taken = passed.agg(F.count(F.lit(1))).scalar()
    width = (high - low).cast("double")
    place = F.when(width > 0, F.floor((F.col("__score") - low) / width * BRACKET_PARTS)).otherwise(F.lit(0)).cast("bigint")
    inside = rank_within(
        scored.filter(F.col("__score").between(low, high)), [], [place], ["__score", *ties], "__rank")
    inside = inside.filter(F.col("__rank") < F.lit(n) - taken).drop("__rank")
    return passed.unionByName(inside).drop("__score")


def nearest_quantiles(long: DataFrame, group: Sequence[str], value: str, quantiles: Sequence[float]) -> DataFrame:
    """Exact quantiles per group, taken at the nearest rank ``round(q * (n - 1))``.

    A mergeable sketch brackets every target rank; one more pass counts the rows below each
    bracket and the distinct values inside it. Only that thin slice is ordered. Group values must
    not be null.
    """
    slack = 3.0 / SKETCH_ACCURACY
    edges = [e for q in quantiles for e in (max(0.0, q - slack), min(1.0, q + slack))]
    known = long.filter(F.col(value).isNotNull())
    # In a small group the slack is less than a row; its bracket is its whole range.
    few = F.col("__n") < 2 * SKETCH_ACCURACY
    targets = (
        known.groupBy(*group).agg(
            F.count(F.lit(1)).alias("__n"),
            F.percentile_approx(value, edges, SKETCH_ACCURACY).alias("__edges"),
            F.min(value).alias("__min"), F.max(value).alias("__max"),
        )
        .select(*group, F.explode(F.array(*[
            F.struct(
                F.lit(q).alias("q"),
                F.round(F.lit(q) * (F.col("__n") - 1)).cast("bigint").alias("rank"),
                F.when(few, F.col("__min")).otherwise(F.col("__edges")[2 * i]).alias("low"),
                F.when(few, F.col("__max")).otherwise(F.col("__edges")[2 * i + 1]).alias("high"),
            )
            for i, q in enumerate(quantiles)
        ])).alias("t"))
        .select(*group, "t.*")
    )
    v = F.col(value)
    # Null stands for "somewhere below the bracket" and sorts first.
    slice_counts = (
        known.join(targets, list(group))
        .filter(v <= F.col("high"))
        .groupBy(*group, "q", "rank", F.when(v >= F.col("low"), v).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    upto = (
        Window.partitionBy(*group, "q").orderBy(F.col("__v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        slice_counts.withColumn("__cum", F.sum("__c").over(upto))
        .filter(F.col("__cum") > F.col("rank"))
        .groupBy(*group, "q").agg(F.min("__v").alias(value))
    )
