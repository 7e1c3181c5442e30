"""Reaction-pathway curation: transition states, endpoints, single peaks, balanced classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strucsift.operators.ranking import rank_within

PATHWAY = ["reaction_id", "reaction_pathway_id"]
STEP_BUCKET = 4096


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join in which null keys match each other; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def label_transition_states(df: DataFrame, row_filter: Column | None = None) -> DataFrame:
    """Add ``is_ts``: the row's energy is the highest of its pathway.

    All tied rows are labelled. The maximum runs over every row; rows that fail ``row_filter``
    are labelled false. The maximum is aggregated and joined back, not taken in a window, so a
    pathway with very many rows is never sorted in one task.
    """
    row_filter = F.lit(True) if row_filter is None else row_filter
    peak = df.groupBy(*PATHWAY).agg(F.max("energy").alias("__peak"))
    is_ts = F.when(row_filter, F.col("energy") == F.col("__peak")).otherwise(F.lit(False))
    return _null_safe(df, peak, PATHWAY, "inner").withColumn("is_ts", is_ts).drop("__peak")


def endpoint_pathways(labelled: DataFrame, first: Column, last: Column) -> DataFrame:
    """Distinct pathways whose transition state sits on their first or last step."""
    step = F.col("reaction_step_idx")
    return labelled.filter(F.col("is_ts") & ((step == first) | (step == last))).select(*PATHWAY).distinct()


def drop_pathways(df: DataFrame, unwanted: DataFrame) -> DataFrame:
    """Rows of all other pathways."""
    return df.join(unwanted, PATHWAY, "left_anti")


def peak_counts(df: DataFrame) -> DataFrame:
    """Number of interior local maxima per pathway.

    Every energy is sent to its own place and the two places beside it, so a row meets its
    neighbours by an equi-key instead of a lag over the whole pathway.
    """
    step = F.col("reaction_step_idx")
    placed = rank_within(
        df.select(*PATHWAY, "reaction_step_idx", "energy"), PATHWAY,
        [F.floor(step / STEP_BUCKET)], ["reaction_step_idx", "energy"], "place")
    sent = placed.select(*PATHWAY, F.explode(F.array(*[
        F.struct((F.col("place") + d).alias("place"), F.lit(d).alias("side"), F.col("energy").alias("e"))
        for d in (-1, 0, 1)
    ])).alias("s")).select(*PATHWAY, "s.*")
    met = sent.groupBy(*PATHWAY, "place").agg(
        F.max(F.when(F.col("side") == 0, F.col("e"))).alias("here"),
        F.max(F.when(F.col("side") == 1, F.col("e"))).alias("before"),
        F.max(F.when(F.col("side") == -1, F.col("e"))).alias("after"),
    ).filter(F.col("here").isNotNull())
    is_peak = (F.col("here") > F.col("before")) & (F.col("here") > F.col("after"))
    return met.groupBy(*PATHWAY).agg(F.count_if(is_peak).alias("n_peaks"))


def single_peak_pathways(df: DataFrame) -> DataFrame:
    """Pathways with exactly one interior local maximum."""
    return peak_counts(df).filter(F.col("n_peaks") == 1).select(*PATHWAY)


def identity_coverage(df: DataFrame, identity: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct identities, in total or per group.

    Two plain aggregations: (group, identity) first, then the group, so no distinct set is held.
    """
    per_identity = df.groupBy(*by, identity).agg(F.count(F.lit(1)).alias("__n"))
    return per_identity.groupBy(*by).agg(
        F.sum("__n").alias("n_rows"), F.count(identity).alias("n_identities"))


def class_shares(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Share of rows carrying each flag, one row per flag."""
    shares = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(F.coalesce(F.col(f).cast("int"), F.lit(0))).alias(f) for f in flags])
    return shares.select("n_rows", F.explode(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.col(f).alias("share")) for f in flags])).alias("s")).select("s.*", "n_rows")


def removed_share(before: DataFrame, after: DataFrame, keys: Sequence[str] = PATHWAY) -> DataFrame:
    """Share of the groups of ``before`` that ``after`` no longer has."""
    def groups(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(name))

    n_before = groups(before, "n_before")
    n_after = groups(after, "n_after").scalar()
    return n_before.withColumn("n_after", n_after).withColumn(
        "removed_share", (F.col("n_before") - F.col("n_after")) / F.col("n_before"))
