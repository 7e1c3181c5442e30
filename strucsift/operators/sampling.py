"""Reproducible sampling, leak-free splits and diversity selection.

All draws come from hashed keys: the same seed gives the same rows whatever the partitioning.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strucsift.functions.hashing import hex_to_long, seeded_md5, uniform
from strucsift.operators.fingerprints import longest, pack, packed_minimum
from strucsift.operators.ranking import BUCKET_DIGITS, PLAIN_TOP_N, rank_within, row_at, smallest_n
from strucsift.schema import expand_presets
from strucsift.session import cut_lineage, scratch_path

logger = logging.getLogger(__name__)

Sampler = Callable[..., DataFrame]

# Bits of a digest used as an exactly representable score.
_SCORE_DIGITS = 13

# Defaults of the diversity sampler.
GREEDY_BLOCK = 25_000
GREEDY_THRESHOLD = 0.65


def _score(seed: int | str, key: str) -> Column:
    return hex_to_long(seeded_md5(seed, F.col(key)), _SCORE_DIGITS)


def sample_random(df: DataFrame, n: int | None, seed: int | str | None = None, key: str = "entry_key",
                  plain_top_n: int = PLAIN_TOP_N) -> DataFrame:
    """Exactly ``n`` rows without replacement; all rows when ``n`` is null or 0.

    Rows without a key are not drawn. Beyond ``plain_top_n`` rows the sample is cut by score on
    the executors.
    """
    if not n:
        return df
    df = df.filter(F.col(key).isNotNull())
    total = df.count()
    if total < n:
        raise ValueError(f"n_samples {n} is greater than the number of rows {total}")
    seed = "" if seed is None else seed
    return smallest_n(df, n, _score(seed, key), [key], total, plain_top_n)


def sample_weighted(df: DataFrame, n: int, weight: Column, seed: int | str, key: str = "entry_key",
                    plain_top_n: int = PLAIN_TOP_N) -> DataFrame:
    """``n`` rows without replacement, each draw proportional to ``weight``.

    Keeps the rows of lowest ``ln(-ln(u)) - ln(weight)``: a common factor of all weights moves all
    scores alike. Rows without a key, or of zero or null weight, are never drawn.
    """
    score = F.log(-F.log(uniform(seed, F.col(key)))) - F.log("__w")
    weighted = df.withColumn("__w", weight.cast("double")).filter((F.col("__w") > 0) & F.col(key).isNotNull())
    return smallest_n(weighted, n, F.round(score, 12), [key], weighted.count(), plain_top_n).drop("__w")


def ratio_weights(df: DataFrame, label: str, targets: Mapping[str, float]) -> DataFrame:
    """Add ``weight``: the target share of the row's class over the size of the class."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__size"))
    share = F.element_at(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]), F.col(label))
    known = F.col(label).isin(list(targets))
    # One row per target class.
    return (
        df.join(F.broadcast(sizes.filter(known)), label, "left")
        .withColumn("weight", F.when(known, share / F.col("__size")).otherwise(F.lit(0.0)))
        .drop("__size")
    )


def sample_per_group(df: DataFrame, group: str, n: int | Mapping[str, int], seed: int | str,
                     key: str = "entry_key") -> DataFrame:
    """Up to ``n`` rows of each group (one number, or one per group value).

    Ranks are counted within (group, digest prefix) buckets, so one large group is no
    bottleneck.
    """
    digest = seeded_md5(seed, F.col(key))
    if isinstance(n, Mapping):
        limit = F.element_at(F.create_map(*[F.lit(x) for kv in n.items() for x in kv]), F.col(group))
        df = df.filter(F.col(group).isin(list(n)))
    else:
        limit = F.lit(n)
    ranked = rank_within(
        df.withColumn("__digest", digest), [group],
        [F.substring("__digest", 1, BUCKET_DIGITS)], ["__digest", key], "__rank")
    return ranked.filter(F.col("__rank") < limit).drop("__digest", "__rank")


def split_cutoff(df: DataFrame, identity: str, fraction: float, seed: int | str) -> DataFrame:
    """One row with the digest of the last training identity.

    The first ``floor(fraction * n)`` of the ``n`` distinct identities, in digest order, train.
    """
    digests = df.filter(F.col(identity).isNotNull()).select(identity).distinct().select(
        seeded_md5(seed, F.col(identity)).alias("digest"))
    return row_at(digests, ["digest"], lambda total: F.floor(F.lit(float(fraction)) * total.cast("double")) - 1)


def leak_free_split(df: DataFrame, identity: str, fraction: float = 0.9, seed: int | str = 42) -> DataFrame:
    """Add ``split``: train or validation, decided per identity, never per row.

    A row is compared with the cut-off digest, so rows are neither joined nor shuffled and a
    very frequent identity costs nothing extra. Rows without identity get no split.
    """
    cutoff = F.coalesce(split_cutoff(df, identity, fraction, seed).scalar(), F.lit(""))
    digest = seeded_md5(seed, F.col(identity))
    side = F.when(digest <= cutoff, F.lit("train")).when(digest.isNotNull(), F.lit("validation"))
    return df.withColumn("split", side)


def ordered_blocks(df: DataFrame, block_size: int, key: str = "entry_key") -> DataFrame:
    """Number rows by key order and cut them into blocks of ``block_size``."""
    digest = F.md5(F.col(key).cast("binary"))
    return rank_within(
        df.withColumn("__digest", digest), [], [F.substring("__digest", 1, BUCKET_DIGITS)],
        ["__digest", key], "position",
    ).drop("__digest").withColumn("block", F.floor(F.col("position") / block_size))


def pick_row(df: DataFrame, position: int, key: str = "entry_key") -> DataFrame:
    """The row at a 0-based position in the order of hashed keys; out of range is an error."""
    digests = df.withColumn("__digest", F.md5(F.col(key).cast("binary")))
    row = row_at(digests, ["__digest", key], lambda _total: F.lit(position)).drop("__digest")
    if row.isEmpty():
        raise ValueError(f"row {position} is out of range")
    return row


def _far_from(rows: DataFrame, pool: DataFrame, n_rows: int, n_pool: int, n_words: int,
              threshold: float) -> tuple[DataFrame, int]:
    """The packed rows of which no pool member is within ``threshold``, written once, and their count."""
    near = packed_minimum(rows, pool, n_rows, n_pool, n_words, cutoff=threshold)
    left = cut_lineage(rows.join(near, "entry_key", "left_anti"), "left")
    return left, left.count()


def greedy_diverse(df: DataFrame, n: int | None = None, start: int | None = None,
                   seed: int | str | None = None, block_size: int = GREEDY_BLOCK,
                   threshold: float = GREEDY_THRESHOLD) -> DataFrame:
    """Grow a pool of mutually distant fingerprints, block by block.

    Rows are taken in the order of their hashed keys. Every row of a block whose nearest member
    of the pool, as it was before the block, is further than ``threshold`` joins the pool; rows
    of one block are not compared with each other. ``start`` names the first member by
    position; without it ``seed`` draws one from the first block, else it is the first row.

    Candidates are packed and written once, laid out by block. Blocks are taken in windows: one job
    leaves the rows of a window that are far from the whole pool, and each block of the window that
    still has rows adds them to the pool and removes those near to them from the later blocks. A window
    doubles as long as less than a block is left of it, so the jobs grow with the blocks that add
    rows, not with the rows. The pool lives in the shared folder and can outgrow any single machine.
    Returns ``(entry_key, position)`` of the pool members.
    """
    if n is not None and n <= 0:
        raise ValueError("n must be positive")
    spark = df.sparkSession
    candidates_at = scratch_path(spark, "candidates")
    pool_at = scratch_path(spark, "pool")
    # One task, and one file, per block.
    ordered_blocks(pack(df), block_size).repartition("block").write.partitionBy("block").parquet(candidates_at)
    rows = spark.read.parquet(candidates_at)
    total = rows.count()
    if total == 0:
        raise ValueError("no rows to select from")
    n_words = longest(rows)

    if start is not None:
        if not 0 <= start < total:
            raise ValueError(f"start {start} is out of range")
        first = rows.filter(F.col("block") == start // block_size).filter(F.col("position") == start)
    elif seed is not None:
        first = rows.filter(F.col("block") == 0).orderBy(seeded_md5(seed, F.col("entry_key"))).limit(1)
    else:
        first = rows.filter((F.col("block") == 0) & (F.col("position") == 0))
    layout = ["entry_key", "words", "n_set", "position"]
    first.select(*layout).write.parquet(f"{pool_at}/round=-1")
    first_position = spark.read.schema("position bigint").parquet(pool_at).first()["position"]
    accepted = 1

    n_blocks = -(-total // block_size)
    begin, width = 0, 1
    while begin < n_blocks and (n is None or accepted < n):
        pool = spark.read.schema("entry_key string, words array<bigint>, n_set int, position bigint").parquet(pool_at)
        # Of the pool, only the first member can belong to a block still to come.
        window = rows.filter(F.col("block").between(begin, begin + width - 1) & (F.col("position") != first_position))
        left, n_left = _far_from(window, pool, width * block_size, accepted, n_words, threshold)
        begin, width = begin + width, 2 * width if n_left < block_size else max(1, width // 2)
        while n_left and (n is None or accepted < n):
            block = left.agg(F.min("block")).first()[0]
            added = left.filter(F.col("block") == block).select(*layout)
            if n is not None:
                # A block is bounded, so ordering what is left of it is too.
                added = added.orderBy("position").limit(n - accepted)
            seen = Observation()
            at = f"{pool_at}/round={block}"
            added.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(at)
            accepted += seen.get["n"]
            later = left.filter(F.col("block") > block)
            members = spark.read.schema(added.schema).parquet(at)
            left, n_left = _far_from(later, members, n_left, seen.get["n"], n_words, threshold)

    if n is not None and accepted < n:
        logger.warning("selected %s of %s rows; lower the threshold or ask for fewer", accepted, n)
    pool = spark.read.schema("entry_key string, position bigint").parquet(pool_at)
    return pool.select("entry_key", "position")


def run_sampler(df: DataFrame, method: str | Sampler, n: int | None = None, seed: int | str | None = None,
                required_columns: Sequence[str] | None = None, kwargs: Mapping[str, Any] | None = None) -> DataFrame:
    """Dispatch to a built-in sampler or a callable ``(frame, n, **kwargs) -> frame``.

    A callable must declare the columns it needs; ``seed`` goes to built-in samplers only.
    """
    if callable(method):
        columns = expand_presets(list(required_columns or []))
        return method(df.select(*dict.fromkeys(["entry_key", *columns])), n, **dict(kwargs or {}))
    if method == "all":
        return df
    if method == "random":
        return sample_random(df, n, seed)
    raise ValueError(f"invalid sampling method: {method}")
