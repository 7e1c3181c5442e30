"""Neighbourhood fingerprints and Tanimoto distances between them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.functions.hashing import hex_to_long
from strucsift.operators.geometry import both_ways
from strucsift.schema import FINGERPRINT_BITS
from strucsift.session import cut_lineage, ship_package

RADIUS = 2
# Fixed value: keeps the union in the Tanimoto ratio above zero.
EPSILON = 1e-8
# Rows of one block on either side of a distance computation.
CANDIDATE_BLOCK = 25_000
POOL_BLOCK = 4_096
# Pairs that one task compares, and the most tasks they are dealt to. Packed rows are too small for their
# bytes to tell how much work they bring.
TASK_PAIRS = 25_000_000
MOST_TASKS = 20_000
# Pairs that numpy compares at a time, some 30 bytes each.
STEP_PAIRS = 500_000
WORD_BITS = 64


def digest(*parts: Column) -> Column:
    """The first 32 bits of the MD5 of the joined parts."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return hex_to_long(F.md5(text.cast("binary")), 8)


def environment_ids(atoms: DataFrame, bonds: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per atom the identifiers ``ids`` of its environments at radius 0 to ``radius``.

    An identifier hashes the atom's own previous one with the count and sum of its neighbours'.
    The sum does not depend on neighbour order and is combined before the shuffle, so no
    neighbour list is ever gathered. Every atom is also linked to itself: one join and one
    aggregation per round then carry its own identifiers along, and no round refers to the one
    before it twice. Bonds are found once and kept in the shared folder.
    """
    itself = atoms.select("sid", F.col("idx").alias("u"), F.col("idx").alias("v"), "z")
    others = both_ways(bonds).withColumn("z", F.lit(None).cast("int"))
    links = cut_lineage(others.unionByName(itself), "links")
    own = F.col("u") == F.col("v")
    current = (
        links.groupBy("sid", F.col("v").alias("idx"))
        .agg(F.max("z").alias("z"), F.count_if(~own).alias("degree"))
        .select("sid", "idx", digest(F.lit("atom"), F.col("z"), F.col("degree")).alias("id0"))
    )
    for r in range(1, radius + 1):
        known = [f"id{k}" for k in range(r)]
        met = (
            links.drop("z").join(current.withColumnRenamed("idx", "v"), ["sid", "v"])
            .groupBy("sid", F.col("u").alias("idx")).agg(
                *[F.max(F.when(own, F.col(c))).alias(c) for c in known],
                F.coalesce(F.sum(F.when(~own, F.col(known[-1]))), F.lit(0)).alias("total"),
                F.count_if(~own).alias("met"))
        )
        fresh = digest(F.lit(r), F.col(known[-1]), F.col("total"), F.col("met"))
        current = met.select("sid", "idx", *known, fresh.alias(f"id{r}"))
    return current.select("sid", "idx", F.array(*[f"id{k}" for k in range(radius + 1)]).alias("ids"))


def circular_fingerprint(atoms: DataFrame, bonds: DataFrame, radius: int = RADIUS,
                         n_bits: int = FINGERPRINT_BITS) -> DataFrame:
    """Set bits of each structure's fingerprint, sorted: at most ``n_bits`` per structure."""
    return (
        environment_ids(atoms, bonds, radius).select("sid", F.explode("ids").alias("id"))
        .select("sid", F.pmod("id", F.lit(n_bits)).cast("int").alias("bit")).distinct()
        .groupBy("sid").agg(F.sort_array(F.collect_list("bit")).alias("set_bits"))
    )


def bit_array(set_bits: Column, n_bits: int = FINGERPRINT_BITS) -> Column:
    """Dense 0/1 array from the positions of the set bits; null without positions."""
    def dense(positions: Column) -> Column:
        places = F.sequence(F.lit(0), F.lit(n_bits - 1))
        return F.when(positions.isNotNull(), F.transform(places, lambda i: F.array_contains(positions, i).cast("tinyint")))

    # Bound as the only element of an array, so that the positions are worked out once.
    return F.get(F.transform(F.array(set_bits), dense), F.lit(0))


def packed_words(bits: Column) -> Column:
    """0/1 array as 64-bit words, first bit highest; a missing array or bit counts as not set."""
    def word(i: Column) -> Column:
        part = F.slice(bits, i * WORD_BITS + 1, WORD_BITS)
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(
            F.coalesce(b.cast("bigint"), F.lit(0).cast("bigint"))))

    n_words = F.ceil(F.size(bits) / WORD_BITS).cast("int")
    words = F.when(F.size(bits) > 0, F.transform(F.sequence(F.lit(0), n_words - 1), word))
    return F.coalesce(words, F.array().cast("array<bigint>"))


def pack(df: DataFrame, *keep: str) -> DataFrame:
    """``(entry_key, bits)`` as ``(entry_key, words, n_set)`` with the columns ``keep``."""
    packed = df.select("entry_key", *keep, packed_words(F.col("bits")).alias("words"))
    n_set = F.aggregate("words", F.lit(0), lambda acc, w: acc + F.bit_count(w))
    return packed.withColumn("n_set", n_set)


def _common_bits(n_words: int) -> Column:
    """Bits set on both sides of a pair."""
    total = F.lit(0)
    for i in range(n_words):
        both = F.get("a_words", F.lit(i)).bitwiseAND(F.get("b_words", F.lit(i)))
        total = total + F.coalesce(F.bit_count(both), F.lit(0))
    return total


def _distance(common: Column, either: Column) -> Column:
    return F.lit(1.0) - common / (either + F.lit(EPSILON))


def _least_distance(n_set: Column, group: Column) -> Column:
    """Distance below which no member of a pool group can be: common bits are at most the smaller count."""
    inside = (n_set >= group["lo"]) & (n_set <= group["hi"])
    below = _distance(n_set.cast("double"), group["lo"].cast("double"))
    above = _distance(group["hi"].cast("double"), n_set.cast("double"))
    return F.when(inside, F.lit(0.0)).when(n_set < group["lo"], below).otherwise(above)


def longest(pool: DataFrame) -> int:
    """Words of the longest packed fingerprint."""
    return pool.agg(F.max(F.size("words"))).first()[0] or 0


def _pool_groups(pool: DataFrame) -> list[tuple[int, int, int, int]]:
    """Groups ``(lo, hi, first, n)`` of the pool by number of bits set, each of ``n`` blocks of about
    ``POOL_BLOCK`` rows from block ``first`` on.

    What reaches the driver is one row per number of bits, so at most ``n_bits + 1``.
    """
    sizes = pool.groupBy("n_set").agg(F.count(F.lit(1)).alias("n")).orderBy("n_set").collect()
    merged: list[list[int]] = []
    for row in sizes:
        if merged and merged[-1][2] + row["n"] <= POOL_BLOCK:
            merged[-1] = [merged[-1][0], row["n_set"], merged[-1][2] + row["n"]]
        else:
            merged.append([row["n_set"], row["n_set"], row["n"]])
    groups, first = [], 0
    for lo, hi, n in merged:
        blocks = -(-n // POOL_BLOCK)
        groups.append((lo, hi, first, blocks))
        first += blocks
    return groups


def _tasks(n_candidates: int, n_pool: int) -> int:
    return max(1, min(MOST_TASKS, -(-n_candidates * n_pool // TASK_PAIRS)))


def _matrix(words: pa.ChunkedArray, n_words: int) -> np.ndarray:
    """Packed fingerprints as rows of ``n_words`` words, shorter ones filled up with zeros."""
    column = words.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), n_words), np.uint64)
    out[np.arange(n_words) < sizes[:, None]] = column.flatten().to_numpy().view(np.uint64)
    return out


def _compare(candidates: DataFrame, pool: DataFrame, n_words: int, own_blocks: int, small: bool, tasks: int) -> DataFrame:
    """Least distance ``(a_entry_key, a_words, a_n_set, distance)`` of candidates to the pool blocks ``theirs`` named in their rows.

    A pool of one block is sent to the candidates. Otherwise both sides meet by (own block, pool block),
    where numpy compares some candidates with the whole pool block at a time. Pairs end in a partial
    minimum and are never kept. They are dealt to ``tasks`` tasks.
    """
    a = candidates.select(*[F.col(c).alias(f"a_{c}") for c in ("entry_key", "words", "n_set")], "theirs")
    b = pool.select(*[F.col(c).alias(f"b_{c}") for c in ("words", "n_set")], "theirs")
    if small:
        met = (a.repartition(tasks) if tasks > 1 else a).join(F.broadcast(b), "theirs")
        common = _common_bits(n_words)
        distance = _distance(common, F.col("a_n_set") + F.col("b_n_set") - common)
        return met.groupBy("a_entry_key", "a_words", "a_n_set").agg(F.min(distance).alias("distance"))

    def compare(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        left, right = _matrix(ours["a_words"], n_words), _matrix(theirs["b_words"], n_words)
        if not len(left) or not len(right):
            return ours.select(kept).slice(0, 0).append_column("distance", pa.array([], pa.float64()))
        n_left, n_right = ours["a_n_set"].to_numpy(), theirs["b_n_set"].to_numpy()
        least = np.empty(len(left))
        share = max(1, STEP_PAIRS // len(right))
        for i in range(0, len(left), share):
            common = np.zeros((len(left[i:i + share]), len(right)), np.int32)
            for w in range(n_words):
                common += np.bitwise_count(left[i:i + share, w, None] & right[None, :, w])
            either = n_left[i:i + share, None] + n_right[None, :] - common
            least[i:i + share] = (1.0 - common / (either + EPSILON)).min(axis=1)
        return ours.select(kept).append_column("distance", pa.array(least))

    ship_package(candidates.sparkSession)
    cell, kept = ["ours", "theirs"], ["a_entry_key", "a_words", "a_n_set"]
    own = F.pmod(F.xxhash64("a_entry_key", "a_words"), F.lit(own_blocks))
    every = F.explode(F.sequence(F.lit(0), F.lit(own_blocks - 1)).cast("array<bigint>"))
    left, right = (x.repartition(tasks, *cell).groupBy(*cell) for x in (a.withColumn("ours", own), b.withColumn("ours", every)))
    schema = T.StructType([*[a.schema[c] for c in kept], T.StructField("distance", T.DoubleType())])
    return left.cogroup(right).applyInArrow(compare, schema).groupBy(*kept).agg(F.min("distance").alias("distance"))


def packed_minimum(candidates: DataFrame, pool: DataFrame, n_candidates: int, n_pool: int,
                   n_words: int, cutoff: float | None = None) -> DataFrame:
    """As :func:`min_distance_to_pool`, of frames that :func:`pack` has packed.

    The pool is grouped by number of bits set, and a candidate visits only groups that can hold a nearer
    member than the nearest one of a first block. With ``cutoff`` it visits the groups that can hold one
    within it, and candidates without any are left out. ``n_words`` is that of the longest fingerprint.
    """
    small = n_pool <= POOL_BLOCK
    # A pool of one block needs no groups: it is compared with every candidate where that is.
    groups = [(0, n_words * WORD_BITS, 0, 1)] if small else _pool_groups(pool)
    own_blocks, tasks = max(1, -(-n_candidates // CANDIDATE_BLOCK)), _tasks(n_candidates, n_pool)
    if not groups:
        return candidates.select("entry_key", F.lit(None).cast("double").alias("distance")).limit(0)
    listed = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("lo", "hi", "first", "n"), g)]) for g in groups])
    here = lambda g: (F.col("n_set") >= g["lo"]) & (F.col("n_set") <= g["hi"])
    home = F.get(F.filter(listed, here), F.lit(0))
    blocked = pool.withColumn("__g", home).withColumn(
        "theirs", F.col("__g.first") + F.pmod(F.xxhash64("entry_key", "words"), F.col("__g.n"))).drop("__g")

    def blocks(wanted: Column) -> Column:
        return F.flatten(F.transform(wanted, lambda g: F.sequence(g["first"], g["first"] + g["n"] - 1))).cast("array<bigint>")

    least = lambda g: _least_distance(F.col("n_set"), g)
    if cutoff is not None or small:
        wanted = listed if cutoff is None else F.filter(listed, lambda g: least(g) <= F.lit(cutoff))
        sent = candidates.withColumn("theirs", F.explode(blocks(wanted)))
        nearest = _compare(sent, blocked, n_words, own_blocks, small, tasks)
        if cutoff is not None:
            nearest = nearest.filter(F.col("distance") <= F.lit(cutoff))
        return nearest.groupBy(F.col("a_entry_key").alias("entry_key")).agg(F.min("distance").alias("distance"))

    ranked = F.array_min(F.transform(listed, lambda g: F.struct(least(g).alias("d"), g["first"].alias("first"), g["n"].alias("n"))))
    first = F.col("__g.first") + F.pmod(F.xxhash64("entry_key", "words"), F.col("__g.n"))
    begun = candidates.withColumn("__g", ranked).withColumn("theirs", first).drop("__g")
    # Hashed rows may leave a block of the pool empty, so every candidate keeps a row here.
    bound = cut_lineage(
        begun.join(_compare(begun, blocked, n_words, own_blocks, small, tasks).select(
            F.col("a_entry_key").alias("entry_key"), F.col("a_words").alias("words"), F.col("distance").alias("bound")),
            ["entry_key", "words"], "left"), "bounds")
    nearer = F.filter(listed, lambda g: F.col("bound").isNull() | (least(g) < F.col("bound")))
    rest = bound.withColumn("seen", F.col("theirs")).withColumn(
        "theirs", F.explode(blocks(nearer))).filter(F.col("theirs") != F.col("seen"))
    later = _compare(rest, blocked, n_words, own_blocks, small, tasks).select(F.col("a_entry_key").alias("entry_key"), "distance")
    found = bound.filter(F.col("bound").isNotNull()).select("entry_key", F.col("bound").alias("distance"))
    return found.unionByName(later).groupBy("entry_key").agg(F.min("distance").alias("distance"))


def min_distance_to_pool(candidates: DataFrame, pool: DataFrame, n_candidates: int, n_pool: int) -> DataFrame:
    """Distance of every candidate to its nearest pool member, as ``(entry_key, distance)``.

    Both sides hold ``(entry_key, bits)`` and are packed into 64-bit words. Equal fingerprints have equal
    distances, so each is compared once, see :func:`packed_minimum`, and one that the pool holds itself not at
    all: no member is nearer. A key that repeats has the least distance of its rows, a row without a fingerprint
    no bits set and so the distance 1; an empty pool gives no rows. ``n_candidates`` and ``n_pool`` must not be
    below the rows of either side.
    """
    def vectors(packed: DataFrame) -> DataFrame:
        return packed.select(F.col("words").alias("entry_key"), "words", "n_set").distinct()

    ours = cut_lineage(pack(candidates), "packed")
    theirs = cut_lineage(vectors(pack(pool)), "pool")
    held = theirs.select("words", F.lit(True).alias("held"))
    own = cut_lineage(vectors(ours).join(held, "words", "left").withColumn("held", F.col("held").isNotNull()), "vectors")
    itself = own.filter("held").select("entry_key", _distance(F.col("n_set"), F.col("n_set")).alias("distance"))
    open_ones = own.filter(~F.col("held")).select("entry_key", "words", "n_set")
    found = packed_minimum(open_ones, theirs, min(n_candidates, open_ones.count()), min(n_pool, theirs.count()),
                           max(longest(ours), longest(theirs)))
    nearest = itself.unionByName(found).withColumnRenamed("entry_key", "words")
    return ours.join(nearest, "words").groupBy("entry_key").agg(F.min("distance").alias("distance"))
