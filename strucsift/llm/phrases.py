"""Collocations from a vertically partitioned suffix trie over words.

Texts are lower-cased (A-Z) and split into pieces at sentence punctuation and line breaks, and those
into words. All counts are per language; a phrase never leaves its piece.

1. Words are counted. A word of a language has a 64-bit code; that no two have the same is checked
   on the whole vocabulary, else codes are made anew with another seed. Texts become runs of codes,
   broken where no phrase can lie: between pieces and at words below the least count.
2. Prefixes of two words are counted. Only a suffix that begins with a frequent pair is ever dealt
   out, and it ends before the first pair that is not frequent, or after five words.
3. Vertical partitioning: a prefix that begins more suffixes than the budget is extended by a word,
   counted again if need be, until it is below the budget or as long as a suffix. The final prefixes
   are dealt to groups by hash, so that a group has some budgets of suffixes at most.
4. Each group builds its subtrees, truncated at five words, by sorting its suffixes alone; the count
   of a node is the sum of its leaves. A node above a group's prefixes gets its total by adding what
   the groups have.
5. Cuts of candidates are looked up among the counts and scored in exact decimals. Candidates with
   no count of their own beside a longer one are dropped; the best of each language are ranked in
   two steps, so that no task sees a language whole.

Sets of frequent pairs and of prefixes to extend are sent as bitmaps of fixed size: a false hit
costs a suffix that is counted in vain or a longer prefix, but changes no count. Equal suffixes are
added up before they are dealt out.

Defined results: a null or empty text has no words; a null language is ``und`` and one with it.
Ids are not used, so that null and repeated ones do not matter: repeated rows count each. An empty
table gives no phrase. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strucsift.llm.common import BROADCAST_ROWS, if_small, prepare, steps
from strucsift.llm.textscan import Words, mix, weights, words_of
from strucsift.session import cut_lineage

LONGEST = 5
LEAST_COUNT = 100
BEST = 2000
FACTOR = 1000
# Suffixes a prefix may begin before it is extended: the fewer of what a group can sort in memory
# and a small share of all.
BUDGET, SHARE = 1_000_000, 4096
# Groups are this many times fewer than the budget would give if hashing dealt evenly.
GROUP_BUDGETS = 4
# Candidates of a language that one task of the first ranking sees, about.
RANKED = 50_000
PAIR_BITS, HEAVY_BITS = 27, 24
# Bits of a bitmap row in Spark's bitmap functions.
BITMAP_ROW = 32_768
# Words that are put into runs at a time.
STEP_WORDS = 1 << 18
BREAKS = {*b".,;:!?", *range(0x0A, 0x0E)}
PLAIN = weights(lambda b: b not in BREAKS and b not in (0x20, 0x09), fold_case=True)
IS_BREAK = np.isin(np.arange(256), list(BREAKS))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NO_LANGUAGE = "und"
SUFFIX = [f"s{k}" for k in range(1, LONGEST + 1)]
# Fixed odd numbers that tell prefixes of different lengths, and languages, apart.
STEP_FACTOR, LANGUAGE_FACTOR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))


def seeded(seed: int) -> np.ndarray:
    """The weights of bytes in words, for each seed others."""
    return np.where(PLAIN != 0, mix(PLAIN + np.uint64(seed)) | np.uint64(1), np.uint64(0))


def word_codes(words: Words, languages: Sequence[str], seed: int, bits: int = 64) -> np.ndarray:
    """A code above 0 for each word of a language, of so many bits."""
    names = list(dict.fromkeys(languages))
    each = words_of(pa.array(["-" + n.encode().hex() for n in names], pa.string()), seeded(seed)).hash
    number = {n: i for i, n in enumerate(names)}
    own = mix(each * LANGUAGE_FACTOR)[[number[n] for n in languages]] if names else each
    code = mix(words.hash ^ own[words.owner()]) >> np.uint64(64 - bits)
    return np.maximum(code, np.uint64(1))


def distinct_rows(codes: np.ndarray, equal) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct items and their counts. Items of one code are equal unless ``equal``
    (places, places) denies it: those are given one by one."""
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, place, inverse = np.unique(codes, return_index=True, return_inverse=True)
    same = equal(np.arange(len(codes)), place[inverse])
    counts = np.bincount(inverse[same], minlength=len(place))
    odd = np.flatnonzero(~same)
    return np.concatenate([place, odd]), np.concatenate([counts, np.ones(len(odd), np.int64)])


def _same_bytes(words: Words, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words at ``a`` and ``b`` have the same lower-cased bytes."""
    size = ends - words.start
    same = size[a] == size[b]
    a, b = a[same], b[same]
    if len(a):
        length = size[a]
        first = np.cumsum(length) - length
        inside = np.arange(length.sum()) - np.repeat(first, length)
        data = LOWER[words.data]
        agree = data[np.repeat(words.start[a], length) + inside] == data[np.repeat(words.start[b], length) + inside]
        same[same] = np.logical_and.reduceat(agree, first)
    return same


def count_words(docs: DataFrame, seed: int, bits: int = 64) -> DataFrame:
    """(lang, word, code, n) of the whole vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole):
                languages = batch.column("lang").to_pylist()
                words = words_of(batch.column("text"), seeded(seed))
                ends, owner = words.ends(), words.owner()
                codes = word_codes(words, languages, seed, bits)
                same = lambda a, b: (owner_name[a] == owner_name[b]) & _same_bytes(words, ends, a, b)  # noqa: B023, E731
                number = {n: i for i, n in enumerate(dict.fromkeys(languages))}
                owner_name = np.array([number[n] for n in languages], np.int64)[owner]
                place, counts = distinct_rows(codes, same)
                data = LOWER[words.data].tobytes()
                spans = zip(words.start[place].tolist(), ends[place].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([languages[i] for i in owner[place].tolist()], pa.string()),
                    pa.array([data[a:b].decode("utf-8", "surrogatepass") for a, b in spans], pa.string()),
                    pa.array(codes[place].view(np.int64)), pa.array(counts)], ["lang", "word", "code", "n"])

    return docs.mapInArrow(run, "lang string, word string, code bigint, n bigint").groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))


@dataclass
class Codes:
    """The frequent words as executors know them: an ascending array when they are few, else a bitmap."""

    listed: np.ndarray | None
    bits: np.ndarray | None

    def frequent(self, codes: np.ndarray) -> np.ndarray:
        if self.listed is None:
            return is_set(self.bits, mix(codes))
        if not len(self.listed):
            return np.zeros(len(codes), bool)
        return self.listed[np.minimum(np.searchsorted(self.listed, codes), len(self.listed) - 1)] == codes

    def short(self, codes: np.ndarray) -> np.ndarray:
        """What stands for frequent words in runs: their rank in the array, from 1, or the code."""
        return codes if self.listed is None else np.searchsorted(self.listed, codes).astype(np.uint64) + np.uint64(1)

    def code(self, short: np.ndarray) -> np.ndarray:
        """The codes of shortened ones; 0 stays."""
        return short if self.listed is None else np.concatenate([np.zeros(1, np.uint64), self.listed])[short.astype(np.int64)]


def bit_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def is_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of hashed keys are set in a bitmap (bytes, a power of two of them)."""
    at = bit_of(keys, (len(bitmap) * 8).bit_length() - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the 64-bit keys in column ``key``, made on the executors row by row of the bitmap."""
    bit = F.shiftrightunsigned("key", 64 - bits)
    rows = keys.select(bit.alias("bit")).groupBy((F.col("bit") / BITMAP_ROW).cast("bigint").alias("row")).agg(
        F.bitmap_construct_agg((F.col("bit") % BITMAP_ROW).cast("bigint")).alias("map"))
    out = np.zeros(1 << bits - 3, np.uint8)
    for row in rows.collect():
        own = np.frombuffer(bytes(row["map"]), np.uint8)
        begin = row["row"] * BITMAP_ROW // 8
        out[begin:begin + len(own)] = own[:len(out) - begin]
    return out


def runs(docs: DataFrame, seed: int, known, bits: int = 64) -> DataFrame:
    """(codes) of every text: runs of frequent words, a 0 after each run."""
    def encode(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(batch.column("text"), seeded(seed))
        code = word_codes(words, batch.column("lang").to_pylist(), seed, bits)
        often = known.value.frequent(code)
        # A word ends a run when it is the last of its text or followed by a break, or is not frequent.
        broken = np.concatenate([[0], np.cumsum(IS_BREAK[words.data])])
        last = np.ones(len(code), bool)
        last[:-1] = (broken[words.start[1:]] > broken[words.start[:-1]]) | (np.diff(words.owner()) > 0)
        last |= ~often
        value = np.where(often, known.value.short(code), np.uint64(0))
        keep = often | np.concatenate([[False], often[:-1] & ~last[:-1]])
        size = np.where(often & last, 2, 1) * keep
        out = np.repeat(value, size)
        out[(np.cumsum(size) - 1)[often & last]] = 0
        total = np.concatenate([[0], np.cumsum(size)])
        return out, total[words.first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole):
                codes, border = encode(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(border, pa.int32()), pa.array(codes.view(np.int64)))], ["codes"])

    return docs.mapInArrow(run, "codes array<bigint>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The suffixes of all runs, some at a time; runs end with a 0 each."""
    for batch in batches:
        flat = batch.column("codes").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(flat), STEP_WORDS):
            # A block reads on for as many words as a suffix holds, which begin in the next.
            yield _suffix_columns(flat[k:k + STEP_WORDS + LONGEST], min(STEP_WORDS, len(flat) - k))


def _suffix_columns(codes: np.ndarray, n: int) -> np.ndarray:
    """Row k has the k-th words of the suffixes that begin at the first ``n`` places, 0 past their ends."""
    padded = np.concatenate([codes, np.zeros(LONGEST, np.uint64)])
    out = np.stack([padded[k:k + n] for k in range(LONGEST)])
    for k in range(1, LONGEST):
        out[k][out[k - 1] == 0] = 0
    return out[:, out[0] != 0]


def prefix_keys(columns: np.ndarray, depth: int) -> np.ndarray:
    """A hashed key of the first ``depth`` words of every column."""
    key = np.full(columns.shape[1], depth, np.uint64)
    with np.errstate(over="ignore"):
        for row in columns[:depth]:
            key = mix(key * STEP_FACTOR + row)
    return key


def _totals(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns and their counts."""
    same = lambda a, b: (columns[:, a] == columns[:, b]).all(axis=0)
    place, counts = distinct_rows(prefix_keys(columns, len(columns)), same)
    return columns[:, place], counts


def count_prefixes(coded: DataFrame, depth: int, sets) -> DataFrame:
    """(s1..s``depth``, n) of all prefixes of so many words, of which the shorter ones are all heavy."""
    names = SUFFIX[:depth]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _blocks(batches):
            columns = columns[:depth, columns[depth - 1] != 0]
            if depth > 2:
                pairs, heavy = sets.value
                columns = _cut(columns, pairs)
                columns = columns[:, columns[depth - 1] != 0]
                for k in range(1, depth):
                    columns = columns[:, is_set(heavy, prefix_keys(columns, k))]
            found, counts = _totals(columns)
            yield pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int64)) for c in found), pa.array(counts)], [*names, "n"])

    schema = ", ".join(f"{c} bigint" for c in (*names, "n"))
    return coded.mapInArrow(run, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def _cut(columns: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Suffixes that end before the first pair that is not frequent."""
    columns = columns.copy()
    for k in range(1, len(columns)):
        gone = ~is_set(pairs, prefix_keys(columns[k - 1:k + 1], 2)) | (columns[k - 1] == 0)
        columns[k][gone] = 0
    return columns


def _with_key(prefixes: DataFrame, depth: int) -> DataFrame:
    """``prefixes`` (s1..) as the column ``key`` of bitmaps."""
    names = SUFFIX[:depth]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.stack([batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in names])
            yield pa.RecordBatch.from_arrays([pa.array(prefix_keys(columns, depth).view(np.int64))], ["key"])

    return prefixes.select(*names).mapInArrow(run, "key bigint")


def partition(coded: DataFrame, words: DataFrame, known, least: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """The bitmaps of frequent pairs and of the prefixes that begin more than ``budget`` suffixes."""
    context = coded.sparkSession.sparkContext
    single = words.filter(F.col("n") > budget).select("code")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = known.value.short(batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(short.view(np.int64))], ["s1"])

    heavy = bitmap(_with_key(single.mapInArrow(shorten, "s1 bigint"), 1), HEAVY_BITS)
    counted = cut_lineage(count_prefixes(coded, 2, None).filter(F.col("n") >= least), "pairs")
    pairs = bitmap(_with_key(counted, 2), PAIR_BITS)
    for depth in range(2, LONGEST):
        large = counted.filter(F.col("n") > budget)
        if large.isEmpty():
            break
        heavy |= bitmap(_with_key(large, depth), HEAVY_BITS)
        if depth + 1 < LONGEST:
            sets = context.broadcast((pairs, heavy))
            counted = cut_lineage(count_prefixes(coded, depth + 1, sets).filter(F.col("n") > budget), "prefixes")
    return pairs, heavy


def deal(coded: DataFrame, sets, n_groups: int) -> DataFrame:
    """(grp, depth, s1..s5, n): suffixes with the group of their prefix, which has ``depth`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, heavy = sets.value
        for columns in _blocks(batches):
            columns = _cut(columns, pairs)
            found, counts = _totals(columns[:, columns[1] != 0])
            depth, going = np.ones(found.shape[1], np.int64), np.ones(found.shape[1], bool)
            key = prefix_keys(found, 1)
            for k in range(1, LONGEST):
                going &= is_set(heavy, prefix_keys(found, k))
                depth[going] = k + 1
                key[going] = prefix_keys(found[:, going], k + 1)
            group = (key % np.uint64(n_groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), pa.array(depth), *(pa.array(c.view(np.int64)) for c in found), pa.array(counts)],
                ["grp", "depth", *SUFFIX, "n"])

    schema = ", ".join(f"{c} bigint" for c in ("grp", "depth", *SUFFIX, "n"))
    return coded.mapInArrow(run, schema)


def subtrees(table: pa.Table, known, least: int) -> pa.Table:
    """The nodes of two to five words in the subtrees of a group: (phrase, a, whole). A node above
    the group's prefix is not whole: other groups hold other leaves of it."""
    columns = np.stack([table[c].to_numpy().view(np.uint64) for c in SUFFIX])
    depth, counts = table["depth"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort(columns[::-1])
    columns, depth, counts = columns[:, order], depth[order], counts[order]
    fresh = np.zeros(columns.shape[1], bool)
    fresh[0] = True
    phrases, totals, whole = [], [], []
    for k in range(LONGEST):
        # Sorted suffixes part where any word up to this one differs.
        fresh[1:] |= columns[k, 1:] != columns[k, :-1]
        if k == 0:
            continue
        first = np.flatnonzero(fresh)
        a = np.add.reduceat(counts, first)
        complete = depth[first] <= k + 1
        node = (columns[k, first] != 0) & ((a >= least) | ~complete)
        phrases += known.value.code(columns[:k + 1, first[node]]).view(np.int64).T.tolist()
        totals.append(a[node])
        whole.append(complete[node])
    return pa.table({"phrase": pa.array(phrases, pa.list_(pa.int64())), "a": pa.array(np.concatenate(totals), pa.int64()),
                     "whole": pa.array(np.concatenate(whole), pa.bool_())})


def coded_vocabulary(docs: DataFrame, bits: int = 64) -> tuple[DataFrame, int]:
    """(lang, word, code, n) of all words with codes that differ, and the seed that gives them."""
    for seed in range(8):
        words = cut_lineage(count_words(docs, seed, min(64, bits + 8 * seed)), "vocabulary")
        if words.groupBy("code").count().filter("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("no seed gives different codes")


def candidates(docs: DataFrame, least: int = LEAST_COUNT, budget: int | None = None, few_words: int = BROADCAST_ROWS,
               bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrase, a) of all phrases of two to five words on at least ``least`` places, as arrays of
    codes; (lang, word, code, n) of the words on so many; and (lang, n) of all words."""
    spark: SparkSession = docs.sparkSession
    context = spark.sparkContext
    prepare(spark)
    source = docs.select(language().alias("lang"), F.col("text").cast("string").alias("text"))
    vocabulary, seed = coded_vocabulary(source, bits)
    words = cut_lineage(vocabulary.filter(F.col("n") >= least), "words")
    if words.count() <= few_words:
        listed = np.sort(words.select("code").toArrow()["code"].to_numpy().view(np.uint64))
        known = context.broadcast(Codes(listed, None))
    else:
        mixed = _mixed(words)
        known = context.broadcast(Codes(None, bitmap(mixed, PAIR_BITS)))
    coded = cut_lineage(runs(source, seed, known, min(64, bits + 8 * seed)), "runs")
    total = words.agg(F.sum("n")).first()[0] or 0
    budget = budget or max(1, min(BUDGET, total // SHARE))
    sets = context.broadcast(partition(coded, words, known, least, budget))
    n_groups = max(1, -(-total // (GROUP_BUDGETS * budget)))
    dealt = deal(coded, sets, n_groups)

    def build(table: pa.Table) -> pa.Table:
        return subtrees(table, known, least)

    nodes = cut_lineage(dealt.groupBy("grp").applyInArrow(build, "phrase array<bigint>, a bigint, whole boolean"), "nodes")
    above = nodes.filter(~F.col("whole")).groupBy("phrase").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    found = cut_lineage(nodes.filter("whole").select("phrase", "a").unionByName(above), "candidates")
    return found, words, vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))


def _mixed(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(mix(code.copy()).view(np.int64))], ["key"])

    return words.select("code").mapInArrow(run, "key bigint")


def scored(found: DataFrame, words: DataFrame, totals: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``found`` (phrase, a) with lang, n, l, r and score of the lowest-scoring cut."""
    # Every part of a candidate is a candidate or a frequent word.
    counts = found.select("phrase", F.col("a").alias("f")).unionByName(
        words.select(F.array("code").alias("phrase"), F.col("n").alias("f")))
    k = F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")
    cuts = found.select("phrase", "a", k).select(
        "phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("head"),
        F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")).alias("tail"))
    left, right = (counts.select(F.col("phrase").alias(c), F.col("f").alias(n)) for c, n in (("head", "l"), ("tail", "r")))
    first = cut_lineage(words.select(F.col("code").alias("first"), "lang").join(totals, "lang"), "languages")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"CAST({factor} * CAST(a AS DECIMAL(19,0)) AS DECIMAL(38,0))") * exact("n")
    cut = (
        cuts.join(left, "head").join(right, "tail").withColumn("first", F.get("phrase", F.lit(0))).join(if_small(first), "first")
        .withColumn("top", score.cast("decimal(38,0)")).withColumn("below", (exact("l") * exact("r")).cast("decimal(38,0)"))
        .withColumn("score", F.expr("top div below"))
    )
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cut.groupBy("phrase", "a", "lang", "n").agg(best).select("phrase", "a", "lang", "n", "best.score", "best.l", "best.r")


def maximal(found: DataFrame) -> DataFrame:
    """The phrases of ``found`` (phrase, a) that no longer one covers at all their places.

    Counts never rise from a phrase to a longer one, so that the next longer ones decide.
    """
    n = F.size("phrase")
    parts = F.explode(F.array(F.slice("phrase", F.lit(1), n - 1), F.slice("phrase", F.lit(2), n - 1))).alias("phrase")
    longer = found.filter(n > 2).select(parts, F.col("a").alias("most")).groupBy("phrase").agg(F.max("most").alias("most"))
    joined = found.join(longer, "phrase", "left")
    return joined.filter(F.col("most").isNull() | (F.col("most") < F.col("a"))).select("phrase", "a")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, best: int = BEST, budget: int | None = None,
                 few_words: int = BROADCAST_ROWS, bits: int = 64, ranked: int = RANKED) -> DataFrame:
    """Each language's ``best`` phrases of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score."""
    found, words, totals = candidates(docs, least, budget, few_words, bits)
    kept = maximal(found).select(F.col("phrase").alias("whole"))
    whole = scored(found, words, totals).join(kept, F.col("phrase") == F.col("whole"), "left_semi")
    figures = cut_lineage(whole, "scored")
    spelled = (
        figures.select("phrase", F.posexplode("phrase").alias("at", "code")).join(if_small(words.select("code", "word")), "code")
        .groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("phrase", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("text"))
    )
    rows = figures.join(spelled, "phrase").drop("phrase").withColumnRenamed("text", "phrase")
    order = [F.desc("score"), F.desc("a"), F.col("phrase").asc()]
    most = figures.count()
    while most > ranked:
        # The best of every share hold the best of all; shares get fewer until one task can rank them.
        shares = -(-most // ranked)
        place = F.row_number().over(Window.partitionBy("lang", "__share").orderBy(*order))
        rows = rows.withColumn("__share", F.pmod(F.xxhash64("phrase", F.lit(shares)), F.lit(shares)))
        rows = cut_lineage(rows.withColumn("__place", place).filter(F.col("__place") <= best).drop("__share", "__place"), "best")
        most = min(shares * best, most - 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return rows.withColumn("rank", rank).filter(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
