"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact check.

1. Every text becomes its set of distinct five-word shingles, known by a 128-bit key, and a
   signature of minima. Texts of equal sets form a class, represented by its smallest id.
2. Bands of the signature put representatives into buckets. A link can only be found in a bucket:
   with 40 bands of 5 rows a pair at the threshold is in none with a chance of 2e-5.
3. In every bucket two hubs are compared with all members, which links most groups in one step.
   Buckets that still hold several components go on: a member most of whose shingles occur nowhere
   else among them cannot reach the threshold and is out; what is left, and not yet connected, is
   compared in blocks of bounded size. So no bucket is capped, and none gathered in one task.
4. A comparison reads the signatures batch by batch and stops when the posterior probability of
   reaching the threshold, from a uniform prior, falls below the chosen chance of a miss. Survivors
   are verified on their full sets. Connected components of the links are the groups.

Defined results: texts without words have no shingles and are linked with nothing; a text of fewer
than five words has its whole sequence as one. Rows with a null id are kept and have no component.
Rows that repeat an id count as one document in ``near_duplicates``, which ignores other columns.
``deduplicate`` judges texts: different texts under one id are documents of their own, which stand
behind all others when one of a group is to stay. It keeps other columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import field, if_small, map_texts, prepare
from strucsift.llm.components import components
from strucsift.llm.textscan import mix, weights, windows, words_of
from strucsift.session import cut_lineage

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 5
N_HASHES = BANDS * ROWS
# Signature entries compared before the posterior is looked at again.
BATCH = 40
# A pair is dropped when its posterior chance of being a link is below this.
MISS = 1e-4
# Members of a bucket compared in one block; pairs one task of the exact check takes for a hub.
BLOCK, SHARE = 512, 256
# Parts of the shingle space by which shared shingles are counted.
PARTS = 256
SPACE = {0x20, *range(0x09, 0x0E)}
WORD = weights(lambda b: b not in SPACE, fold_case=True)
_SEEDS = np.random.default_rng(20_240_501)
FACTORS = _SEEDS.integers(0, 1 << 32, N_HASHES, dtype=np.uint32) | np.uint32(1)
SHIFTS = _SEEDS.integers(0, 1 << 32, N_HASHES, dtype=np.uint32)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of every text as ascending 64-bit hashes."""
    words = words_of(column, WORD)
    found, _, border = windows(words, SHINGLE)
    sets = [np.unique(found[a:b]) for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True)]
    counts = words.count
    for k in range(1, SHINGLE):
        few = np.flatnonzero(counts == k)
        if len(few):
            whole, _, edges = windows(words, k)
            code = mix(whole[edges[few]] + np.uint64(k))
            for i, h in zip(few.tolist(), code, strict=True):
                sets[i] = np.array([h], np.uint64)
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of all hash functions, folded to 16 bits each."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), 1024):
        np.minimum(least, (short[i:i + 1024, None] * FACTORS + SHIFTS).min(axis=0), out=least)
    return ((least ^ (least >> np.uint32(16))) & np.uint32(0xFFFF)).astype("<u2")


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """After each batch, the fewest matches with which a pair stays.

    With a uniform prior the posterior after m matches of n is a Beta(m + 1, n - m + 1); its mass
    above t is the chance of at most m successes in n + 1 trials of probability t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, N_HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def survivors(left: np.ndarray, right: np.ndarray, needed: list[int]) -> np.ndarray:
    """Places of the signature pairs that no batch prunes."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, least in enumerate(needed):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        stay = matches >= least
        alive, matches = alive[stay], matches[stay]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), N_HASHES)


SKETCH = [field("n_shingles", "bigint"), field("key1", "bigint"), field("key2", "bigint"), field("sig", "binary")]


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key1, key2, sig) of every document; no signature without shingles."""
    def work(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"))
        key = lambda salt: np.array([mix(s ^ np.uint64(salt)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        return {"n_shingles": [len(s) for s in sets], "key1": key(0x5851F42D4C957F2D), "key2": key(0x14057B7EF767814F),
                "sig": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())}

    return map_texts(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), SKETCH, work)


def _sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, n, shingles) of the documents in ``reps``."""
    def work(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"))
        edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        return {"n": np.diff(edges).astype(np.int64), "shingles": pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))}

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(if_small(reps), "rep", "left_semi")
    return map_texts(chosen, [field("n", "bigint"), field("shingles", "bigint[]")], work, keep=("rep",))


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, band, rep) of all bands."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    return reps.select("rep", "sig", band).select(
        F.xxhash64("band", F.substring("sig", F.col("band") * F.lit(2 * ROWS) + 1, F.lit(2 * ROWS))).alias("bucket"), "band", "rep")


def _prune(pairs: DataFrame, reps: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that Bayesian verification leaves."""
    needed = least_matches(percent, miss)
    a, b = (reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = survivors(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")), needed)
            yield batch.select(["a", "b"]).take(pa.array(stay))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    The members of a hub b are dealt out in shares; the hub's set comes first in each share, and
    members are compared as they stream by.
    """
    shares = F.ceil(F.col("n_pairs") / SHARE).cast("bigint")
    hubs = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n_pairs"))
    members = (
        pairs.join(hubs, "b").select("b", F.pmod(F.xxhash64("a"), shares).alias("share"), F.col("a").alias("rep"))
        .join(sets, "rep").select("b", "share", F.lit(1).alias("kind"), "rep", "shingles")
    )
    heads = (
        hubs.select("b", F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1)).alias("share"))
        .join(sets.withColumnRenamed("rep", "b"), "b").select("b", "share", F.lit(0).alias("kind"), F.col("b").alias("rep"), "shingles")
    )
    dealt = heads.unionByName(members).repartition("b", "share").sortWithinPartitions("b", "share", "kind", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: tuple[list[int], list[int]] = ([], [])
            column = batch.column("shingles")
            edges = column.offsets.to_numpy()
            flat = column.values.to_numpy().view(np.uint64)
            for i, (b, kind, rep) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("b", "kind", "rep")], strict=True)):
                found = flat[edges[i]:edges[i + 1]]
                if kind == 0:
                    hub, own = b, found.copy()
                elif hub == b and len(own):
                    at = np.minimum(np.searchsorted(own, found), len(own) - 1)
                    same = int((own[at] == found).sum())
                    if 100 * same >= percent * (len(own) + len(found) - same):
                        out[0].append(rep)
                        out[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _open_buckets(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, band, rep, comp) of buckets that hold more than one component."""
    known = members.join(comps.select(F.col("id").alias("rep"), "root"), "rep", "left").select(
        "bucket", "band", "rep", F.coalesce("root", "rep").alias("comp"))
    several = known.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket")
    return known.join(several, "bucket", "left_semi")


def _support(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, n, shared, profile): how many shingles of each also occur in another of ``reps``, and
    their numbers in each part of the shingle space."""
    own = sets.join(reps, "rep", "left_semi")
    # No longer than the document itself.
    alone = (
        own.select("rep", F.explode("shingles").alias("s")).groupBy("s")
        .agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("rep")).filter("c = 1")
        .groupBy("rep").agg(F.collect_list("s").alias("alone"))
    )
    parts = lambda x: np.bincount(np.asarray(x, np.int64) & (PARTS - 1), minlength=PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            profile = [parts(every) - parts(few or []) for every, few in
                       zip(batch.column("shingles").to_pylist(), batch.column("alone").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("n"), pa.array([int(p.sum()) for p in profile], pa.int64()),
                 pa.array([p.astype("<u4").tobytes() for p in profile], pa.binary())], ["rep", "n", "shared", "profile"])

    return own.join(alone, "rep", "left").select("rep", "n", "shingles", "alone").mapInArrow(
        run, "rep bigint, n bigint, shared bigint, profile binary")


def _block_pairs(members: DataFrame, reps: DataFrame, support: DataFrame, percent: int, miss: float) -> DataFrame:
    """Unpruned pairs (a, b) of different components in one bucket, found block by block.

    ``members``: (bucket, band, rep, comp). The bucket's largest component needs no comparison in itself:
    its members meet the open ones only. Blocks are dealt by (bucket, block of open members, block
    of all members). A pair of open members is compared once, and a pair that shares several
    buckets is given by the one of its first band. Shared shingles in each part of the shingle
    space bound the intersection from above, which spares pairs that differ in different places.
    """
    size = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
    plan = size.groupBy("bucket").agg(F.max_by("comp", F.struct("c", "comp")).alias("anchor"),
                                      F.sum("c").alias("all"), F.max("c").alias("most"))
    plan = plan.select("bucket", "anchor", F.ceil(F.col("all") / BLOCK).cast("int").alias("n_all"),
                       F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("n_open"))
    rows = members.join(plan, "bucket").withColumn("is_open", F.col("comp") != F.col("anchor"))
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    opens = rows.filter("is_open").withColumn("i", part("n_open")).withColumn("j", every("n_all")).withColumn("side", F.lit(0))
    others = rows.withColumn("j", part("n_all")).withColumn("i", every("n_open")).withColumn("side", F.lit(1))
    columns = ["bucket", "i", "j", "side", "band", "rep", "comp", "is_open"]
    facts = reps.select("rep", "sig").join(support, "rep")
    dealt = (
        opens.select(*columns).unionByName(others.select(*columns)).join(facts, "rep")
        .select(*columns, "n", "shared", "profile", "sig").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side")
    )
    needed = least_matches(percent, miss)

    def compare(block: pa.Table) -> Iterator[pa.RecordBatch]:
        side = block["side"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        rep, comp, n, shared = (block[c].to_numpy() for c in ("rep", "comp", "n", "shared"))
        is_open, sig, band = block["is_open"].to_numpy(), _signatures(block["sig"]), int(block["band"][0].as_py())
        profile = np.frombuffer(b"".join(block["profile"].to_pylist()), "<u4").reshape(len(rep), PARTS)
        # The shared shingles bound the intersection from above.
        most = np.minimum(shared[left][:, None], shared[right][None, :])
        able = (comp[left][:, None] != comp[right][None, :]) & (100 * most >= percent * (n[left][:, None] + n[right][None, :] - most))
        able &= ~is_open[right][None, :] | (rep[left][:, None] < rep[right][None, :])
        a, b = np.nonzero(able)
        for k in range(0, len(a), 16_384):
            x, y = left[a[k:k + 16_384]], right[b[k:k + 16_384]]
            stay = survivors(sig[x], sig[y], needed)
            x, y = x[stay], y[stay]
            most = np.minimum(profile[x], profile[y]).sum(axis=1, dtype=np.int64)
            same = (sig[x] == sig[y])[:, :band * ROWS].reshape(len(x), band, ROWS)
            give = (100 * most >= percent * (n[x] + n[y] - most)) & ~same.all(axis=2).any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(rep[x[give]]), pa.array(rep[y[give]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = np.stack([table[c].to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=False):
                yield from compare(table.slice(lo, hi - lo))
            # The last block may go on in the next batch.
            rest = table.slice(int(cuts[-1]) if len(cuts) else 0)
        if rest is not None and rest.num_rows:
            yield from compare(rest)

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Per document: n_shingles, component_id (smallest id of its group) and kept (is that id)."""
    prepare(docs.sparkSession)
    sketched = cut_lineage(sketch(docs), "sketch")
    keyed = ["key1", "key2", "n_shingles"]
    classes = cut_lineage(
        sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*keyed)
        .agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")), "classes")
    reps = classes.select("rep", "sig")

    bands = _buckets(reps)
    hubs = bands.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("c"), F.min("rep").alias("hub0"), F.min_by("rep", F.xxhash64("rep")).alias("hub1")).filter("c > 1")
    members = cut_lineage(bands.join(hubs.drop("c"), "bucket"), "members")
    sets = cut_lineage(_sets(docs, members.select("rep").distinct()), "sets")
    first = (
        members.select(F.col("rep").alias("a"), F.explode(F.array("hub0", "hub1")).alias("b"))
        .filter("a <> b").distinct()
    )
    links = cut_lineage(_verify(_prune(first, reps, percent, miss), sets, percent), "links")

    left = cut_lineage(_open_buckets(members.select("bucket", "band", "rep"), components(links)), "open")
    support = _support(sets, left.select("rep").distinct())
    support = cut_lineage(support.filter(100 * F.col("shared") >= percent * F.col("n")), "support")
    able = left.join(support.select("rep"), "rep", "left_semi")
    several = able.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket")
    able = cut_lineage(able.join(several, "bucket", "left_semi"), "able")
    more = _verify(_block_pairs(able, reps, support, percent, miss), sets, percent)

    comps = components(links.unionByName(more))
    roots = classes.join(comps, classes["rep"] == comps["id"], "left").select(
        *keyed, F.coalesce("root", "rep").alias("root"))
    joined = sketched.join(roots, keyed, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _vertices(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__vertex``: the id, or where an id has several texts a number of its own for each,
    above all ids. Those numbers are written once, so that a task that is run again finds the same."""
    marked = docs.withColumn("__text_hash", F.xxhash64("text"))
    texts = marked.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("__text_hash").alias("lo"), F.max("__text_hash").alias("hi"), F.max("doc_id").alias("id"))
    several = cut_lineage(texts.filter("lo < hi").select("doc_id"), "repeated")
    id_type = F.col("doc_id").cast("bigint")
    if several.isEmpty():
        return marked.drop("__text_hash").withColumn("__vertex", id_type)
    top = docs.agg(F.max(id_type)).first()[0]
    pairs = marked.select("doc_id", "__text_hash").join(if_small(several), "doc_id", "left_semi").distinct()
    numbered = cut_lineage(pairs.select(
        F.col("doc_id").alias("__id"), F.col("__text_hash").alias("__hash"),
        (F.monotonically_increasing_id() + F.lit(top) + 1).alias("__own")), "vertices")
    same = (F.col("doc_id") == F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    return marked.join(if_small(numbered), same, "left").withColumn("__vertex", F.coalesce("__own", id_type)).drop(
        "__text_hash", "__id", "__hash", "__own")


def deduplicate(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """``docs`` with one document of every group: the one of the smallest id."""
    placed = _vertices(docs)
    judged = near_duplicates(placed.select(F.col("__vertex").alias("doc_id"), "text"), percent, miss)
    gone = cut_lineage(judged.filter(~F.col("kept")).select(F.col("doc_id").alias("__vertex")).distinct(), "copies")
    return placed.join(if_small(gone), "__vertex", "left_anti").select(*docs.columns)
