"""Benchmark decontamination: windows of test words looked up in every training document.

The test set's windows of 13 words (an item of fewer words is one window) form a hash set. It is
sent to the executors in slices of a fixed number of windows, one pass over the documents for a
slice, so that no broadcast grows with the test set; usually one slice holds all. Every hit is
verified word by word. The words of the documents inside any occurrence are hit; documents, or
the hit spans alone, can be removed.

Defined results: null or empty texts have no words and are never contaminated. Test rows with a
null id or without words are ignored; rows that repeat an id add windows to the same item. An
empty test set hits nothing. Repeated documents are judged each by itself. Other columns of either
table are ignored by ``scan`` and kept by ``remove``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import ROW_HASH, field, map_texts, prepare, same_row, with_row_hash, without_rows
from strucsift.llm.textscan import Words, weights, windows, words_of
from strucsift.session import cut_lineage

WINDOW = 13
# Windows sent to the executors at a time: with ids and words about 100 MB.
SLICE_WINDOWS = 300_000
_WORD_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
WORD = weights(lambda b: b in _WORD_BYTES, fold_case=True)

FIELDS = [field("n_words", "bigint"), field("n_hit", "bigint"), field("items", "string[]"),
          field("span_start", "bigint[]"), field("span_end", "bigint[]")]


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of every item: (item, k, hash, words), the words lower-cased, spaced."""
    prepare(benchmark.sparkSession)

    def cut(batches):
        for batch in batches:
            words, ids = words_of(batch.column("text"), WORD), batch.column("item").to_pylist()
            texts = _lower(words)
            rows = []
            for i, item in enumerate(ids):
                lo, hi = int(words.first[i]), int(words.first[i + 1])
                k = min(window, hi - lo)
                if k and item is not None:
                    own = Words(words.hash[lo:hi], words.start[lo:hi], np.array([0, hi - lo]), words.inside, words.data, words.edges)
                    rows += [(item, k, int(h), b" ".join(texts[lo + a:lo + a + k])) for h, a in zip(*windows(own, k)[:2], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64)), pa.array([r[3] for r in rows], pa.binary())],
                ["item", "k", "hash", "words"])

    return (
        benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
        .mapInArrow(cut, "item string, k int, hash bigint, words binary").distinct()
    )


def _lower(words: Words) -> list[bytes]:
    data = words.data.tobytes()
    return [data[a:b].lower() for a, b in zip(words.start.tolist(), words.ends().tolist(), strict=True)]


class _Index:
    """The windows of one slice: hashes in order, and for each its item and words."""

    def __init__(self, rows: list):
        rows = sorted((r["k"], r["hash"] & (2**64 - 1), r["item"], bytes(r["words"])) for r in rows)
        self.by_length = {}
        for k in sorted({r[0] for r in rows}):
            own = [r for r in rows if r[0] == k]
            known: dict[int, list[tuple[str, bytes]]] = {}
            for _, h, item, words in own:
                known.setdefault(h, []).append((item, words))
            self.by_length[k] = np.array(sorted(known), np.uint64), known

    def hits(self, words: Words) -> list[tuple[int, int, set[str]]]:
        """(first word, length, items) of every verified window."""
        out, texts = [], None
        for k, (hashes, known) in self.by_length.items():
            found, at, _ = windows(words, k)
            if not len(found):
                continue
            place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for i in np.flatnonzero(hashes[place] == found).tolist():
                if texts is None:
                    texts = words.data.tobytes(), words.start, words.ends()
                first = int(at[i])
                own = b" ".join(texts[0][a:b].lower() for a, b in zip(texts[1][first:first + k].tolist(), texts[2][first:first + k].tolist(), strict=True))
                items = {item for item, same in known[int(found[i])] if same == own}
                if items:
                    out.append((first, k, items))
        return out


def _spans(words: Words, hit: np.ndarray, judged: list) -> list[tuple[list[int], list[int]]]:
    """Begins and ends, in characters, of the runs of hit words in every text that ``judged`` names."""
    spans = [([], [])] * len(judged)
    if hit.any():
        ends, char = words.ends(), np.cumsum((words.data & 0xC0) != 0x80)
        for i in range(len(judged)):
            if judged[i]:
                lo, hi = words.first[i], words.first[i + 1]
                step = np.diff(np.concatenate([[0], hit[lo:hi].astype(np.int8), [0]]))
                before = char[words.edges[i] - 1] if words.edges[i] else 0
                spans[i] = ((char[words.start[lo + np.flatnonzero(step == 1)]] - 1 - before).tolist(),
                            (char[ends[lo + np.flatnonzero(step == -1) - 1] - 1] - before).tolist())
    return spans


def _pass(docs: DataFrame, index: _Index, keep: Sequence[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def work(batch: pa.RecordBatch) -> dict:
        words = words_of(batch.column("text"), WORD)
        n = len(words.count)
        cover, items = np.zeros(len(words.hash) + 1, np.int64), [set() for _ in range(n)]
        for first, k, found in shared.value.hits(words):
            cover[first] += 1
            cover[first + k] -= 1
            items[int(np.searchsorted(words.first, first, "right")) - 1] |= found
        hit = np.cumsum(cover)[:-1] > 0
        spans = _spans(words, hit, items)
        hits = np.concatenate([[0], np.cumsum(hit)])
        return {
            "n_words": words.count, "n_hit": hits[words.first[1:]] - hits[words.first[:-1]],
            "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            "span_start": pa.array([s for s, _ in spans], pa.list_(pa.int64())),
            "span_end": pa.array([e for _, e in spans], pa.list_(pa.int64())),
        }

    return map_texts(docs, FIELDS, work, keep)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_windows: int = SLICE_WINDOWS,
         keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document: the columns ``keep``, n_words, n_hit, items (sorted ids), and hit spans in characters.

    Several slices mean several passes, joined by id and text, on which alone hits depend: null and
    repeated ids give what one pass gives. Words hit by two slices are united by their spans.
    """
    found = test_windows(benchmark, window)
    n_slices = max(1, -(-found.count() // slice_windows))
    if n_slices == 1:
        return _pass(docs.select(*keep, "text"), _Index(found.collect()), keep)
    source, parts = with_row_hash(docs.select("doc_id", "text")), []
    for s in range(n_slices):
        # A share of the windows with at most about slice_windows rows.
        rows = found.filter(F.pmod(F.col("hash"), F.lit(n_slices)) == s).collect()
        parts.append(_pass(source, _Index(rows), ("doc_id", ROW_HASH)))
    return _unite(docs, parts, keep)


def _unite(docs: DataFrame, parts: list[DataFrame], keep: Sequence[str]) -> DataFrame:
    """Unite the passes of all slices: rows with hits are gathered by id and text, others need not.

    Rows of equal id and text give equal hits, so that a group has one set of them for each slice.
    """
    some = [p.filter(F.size("items") > 0) for p in parts]
    every = some[0]
    for p in some[1:]:
        every = every.unionByName(p)
    hits = F.collect_set(F.struct("items", F.arrays_zip("span_start", "span_end").alias("spans")))
    united = every.groupBy(F.col("doc_id").alias("__id"), F.col(ROW_HASH).alias("__hash")).agg(hits.alias("hits")).select(
        "__id", "__hash", F.array_sort(F.array_distinct(F.flatten("hits.items"))).alias("__items"),
        F.array_distinct(F.flatten("hits.spans")).alias("__spans"))
    texts = docs.select(*dict.fromkeys([*keep, "doc_id", "text"])).join(
        united, same_row("__id", "__hash"), "left")

    def work(batch: pa.RecordBatch) -> dict:
        column = batch.column("text")
        words = words_of(column, WORD)
        found = batch.column("__spans").to_pylist()
        hit = np.zeros(len(words.hash), bool)
        char = np.cumsum((words.data & 0xC0) != 0x80)
        for i, own in enumerate(found):
            if own:
                lo, hi = words.first[i], words.first[i + 1]
                before = char[words.edges[i] - 1] if words.edges[i] else 0
                at = char[words.start[lo:hi]] - 1 - before
                for s in own:
                    hit[lo:hi] |= (at >= s["span_start"]) & (at < s["span_end"])
        # Runs of hit words, so that spans of two slices that touch are one, as in a single pass.
        spans = _spans(words, hit, found)
        hits = np.concatenate([[0], np.cumsum(hit)])
        return {"n_words": words.count, "n_hit": hits[words.first[1:]] - hits[words.first[:-1]],
                "items": pa.array([x or [] for x in batch.column("__items").to_pylist()], pa.list_(pa.string())),
                "span_start": pa.array([x for x, _ in spans], pa.list_(pa.int64())),
                "span_end": pa.array([x for _, x in spans], pa.list_(pa.int64()))}

    return map_texts(texts, FIELDS, work, keep, also=("__items", "__spans"))


def contaminated() -> F.Column:
    """The contamination rule: a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the contract: counts, a digest of the items, the verdict."""
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, spans: bool = False, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or without the hit spans of all.

    A verdict holds for the rows of its id and text: null and repeated ids are judged row by row.
    """
    own = docs.columns
    found = scan(with_row_hash(docs), benchmark, window, keep=("doc_id", ROW_HASH)).select(
        "doc_id", ROW_HASH, "span_start", "span_end", contaminated().alias("__out"))
    if not spans:
        gone = cut_lineage(found.filter("__out").select("doc_id", ROW_HASH).distinct(), "contaminated")
        return without_rows(docs, gone).select(*own)
    hit = found.filter(F.size("span_start") > 0).select(
        F.col("doc_id").alias("__id"), F.col(ROW_HASH).alias("__hash"), F.col("span_start").alias("__from"),
        F.col("span_end").alias("__to")).dropDuplicates(["__id", "__hash"])
    # The text between the end of one span and the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.col("__to"))
    ends = F.concat(F.col("__from"), F.array(F.char_length("text").cast("bigint")))
    rest = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))), "")
    return docs.join(hit, same_row("__id", "__hash"), "left").withColumn(
        "text", F.when(F.col("__from").isNull(), F.col("text")).otherwise(rest)).select(*own)
