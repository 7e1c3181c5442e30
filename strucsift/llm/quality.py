"""Quality rules: base counts, then a log-likelihood ratio of hashed n-grams.

A document is rejected by its base counts, or because the n-grams of its bytes are less likely
under the multinomial of a trusted target than under that of the raw corpus. Both multinomials are
counted over all documents; the ratio is divided by the number of n-grams of the document.

Defined results: a null or empty text has no words and fails the base rule. A text of fewer than
four bytes has no n-gram and scores 0. Without any target document every ratio is 0, so that only
the base rule rejects. Rows are independent of each other: repeated rows and ids stay repeated.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.llm.common import field, if_small, map_texts, prepare, steps
from strucsift.llm.textscan import grams, per_text, text_bytes, weights, windows, words_of

GRAM = 4
# Hash buckets of n-grams: what the driver receives is one pair of counts each.
BUCKETS = 1 << 16
# Documents below this mean log ratio per n-gram are rejected.
THRESHOLD = -0.3
SYMBOLS = b"#*$%&|<>"
SPACE = {0x20, *range(0x09, 0x0E)}
WORD = weights(lambda b: b not in SPACE, fold_case=False)
LINE = weights(lambda b: b != 0x0A, fold_case=False)
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))

BASE = [field(n, "bigint") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of every text."""
    words = words_of(column, WORD)
    data, edges = words.data, words.edges
    lines = words_of(column, LINE)
    filled = np.add.reduceat(words.inside, lines.start, dtype=np.int64) > 0 if len(lines.start) else np.zeros(0, bool)
    owner, line = lines.owner()[filled], lines.hash[filled]
    order = np.lexsort((line, owner))
    owner, line = owner[order], line[order]
    again = (owner[1:] == owner[:-1]) & (line[1:] == line[:-1])
    window, at, border = windows(words, 5)
    window = window ^ (np.repeat(np.arange(len(words.count)), np.diff(border)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    cover = np.zeros(len(words.hash) + 1, np.int64)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
        hit = at[twice[place] == window]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + 5, -1)
    return {
        "n_words": words.count,
        "word_chars": per_text(words.inside & ((data & 0xC0) != 0x80), edges),
        "n_symbols": per_text(IS_SYMBOL[data], edges),
        "n_dup_lines": np.bincount(owner[1:][again], minlength=len(words.count)),
        "n_repeat_words": per_text(np.cumsum(cover)[:-1] > 0, words.first),
    }


def gram_counts(docs: DataFrame, target: DataFrame | None) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every bucket over the documents in ``target`` (by doc_id) and over all."""
    prepare(docs.sparkSession)
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if target is None:
        marked = marked.withColumn("trusted", F.lit(False))
    else:
        ids = target.select("doc_id", F.lit(True).alias("trusted")).filter(F.col("doc_id").isNotNull()).distinct()
        marked = marked.join(if_small(ids), "doc_id", "left").fillna(False, ["trusted"])

    def count(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for whole in batches:
            for batch in steps(whole):
                codes, border = grams(*text_bytes(batch.column("text")), GRAM, BUCKETS)
                total[1] += np.bincount(codes, minlength=BUCKETS)
                flags = np.repeat(np.array(batch.column("trusted").to_pylist(), bool), np.diff(border))
                total[0] += np.bincount(codes[flags], minlength=BUCKETS)
        used = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[0][used]), pa.array(total[1][used])],
                                         ["bucket", "target", "raw"])

    found = (
        marked.select("text", "trusted").mapInArrow(count, "bucket int, target bigint, raw bigint")
        .groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()
    )
    both = np.zeros((2, BUCKETS), np.int64)
    both[0][found["bucket"]], both[1][found["bucket"]] = found["target"], found["raw"]
    return both[0], both[1]


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the smoothed target share over the smoothed raw share of every bucket."""
    if not target.sum():
        return np.zeros(len(raw))
    share = lambda c: (c + 0.5) / (c.sum() + 0.5 * len(c))
    return np.log(share(target)) - np.log(share(raw))


def quality_rules(docs: DataFrame, target: DataFrame | None, threshold: float = THRESHOLD,
                  keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per document: the columns ``keep``, base counts, base_failed, the length-normalised ratio ``llr`` and ``kept``."""
    ratio = log_ratio(*gram_counts(docs, target))

    def work(batch: pa.RecordBatch) -> dict:
        column = batch.column("text")
        codes, border = grams(*text_bytes(column), GRAM, BUCKETS)
        total = np.concatenate([[0.0], np.cumsum(ratio[codes])])
        llr = (total[border[1:]] - total[border[:-1]]) / np.maximum(np.diff(border), 1)
        return base_counts(column) | {"llr": llr}

    scored = map_texts(docs, [*BASE, field("llr", "double")], work, keep)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
