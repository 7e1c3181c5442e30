"""From raw documents to training ids: five stages, each a table of its own.

``run`` applies the stages to ``documents``. Every stage reads what its predecessor kept from
Parquet in the shared folder, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strucsift.llm import bpe, decontaminate, lines, minhash, quality
from strucsift.llm.common import ROW_HASH, with_row_hash, without_rows
from strucsift.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A verdict holds for the rows of its id and text, so that
    rows without an id have their own, and so have different texts under one id."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.col("quality") == 1).select("doc_id")
    judged = quality.quality_rules(with_row_hash(docs), trusted, keep=("doc_id", ROW_HASH))
    out = cut_lineage(judged.filter(~F.col("kept")).select("doc_id", ROW_HASH).distinct(), "rejected")
    return without_rows(docs, out).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source and without all but one copy of long
    passages that documents of any source share; one that consisted of boilerplate only goes, and
    lengths are counted anew. The copy that stays is in a document that near-duplicate removal keeps."""
    found = lines.drop_boilerplate(docs.select(*COLUMNS).withColumnRenamed("source", "host"))
    emptied = (F.col("n_dropped") > 0) & (F.col("n_dropped") == F.col("n_lines"))
    left = cut_lineage(found.filter(~emptied).withColumnRenamed("host", "source"), "lines")
    cut = lines.drop_passages(left, leaving=lambda: minhash.near_duplicates(left).filter(~F.col("kept")))
    changed = (F.col("n_dropped") > 0) | (F.col("n_passages") > 0)
    length = F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return minhash.deduplicate(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminated share of benchmark words, judged like by the quality rules."""
    return decontaminate.remove(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.round_trip(docs, keep=("doc_id", "lang", "source", "n_chars"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe_round_trip", bpe_round_trip),
]

# The stages hash, fit and tokenize, which SQL can't: tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
