"""The queries of the text operators over the given tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strucsift.llm import bpe, chat, decontaminate, language, lines, minhash, packing, phrases, quality, tokencount, tokenfile, toxicity, whitening
from strucsift.session import scratch_path


def _held_out(folds: int, fold: int) -> Column:
    """Whether a document belongs to the fold that is not learnt from; one without an id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, directory, "documents"))


def op2_token_files(spark: SparkSession, directory: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    tokenfile.write_tokens(_table(spark, directory, "documents"), folder)
    return tokenfile.read_checksums(spark, folder)


def op3_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, directory, "documents"))


def op4_chat_perspectives(spark: SparkSession, directory: str) -> DataFrame:
    return chat.with_mask_text(chat.rotate_perspectives(_table(spark, directory, "conversations")))


def op5_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages").select(
        "page_id", lines.host_of(F.col("url")).alias("host"), lines.html_lines(F.col("html")).alias("text"))
    return lines.drop_boilerplate(pages)


def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    held_out = _held_out(3, 1)
    lexicon = toxicity.learn(docs, _table(spark, directory, "labels").filter(~held_out))
    return toxicity.score(docs, lexicon).withColumn("held_out", held_out)


def op7_decontaminate(spark: SparkSession, directory: str) -> DataFrame:
    docs, benchmark = _table(spark, directory, "documents"), _table(spark, directory, "benchmark")
    return decontaminate.digest(decontaminate.scan(docs, benchmark))


def op8_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return bpe.round_trip(_table(spark, directory, "documents"))


def op9_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents")
    held_out = _held_out(5, 0)
    model = language.learn(docs.filter(~held_out).select("text", "lang"))
    return language.predict(docs, model).withColumn("held_out", held_out)


def op10_quality(spark: SparkSession, directory: str) -> DataFrame:
    trusted = _table(spark, directory, "labels").filter(F.col("quality") == 1).select("doc_id")
    return quality.quality_rules(_table(spark, directory, "documents"), trusted)


def op11_embedding_whitening(spark: SparkSession, directory: str) -> DataFrame:
    return whitening.whiten(_table(spark, directory, "embeddings"))


def op12_packing(spark: SparkSession, directory: str) -> DataFrame:
    pieces = packing.pack(_table(spark, directory, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return phrases.collocations(_table(spark, directory, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": op1_near_duplicates, "op2_token_files": op2_token_files, "op3_token_counts": op3_token_counts,
    "op4_chat_perspectives": op4_chat_perspectives, "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate, "op8_bpe": op8_bpe, "op9_language": op9_language, "op10_quality": op10_quality,
    "op11_embedding_whitening": op11_embedding_whitening, "op12_packing": op12_packing,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {"op4_chat_perspectives": chat.ORACLE, "op5_line_dedup": lines.oracle()}
