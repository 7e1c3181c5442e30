"""What the text operators share: session settings, bounded broadcasts, document ids."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.session import ship_package

# Rows in an Arrow batch: with texts of some 100 KB a batch stays below some 50 MB.
BATCH_ROWS = 512
# A side of at most this many rows of a few numbers (some 50 MB) may be sent to every executor.
BROADCAST_ROWS = 1_000_000
# Bytes of text that one vectorised step works on. Its arrays take some 30 times as much, and a worker
# keeps the memory of its largest step.
STEP_BYTES = 500_000
# A verdict on a text holds for the rows of its id and text: ids may be null or repeat.
ROW_HASH = "__row_hash"


def prepare(spark: SparkSession) -> None:
    """Let executors import this package, and keep Arrow batches small for long texts."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def if_small(side: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` with a broadcast hint when it is counted to hold at most ``limit`` rows."""
    return F.broadcast(side) if side.count() <= limit else side


def with_row_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW_HASH, F.xxhash64("text"))


def same_row(doc_id: str, row_hash: str) -> Column:
    """Whether a row of documents has this id, null included, and this text."""
    return F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(row_hash))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows that have the id and the text of a row of ``gone`` (doc_id, ROW_HASH)."""
    named = gone.select(F.col("doc_id").alias("__gone_id"), F.col(ROW_HASH).alias("__gone_hash"))
    return docs.join(if_small(named), same_row("__gone_id", "__gone_hash"), "left_anti")


# The functions whose compiled models a Python worker keeps from task to task.
_models: list = []


def model(compile_: Callable) -> Callable:
    """``compile_`` with a memory of its last models. A worker keeps them from task to task until it runs an
    operator that works without them, so that the stages of a pipeline do not add up in one worker."""
    kept = functools.lru_cache(maxsize=2)(compile_)
    _models.append(kept)
    return kept


def drop_models(but: Callable | None = None) -> None:
    """Forget all models but those of ``but``."""
    others = [m for m in _models if m is not but and m.cache_info().currsize]
    for m in others:
        m.cache_clear()
    if others:
        give_back()


def give_back() -> None:
    """Return memory that this worker has freed to the system. Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def steps(batch: pa.RecordBatch, column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold at most ``most`` bytes, or one text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield batch.slice(begin)


def map_texts(docs: DataFrame, fields: Sequence[T.StructField], work: Callable[[pa.RecordBatch], dict],
              keep: Sequence[str] = ("doc_id",), text: str = "text", also: Sequence[str] = (),
              uses: Callable | None = None) -> DataFrame:
    """One output row per document: the columns ``keep`` and what ``work`` gives for its text.

    ``work`` takes a batch with ``text`` and ``also`` and returns a list or array per new field. ``uses`` is
    the ``model`` it works with.
    """
    prepare(docs.sparkSession)
    keep, names = list(keep), [f.name for f in fields]
    others = [c for c in dict.fromkeys([*keep, *also]) if c != "text"]
    source = docs.select(*others, F.col(text).cast("string").alias("text"))
    schema = T.StructType([*[source.schema[c] for c in keep], *fields])

    def run(batches):
        drop_models(but=uses)
        for whole in batches:
            for batch in steps(whole):
                found = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep],
                     *[x if isinstance(x, pa.Array) else pa.array(x, from_pandas=False) for x in (found[n] for n in names)]],
                    [*keep, *names])
            if uses is not None:
                # What a model keeps lies among what a step has freed; compared with its work this is cheap.
                give_back()
        give_back()

    return source.mapInArrow(run, schema)


KINDS = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "int": T.IntegerType(),
         "string": T.StringType(), "binary": T.BinaryType()}


def field(name: str, kind: str) -> T.StructField:
    """A nullable field; ``kind`` is a name of ``KINDS``, or such a name with [] for an array."""
    plain = KINDS[kind.removesuffix("[]")]
    return T.StructField(name, T.ArrayType(plain) if kind.endswith("[]") else plain, True)
