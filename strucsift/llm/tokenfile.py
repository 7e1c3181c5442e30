"""Token ids as flat binary files with 64-bit document offsets, read by memory mapping.

A store is a folder of parts in ascending order of the document id. Part i has ``ids`` (unsigned
integers, 16 bits if the vocabulary allows, else 32), ``offsets`` (unsigned 64-bit, one more than
documents, counted from the part's own first id) and ``docs`` (signed 64-bit ids). ``manifest.json``
has the parts with their bases: how many ids and documents all earlier parts hold, a prefix sum
over the parts. A document's place in the whole is base + offset.

A task writes its part under a name of its own and renames it at the end, so that a task that is
run again, or twice at once, leaves one whole part.

Defined results: a null or empty text has the end id alone. Null ids sort first and are read back
as null. Equal ids are ordered by a hash of their texts, then the texts. An empty table gives a
store without documents. Other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.llm.common import field, prepare, steps
from strucsift.llm.pieces import MOST_CHUNKS, SPACE, Memory, tokenize

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# How a tokenizer of this kind takes words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Chunks encoded as one text.
JOINED = 128
# Bytes of text for one part.
PART_BYTES = 32 << 20
# Ids read at a time.
READ_IDS = 4 << 20
NULL_ID = np.iinfo(np.int64).min
KINDS = ("ids", "offsets", "docs")


def between_words() -> np.ndarray:
    """For ``words_of``: pairs of bytes between which a word of ``WORDS`` always ends, whatever stands around them.

    A digit is a word by itself. ASCII letters are parted from ASCII marks, but for an apostrophe before a letter and
    the bar of special tokens. Other bytes are left together: they may compose, or change their kind.
    """
    byte = np.arange(256)
    digit = (byte >= 0x30) & (byte <= 0x39)
    letter = (byte | 0x20 >= 0x61) & (byte | 0x20 <= 0x7A) & (byte < 0x80)
    mark = (byte > 0x20) & (byte < 0x7F) & ~digit & ~letter & (byte != ord("|"))
    out = digit[:, None] | digit | (letter[:, None] & mark) | ((mark & (byte != ord("'")))[:, None] & letter)
    out[list(SPACE)] = out[:, list(SPACE)] = False
    return out.ravel()


def has_words(path: str) -> bool:
    """Whether the tokenizer of ``path`` takes words by ``WORDS``, each digit a token, and has special tokens as <|this|>."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = [(n["type"], n.get("pattern"), n.get("content")) for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    apart = [(p["type"], p.get("pattern"), p.get("behavior"), p.get("invert"), p.get("add_prefix_space"), p.get("use_regex"))
             for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    model = spec["model"]
    return (steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
            and apart == [("Split", {"Regex": WORDS}, "Removed", True, None, None), ("ByteLevel", None, None, None, False, False)]
            and model["type"] == "BPE" and not model.get("dropout") and not any(spec.get(k) for k in ("post_processor", "truncation", "padding"))
            and all(d + (model.get("end_of_word_suffix") or "") in model["vocab"] for d in "01")
            and all(re.fullmatch(r"<\|[a-z]+\|>", t["content"]) and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"])
                    for t in spec["added_tokens"]))


def joined(tokenizer, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ids of chunks cut at ``between_words``, and all ids. One text of many chunks costs a fraction of
    many texts; a 0 parts them, which only the chunk 0 has inside."""
    zero, one = (tokenizer.encode(d, add_special_tokens=False).ids[0] for d in "01")
    parted = ["1" if c == "0" else c for c in chunks]
    texts = ["0".join([*parted[i:i + JOINED], ""]) for i in range(0, len(parted), JOINED)]
    ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, sum(map(len, ids)))
    ends = np.flatnonzero(flat == zero)
    lengths = np.diff(ends, prepend=-1) - 1
    flat = np.delete(flat, ends)
    if "0" in chunks:
        at = int(lengths[:chunks.index("0")].sum())
        assert flat[at] == one
        flat[at] = zero
    return lengths, flat


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str, most: int = MOST_CHUNKS):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), Memory(most, between_words() if has_words(path) else None)


def encoder(path: str, most: int = MOST_CHUNKS) -> tuple[Callable, Memory]:
    """The encoding of chunks, and a worker's memory of at most so many of them."""
    tokenizer, memory = _tokenizer(path, most)
    if memory.apart is not None:
        return functools.partial(joined, tokenizer), memory
    return lambda chunks: [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)], memory


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as a path or a URI."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))


def with_end(ids: np.ndarray, border: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids with the end id appended, and the new borders."""
    n = len(border) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    sizes = np.diff(border)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), sizes)] = ids
    return out, border + np.arange(n + 1)


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
                 part_bytes: int = PART_BYTES) -> dict:
    """Encode ``docs`` (doc_id, text) into a store at ``folder``; returns its manifest."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or public_tokenizers.path(VOCABULARY)
    width = 2 if max(_tokenizer(path)[0].get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ranged = source.repartitionByRange(max(1, -(-total // part_bytes)), *order[:2]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memory = encoder(path)
        system, root = _place(folder)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        first = next(batches, None)
        if first is None:
            return
        n_ids = n_docs = 0
        files = [system.open_output_stream(f"{root}/.{name}.{kind}") for kind in KINDS]
        files[1].write(np.zeros(1, "<u8").tobytes())
        for whole in itertools.chain([first], batches):
            for batch in steps(whole):
                ids, border = with_end(*tokenize(batch.column("text"), memory, encode), end_id)
                files[0].write(ids.astype(f"<u{width}").tobytes())
                files[1].write((border[1:] + n_ids).astype("<u8").tobytes())
                files[2].write(batch.column("doc_id").fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_ids, n_docs = n_ids + len(ids), n_docs + batch.num_rows
        for file, kind in zip(files, KINDS, strict=True):
            file.close()
            system.move(f"{root}/.{name}.{kind}", f"{root}/part-{part:06d}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_ids": [n_ids], "n_docs": [n_docs]})

    system, root = _place(folder)
    system.create_dir(root, recursive=True)
    # One row per part, whatever the number of documents.
    written = sorted(ranged.mapInArrow(write, "part int, n_ids bigint, n_docs bigint").collect())
    bases = itertools.accumulate(written, lambda a, r: (a[0] + r.n_ids, a[1] + r.n_docs), initial=(0, 0))
    manifest = {"width": width, "parts": [
        {"part": r.part, "ids": r.n_ids, "docs": r.n_docs, "ids_before": i, "docs_before": d}
        for r, (i, d) in zip(written, bases)]}
    with system.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def _mapped(system: fs.FileSystem, path: str) -> pa.NativeFile:
    """A memory map where files are local, else an open file."""
    return pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)


def _part(folder: str, width: int, part: int, docs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document ids, offsets, ids) of a part, some documents at a time; offsets count in the part."""
    system, root = _place(folder)
    ids, offsets, own = (_mapped(system, f"{root}/part-{part:06d}.{kind}") for kind in KINDS)
    edges = np.frombuffer(offsets.read_at(8 * (docs + 1), 0), "<u8").astype(np.int64)
    names = np.frombuffer(own.read_at(8 * docs, 0), "<i8")
    begin = 0
    while begin < docs:
        end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + READ_IDS, "right")) - 1)
        lo, hi = int(edges[begin]), int(edges[end])
        yield names[begin:end], edges[begin:end + 1], np.frombuffer(ids.read_at(width * (hi - lo), width * lo), f"<u{width}")
        begin = end


def read_manifest(folder: str) -> dict:
    system, root = _place(folder)
    with system.open_input_stream(f"{root}/manifest.json") as file:
        return json.loads(file.read())


def _read(spark: SparkSession, folder: str, extra: T.StructField, value: Callable) -> DataFrame:
    prepare(spark)
    manifest = read_manifest(folder)
    width, parts = manifest["width"], manifest["parts"]

    def read(batches):
        for batch in batches:
            for p in batch.to_pylist():
                for names, edges, ids in _part(folder, width, p["part"], p["docs"]):
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(names, mask=names == NULL_ID), "start": edges[:-1] + p["ids_before"],
                        "n_tokens": np.diff(edges), extra.name: value(ids, edges - edges[0])})

    listed = spark.createDataFrame([(p["part"], p["docs"], p["ids_before"]) for p in parts],
                                   "part int, docs bigint, ids_before bigint")
    schema = T.StructType([field("doc_id", "bigint"), field("start", "bigint"), field("n_tokens", "bigint"), extra])
    return listed.repartition(max(1, len(parts))).mapInArrow(read, schema)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a store: doc_id, start, n_tokens and ids."""
    return _read(spark, folder, field("ids", "bigint[]"), lambda ids, edges: pa.ListArray.from_arrays(
        pa.array(edges, pa.int32()), pa.array(ids.astype(np.int64))))


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_tokens``, with the crc32 of the ids as little-endian 32-bit integers."""
    def crc(ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        wide = memoryview(ids.astype("<u4").tobytes())
        return pa.array([zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], pa.int64())

    return _read(spark, folder, field("ids_crc32", "bigint"), crc)
