"""Extended-XYZ text files: frames of a count line, a comment line and one line per atom.

Plain files are read as text, so Spark splits them like any other. A task parses the frames that are
whole in its split where it reads them; only the first and the last piece of a split, which may be
parts of one frame, move to be joined. Compressed files cannot be split and are decoded as a stream.
"""

from __future__ import annotations

import lzma
import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import suppress
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strucsift.functions.elements import SYMBOLS
from strucsift.session import cut_lineage, ship_package

_D = T.DoubleType()
_ROWS = T.ArrayType(T.ArrayType(_D))
FRAME_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("frame_idx", T.LongType()),
    T.StructField("numbers", T.ArrayType(T.IntegerType())), T.StructField("positions", _ROWS), T.StructField("forces", _ROWS),
    T.StructField("tags", T.ArrayType(T.IntegerType())), T.StructField("charges", T.ArrayType(_D)), T.StructField("cell", _ROWS),
    T.StructField("pbc", T.ArrayType(T.BooleanType())), T.StructField("energy", _D), T.StructField("stress", T.ArrayType(_D)),
    T.StructField("info", T.MapType(T.StringType(), T.StringType())),
    T.StructField("arrays", T.MapType(T.StringType(), T.ArrayType(_D))),
])
# A whole frame, or the lines of a piece at the border of a split.
_PIECE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("block", T.LongType()), T.StructField("ordinal", T.LongType()),
    T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("begins", T.BooleanType()), *FRAME_SCHEMA.fields[2:]])
# Columns of a frame that have a place of their own in a record.
_KNOWN = {"species", "Z", "numbers", "pos", "positions", "forces", "force", "tags"}
CHARGES = ("charges", "mulliken_charges", "initial_charges")

ATOMIC_NUMBER = {s: z for z, s in enumerate(SYMBOLS)}

# A line that is one integer starts a frame. The comment line of this format has key=value pairs,
# so it cannot be mistaken for one.
COUNT_LINE = r"^[ \t\r]*[0-9]+[ \t\r]*$"
_COUNT_LINE = re.compile(COUNT_LINE)
_PAIR = re.compile(r"""([^\s=]+)=(?:"([^"]*)"|'([^']*)'|(\[[^\]]*\])|(\{[^}]*\})|(\S+))""")
_DECODE_BYTES = 1 << 20
PIECES_PER_BATCH = 1024
# Splits up to this many, some 40 MB, are sent to every executor.
BROADCAST_SPLITS = 200_000
DEFAULT_PROPERTIES = "species:S:1:pos:R:3"
_PROPERTIES = re.compile(r"""(?<![^\s])Properties=(?:"[^"]*"|'[^']*'|\S+)""")


def parse_comment(line: str) -> dict[str, str]:
    """``key=value`` pairs of a comment line; values may be quoted or bracketed."""
    return {m[1]: m[m.lastindex] for m in _PAIR.finditer(line)}


def _column_spec(spec: str) -> dict[str, tuple[int, int]]:
    """``name:type:width`` triples to name -> (first column, width)."""
    fields = spec.split(":")
    layout, at = {}, 0
    for name, _kind, width in zip(fields[0::3], fields[1::3], fields[2::3]):
        layout[name] = (at, int(width))
        at += int(width)
    return layout


def _truth(text: str) -> bool:
    return text.strip().lower() in ("t", "true", "1")


def parse_frame(lines: list[str]) -> dict:
    """One frame as a record. Atom lines must be as many as announced; blank ones do not count."""
    if not _COUNT_LINE.match(lines[0]):
        raise ValueError("lines before the first count line")
    n, comment, atoms = int(lines[0]), "".join(lines[1:2]), [line for line in lines[2:] if line.strip()]
    if len(lines) < 2 or len(atoms) < n:
        raise ValueError("truncated")
    if len(atoms) > n:
        raise ValueError(f"{len(atoms)} atom lines instead of {n}")
    info = parse_comment(comment)
    spec = info.pop("Properties", DEFAULT_PROPERTIES)
    layout = _column_spec(spec)
    rows = [line.split() for line in atoms]

    def block(*names: str) -> list[list[str]] | None:
        for name in names:
            if name in layout:
                at, width = layout[name]
                return [row[at:at + width] for row in rows]
        return None

    def numbers(*names: str):
        found = block(*names)
        return None if found is None else [[float(x) for x in row] for row in found]

    species, z, tags = block("species"), block("Z", "numbers"), block("tags")
    rest = _rest_of(info)
    charges = next((numbers(c) for c in CHARGES if c in layout), None)
    # Other numeric columns, the values of an atom one after the other.
    others = {c: [x for row in numbers(c) for x in row] for c in _others(spec, layout)}
    return {
        "numbers": [ATOMIC_NUMBER[s[0]] for s in species] if species is not None else [int(v[0]) for v in z],
        "positions": numbers("pos", "positions"),
        "forces": numbers("forces", "force"),
        "tags": [int(t[0]) for t in tags] if tags is not None else None,
        "charges": [c[0] for c in charges] if charges is not None else _listed(info.get("mulliken_charges")),
        **rest,
        "info": info,
        "arrays": others,
    }


def _rest_of(info: dict[str, str]) -> dict:
    """Cell, axes, energy and stress of a frame; what stands for the first two leaves ``info``."""
    lattice = info.pop("Lattice", None)
    cell = None
    if lattice:
        flat = [float(x) for x in lattice.split()]
        cell = [flat[0:3], flat[3:6], flat[6:9]]
    pbc, energy = info.pop("pbc", None), info.get("energy")
    return {
        "cell": cell,
        "pbc": [_truth(v) for v in re.split(r"[\s,]+", pbc.strip("[] "))] if pbc else [cell is not None] * 3,
        "energy": float(energy) if energy is not None else None,
        "stress": _listed(info.get("stress")),
    }


def _others(spec: str, layout: dict[str, tuple[int, int]]) -> list[str]:
    """The numeric columns that have no field of their own."""
    kinds = dict(zip(spec.split(":")[0::3], spec.split(":")[1::3], strict=False))
    return [c for c in layout if c not in _KNOWN and kinds.get(c) in ("R", "I")]


def _listed(text: str | None) -> list[float] | None:
    """The numbers of a list, nested or not, written with spaces or commas."""
    return None if text is None else [float(x) for x in re.split(r"[\s,\[\]]+", text) if x]


def _assemble(lines: Iterable[str]) -> Iterator[list[str]]:
    """Group lines into frames, blank lines included: a comment may be blank, and stand first in
    a split. The first piece may be the tail of an earlier frame."""
    frame: list[str] = []
    for line in lines:
        if _COUNT_LINE.match(line):
            if frame:
                yield frame
            frame = [line]
        else:
            frame.append(line)
    if frame:
        yield frame


def _is_whole(lines: list[str]) -> bool:
    """Whether a piece with a count line has all its atoms, so that nothing need follow."""
    return len(lines) > 1 and sum(1 for line in lines[2:] if line.strip()) >= int(lines[0])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frames numbered within each split, and the pieces at its borders as lines.

    A piece without a count line continues the frame before it and has ordinal -1. Frames but the
    last of a split are parsed: no line of theirs can be elsewhere.
    """
    schema = to_arrow_schema(_PIECE_SCHEMA)
    borders: list[dict] = []
    whole: list[tuple[str, int, int, list[str]]] = []

    def parsed() -> Iterator[pa.RecordBatch]:
        path, block, ordinal, lines = zip(*whole, strict=True)
        names = [(p, f"{o} of the split at {b}") for p, b, o in zip(path, block, ordinal, strict=True)]
        head = {"path": path, "block": block, "ordinal": ordinal, "lines": [None] * len(lines), "begins": [True] * len(lines)}
        yield from _batches_of(head, names, lines, schema)

    for (path, block), members in groupby(_keyed_lines(batches), key=itemgetter(0)):
        starts, held = 0, None
        for piece in _assemble(text for _, text in members):
            if held is not None:
                whole.append((path, block, *held))
                held = None
            if _COUNT_LINE.match(piece[0]):
                held = starts, piece
                starts += 1
            elif any(map(str.strip, piece)):
                borders.append({"path": path, "block": block, "ordinal": -1, "lines": piece, "begins": False})
            if len(whole) >= PIECES_PER_BATCH:
                yield from parsed()
                whole.clear()
        if held is not None and _is_whole(held[1]):
            whole.append((path, block, *held))
        elif held is not None:
            borders.append({"path": path, "block": block, "ordinal": held[0], "lines": held[1], "begins": True})
        if len(borders) >= PIECES_PER_BATCH:
            yield pa.RecordBatch.from_pylist(borders, schema)
            borders.clear()
    if whole:
        yield from parsed()
    if borders:
        yield pa.RecordBatch.from_pylist(borders, schema)


def _keyed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    """Lines with the file and split they are from, which are the same object along a split."""
    for batch in batches:
        path, block, text = (batch.column(c) for c in ("path", "block", "value"))
        changed = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(block[1:], block[:-1])) if len(text) > 1 else []
        cuts = [0, *(np.flatnonzero(np.asarray(changed)) + 1).tolist(), len(text)] if len(text) else [0]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = path[begin].as_py(), block[begin].as_py()
            for line in text[begin:end].to_pylist():
                yield key, line


def _nested(flat: list, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind.value_type), type=kind)


def _vectors(columns: list[list[float]], offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list of ``columns`` entries per atom, in one list per frame."""
    flat = np.column_stack([np.array(c, np.float64) for c in columns]).ravel()
    inner = pa.ListArray.from_arrays(
        pa.array(np.arange(offsets[-1] + 1) * len(columns), pa.int32()), pa.array(flat), type=kind.value_type)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner, type=kind)


def _alike(frames: list[tuple[str, list[str]]], schema: pa.Schema) -> dict[str, pa.Array] | None:
    """The columns of frames (comment, atom lines) with one column layout, their atoms parsed column by column.

    Only whole, plain frames: any other, or a value that is no number, gives None.
    """
    infos = [parse_comment(comment) for comment, _ in frames]
    specs = {info.pop("Properties", DEFAULT_PROPERTIES) for info in infos}
    rows = [line.split() for _, lines in frames for line in lines]
    if len(specs) != 1 or not rows:
        return None
    spec = specs.pop()
    layout = _column_spec(spec)
    n_columns = sum(width for _, width in layout.values())
    if {len(row) for row in rows} != {n_columns} or len(layout) * 3 != len(spec.split(":")):
        return None
    columns = list(zip(*rows, strict=True))
    offsets = np.concatenate([[0], np.cumsum([len(lines) for _, lines in frames])])
    kind = {f.name: f.type for f in schema}

    def block(*names: str) -> list[tuple[str, ...]] | None:
        for name in names:
            if name in layout:
                at, width = layout[name]
                return columns[at:at + width]
        return None

    def vectors(name: str, *names: str) -> pa.Array:
        found = block(*names)
        if found is None:
            return pa.nulls(len(frames), kind[name])
        return _vectors([list(map(float, c)) for c in found], offsets, kind[name])

    rest = [_rest_of(info) for info in infos]
    out = {name: pa.array([r[name] for r in rest], kind[name]) for name in ("cell", "pbc", "energy", "stress")}
    species, z, tags = block("species"), block("Z", "numbers"), block("tags")
    charges = next((block(c) for c in CHARGES if c in layout), None)
    out["numbers"] = _nested([ATOMIC_NUMBER[s] for s in species[0]] if species is not None else list(map(int, z[0])), offsets, kind["numbers"])
    out["positions"], out["forces"] = vectors("positions", "pos", "positions"), vectors("forces", "forces", "force")
    out["tags"] = pa.nulls(len(frames), kind["tags"]) if tags is None else _nested(list(map(int, tags[0])), offsets, kind["tags"])
    out["charges"] = (_nested(list(map(float, charges[0])), offsets, kind["charges"]) if charges is not None
                      else pa.array([_listed(info.get("mulliken_charges")) for info in infos], kind["charges"]))
    out["info"] = pa.array([list(info.items()) for info in infos], kind["info"])
    others = {c: np.column_stack([np.array(list(map(float, x)), np.float64) for x in block(c)]) for c in _others(spec, layout)}
    out["arrays"] = pa.array([[(c, v[a:b].ravel().tolist()) for c, v in others.items()]
                              for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], kind["arrays"])
    return out


def _batches_of(head: dict[str, Sequence], names: Sequence[tuple[str, int | str]], frames: Sequence[list[str]],
                schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of ``schema`` with the columns ``head`` and those of the parsed ``frames``.

    ``names`` are the file and number of a frame, for messages. Frames that follow each other and have the
    same columns are parsed together; where that fails, one by one.
    """
    layouts = [_PROPERTIES.search(lines[1]) if len(lines) > 1 else None for lines in frames]
    begin = 0
    for _, run in groupby(m and m.group() for m in layouts):
        end = begin + sum(1 for _ in run)
        part = {c: pa.array(v[begin:end], schema.field(c).type) for c, v in head.items()}
        found = None
        with suppress(ValueError, KeyError, IndexError, TypeError, pa.ArrowException):
            plain = [(lines[1], [line for line in lines[2:] if line.strip()]) for lines in frames[begin:end]]
            counted = (_COUNT_LINE.match(lines[0]) and int(lines[0]) == len(atoms)
                       for lines, (_, atoms) in zip(frames[begin:end], plain, strict=True))
            found = _alike(plain, schema) if all(counted) else None
        if found is None:
            rows = [_record(*name, lines) for name, lines in zip(names[begin:end], frames[begin:end], strict=True)]
            found = {c: pa.array([list(r[c].items()) if c in ("info", "arrays") else r[c] for r in rows], schema.field(c).type)
                     for c in schema.names if c not in head}
        yield pa.RecordBatch.from_arrays([(part | found)[c] for c in schema.names], schema=schema)
        begin = end


def _record(path: str, frame_idx: int | str, lines: list[str]) -> dict:
    try:
        return {"path": path, "frame_idx": frame_idx, **parse_frame(lines)}
    except (ValueError, KeyError, IndexError, TypeError) as error:
        raise ValueError(f"frame {frame_idx} of {path} is malformed: {error}") from error


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [
            _record(path, frame_idx, list(lines))
            for path, frame_idx, lines in zip(batch["path"], batch["frame_idx"], batch["lines"])
        ]
        if made:
            yield pd.DataFrame(made)


def read_extxyz(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All frames below ``path`` (a directory, a glob or one file) as structure rows."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    text = reader.text(path)
    if text.isEmpty() and not text.inputFiles():
        raise FileNotFoundError(f"no structure files at {path}")
    return frames_of_text(text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), "value"))


def frames_of_text(lines: DataFrame) -> DataFrame:
    """Frames from text lines ``(path, block, value)`` read split by split, in file order.

    The text is read once, into a table of parsed frames and border pieces in the shared folder, and
    no line of it is exchanged. How many frames begin in each split, one row each, tells where its
    numbers begin. Only border pieces are gathered: the last of a split, if it lacks atoms, with
    the headless ones that follow it.
    """
    ship_package(lines.sparkSession)
    read = cut_lineage(lines.select("path", "block", "value").mapInArrow(_pieces, _PIECE_SCHEMA), "frames")
    # One row per split: its frame count and its place in the file.
    splits = cut_lineage(read.groupBy("path", "block").agg(F.count_if("begins").alias("frames")), "splits")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "block", F.coalesce(F.sum("frames").over(earlier), F.lit(0)).alias("before"))
    # So that frames are not moved to meet the number of their split.
    placed = F.broadcast(offsets) if splits.count() <= BROADCAST_SPLITS else offsets
    numbered = read.join(placed, ["path", "block"]).withColumn(
        "frame_idx", F.col("before") + F.when(F.col("begins"), F.col("ordinal")).otherwise(-1))
    pieces = numbered.filter(F.col("lines").isNotNull())
    in_order = F.sort_array(F.collect_list(F.struct("block", "ordinal", "lines")))
    joined = pieces.groupBy("path", "frame_idx").agg(F.flatten(F.transform(in_order, lambda p: p["lines"])).alias("lines"))
    completed = joined.mapInPandas(_parse_batches, FRAME_SCHEMA)
    return numbered.filter(F.col("lines").isNull()).select(*FRAME_SCHEMA.names).unionByName(completed)


def _inflated(content: bytes) -> Iterator[bytes]:
    """Blocks of all streams of an ``.xz`` file; zero bytes may pad the space between streams."""
    decoder = lzma.LZMADecompressor()
    for at in range(0, len(content), _DECODE_BYTES):
        data = content[at:at + _DECODE_BYTES]
        while data:
            if decoder.eof:
                data = data.lstrip(b"\0")
                if not data:
                    break
                decoder = lzma.LZMADecompressor()
            yield decoder.decompress(data)
            data = decoder.unused_data
    if not decoder.eof:
        raise EOFError("the last xz stream is cut off")


def decoded_lines(content: bytes) -> Iterator[str]:
    """The lines of xz streams, decoded block by block."""
    rest = b""
    for block in _inflated(content):
        head, *others = (rest + block).split(b"\n")
        if others:
            yield head.decode()
            for line in others[:-1]:
                yield line.decode()
            rest = others[-1]
        else:
            rest = head
    if rest:
        yield rest.decode()


def _parse_compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(FRAME_SCHEMA)

    def parsed(path: str, first: int, made: list[list[str]]) -> Iterator[pa.RecordBatch]:
        head = {"path": [path] * len(made), "frame_idx": range(first, first + len(made))}
        yield from _batches_of(head, list(zip(head["path"], head["frame_idx"], strict=True)), made, schema)

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            first, made = 0, []
            for lines in _assemble(decoded_lines(content.as_py())):
                if any(map(str.strip, lines)):
                    made.append(lines)
                if len(made) >= PIECES_PER_BATCH:
                    yield from parsed(path, first, made)
                    first, made = first + len(made), []
            if made:
                yield from parsed(path, first, made)


def frames_of_compressed(files: DataFrame) -> DataFrame:
    """Frames from whole ``.xz`` files ``(path, content)``, decoded piece by piece."""
    ship_package(files.sparkSession)
    return files.select("path", "content").mapInArrow(_parse_compressed, FRAME_SCHEMA)


def read_extxyz_xz(spark: SparkSession, path: str, glob: str = "*.extxyz.xz") -> DataFrame:
    """All frames of the compressed files below ``path``, one task per file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no structure files at {path}")
    return frames_of_compressed(files)


def extxyz_text(structures: DataFrame, *keep: Column) -> DataFrame:
    """One ``value`` per structure in extended-XYZ form, for writing with the text sink.

    Expects ``numbers, positions, forces, tags`` arrays, ``charges`` if there are any, ``energy`` and an ``info`` map.
    """
    def numbers(row: Column) -> Column:
        return F.array_join(F.transform(row, lambda x: x.cast("string")), " ")

    i = F.sequence(F.lit(0), F.size("numbers") - 1)
    symbols = F.expr("array(" + ",".join(f"'{s}'" for s in SYMBOLS) + ")")
    charged = "charges" in structures.columns
    atom = F.transform(i, lambda k: F.concat_ws(
        "\t", F.get(symbols, F.get("numbers", k)), numbers(F.get("positions", k)),
        numbers(F.get("forces", k)), F.get("tags", k).cast("string"),
        *([F.get("charges", k).cast("string")] if charged else [])))
    info = F.array_join(F.transform(
        F.map_entries("info"), lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"'))), " ")
    comment = F.concat_ws(
        " ", F.lit("Properties=species:S:1:pos:R:3:forces:R:3:tags:I:1" + (":charges:R:1" if charged else "")), info,
        F.concat(F.lit("energy="), F.col("energy").cast("string")), F.lit('pbc="F F F"'))
    return structures.select(*keep, F.concat_ws(
        "\n", F.size("numbers").cast("string"), comment, F.array_join(atom, "\n")).alias("value"))
