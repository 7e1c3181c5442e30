"""What the large tables showed: steps that moved or made rows more often than needed keep their results without."""

import contextlib
import io
import time

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from strucsift import session
from strucsift.operators import geometry, rowwise
from strucsift.operators.ranking import rank_in_groups, rank_within
from strucsift.plans import ingest
from strucsift.schema import QUERY_SCHEMA
from strucsift.sources import extxyz, store

ATOMS = "sid bigint, idx bigint, z int, px double, py double, pz double"


def _plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain()
    return text.getvalue()


def test_small_groups_are_numbered_by_one_exchange(spark):
    rows = spark.createDataFrame([(g, i % 3, i) for g in range(3) for i in range(4 * g + 1)] + [(None, 1, 1), (1, None, 1)],
                                 "g int, b int, v int")
    how = (rows, ["g"], [F.col("b")], ["b", "v"], "place")
    small, mixed, spread = rank_in_groups(*how), rank_in_groups(*how, most=2), rank_within(*how)
    assert _plan(small).count("Exchange ") <= 1
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, mixed.collect())) == sorted(map(tuple, spread.collect()))


def test_atoms_of_small_structures_are_paired_without_a_join(spark):
    atoms = spark.createDataFrame(
        [(1, 0, 8, 0.0, 0.0, 0.0), (1, 1, 1, 0.9, 0.0, 0.0), (1, 2, 1, 5.0, 0.0, 0.0), (1, 3, 200, 0.0, 0.0, 0.0),
         (2, 0, 6, 0.0, 0.0, 0.0), (2, 1, 6, 0.0, 0.0, 0.0), (None, 0, 6, 0.0, 0.0, 0.0), (None, 1, 6, 0.0, 0.0, 0.0)], ATOMS)
    pairs = geometry.neighbour_list(atoms)
    assert "Join" not in _plan(pairs)
    assert sorted((r.sid, r.i, r.j, r.dist) for r in pairs.collect()) == [(1, 0, 1, 0.9), (2, 0, 1, 0.0)]


def test_walks_do_not_broadcast_bonds(spark, tmp_path):
    # Tables in files have sizes, which are small here; so they seemed to the plan however many pairs came of them.
    path, size = str(tmp_path / "atoms"), 5
    spark.createDataFrame([(s, i, 6, 0.0, 0.0, 0.0) for s in range(3) for i in range(size)], ATOMS).write.parquet(path)
    atoms = spark.read.parquet(path)
    walks = geometry.n_hop_walks(geometry.neighbour_list(atoms), atoms, 3)
    assert "Broadcast" not in _plan(walks)
    found = [(r.sid, *r.path) for r in walks.collect()]
    assert "Broadcast" not in _plan(walks)
    ends = range(size)
    assert sorted(found) == [(s, a, b, c) for s in range(3) for a in ends for b in ends for c in ends if a != b and b != c]


def test_pairs_of_rows_are_compared_in_batches(spark):
    def row(sid, *atoms):
        return sid, [z for z, _ in atoms], [p for _, p in atoms]

    at = lambda x: [x, 0.0, 0.0]
    water = [(8, at(0.0)), (1, at(0.9)), (1, at(-0.9))]
    rows = [row(1, *water), row(2, (8, at(0.0)), (1, at(1.2)), (1, at(-0.9))), row(3, (1, None), *water), row(4, (6, at(0.0))),
            row(5, (200, at(0.0)), *water), (6, None, None), (7, [], []), (8, [8, 1, 1], None), row(9, *water, *water)]
    landed = spark.createDataFrame(rows, "sid bigint, numbers array<int>, positions array<array<double>>")
    judged = rowwise.validity_and_water(landed)
    assert "ArrowEvalPython" in _plan(judged)
    found = {r.sid: (r.is_molecular_structure_valid, r.num_water_molecules) for r in judged.collect()}
    assert found == {1: (True, 1), 2: (False, 0), 3: (False, 1), 4: (False, 0), 5: (False, 1), 6: (False, 0), 7: (False, 0),
                     8: (False, 0), 9: (False, 0)}


def test_frames_of_one_layout_are_parsed_together():
    schema = to_arrow_schema(extxyz.FRAME_SCHEMA)
    frames = [["2", "Properties=species:S:1:pos:R:3:forces:R:3:tags:I:1:magmoms:R:1 energy=-1.5 a=b", "H 0 0 1 1 2 3 2 .5", "O 1 1 1 0 0 0 0 1e3"],
              ["1", "Properties=species:S:1:pos:R:3:forces:R:3:tags:I:1:magmoms:R:1 Lattice=\"1 0 0 0 1 0 0 0 1\"", "C 0 0 1 1 2 3 2 7", ""],
              ["1", "", "He 0 0 1"], ["1", "pbc=\"T F T\"", "He 0 0 1 8 8"],
              ["1", "Properties=Z:I:1:pos:R:3 mulliken_charges=\"0.5\"", "6 0 0 1"], ["0", "energy=1"]]
    names = [("f", i) for i in range(len(frames))]
    head = {"path": ["f"] * len(frames), "frame_idx": range(len(frames))}
    got = pa.Table.from_batches(extxyz._batches_of(head, names, frames, schema)).to_pylist()
    each = [extxyz._record(*n, f) for n, f in zip(names, frames, strict=True)]
    assert got == [r | {c: list(r[c].items()) for c in ("info", "arrays")} for r in each]
    assert extxyz._alike([(f[1], [x for x in f[2:] if x]) for f in frames[:2]], schema) is not None


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {name for name in found.split("\n") if "/shuffle_" in name}


def test_a_step_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, there = spark.conf.get(setting), _shuffle_files(spark)
    rows = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy("n")
    step = session.cut_lineage(rows)
    # They are removed in the background.
    until = time.time() + 20
    while _shuffle_files(spark) - there and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - there and spark.conf.get(setting) == before
    assert sorted(map(tuple, step.collect())) == sorted(map(tuple, rows.collect())) == [(k, 1429 if k < 4 else 1428) for k in range(7)]


def test_frames_of_text_are_written_once(spark, tmp_path, monkeypatch):
    atom = "H 0 0 0 1 2 3\n"
    frames = [f"{n}\nProperties=species:S:1:pos:R:3:forces:R:3 config_type=a total_charge=0 num_atoms={n} spin=1 energy=-{n}\n{atom * n}"
              for n in (1, 2, 3, 300, 2)]
    (tmp_path / "raw").mkdir()
    for name in "ab":
        (tmp_path / "raw" / f"{name}.extxyz").write_text("".join(frames))
    steps = []
    for module in (extxyz, ingest, rowwise):
        monkeypatch.setattr(module, "cut_lineage", lambda df, label="step": (steps.append(label), session.cut_lineage(df, label))[1])
    # Splits of some frames: a piece at a border is joined with the next ones.
    monkeypatch.setattr(extxyz, "PIECES_PER_BATCH", 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        ingest.process_files(spark, str(tmp_path / "raw"), "xyz", str(tmp_path / "table"), "db", "s")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert steps == ["frames", "splits", "large"]
    rows = store.committed(spark, str(tmp_path / "table"), QUERY_SCHEMA).select("entry_key", "num_atoms", "energy").collect()
    assert sorted(map(tuple, rows)) == sorted((f"db_s_{name}_{i}", n, -float(n)) for name in "ab" for i, n in enumerate((1, 2, 3, 300, 2)))
