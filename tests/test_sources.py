"""Text ingest from real files, across split borders and compression; incremental ingest."""

import lzma

import pytest
from pyspark.sql import functions as F

from strucsift.checks.fixtures import Fixtures
from strucsift.functions import keys
from strucsift.operators import atoms as atom_ops
from strucsift.plans import export
from strucsift.sources import extxyz, keyindex, sidecar, store
from strucsift.sources.landing import number_frames
from strucsift.streaming import incremental

FRAME = """3
Properties=species:S:1:pos:R:3:forces:R:3 conf_idx={i} config_type="My Set" total_charge=0 energy=-32.5{i} Lattice="5 0 0 0 5 0 0 0 5" pbc=[False, False, True]
O\t0.0\t0.0\t{i}.0\t0.1\t0.2\t0.3
H\t1.0\t0.0\t0.0\t0.1\t0.2\t0.3
Cl\t0.0\t1.0\t0.0\t0.1\t0.2\t0.3
"""


def write_frames(path, n):
    path.write_text("".join(FRAME.format(i=i) for i in range(n)))


def check(frames, n):
    rows = sorted(frames.collect(), key=lambda r: r.frame_idx)
    assert [r.frame_idx for r in rows] == list(range(n))
    for i, r in enumerate(rows):
        assert r.numbers == [8, 1, 17] and r.info["conf_idx"] == str(i) and r.info["config_type"] == "My Set"
        assert r.energy == pytest.approx(float(f"-32.5{i}")) and r.positions[0][2] == float(i)
        assert r.forces[2] == [0.1, 0.2, 0.3] and r.pbc == [False, False, True] and r.cell[1] == [0.0, 5.0, 0.0]


def test_frames_across_splits(spark, tmp_path):
    write_frames(tmp_path / "a.extxyz", 200)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        # A few hundred bytes per split cut most frames in two.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "333")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        frames = extxyz.read_extxyz(spark, str(tmp_path), "*.extxyz")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
        check(frames, 200)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opened)


def test_compressed_frames(spark, tmp_path):
    write_frames(tmp_path / "a.extxyz", 30)
    (tmp_path / "a.extxyz.xz").write_bytes(lzma.compress((tmp_path / "a.extxyz").read_bytes()))
    check(extxyz.read_extxyz_xz(spark, str(tmp_path)), 30)


def test_truncated_frame_fails(spark, tmp_path):
    (tmp_path / "a.extxyz").write_text(FRAME.format(i=0) + "5\nProperties=species:S:1:pos:R:3\nH 0 0 0\n")
    with pytest.raises(Exception, match="truncated"):
        extxyz.read_extxyz(spark, str(tmp_path)).collect()


def test_no_files(spark, tmp_path):
    with pytest.raises(Exception):
        extxyz.read_extxyz(spark, str(tmp_path / "*.nothing")).collect()


def test_sidecars(spark, tmp_path):
    lines = "".join(f"sid_{i % 3},frame{i},{-181.5 - i}\n" for i in range(50))
    (tmp_path / "a.txt").write_text(lines)
    (tmp_path / "b.txt.xz").write_bytes(lzma.compress(lines.encode()))
    for rows in (sidecar.read_sidecar(spark, str(tmp_path)), sidecar.read_sidecar_xz(spark, str(tmp_path))):
        got = {r.frame_idx: (r.oc_sid, r.frame_number, r.ref_energy) for r in rows.collect()}
        assert got == {i: (f"sid_{i % 3}", f"frame{i}", -181.5 - i) for i in range(50)}
    mapping = spark.createDataFrame([("sid_0", 1), ("sid_1", 2)], "oc_sid string, bulk_id int")
    rows = sidecar.read_sidecar(spark, str(tmp_path))
    assert {r.oc_sid for r in sidecar.unknown_sids(rows, mapping).collect()} == {"sid_2"}
    files = spark.createDataFrame([("x",), ("y",)], "f string")
    assert [r.f for r in sidecar.files_without_sidecar(files, files.filter("f = 'x'"), ["f"]).collect()] == ["y"]


def test_array_form_equals_atom_form(spark, small):
    fx = Fixtures(spark, small)
    exploded = atom_ops.explode_structures(fx.landing.drop("sid"))
    a = {r.sid: r for r in atom_ops.force_measures(exploded).collect()}
    b = {r.entry_key: r for r in fx.query_table.collect()}
    assert len(a) == len(b)
    for key, row in b.items():
        assert a[key].net_force_norm == pytest.approx(row.net_force_norm, abs=1e-6)
        assert a[key].max_force_norm == pytest.approx(row.max_force_norm, abs=1e-6)


def test_frame_numbers_of_a_dominant_file(spark):
    df = spark.range(200_000).select(
        "id", F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("f"), (F.col("id") % 50).cast("string"))).alias("file"))
    numbered = number_frames(df, "id", ["file"])
    span = numbered.groupBy("file").agg(
        F.min("frame_idx").alias("lo"), F.max("frame_idx").alias("hi"), F.count_distinct("frame_idx").alias("n")).collect()
    assert all(r.lo == 0 and r.hi == r.n - 1 for r in span) and len(span) == 51


SHORT = "2\nProperties=species:S:1:pos:R:3 energy=-1.0\nH 0 0 0\nO 0 0 1\n"


def _frames(df):
    return sorted((r.frame_idx, len(r.numbers)) for r in df.collect())


def test_all_xz_streams_are_read(spark, tmp_path):
    streams = [lzma.compress(SHORT.encode()), b"\0" * 8, lzma.compress((SHORT * 3).encode())]
    (tmp_path / "a.extxyz.xz").write_bytes(b"".join(streams))
    assert _frames(extxyz.read_extxyz_xz(spark, str(tmp_path))) == [(i, 2) for i in range(4)]
    (tmp_path / "b.extxyz.xz").write_bytes(streams[2][:-9])
    with pytest.raises(Exception, match="cut off|EOF"):
        extxyz.read_extxyz_xz(spark, str(tmp_path / "b.extxyz.xz")).collect()


@pytest.mark.parametrize("text", [SHORT + "H 0 0 2\n", "H 0 0 2\n" + SHORT, "3" + SHORT[1:]])
def test_malformed_frames_fail(spark, tmp_path, text):
    (tmp_path / "a.extxyz").write_text(text)
    (tmp_path / "a.extxyz.xz").write_bytes(lzma.compress(text.encode()))
    for read in (extxyz.read_extxyz, extxyz.read_extxyz_xz):
        with pytest.raises(Exception, match="malformed"):
            read(spark, str(tmp_path / ("a.extxyz" if read is extxyz.read_extxyz else "a.extxyz.xz"))).collect()


def test_split_borders_do_not_matter(spark, tmp_path):
    """Blank comments and blank lines at any border of a split."""
    blank = "\n\n2\n\nH 0 0 0\nO 0 0 1\n\n"
    (tmp_path / "a.extxyz").write_text((blank + SHORT) * 3)
    whole = _frames(extxyz.read_extxyz(spark, str(tmp_path)))
    assert whole == [(i, 2) for i in range(6)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (7, 11, 16, 23, 41):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            assert _frames(extxyz.read_extxyz(spark, str(tmp_path))) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_keys_without_structures_fail(spark):
    structures = spark.createDataFrame([("db", "train", "f", 0, [1])], "database_name string, split_name string, source_file_name string, frame_idx bigint, numbers array<int>")
    key = keys.build_key(*[F.col(c) for c in export.LOCATION]).alias("entry_key")
    known = structures.select(key)
    assert export.lookup_records(known, structures).count() == 1
    missing = structures.withColumn("frame_idx", F.lit(5)).select(key)
    with pytest.raises(Exception, match="no structure for key"):
        export.lookup_records(known.unionByName(missing), structures).collect()


def test_empty_key_set_leaves_nothing_behind(spark, tmp_path):
    none = spark.createDataFrame([], "entry_key string")
    for _ in range(2):
        with pytest.raises(ValueError):
            store.save_keys(none, str(tmp_path / "keys"))
    assert not (tmp_path / "keys").exists()


def test_strict_sidecars(spark, tmp_path):
    lines = "sid_0,frame0,-1.5\nsid_1,frame1,-2.5\n"
    (tmp_path / "a.txt.xz").write_bytes(lzma.compress(lines.encode()))
    mapping = spark.createDataFrame([("sid_0", 1)], "oc_sid string, bulk_id int")
    rows = sidecar.read_sidecar_xz(spark, str(tmp_path))
    assert {(r.oc_sid, r.known) for r in sidecar.resolve_sids(rows, mapping).collect()} == {("sid_0", True), ("sid_1", False)}
    # The check stays although only another column is read.
    with pytest.raises(Exception, match=r"sid sid_1 of .*a\.txt\.xz is not in the mapping"):
        sidecar.resolve_sids(rows, mapping, strict=True).select("ref_energy").collect()
    frames = spark.createDataFrame([("a", 0, 9.0), ("a", 1, 9.0), ("a", 2, 9.0), ("b", 0, 9.0)], "file string, frame_idx bigint, ref_energy double")
    extra = rows.withColumn("file", F.lit("a"))
    attach = lambda df, strict: {
        (r.file, r.frame_idx): r.ref_energy
        for r in sidecar.attach_sidecar(df, extra, ["ref_energy"], ["file", "frame_idx"], strict).collect()}
    assert attach(frames, False) == {("a", 0): -1.5, ("a", 1): -2.5, ("a", 2): 9.0, ("b", 0): 9.0}
    assert attach(frames.filter("file = 'a'"), True) == {("a", 0): -1.5, ("a", 1): -2.5, ("a", 2): 9.0}
    with pytest.raises(Exception, match="no sidecar for b"):
        attach(frames, True)


def test_key_index_reads_the_partitions_of_a_batch(spark, tmp_path):
    table = str(tmp_path / "table")
    keyed = lambda *names: spark.createDataFrame(
        [(f"db_s_{n}_{i}", i) for n in names for i in range(20)], "entry_key string, v bigint")
    store.append(keyed("f1", "f2", "f3"), table, indexed=True)
    store.append(keyed("f4"), table, indexed=True)
    # Rows that were written without the index are found as well.
    keyed("f5").write.mode("append").parquet(table)
    for taken in ("f1", "f5"):
        with pytest.raises(store.KeyCollisionError):
            store.append(keyed("f6", taken), table, indexed=True)
    with pytest.raises(ValueError, match="without an entry key"):
        store.append(spark.createDataFrame([(None, 1)], "entry_key string, v bigint"), table, indexed=True)
    assert spark.read.parquet(table).count() == 100
    assert keyindex.refresh(spark, table) == 0
    found = keyindex.known_keys(keyed("f2"), table)
    assert {r.entry_key for r in found.collect()} >= {f"db_s_f2_{i}" for i in range(20)} and found.count() < 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(prefix" in plan
    assert len(found.inputFiles()) > 0 and all("prefix=" in f for f in found.inputFiles())
    # A key that names no frame has a partition of its own.
    assert keyindex.known_keys(spark.createDataFrame([("odd",), (None,)], "entry_key string"), table).count() == 0


def test_incremental_ingest_rejects_rows_without_a_key(spark, tmp_path):
    landing, table, mark = (str(tmp_path / n) for n in ("landing", "table", "mark"))
    rows = spark.createDataFrame([("a_b_f_0", 1), ("a_b_f_1", 2), ("a_b_f_1", 2)], "entry_key string, v bigint")
    rows.coalesce(1).write.parquet(landing)
    run = lambda m: incremental.ingest_new_files(spark, landing, rows.schema, table, m, lambda df: df)
    run(mark)
    # A lost checkpoint delivers all files again.
    run(mark + "2")
    assert spark.read.parquet(table).count() == 2
    spark.createDataFrame([(None, 3)], rows.schema).write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="without an entry key"):
        run(mark)
    assert spark.read.parquet(table).count() == 2
