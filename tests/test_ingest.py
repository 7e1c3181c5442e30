"""Files to the query table: fields, typed metadata, commits, slabs without atoms, strict sidecars."""

import json
import lzma

import pytest
from pyspark.sql import functions as F

from strucsift.operators import info, rowwise
from strucsift.plans import export, ingest, process
from strucsift.schema import QUERY_SCHEMA
from strucsift.sources import extxyz, store

PROPERTIES = "Properties=species:S:1:pos:R:3:forces:R:3:tags:I:1:charges:R:1:magmoms:R:1"
WATER = """3
{p} config_type=liquid total_charge=0 num_atoms=3 spin=1 energy=-1.5{i} stress="1 2 3 4 5 6" {more}
O 0 0 0 0.1 0 0 2 -0.8 0.5
H 0.96 0 0 0 0 0 2 0.4 0.1
H -0.24 0.93 0 0 0 0 2 0.4 0.2
"""


def write(path, n, more=""):
    path.mkdir(exist_ok=True)
    (path / "set_a.extxyz").write_text("".join(WATER.format(p=PROPERTIES, i=i, more=more) for i in range(n)))
    return str(path)


def test_files_become_rows_and_a_registered_source(spark, tmp_path):
    source, table = write(tmp_path / "raw", 12), str(tmp_path / "table")
    ingest.process_files(spark, source, "xyz", table, "My_DB", "Train", metadata={"functional": "PBE"})
    rows = sorted(store.committed(spark, table, QUERY_SCHEMA).collect(), key=lambda r: r.energy, reverse=True)
    assert {r.entry_key for r in rows} == {f"my-db_train_set$a_{i}" for i in range(12)}
    first = next(r for r in rows if r.entry_key.endswith("_0"))
    assert (first.subset, first.net_charge, first.num_atoms, first.functional, first.composition) == ("liquid", 0, 3, "PBE", "H2O")
    assert first.is_molecular_structure_valid and first.num_water_molecules == 1 and first.dipole_moment_magnitude > 0
    entry = store.read_registry(spark, table).collect()
    assert [(r.database_name, r.split_name, r.file_extension, r.files_path) for r in entry] == [("my-db", "train", "extxyz", source)]
    with pytest.raises(store.KeyCollisionError):
        ingest.process_files(spark, source, "xyz", table, "My_DB", "Train")
    ingest.process_files(spark, source, "xyz", table, "My_DB", "val", graph=True)
    assert store.committed(spark, table, QUERY_SCHEMA).count() == 24 and store.read_registry(spark, table).count() == 2
    made = store.committed(spark, table, QUERY_SCHEMA).filter("split_name = 'val'").first()
    assert made.graph_properties_candidate and not made.error_graph_properties and sum(made.fingerprint) > 0


def test_failed_runs_leave_neither_rows_nor_registry(spark, tmp_path):
    """A missing field, and a key that repeats, fail before anything can be seen."""
    table = str(tmp_path / "table")
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.extxyz").write_text("1\nProperties=species:S:1:pos:R:3 energy=-1 num_atoms=1 color=red\nH 0 0 0\n")
    with pytest.raises(Exception, match="available fields: color, energy, num_atoms"):
        ingest.process_files(spark, str(bad), "xyz", table, "db", "s")
    assert store.committed(spark, table, QUERY_SCHEMA) is None and store.read_registry(spark, table) is None
    rows = spark.createDataFrame([("k",), ("k",)], "entry_key string")
    source = ingest.source_entry(spark, "p", "extxyz", "db", "s")
    for broken, error in ((rows, store.KeyCollisionError), (rows.select(F.lit(None).cast("string").alias("entry_key")), ValueError)):
        with pytest.raises(error):
            store.commit(broken, table, source)
    assert store.read_registry(spark, table) is None
    with pytest.raises(ValueError, match="unsupported"):
        ingest.process_files(spark, str(bad), "other", table, "db", "s")
    lenient = ingest.derive_frames(extxyz.read_extxyz(spark, str(bad)), "xyz", "db", "s", strict=False).first()
    assert lenient.net_charge is None and lenient.num_atoms == 1


def test_other_columns_of_frames(spark, tmp_path):
    row = extxyz.read_extxyz(spark, write(tmp_path / "raw", 2)).filter("frame_idx = 1").first()
    assert row.charges == [-0.8, 0.4, 0.4] and row.stress == [1, 2, 3, 4, 5, 6] and row.tags == [2, 2, 2]
    assert row.arrays == {"charges": [-0.8, 0.4, 0.4], "magmoms": [0.5, 0.1, 0.2]}


def test_slabs_of_compressed_files_with_and_without_atoms(spark, tmp_path):
    text = WATER.format(p=PROPERTIES, i=1, more='class=1 anomaly=0 frame_number=frame7 bulk_id=mp-1 miller_index="1 0 1"')
    empty = "0\nProperties=species:S:1:pos:R:3 energy=-2 num_atoms=0\n"
    (tmp_path / "s.extxyz.xz").write_bytes(lzma.compress((text + empty).encode()))
    frames = extxyz.read_extxyz_xz(spark, str(tmp_path))
    extra = spark.createDataFrame([("s", 0, "ads-5")], "source_file_name string, frame_idx bigint, ads_id string")
    rows = {r.entry_key: r for r in ingest.derive_frames(frames, "xyz_oc", "oc20", "s2ef", sidecar=extra).collect()}
    full, none = rows["oc20_s2ef_s_0"], rows["oc20_s2ef_s_1"]
    assert (full.catalyst_class, full.catalyst_anomaly, full.catalyst_relaxation_frame_idx) == ("metalloids", "no_anomaly", 7)
    assert (full.catalyst_bulk_id, full.catalyst_adsorbate_id, full.catalyst_miller_index) == ("mp-1", "ads-5", [1, 0, 1])
    assert full.catalyst_num_adsorbate_atoms == 3 and full.net_charge == 0
    assert none.num_atoms == 0 and none.catalyst_num_adsorbate_atoms == 0 and not none.is_molecular_structure_valid


def landed(spark, rows):
    return spark.createDataFrame(rows, "sid string, numbers array<int>, positions array<array<double>>, forces array<array<double>>, "
                                 "charges array<double>, tags array<int>, cell array<array<double>>, pbc array<boolean>")


def test_row_form_plans_the_long_form_only_when_needed(spark):
    h2 = ([1, 1], [[0.0, 0.0, 0.0], [0.0, 0.0, 0.7]], [[0.0] * 3] * 2, None, None)
    box = [[4.0, 0.01, 0.01], [0.01, 4.0, 0.01], [0.01, 0.01, 4.0]]
    # Two hydrogens that only meet through the border of their cell.
    apart = ([1, 1], [[0.1, 2.0, 2.0], [3.8, 2.0, 2.0]], [[0.0] * 3] * 2, None, None)
    plain = landed(spark, [("a", *h2, None, None), ("b", *apart, box, [False] * 3), ("n", None, None, None, None, None, None, None)])
    found = rowwise.with_validity_and_water(plain)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.sid: r.is_molecular_structure_valid for r in found.collect()} == {"a": True, "b": False, "n": False}
    boxed = plain.unionByName(landed(spark, [("c", *apart, box, [True] * 3)]))
    assert {r.sid: r.is_molecular_structure_valid for r in rowwise.with_validity_and_water(boxed).collect()} == {
        "a": True, "b": False, "c": True, "n": False}


VALUES = {"charge": "-1", "spin": "2.0", "name": "rgd uks", "list": "[0.5, 1]", "row": "0.5 -1e-3", "quote": 'a "b" \\', "two": "1,2",
          "none": "none", "lead": "007", "zero": "", "mulliken_charges": "0.25 0.5"}


def test_metadata_keeps_its_types_as_a_variant(spark):
    df = spark.createDataFrame([("k", VALUES)], "entry_key string, info map<string,string>")
    typed = df.withColumn("info", info.as_variant(F.col("info")))
    assert json.loads(typed.select(F.to_json("info").alias("j")).first().j) == {
        "charge": -1, "spin": 2.0, "name": "rgd uks", "list": [0.5, 1], "row": [0.5, -1e-3], "quote": 'a "b" \\', "two": "1,2",
        "none": "none", "lead": "007", "zero": "", "mulliken_charges": [0.25, 0.5]}
    for frame in (df, typed):
        row = frame.select(*[info.typed_field(frame, c).alias(c) for c in ("charge", "spin", "name", "mulliken_charges", "absent")]).first()
        assert tuple(row) == (-1, 2.0, "rgd uks", [0.25, 0.5], None)
        with pytest.raises(Exception, match="field absent not found in k; available fields"):
            frame.select(info.required_field(frame, "absent")).collect()


def test_export_needs_registered_sources(spark):
    frames = spark.createDataFrame([("db", "s", "f", 0, [1], [[0.0] * 3], [[0.0] * 3], [False] * 3, -1.0, [1.0] * 6, {"charge": "1"})],
                                   "database_name string, split_name string, source_file_name string, frame_idx bigint, numbers array<int>, "
                                   "positions array<array<double>>, forces array<array<double>>, pbc array<boolean>, energy double, "
                                   "stress array<double>, info map<string,string>")
    keys = spark.createDataFrame([("db_s_f_0",), (None,), ("db_s_f_0",)], "entry_key string")
    known = spark.createDataFrame([("db", "s")], "database_name string, split_name string")
    rows = export.export_format(keys, frames, "aselmdb_omol", known).collect()
    assert len(rows) == 1 and rows[0].charge == 1 and rows[0].part == 0 and rows[0].mulliken_charges is None
    with pytest.raises(Exception, match="no registered source"):
        export.export_format(keys, frames, "aselmdb_omol", known.filter("split_name = 'x'")).collect()


def test_motif_columns_of_processed_rows(spark):
    row = ("a", [1], [[0.0] * 3], [[0.0] * 3], None, None, None, None)
    frames = landed(spark, [row, ("b", *row[1:])]).withColumns({"entry_key": F.col("sid"), "energy": F.lit(0.0), "info": F.create_map(
        F.lit("x"), F.lit("y"))})
    found = [("a", "ala", "p", 0, 3), ("a", "ala", "q", 1, 2), ("a", "ALA", "p", 5, 6), ("a", "ade", "p", 0, 0)]
    matches = spark.createDataFrame(found, "id string, code string, pattern string, s bigint, e bigint")
    rows = {r.entry_key: r for r in process.process_landed(frames, "aselmdb_odac", matches=matches).collect()}
    assert (rows["a"].num_ala, rows["a"].num_ade, rows["a"].is_protein) == (2, 1, False)
    assert (rows["b"].num_ala, rows["b"].is_nucleobase) == (0, False)
