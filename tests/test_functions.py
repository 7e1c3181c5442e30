"""Expressions on hand-made values."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strucsift import schema
from strucsift.functions import keys, parsers, predicates, vectors
from strucsift.operators import catalyst, fields, stats
from strucsift.sources.sidecar import sidecar_name


def parse(spark, parser, source, reference=None):
    row = spark.createDataFrame([(source, reference)], "source string, reference string")
    return row.select(parser.alias("p")).first()["p"]


def test_rgd(spark):
    p = parse(spark, parsers.parse_rgd(F.col("source")), "rgd_uks/MR_693393_1_13_0_1/orca.tar.zst")
    assert (p.reaction_id, p.reaction_pathway_id, p.reaction_step_idx) == ("MR_693393", 1, 13)
    assert (p.is_reactant, p.is_product) == (False, False)
    for step, ends in ((0, (True, False)), (18, (False, True))):
        p = parse(spark, parsers.parse_rgd(F.col("source")), f"rgd_uks/MR_693393_1_{step}_0_1/orca.tar.zst")
        assert (p.is_reactant, p.is_product) == ends
    for bad in ("bad", "rgd/MR_1", "rgd/MR_1_x_y_0_1/o", ""):
        assert parse(spark, parsers.parse_rgd(F.col("source")), bad).reaction_step_idx is None


@pytest.mark.parametrize("source, expected", [
    ("pmechdb/r_12345_step3/file.tar", ("pmechdb", "12345", 0, 3)),
    ("rmechdb/r_7_3step/file.tar", ("rmechdb", "7", 0, 3)),
    ("ani1xbb/r_11111_5/file.tar", ("ani1xbb", "11111", 0, 5)),
    ("other/r_1_2/file.tar", ("other", "", 0, 0)),
    ("bad", (None, "", 0, 0)),
    ("pmechdb/r_1_stepx/f", ("pmechdb", "1", 0, None)),
])
def test_reactivity(spark, source, expected):
    p = parse(spark, parsers.parse_reactivity(F.col("source")), source)
    assert (p.subset, p.reaction_id, p.reaction_pathway_id, p.reaction_step_idx) == expected


@pytest.mark.parametrize("n, step, pathway, reactant, product", [
    (0, 0, 0, True, None), (1, 8, 0, None, None), (5, 4, 0, None, None), (8, 7, 0, None, None),
    (9, 10, 0, None, True), (12, 3, 1, None, None), (20, 3, 2, None, None),
])
def test_trans1x(spark, n, step, pathway, reactant, product):
    p = parse(spark, parsers.parse_trans1x(F.col("source")), f"trans1x/r_12345_2_{n}/file.tar")
    assert (p.reaction_id, p.reaction_step_idx, p.reaction_pathway_id) == ("12345", step, pathway)
    assert (p.is_reactant, p.is_product) == (reactant, product)


@pytest.mark.parametrize("source, reference, expected", [
    ("tm_react/mc_7_step4_x/orca", None, ("reactivity_metal_complexes", "mc7", 4)),
    ("tm_react/mc_7_x/orca", None, (None, None, None)),
    ("omol/mc_7/orca", None, ("ground_state_metal_complexes", None, None)),
    ("omol/mc_7/orca", "ref/step1_incomplete", ("failed_metal_complexes", None, None)),
    ("tm_react/mc_7_step4/orca", "ref/step2_ok", ("ground_state_metal_complexes", None, None)),
    ("omol/mc_7/orca", "ref/other", ("ground_state_metal_complexes", None, None)),
])
def test_metal_complexes(spark, source, reference, expected):
    p = parse(spark, parsers.parse_metal_complexes(F.col("source"), F.col("reference")), source, reference)
    assert (p.subset, p.reaction_id, p.reaction_step_idx) == expected


def test_keys(spark):
    row = spark.createDataFrame([("OC20_s2ef", "Train", "data_0001", 7)], "d string, s string, f string, i long")
    key = keys.build_key(keys.normalize_name(F.col("d")), keys.normalize_name(F.col("s")), F.col("f"), F.col("i"))
    made = row.select(key.alias("k")).first()["k"]
    assert made == "oc20-s2ef_train_data$0001_7"
    parsed = spark.createDataFrame([(made,)], "k string").select(keys.parse_key(F.col("k")).alias("p")).first()["p"]
    assert tuple(parsed) == ("oc20-s2ef", "train", "data_0001", 7)
    bad = spark.createDataFrame([("a_b_c",), ("a_b_c_x",), (None,)], "k string")
    assert {r["p"] for r in bad.select(keys.parse_key(F.col("k"), strict=False).alias("p")).collect()} == {None}
    with pytest.raises(PySparkException):
        bad.select(keys.parse_key(F.col("k")).alias("p")).collect()


def test_subset_from_name(spark):
    names = spark.createDataFrame([("oc20_2020__is2res",), ("omat24-rattled-1000",), ("omol25",)], "n string")
    got = [r["p"] and tuple(r["p"]) for r in names.select(
        keys.subset_from_name(F.col("n"), strict=False).alias("p")).collect()]
    assert got == [("oc20", "2020-is2res"), ("omat24", "rattled-1000"), None]
    with pytest.raises(PySparkException):
        names.select(keys.subset_from_name(F.col("n"))).collect()


def test_predicate_rewrite():
    rewrite = predicates.spark_predicate
    assert rewrite("a ~ '^[CHO]+$' AND b = '~'") == "a  RLIKE '^[CHO]+$' AND b = '~'"
    assert "NOT RLIKE r'\\d'" in rewrite(r"a !~ '\d'")


def test_predicates(spark):
    df = spark.createDataFrame(
        [("mol_1", "CHO", 0), ("mol_2", "NHO", 1), ("mol_3", "CH", 5)], "entry_key string, symbols string, n long")
    assert predicates.apply_predicate(df, "symbols ~ '^(C|H|O)+$'").count() == 2
    assert predicates.apply_predicate(df, r"entry_key ~ '_\d$' AND n BETWEEN -1 AND 1").count() == 2
    with pytest.raises(predicates.PredicateError):
        predicates.apply_predicate(df, "  ")
    with pytest.raises(predicates.PredicateError, match="available columns: entry_key, symbols, n"):
        predicates.apply_predicate(df, "missing > 1")
    with pytest.raises(PySparkException):
        predicates.apply_predicate(df, "n > 1 ORDER BY n LIMIT 1")


def test_fingerprint_names_in_predicates(spark):
    df = spark.createDataFrame([("a", [1, 0]), ("b", [0, 1])], "entry_key string, fingerprint array<int>")
    body = predicates.fingerprint_bits_in(df, "fingerprint_1 = 1")
    assert [r.entry_key for r in predicates.apply_predicate(df, body).collect()] == ["b"]


def test_schema_round_trip(spark):
    wide = spark.createDataFrame([("a", 1, 0, 1)], "entry_key string, fingerprint_10 int, fingerprint_2 int, fingerprint_0 int")
    assert schema.pack_bits(wide).first()["fingerprint"] == [1, 0, 1]
    with pytest.raises(ValueError):
        schema.pack_bits(wide.select("entry_key"))
    conformed = schema.conform(wide)
    assert conformed.columns == schema.QUERY_SCHEMA.names and len(conformed.columns) == 74
    with pytest.raises(ValueError):
        schema.expand_presets([])


def test_field_mapping(spark):
    df = spark.createDataFrame([(1, 2)], "charge long, spin long")
    assert fields.map_fields(df, {"net_charge": "charge"}).first()["net_charge"] == 1
    with pytest.raises(KeyError, match="available fields"):
        fields.map_fields(df, {"net_charge": "total"})
    assert fields.attach_metadata(df, {"spin": "x", "functional": "PBE"}).first().asDict() == {
        "charge": 1, "spin": 2, "functional": "PBE"}
    later = fields.apply_transforms(df, [
        lambda d: d.withColumn("charge", F.lit(5)), lambda d: d.withColumn("charge", F.col("charge") + 1)])
    assert later.first()["charge"] == 6


def test_decode_and_catalyst_defaults(spark):
    df = spark.createDataFrame([("frame258", 3, 9)], "f string, c int, a int")
    row = df.select(*catalyst.catalyst_fields(
        {"frame_number": F.col("f"), "class": F.col("c"), "anomaly": F.col("a")})).first()
    assert row.catalyst_relaxation_frame_idx == 258 and row.catalyst_class == "halides"
    assert row.catalyst_anomaly is None and row.catalyst_reference_energy == 0.0


def test_surface_normal_is_oriented_and_null_when_flat(spark):
    cells = [[[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, -5.0]], [[1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [0.0, 0.0, 5.0]]]
    df = spark.createDataFrame([(c,) for c in cells], "cell array<array<double>>")
    normals = df.select(*[n.alias(a) for n, a in zip(vectors.surface_normal(vectors.cell_of(F.col("cell"))), "xyz")])
    assert [tuple(r) for r in normals.collect()] == [(0.0, 0.0, -1.0), (None, None, None)]


def test_supported_columns(spark):
    df = spark.createDataFrame([(1, "a", True, 1.0)], "n long, s string, b boolean, d double")
    assert stats.supported_columns(df.schema, ["n", "s", "b", "d", "zz"]) == ["n", "b", "d"]


def test_sidecar_names():
    assert sidecar_name("a.extxyz.xz") == "a.txt.xz"
    assert sidecar_name("a.extxyz") == "a.txt" and sidecar_name("a.aselmdb") == "a.txt"
