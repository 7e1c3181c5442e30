"""Operators against brute force and hand-made cases."""

import hashlib
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strucsift.functions import elements
from strucsift.operators import (
    atoms as atom_ops, catalyst, curation, fingerprints, geometry, motifs, ranking, rowwise, sampling, stats,
)
from strucsift.plans import actions, export, formats, process, select
from strucsift.sources import querydb, store

ATOM = "sid long, idx long, z int, px double, py double, pz double, fx double, fy double, fz double, charge double, tag int"


def atoms_of(spark, *structures):
    rows = []
    for sid, structure in enumerate(structures):
        for idx, (z, x, y, w, *tag) in enumerate(structure):
            rows.append((sid, idx, z, float(x), float(y), float(w), 0.0, 0.0, 1.0, 0.1, tag[0] if tag else None))
    return spark.createDataFrame(rows, ATOM)


WATER = [(8, 0, 0, 0), (1, 0.96, 0, 0), (1, -0.24, 0.93, 0)]


def test_element_tables():
    n = len(elements.SYMBOLS)
    assert n == len(elements.MASSES) == len(elements.COVALENT_RADII) == 119
    assert elements.SYMBOLS[29] == "Cu" and elements.COVALENT_RADII[29] == 1.32


def test_scalars(spark):
    row = atom_ops.scalar_measures(atoms_of(spark, WATER)).first()
    assert row.num_atoms == 3 and row.atomic_symbols == "HO" and row.composition == "H2O"
    assert row.net_force_norm == pytest.approx(3.0) and row.max_force_norm == pytest.approx(1.0)
    assert row.molecular_weight == pytest.approx(18.015) and row.parity_spin == 1


def test_scalars_equal_single_measures(spark, small):
    from strucsift.checks.fixtures import Fixtures

    plain = Fixtures(spark, small).plain_atoms
    fused = {r.sid: r for r in atom_ops.scalar_measures(plain).collect()}
    single = plain.groupBy("sid").agg(
        atom_ops.net_force_norm().alias("net"), atom_ops.max_force_norm().alias("top"),
        atom_ops.dipole_moment().alias("dipole"), atom_ops.molecular_weight().alias("weight")).collect()
    for r in single:
        f = fused[r.sid]
        assert (f.net_force_norm, f.max_force_norm, f.dipole_moment_magnitude, f.molecular_weight) == pytest.approx(
            (r.net, r.top, r.dipole, r.weight), abs=1e-9)
        assert f.net_force_norm <= f.num_atoms * f.max_force_norm + 1e-9


def test_formula_order(spark):
    df = atoms_of(spark, [(6, 0, 0, 0), (1, 0, 0, 0), (1, 0, 0, 0), (8, 0, 0, 0)], [(8, 0, 0, 0), (1, 0, 0, 0), (29, 0, 0, 0)])
    got = {r.sid: r.composition for r in atom_ops.composition(df).collect()}
    assert got == {0: "CH2O", 1: "CuHO"}


def test_validity_and_water(spark):
    lone = WATER + [(6, 9, 9, 9)]
    ring = [(1, 0, 0, 0), (1, 0.7, 0, 0), (1, 0.35, 0.6, 0)]
    df = atoms_of(spark, WATER, lone, [(8, 0, 0, 0)], ring)
    valid = {r.sid: r.is_molecular_structure_valid for r in geometry.structure_valid(df).collect()}
    assert valid == {0: True, 1: False, 2: False, 3: False}
    strict = {r.sid: r.is_molecular_structure_valid for r in geometry.structure_valid(df, 4).collect()}
    assert strict == {0: False, 1: False, 2: False, 3: False}
    water = {r.sid: r.num_water_molecules for r in geometry.water_count(df).collect()}
    assert water == {0: 1, 1: 1, 2: 0, 3: 0}


def test_large_structure_uses_the_grid(spark):
    rng = random.Random(3)
    big = [(rng.choice([1, 6, 8]), rng.uniform(-8, 8), rng.uniform(-8, 8), rng.uniform(-8, 8)) for _ in range(700)]
    assert len(big) > geometry.GRID_ABOVE
    df = atoms_of(spark, big, WATER)
    got = {(r.i, r.j) for r in geometry.neighbour_list(df).filter("sid = 0").collect()}
    r = {z: elements.COVALENT_RADII[z] for z in (1, 6, 8)}
    want = {
        (i, j) for (i, a), (j, b) in itertools.combinations(enumerate(big), 2)
        if math.dist(a[1:], b[1:]) < 1.2 * (r[a[0]] + r[b[0]])
    }
    assert got == want
    degree = {i: 0 for i in range(len(big))}
    for i, j in want:
        degree[i] += 1
        degree[j] += 1
    met = geometry.coordination(df).filter("sid = 0").agg(F.sum(F.col("degree") * F.col("n"))).first()[0]
    assert met == sum(degree.values())


@pytest.mark.parametrize("spread", [1.0, 6.0, 40.0])
def test_validity_of_crowded_structures(spark, spread):
    rng = random.Random(int(spread))
    heap = [(rng.choice([6, 8]), *(rng.uniform(0, spread) for _ in range(3))) for _ in range(400)]
    df = atoms_of(spark, heap, heap + [(1, spread + 0.9, 0, 0)], heap + [(6, 500, 0, 0)])
    got = {r.sid: r.is_molecular_structure_valid for r in geometry.structure_valid(df).collect()}
    exact = geometry.coordination(df).groupBy("sid").agg(
        (F.min("degree") >= 1) & F.bool_and((F.col("z") != 1) | (F.col("degree") == 1))).collect()
    assert got == {r[0]: r[1] for r in exact} and got[2] is False


def test_fragments_of_long_chains(spark):
    n = 120
    chain = [(6, 1.5 * k, 0, 0) for k in range(n)]
    order = list(range(n))
    random.Random(1).shuffle(order)
    shuffled = [chain[k] for k in order] + [(6, 0, 50, 0), (6, 0, 51.5, 0), (8, 0, 90, 0)]
    df = atoms_of(spark, shuffled)
    got = sorted(r.n_atoms for r in geometry.fragments(df, geometry.neighbour_list(df)).collect())
    assert got == [1, 2, n]


@pytest.mark.parametrize("in_row", [64, 0])
def test_fragments_of_random_graphs(spark, monkeypatch, in_row):
    monkeypatch.setattr(geometry, "LABEL_IN_ROW", in_row)
    rng = random.Random(8)
    atoms, bonds, want = [], [], {}
    for sid in range(30):
        n = rng.randint(1, 25)
        group = list(range(n))
        atoms += [(sid, i) for i in range(n)]
        for _ in range(rng.randint(0, n)):
            i, j = rng.randrange(n), rng.randrange(n)
            if i != j:
                bonds.append((sid, min(i, j), max(i, j)))
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
        for root in set(group):
            want[sid, root] = group.count(root)
    got = geometry.fragments(
        spark.createDataFrame(atoms, "sid long, idx long"), spark.createDataFrame(bonds, "sid long, i long, j long"))
    assert {(r.sid, r.root): r.n_atoms for r in got.collect()} == want


def test_periodic_neighbours_against_images(spark):
    rng = random.Random(5)
    cell = np.array([[6.0, 0.5, 0.0], [0.0, 5.0, 0.7], [0.4, 0.0, 7.0]])
    structure = [(rng.choice([1, 6, 8]), *(rng.uniform(-4, 9) for _ in range(3))) for _ in range(40)]
    df = atoms_of(spark, structure)
    cells = spark.createDataFrame([(0, cell.tolist())], "sid long, cell array<array<double>>")
    got = {(r.i, r.j): r.dist for r in geometry.periodic_neighbour_list(df, cells).collect()}
    shifts = [np.array(s) @ cell for s in itertools.product(range(-3, 4), repeat=3)]
    want = {}
    for (i, a), (j, b) in itertools.combinations(enumerate(structure), 2):
        d = min(np.linalg.norm(np.array(a[1:]) - np.array(b[1:]) + s) for s in shifts)
        if d < 1.2 * (elements.COVALENT_RADII[a[0]] + elements.COVALENT_RADII[b[0]]):
            want[i, j] = d
    assert got.keys() == want.keys() and got == pytest.approx(want, abs=1e-6)


def test_walks_may_return(spark):
    bonds = spark.createDataFrame([(0, 0, 1), (0, 1, 2)], "sid long, i long, j long")
    starts = spark.createDataFrame([(0, 0)], "sid long, idx long")
    paths = sorted(r.path for r in geometry.n_hop_walks(bonds, starts, 3).collect())
    assert paths == [[0, 1, 0], [0, 1, 2]]
    assert geometry.n_hop_walks(bonds, starts, 1).count() == 0


def test_slab_and_adsorbate(spark):
    slab = [(29, 1, 1, 5, 1), (29, 9, 9, 5, 1)]
    df = atoms_of(spark, slab + [(8, 5, 5, 8, 2)], slab + [(8, 5, 5, 1, 2)], slab)
    cell = [[10.0, 0.0, 0.0], [0.0, 10.0, 0.0], [0.0, 0.0, 30.0]]
    cells = spark.createDataFrame([(s, cell) for s in range(3)], "sid long, cell array<array<double>>")
    verdict = {r.sid: r.catalyst_xyz_adsorbate_is_valid for r in catalyst.adsorbate_valid(df, cells).collect()}
    assert verdict == {0: True, 1: False, 2: None}
    height = {r.sid: r.catalyst_substrate_height for r in catalyst.substrate_height(df, cells).collect()}
    assert height == pytest.approx({0: 3.0, 1: -4.0, 2: 0.0})
    flat = spark.createDataFrame([(s, [[0.0] * 3] * 3) for s in range(3)], "sid long, cell array<array<double>>")
    assert {r.sid: r.catalyst_substrate_height for r in catalyst.substrate_height(df, flat).collect()}[0] == pytest.approx(3.0)


@pytest.mark.parametrize("states, best", [
    ([(0, 1), (1, 1)], (0, 1)), ([(0, 1), (0, 3)], (0, 1)), ([(-1, 1), (1, 1)], (-1, 1)), ([(2, 1), (0, 3)], (0, 3)),
    ([], (0, 1)),
])
def test_lowest_state(spark, states, best):
    df = spark.createDataFrame([(0, *s) for s in states], "sid long, net_charge long, spin_multiplicity long")
    row = atom_ops.lowest_state(df, atoms_of(spark, WATER)).first()
    assert (row.net_charge, row.spin_multiplicity) == best


def test_motif_subsumption(spark):
    rows = [(1, "A", [1, 2, 3]), (1, "A", [2, 3]), (1, "A", [3, 2, 1]), (1, "B", [2, 3]), (1, "A", [3, 4])]
    df = spark.createDataFrame(rows, "id long, code string, members array<long>")
    row = motifs.motif_counts(df, ["A", "B"], 3, "is_protein").first()
    assert (row.num_a, row.num_b, row.is_protein) == (3, 1, True)


def test_motif_subsumption_against_brute_force(spark):
    rng = random.Random(9)
    sets = [(rng.randrange(4), rng.choice("AB"), sorted(rng.sample(range(12), rng.randint(1, 5)))) for _ in range(300)]
    got = motifs.maximal_matches(spark.createDataFrame(sets, "id long, code string, members array<long>"))
    want = sum(
        not any(i == o[0] and c == o[1] and set(m) < set(o[2]) for o in sets) for i, c, m in sets)
    assert got.agg(F.sum("n")).first()[0] == want


def test_motif_runs_against_brute_force_in_one_scan(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(5), rng.choice(["ala", "ALA", "ade", None]), s, s + rng.randint(0, 9)) for s in (rng.randrange(30) for _ in range(200))]
    # Backwards, without an end, without an id, and the same runs again.
    rows += [(1, "ala", 25, 3), (2, "ala", 4, None), (None, "ala", 1, 2), (9, "other", 1, 2), *rows[:20]]
    df = spark.createDataFrame(rows, "id bigint, code string, s bigint, e bigint")
    got = {r.id: (r.num_ala, r.num_ade, r.is_protein, r.is_nucleobase) for r in motifs.motif_columns(df).collect()}
    places = lambda s, e: None if e is None else frozenset(range(min(s, e), max(s, e) + 1))
    sets = [(i, c, places(s, e)) for i, c, s, e in rows]
    kept = [x for x in sets if x[2] is None or x[1] is None or not any(o[:2] == x[:2] and o[2] is not None and x[2] < o[2] for o in sets)]
    n = lambda i, c: sum(x[0] == i and (x[1] or "").lower() == c for x in kept)
    assert got == {i: (n(i, "ala"), n(i, "ade"), n(i, "ala") > 3, n(i, "ade") > 2) for i in {x[0] for x in rows} - {None}}
    texts = spark.createDataFrame([(1, "xaaax a.b"), (2, None)], "id bigint, text string")
    found = motifs.find_motifs(texts, [("ala", "aa"), ("ala", "a.b"), ("gly", "x+")])
    assert sorted((r.pattern, r.s, r.e) for r in found.collect()) == [("a.b", 6, 8), ("aa", 1, 2), ("aa", 2, 3), ("x+", 0, 0), ("x+", 4, 4)]
    plan = motifs.motif_columns(found)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_fingerprint_depends_on_structure_not_on_numbering(spark):
    ethanol = [(6, 0, 0, 0), (6, 1.5, 0, 0), (8, 2.2, 1.2, 0)]
    df = atoms_of(spark, ethanol, ethanol[::-1], [(6, 0, 0, 0), (8, 1.4, 0, 0), (6, 2.2, 1.2, 0)])
    bits = {r.sid: r.set_bits for r in fingerprints.circular_fingerprint(df, geometry.neighbour_list(df)).collect()}
    assert bits[0] == bits[1] != bits[2]


def one_hot(spark, n):
    rows = [(f"mol_{i}", [int(i == k) for k in range(n)]) for i in range(n)]
    return spark.createDataFrame(rows + [("mol_0_dup", rows[0][1])], "entry_key string, bits array<int>")


def test_greedy_keeps_distinct_fingerprints(spark):
    # Blocks of one row: each row is compared with everything accepted before it.
    picked = {r.entry_key for r in sampling.greedy_diverse(one_hot(spark, 4), threshold=0.5, block_size=1).collect()}
    assert len(picked) == 4 and len(picked & {"mol_0", "mol_0_dup"}) == 1
    assert sampling.greedy_diverse(one_hot(spark, 4), n=2, threshold=0.5).count() == 2
    for bad in ({"n": 0}, {"start": 99}):
        with pytest.raises(ValueError):
            sampling.greedy_diverse(one_hot(spark, 4), **bad)


def test_min_distance_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CANDIDATE_BLOCK", 30)
    monkeypatch.setattr(fingerprints, "POOL_BLOCK", 7)
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (120, 32))
    df = spark.createDataFrame([(f"k{i}", row.tolist()) for i, row in enumerate(bits)], "entry_key string, bits array<int>")
    pool = df.filter(F.substring("entry_key", -1, 1) == "3")
    got = {r.entry_key: r.distance for r in fingerprints.min_distance_to_pool(df, pool, 120, 12).collect()}
    members = [i for i in range(120) if i % 10 == 3]
    for i in range(120):
        common = bits[members] @ bits[i]
        union = bits[i].sum() + bits[members].sum(1) - common
        assert got[f"k{i}"] == pytest.approx((1 - common / (union + 1e-8)).min())


def test_rank_within_equals_a_window(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(20)}", i) for i in rng.sample(range(100000), 3000)]
    df = spark.createDataFrame(rows, "g string, v long")
    ranked = ranking.rank_within(df, ["g"], [F.floor(F.col("v") / 500)], ["v"], "rank").collect()
    seen: dict = {}
    for r in sorted(ranked, key=lambda r: (r.g, r.v)):
        assert r["rank"] == seen.get(r.g, 0)
        seen[r.g] = r["rank"] + 1


@pytest.mark.parametrize("few", [True, False])
def test_nearest_quantiles(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(ranking, "SKETCH_ACCURACY", 200)
    rng = random.Random(4)
    values = [rng.choice([1.0, 1.0, rng.gauss(0, 10)]) for _ in range(5000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 3.0), ("b", None)], "g string, v double")
    got = {(r.g, r.q): r.v for r in ranking.nearest_quantiles(df, ["g"], "v", (0.25, 0.5, 0.75)).collect()}
    ordered = sorted(values)
    for q in (0.25, 0.5, 0.75):
        assert got["a", q] == ordered[math.floor(q * (len(values) - 1) + 0.5)]
        assert got["b", q] == 3.0


def test_smallest_n_beyond_the_driver(spark):
    df = spark.range(20000).withColumn("score", F.pmod(F.col("id") * 7919, F.lit(1009)).cast("double"))
    got = {r.id for r in ranking.smallest_n(df, 7001, F.col("score"), ["id"], 20000, plain_top_n=0).collect()}
    want = {i for _, i in sorted((float(i * 7919 % 1009), i) for i in range(20000))[:7001]}
    assert got == want


def test_pick_row(spark):
    import hashlib

    df = keyed(spark, 3000)
    ordered = sorted((f"mol_{i}" for i in range(3000)), key=lambda k: hashlib.md5(k.encode()).hexdigest())
    for position in (0, 1234, 2999):
        assert sampling.pick_row(df, position).first().entry_key == ordered[position]
    with pytest.raises(ValueError):
        sampling.pick_row(df, 3000)


def keyed(spark, n=50):
    return spark.range(n).select(F.concat(F.lit("mol_"), F.col("id").cast("string")).alias("entry_key"), "id")


def test_random_sample(spark):
    df = keyed(spark)
    first = {r.entry_key for r in sampling.sample_random(df, 10, 1).collect()}
    again = {r.entry_key for r in sampling.sample_random(df.repartition(7), 10, 1).collect()}
    other = {r.entry_key for r in sampling.sample_random(df, 10, 2).collect()}
    assert len(first) == 10 and first == again != other
    assert sampling.sample_random(df, None).count() == 50
    with pytest.raises(ValueError):
        sampling.sample_random(df, 51, 1)


def test_sampler_dispatch(spark):
    df = keyed(spark)
    assert sampling.run_sampler(df, "all", 3).count() == 50
    with pytest.raises(ValueError):
        sampling.run_sampler(df, "best")
    with pytest.raises(ValueError):
        sampling.run_sampler(df, lambda frame, n: frame)
    assert sampling.run_sampler(df, lambda frame, n, low: frame.filter(F.col("id") > low).limit(n), 5,
                                required_columns=["id"], kwargs={"low": 40}).count() == 5


def test_weighted_sample_reaches_its_ratios(spark):
    df = spark.range(20000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("entry_key"),
        F.when(F.col("id") % 20 == 0, "rare").when(F.col("id") % 2 == 0, "even").otherwise("none").alias("class"))
    weighted = sampling.ratio_weights(df, "class", {"rare": 0.5, "even": 0.5})
    got = {r["class"]: r["count"] for r in sampling.sample_weighted(weighted, 800, F.col("weight"), 3).groupBy("class").count().collect()}
    assert set(got) == {"rare", "even"} and abs(got["rare"] - 400) < 60


def test_split_does_not_leak(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("entry_key"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 211).alias("reaction_id"))
    split = sampling.leak_free_split(df, "reaction_id", 0.9, 42)
    sides = split.groupBy("reaction_id").agg(F.count_distinct("split").alias("n"), F.max("split").alias("s")).collect()
    assert all(r.n == 1 for r in sides)
    assert sum(r.s == "train" for r in sides) == int(0.9 * len(sides))
    assert split.filter("split IS NULL").count() == 0
    for fraction, n in ((0.0, 0), (1.0, len(sides))):
        rows = sampling.leak_free_split(df, "reaction_id", fraction, 42).filter("split = 'train'")
        assert rows.select("reaction_id").distinct().count() == n


def test_split_labels_rows_without_moving_them(spark, tmp_path):
    spark.range(1000).withColumn("reaction_id", F.col("id") % 7).write.parquet(str(tmp_path / "t"))
    split = sampling.leak_free_split(spark.read.parquet(str(tmp_path / "t")), "reaction_id", 0.9, 42)
    plan = split._jdf.queryExecution().sparkPlan().toString()
    # Lines that start with a colon belong to the scalar subquery.
    rows = [line for line in plan.splitlines() if not line.startswith(":")]
    assert len(rows) <= 3 and not any("Join" in line or "Exchange" in line for line in rows)


def pathway(spark, *profiles):
    rows = [(f"p{k}_{i}", k, 0, i, float(e)) for k, profile in enumerate(profiles) for i, e in enumerate(profile)]
    return spark.createDataFrame(
        rows, "entry_key string, reaction_id long, reaction_pathway_id int, reaction_step_idx long, energy double")


def test_transition_states(spark):
    df = pathway(spark, [1, 3, 2], [5, 1, 2], [1, 4, 2, 4, 1])
    labelled = curation.label_transition_states(df)
    assert {r.entry_key for r in labelled.filter("is_ts").collect()} == {"p0_1", "p1_0", "p2_1", "p2_3"}
    bad = curation.endpoint_pathways(labelled, F.lit(0), F.lit(18))
    assert [r.reaction_id for r in bad.collect()] == [1]
    assert {r.reaction_id for r in curation.drop_pathways(df, bad).collect()} == {0, 2}
    assert {r.reaction_id for r in curation.single_peak_pathways(df).collect()} == {0}
    masked = curation.label_transition_states(df, F.col("reaction_step_idx") != 1)
    assert {r.entry_key for r in masked.filter("is_ts").collect()} == {"p1_0", "p2_3"}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, True), (0.5, True), (1.0, True), (None, True)], "x double, b boolean")
    rows = {(r.column, r.bin): r.n for r in stats.histogram(df, ["x", "b"], 10).collect() if r.n}
    assert rows == {("x", 0): 1, ("x", 5): 1, ("x", 9): 1, ("b", 5): 4}
    assert stats.histogram(df, ["x"], 10).count() == 10


def test_density_integrates_to_one(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(rng.gauss(0, 1),) for _ in range(2000)], "x double")
    curve = sorted((r.x, r.density) for r in stats.density_curve(df, "x").collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in itertools.pairwise(curve))
    assert len(curve) == 500 and area == pytest.approx(1.0, abs=0.01)


def query_table(spark):
    return spark.createDataFrame([
        ("mol_1", "spice", 0, 10, "CHO", "CCO"), ("mol_2", "tr1x", 1, 15, "NHO", "NCCO"),
        ("mol_3", "anix", -1, 8, "CHO", "C=O"), ("mol_4", "spice", 0, 20, "CH", None),
        ("mol_5", "biomolecules", 0, 12, "CHO", "")],
        "entry_key string, subset string, net_charge long, num_atoms long, symbols string, smiles string")


def chosen(df):
    return sorted(r.entry_key for r in df.collect())


def test_selection(spark):
    table = query_table(spark)
    assert chosen(select.select_rows(table, "subset = 'spice'")) == ["mol_1", "mol_4"]
    allowed = spark.createDataFrame([("CCO", 0), ("NCCO", 1), (None, 0)], "smiles string, net_charge int")
    single = {"columns": "smiles", "values": allowed}
    assert chosen(select.select_rows(table, "num_atoms > 0", single)) == ["mol_1", "mol_2"]
    both = {"columns": ["smiles", "net_charge"], "values": allowed}
    assert chosen(select.select_rows(table, "num_atoms > 11", both)) == ["mol_2"]
    for bad in ({"columns": "smiles"}, {"columns": "smiles", "values": ["CCO"]}, {"columns": [], "values": allowed}):
        with pytest.raises(ValueError):
            select.select_rows(table, "num_atoms > 0", bad)
    with pytest.raises(ValueError):
        select.select_rows(table, "num_atoms > 0", method="best")


def test_only_needed_columns_are_read(spark, tmp_path):
    query_table(spark).write.parquet(str(tmp_path / "t"))
    picked = select.select_rows(spark.read.parquet(str(tmp_path / "t")), "num_atoms > 9 AND subset = 'spice'")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<entry_key:string,subset:string,num_atoms:bigint>" in plan
    assert "GreaterThan(num_atoms,9)" in plan


def test_fetch_and_actions(spark):
    table = query_table(spark)
    keys = spark.createDataFrame([("mol_1",), ("mol_1",), ("mol_5",), ("none",)], "entry_key string")
    assert chosen(select.fetch(table, keys, "num_atoms")) == ["mol_1", "mol_5"]
    assert sorted(r.smiles for r in actions.extract_text(table, keys).collect()) == ["", "CCO"]
    results = actions.run_actions(table, keys, [
        "extract_smiles", "make_statistics", {"make_histograms": ["num_atoms", "subset"]}, "unknown"])
    assert set(results) == {"extract_smiles", "make_histograms"}
    assert results["make_histograms"].count() == 100
    assert actions.make_statistics(table, keys, "subset") is None
    stats_row = actions.make_statistics(table, keys, "num_atoms").first()
    assert (stats_row["count"], stats_row["min"], stats_row["max"]) == (2, 10.0, 12.0)
    assert actions.statistics_name(["a" * 101]) == "statistics-many"


def test_store(spark, tmp_path):
    path = str(tmp_path / "db")
    table = query_table(spark)
    store.append(table.limit(0), path)
    store.append(table, path)
    with pytest.raises(store.KeyCollisionError):
        store.append(table.filter("entry_key = 'mol_2'"), path)
    store.append(table.filter("entry_key = 'mol_2'"), path, check_keys=False)
    assert spark.read.parquet(path).count() == 6
    scanned = querydb.scan_query_table(spark, path)
    assert scanned.count() == 6 and scanned.filter("tpsa IS NULL").count() == 6
    with pytest.raises(FileNotFoundError):
        querydb.scan_query_table(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError):
        store.save_keys(table.filter("num_atoms > 99"), str(tmp_path / "keys"))
    merged = store.merge_shards(table.filter("net_charge = 0"), table.filter("net_charge <> 0"))
    assert merged.count() == 5
    with pytest.raises(PySparkException):
        store.merge_shards(table, table).collect()


def test_registry(spark):
    entry = spark.createDataFrame([("a", "train", "/x")], "database_name string, split_name string, files_path string")
    registry = querydb.register_source(querydb.register_source(None, entry), entry.withColumn("files_path", F.lit("/y")))
    assert [r.files_path for r in registry.collect()] == ["/y"]
    with pytest.raises(ValueError):
        querydb.load_allowlist(entry, ["smiles"])


STRUCTURES = ("database_name string, split_name string, source_file_name string, frame_idx long, numbers array<int>, "
              "positions array<array<double>>, forces array<array<double>>, pbc array<boolean>, energy double, "
              "stress array<double>, info map<string,string>")


def structures(spark, forces=True):
    force = [[0.0, 0.0, 1.0]] if forces else None
    return spark.createDataFrame([
        ("omol25", split, f"shard_{k}", i, [1], [[0.0] * 3], force, [True] * 3, None if i else -1.0,
         [1.0, 2.0, 3.0, 4.0, 5.0, 6.0] if i else None, {"charge": "0"})
        for split, k, i in (("train", 1, 0), ("train", 1, 1), ("train", 2, 0), ("valid", 1, 0))], STRUCTURES)


def structure_keys(spark):
    names = ["omol25_train_shard$1_0", "omol25_train_shard$1_1", "omol25_train_shard$2_0", "omol25_valid_shard$1_0"]
    return spark.createDataFrame([(k,) for k in [*names, names[0]]], "entry_key string")


def test_export(spark, tmp_path):
    keys = structure_keys(spark)
    assert export.keys_by_file(keys).select("file_group").distinct().count() == 3
    table = spark.createDataFrame([("omol25_train_shard$1_1", 5)], "entry_key string, num_atoms long")
    records = export.export(keys, structures(spark), table, ["num_atoms"], 2, {"charge": "charge"})
    rows = {r.entry_key: r for r in records.collect()}
    assert len(rows) == 4
    second = rows["omol25_train_shard$1_1"]
    assert second.stress == [[1.0, 6.0, 5.0], [6.0, 2.0, 4.0], [5.0, 4.0, 3.0]]
    assert second.extras.num_atoms == 5 and second.charge == "0" and second.pbc == [1.0] * 3
    assert rows["omol25_train_shard$1_0"].extras is None and rows["omol25_train_shard$1_0"].energy == -1.0
    assert {k: r.part for k, r in rows.items()} == {
        "omol25_train_shard$1_0": 0, "omol25_train_shard$1_1": 0, "omol25_train_shard$2_0": 1, "omol25_valid_shard$1_0": 1}

    path = str(tmp_path / "out")
    export.write_parts(records.filter("part = 0"), path, resume=True)
    with pytest.raises(PySparkException):
        export.write_parts(records, path)
    export.write_parts(records, path, resume=True)
    assert spark.read.parquet(path).count() == 4


def test_export_failures(spark):
    keys = structure_keys(spark)
    with pytest.raises(PySparkException, match="no forces"):
        export.training_records(export.lookup_records(keys, structures(spark, forces=False)), {}).collect()
    registry = spark.createDataFrame([("omol25", "train")], "database_name string, split_name string")
    with pytest.raises(PySparkException, match="no registered source"):
        export.lookup_records(keys, structures(spark), registry).collect()
    assert [r.split_name for r in export.unregistered_keys(keys, registry).collect()] == ["valid"]


@pytest.mark.parametrize("groups, parts", [(1, 3), (5, 2), (7, 3), (8, 8)])
def test_part_slices(spark, groups, parts):
    keys = spark.createDataFrame([(f"d_s_f{g:03d}_0",) for g in range(groups)], "entry_key string")
    got = {r.file_group: r.part for r in export.plan_parts(keys, parts).collect()}
    used = min(parts, groups)
    want = {
        f"d_s_f{g:03d}": p for p in range(used) for g in range(p * groups // used, (p + 1) * groups // used)}
    assert got == want


def test_processing_with_graph_properties(spark):
    atoms = atoms_of(spark, WATER, WATER * 4)
    rows = spark.createDataFrame([(0, "a", "spice"), (1, "b", "spice")], "sid long, entry_key string, subset string")
    done = {r.entry_key: r for r in process.process(rows, atoms, {"functional": "PBE"}, graph=True, atom_limit=5).collect()}
    assert done["a"].functional == "PBE" and done["a"].num_water_molecules == 1 and done["a"].composition == "H2O"
    assert done["a"].graph_properties_candidate and sum(done["a"].fingerprint) > 0 and not done["a"].error_graph_properties
    assert done["b"].graph_properties_candidate is False and done["b"].fingerprint is None and not done["b"].error_graph_properties


def test_format_rules(spark):
    df = spark.createDataFrame([(0, "omat24-rattled-1000", 5, 2.0)], "sid long, database_name string, net_charge long, spin_multiplicity double")

    def applied(fmt):
        out = df
        for transform in formats.transforms_for(fmt):
            out = transform(out)
        return out.first()

    omat = applied("aselmdb_omat")
    assert (omat.database_name, omat.subset, omat.net_charge, omat.spin_multiplicity) == ("omat24", "rattled-1000", 0, None)
    assert (applied("aselmdb_omc").net_charge, applied("aselmdb_odac").spin_multiplicity) == (0, 1.0)
    assert applied("xyz").net_charge == 5
    with pytest.raises(ValueError):
        formats.transforms_for("cif")


def test_null_keys_are_never_drawn(spark):
    df = spark.range(3000).select(F.when(F.col("id") >= 10, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("entry_key"))
    for n in (100, 2990):
        paths = [{r.entry_key for r in sampling.sample_random(df, n, 1, plain_top_n=p).collect()} for p in (0, 10_000)]
        assert paths[0] == paths[1] and len(paths[0]) == n and None not in paths[0]
    with pytest.raises(ValueError):
        sampling.sample_random(df, 2995, 1)


def test_weights_may_have_any_scale(spark):
    df = spark.range(600).select(F.col("id").cast("string").alias("entry_key"), F.when(F.col("id") < 300, 9.0).otherwise(1.0).alias("w"))
    draws = [{r.entry_key for r in sampling.sample_weighted(df, 200, F.col("w") * scale, 3).collect()} for scale in (1.0, 1e14, 1e-14)]
    assert draws[0] == draws[1] == draws[2] and sum(int(k) < 300 for k in draws[0]) > 150


def test_small_periodic_cells(spark):
    """Two atoms in a cell that is lower than the cutoff: all images, own ones too, against counting."""
    side, cutoff = 2.0, 3.0
    atoms = spark.createDataFrame([(1, 0, 6, 0.1, 0.2, 0.3), (1, 1, 6, 1.1, 1.2, 1.3)], "sid int, idx int, z int, px double, py double, pz double")
    cells = spark.createDataFrame([(1, [[side, 0.0, 0.0], [0.0, side, 0.0], [0.0, 0.0, side]])], "sid int, cell array<array<double>>")
    found = {(r.i, r.j): (round(r.dist, 6), r.images) for r in geometry.periodic_neighbour_list(atoms, cells, geometry.fixed_radius(cutoff)).collect()}
    steps = [(a, b, c) for a in range(-3, 4) for b in range(-3, 4) for c in range(-3, 4)]
    own = [side * math.hypot(*s) for s in steps if s != (0, 0, 0)]
    other = [math.hypot(*(1.0 + side * x for x in s)) for s in steps]
    count = lambda d: (round(min(d), 6), sum(x < cutoff for x in d))
    assert found == {(0, 0): count(own), (1, 1): count(own), (0, 1): count(other)}


def test_structures_without_atoms_and_given_formulas_stay(spark):
    structures = spark.createDataFrame([(1, "a", "CaO2"), (2, "b", None), (3, "c", None)], "sid int, entry_key string, composition string")
    atoms = spark.createDataFrame(
        [(s, i, z, 1.2 * i, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0) for s in (1, 2) for i, z in enumerate((8, 6))],
        "sid int, idx int, z int, px double, py double, pz double, fx double, fy double, fz double, charge double")
    rows = {r.entry_key: r for r in process.process(structures, atoms).collect()}
    assert [rows[k].composition for k in "abc"] == ["CaO2", "CO", None]
    assert list(rows["a"].atomic_numbers) == [8, 6] and rows["c"].num_atoms == 0 and rows["c"].is_molecular_structure_valid is False


def test_nan_is_in_no_bin(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    rows = stats.histogram(df, ["v"], 2).collect()
    assert sum(r.n for r in rows) == 2 and not any(math.isnan(r.bin_start) for r in rows)


def test_row_form_equals_long_form_without_exchange(spark, tmp_path):
    """Measures of landing rows against the atom table's, dense and lone atoms, on both sides of the row limit."""
    rnd = random.Random(4)
    rows = []
    for sid in range(60):
        n, side = rnd.choice([1, 2, 3, 8, 30]), rnd.choice([1.0, 2.5, 6.0])
        z = [rnd.choice([1, 1, 6, 8]) for _ in range(n)]
        point = lambda: [rnd.uniform(0, side) for _ in range(3)]
        rows.append((sid, z, [point() for _ in z], [point() for _ in z], [rnd.uniform(-1, 1) for _ in z], [0] * n))
    spark.createDataFrame(rows, "sid bigint, numbers array<int>, positions array<array<double>>, forces array<array<double>>, "
                          "charges array<double>, tags array<int>").write.parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    atoms = atom_ops.explode_structures(landed, "sid")
    long = {r.sid: r.asDict() for r in atom_ops.scalar_measures(atoms).collect()}
    for r in rowwise.scalars(landed, "sid").collect():
        assert all(v == (pytest.approx(long[r.sid][k]) if isinstance(v, float) else long[r.sid][k]) for k, v in r.asDict().items())
    checked = geometry.structure_valid(atoms).join(geometry.water_count(atoms), "sid")
    expected = {r.sid: (r.is_molecular_structure_valid, r.num_water_molecules) for r in checked.collect()}
    for limit in (0, 5, 256):
        found = rowwise.validity_and_water(landed, limit)
        assert {r.sid: (r.is_molecular_structure_valid, r.num_water_molecules) for r in found.collect()} == expected
    plan = rowwise.scalars(landed, "sid")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_landed_rows_without_atoms_stay(spark):
    """Null or empty ``numbers``: kept as invalid with 0 atoms, on both sides of the row limit."""
    point = [[0.0, 0.0, 0.0], [0.0, 0.0, 0.7]]
    rows = [(1, None, None, None, None, None), (2, None, point, point, [0.0, 0.0], [0, 0]), (3, [], [], [], [], []), (4, [1, 1], point, point, [0.0, 0.0], [0, 0])]
    landed = spark.createDataFrame(rows, "sid bigint, numbers array<int>, positions array<array<double>>, forces array<array<double>>, "
                                   "charges array<double>, tags array<int>")
    for limit in (0, 1, 256):
        found = {tuple(r) for r in rowwise.validity_and_water(landed, limit).collect()}
        assert found == {(1, False, 0), (2, False, 0), (3, False, 0), (4, True, 0)}
    scalars = {r.sid: r.asDict() for r in rowwise.scalars(landed, "sid").collect()}
    assert [scalars[i]["num_atoms"] for i in (1, 2, 3, 4)] == [0, 0, 0, 2]
    assert all(v is None for i in (1, 2, 3) for k, v in scalars[i].items() if k not in ("sid", "num_atoms"))
    done = process.process_landed(landed.withColumns({
        "entry_key": F.concat(F.lit("k"), "sid"), "info": F.create_map(F.lit("data_id"), F.lit("x"))}).withColumn(
        "info", F.from_json(F.to_json("info"), "data_id string, charge double, num_atoms bigint, spin double, composition string")), "aselmdb_omol")
    assert {(r.entry_key, r.num_atoms, r.is_molecular_structure_valid, r.num_water_molecules) for r in done.collect()} == {
        ("k1", 0, False, 0), ("k2", 0, False, 0), ("k3", 0, False, 0), ("k4", 2, True, 0)}


@pytest.mark.parametrize("pool_block, own_block", [(4_096, 25_000), (5, 11), (1, 40)])
def test_min_distance_of_odd_fingerprints(spark, monkeypatch, pool_block, own_block):
    monkeypatch.setattr(fingerprints, "CANDIDATE_BLOCK", own_block)
    monkeypatch.setattr(fingerprints, "POOL_BLOCK", pool_block)
    rng = np.random.default_rng(3)
    rows = [(f"k{i}", (rng.random(150) < rng.random() ** 2).astype(int).tolist()) for i in range(60)]
    # No array, no bits, a missing bit, a shorter array, a key of two rows and a row given twice.
    rows += [("none", None), ("zero", [0] * 150), ("empty", []), ("hole", [1, None, 1]), ("k0", [1] * 150), rows[5]]
    df = spark.createDataFrame(rows, "entry_key string, bits array<int>")
    members = rows[::4] + rows[-3:]
    pool = spark.createDataFrame(members, df.schema)
    found = {r.entry_key: r.distance for r in fingerprints.min_distance_to_pool(df, pool, len(rows), len(members)).collect()}

    def full(bits):
        return np.array([b or 0 for b in bits or []] + [0] * (150 - len(bits or [])))

    expected = {}
    for key, bits in rows:
        a = full(bits)
        nearest = min(1 - (a @ full(b)) / (a.sum() + full(b).sum() - a @ full(b) + 1e-8) for _, b in members)
        expected[key] = min(nearest, expected.get(key, 2.0))
    assert found == pytest.approx(expected)
    assert fingerprints.min_distance_to_pool(df, pool.limit(0), len(rows), 0).count() == 0
    assert fingerprints.min_distance_to_pool(df.limit(0), pool, 0, len(members)).count() == 0


def test_min_distance_compares_equal_fingerprints_once(spark, monkeypatch):
    compared = []
    plain = fingerprints.packed_minimum
    monkeypatch.setattr(fingerprints, "packed_minimum", lambda ours, theirs, *a, **k: (
        compared.append((ours.count(), theirs.count())), plain(ours, theirs, *a, **k))[1])
    rows = [(f"k{i}", [int(b) for b in f"{i % 10 + 1:08b}"]) for i in range(200)] + [(None, [1] * 8), (None, [1] * 8)]
    df = spark.createDataFrame(rows, "entry_key string, bits array<int>")
    pool = df.filter(F.get("bits", F.lit(7)) == 1)
    found = {r.entry_key: r.distance for r in fingerprints.min_distance_to_pool(df, pool, 202, pool.count()).collect()}
    # Odd numbers are in the pool themselves; the five even ones are compared, each once.
    assert compared == [(5, 6)] and len(found) == 201
    members = [b for _, b in rows if b[7]]
    for key, bits in rows:
        a = np.array(bits)
        assert found[key] == pytest.approx(min(1 - (a @ b) / (a.sum() + b.sum() - a @ b + 1e-8) for b in map(np.array, members)))


def test_min_distance_deals_small_rows_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "TASK_PAIRS", 2_000)
    df = spark.range(256).select(F.col("id").cast("string").alias("entry_key"), F.transform(
        F.sequence(F.lit(0), F.lit(9)), lambda i: F.get(F.split(F.lpad(F.bin("id"), 10, "0"), ""), i).cast("int")).alias("bits"))
    pool = df.filter("entry_key % 2 = 0").coalesce(1)
    for block in (4_096, 16):
        monkeypatch.setattr(fingerprints, "POOL_BLOCK", block)
        found = fingerprints.min_distance_to_pool(df.coalesce(1), pool, 256, 128)
        assert found.count() == 256
        assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()


@pytest.mark.parametrize("block_size, pool_block", [(7, 4_096), (7, 4), (30, 4), (500, 4)])
def test_greedy_is_the_plain_block_loop(spark, monkeypatch, block_size, pool_block):
    monkeypatch.setattr(fingerprints, "POOL_BLOCK", pool_block)
    rng = np.random.default_rng(8)
    seeds = rng.integers(0, 2, (9, 70))
    # Noisy copies of a few fingerprints, so that most blocks add nothing.
    bits = np.array([np.where(rng.random(70) < 0.1, 1 - seeds[i % 9], seeds[i % 9]) for i in range(90)])
    df = spark.createDataFrame([(f"k{i}", row.tolist()) for i, row in enumerate(bits)], "entry_key string, bits array<int>")
    order = sorted(range(90), key=lambda i: hashlib.md5(f"k{i}".encode()).hexdigest())

    def distance(i, j):
        common = bits[i] @ bits[j]
        return 1 - common / (bits[i].sum() + bits[j].sum() - common + 1e-8)

    picked = order[:1]
    for at in range(0, 90, block_size):
        picked += [i for i in order[at:at + block_size] if i != order[0] and all(distance(i, j) > 0.5 for j in list(picked))]
    found = sampling.greedy_diverse(df, threshold=0.5, block_size=block_size)
    assert {r.entry_key for r in found.collect()} == {f"k{i}" for i in picked}
    if block_size == 7:
        few = {r.entry_key for r in sampling.greedy_diverse(df, n=5, threshold=0.5, block_size=7).collect()}
        assert few == {f"k{i}" for i in picked[:5]}


def test_row_fingerprint_is_the_long_one(spark):
    rng = np.random.default_rng(4)
    elements = np.array([1, 6, 7, 8, 16, 200])
    rows = [(sid, rng.choice(elements, n).tolist(), (rng.random((n, 3)) * 1.6 * n ** (1 / 3)).tolist())
            for sid, n in enumerate([1, 2, 5, 12, 30, 45])]
    schema_of = "sid bigint, numbers array<int>, positions array<array<double>>"
    df = spark.createDataFrame([*rows, (90, [], []), (91, None, None)], schema_of)
    atoms = atom_ops.explode_structures(spark.createDataFrame(rows, schema_of), "sid")
    long = {r.sid: r.set_bits for r in fingerprints.circular_fingerprint(atoms, geometry.neighbour_list(atoms)).collect()}
    for limit in (256, 20):
        found = rowwise.with_fingerprint(df, row_atoms=limit)
        assert {r.sid: r.set_bits for r in found.collect()} == {**long, 90: None, 91: None}
    chosen = rowwise.with_fingerprint(df, where=F.col("sid") < 2)
    assert {r.sid for r in chosen.filter("set_bits is not null").collect()} == {0, 1}
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_describe_reads_its_table_twice_and_is_exact(spark, tmp_path):
    """Every width of bracket, ties, nulls, NaN, a boolean and a skewed label against plain ranks."""
    draw = np.random.default_rng(3)
    sizes = {"tiny": 7, "few": 900, "some": 9_000, "many": 30_000, "most": 230_000}
    frame = pd.concat([pd.DataFrame({
        "label": name, "x": draw.normal(size=n), "ties": draw.integers(0, 4, n), "flag": draw.random(n) < 0.3,
        "holes": np.where(draw.random(n) < 0.5, None, draw.random(n))}) for name, n in sizes.items()])
    spark.createDataFrame(frame, "label string, x double, ties bigint, flag boolean, holes double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    columns = ["x", "ties", "flag", "holes"]
    got = {(r.label, r.column): r for r in stats.describe(df, columns, "label").collect()}
    assert set(got) == {(name, c) for name in sizes for c in columns}
    for (name, column), r in got.items():
        values = frame[frame.label == name][column].dropna().astype(float).sort_values().to_numpy()
        assert (r["count"], r.null_count) == (len(values), sizes[name] - len(values))
        assert (r.min, r.max) == (values[0], values[-1]) and abs(r.mean - values.mean()) < 1e-9
        expected = [None] * 3 if column == "flag" else [values[int(q * (len(values) - 1) + 0.5)] for q in (0.25, 0.5, 0.75)]
        assert [r.p25, r.p50, r.p75] == expected, (name, column)
    whole = {r.column: r for r in stats.describe(df, columns).collect()}
    ordered = np.sort(frame.x.to_numpy())
    assert whole["x"].p50 == ordered[int(0.5 * (len(ordered) - 1) + 0.5)]


def test_describe_odd_tables(spark):
    rows = [(1, 1.5, None, True), (2, float("nan"), None, None), (None, 2.5, None, False)]
    df = spark.createDataFrame(rows, "n bigint, count double, nothing double, found boolean")
    got = {r.column: r for r in stats.describe(df, df.columns).collect()}
    assert [got["n"].p25, got["n"].p50, got["n"].p75] == [1, 2, 2]
    assert got["nothing"]["count"] == 0 and got["nothing"].p50 is None and got["nothing"].null_count == 3
    assert got["found"].std is None and got["found"].mean == 0.5 and got["count"].p50 == 2.5
    assert stats.describe(df.filter("false"), df.columns).count() == 0
    assert [r.column for r in stats.describe(df, ["found"]).collect()] == ["found"]


def test_half_shell_meets_every_pair_once(spark, monkeypatch):
    """Three sizes of grid against all pairs, on cell borders too."""
    draw = np.random.default_rng(5)
    places = np.concatenate([draw.random((150, 3)) * 9 - 4, np.stack(np.meshgrid(*[np.arange(-2.0, 3)] * 3), -1).reshape(-1, 3)])
    rows = [(1, i, int(draw.choice([1, 6, 8, 0])), *map(float, p)) for i, p in enumerate(places)]
    df = spark.createDataFrame(rows, "sid bigint, idx bigint, z int, px double, py double, pz double")
    for radius in (geometry.bond_radius(), geometry.fixed_radius(1.0), geometry.fixed_radius(2.0)):
        monkeypatch.setattr(geometry, "GRID_ABOVE", 10_000)
        plain = geometry.neighbour_list(df, radius).collect()
        monkeypatch.setattr(geometry, "GRID_ABOVE", 8)
        found = geometry.neighbour_list(df, radius).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, plain)) and len(plain) == len({(r.i, r.j) for r in plain}) > 0
        assert all(r.i < r.j for r in found)


def test_neighbour_plans_are_short(spark):
    rows = [(1, i, 6, float(i), 0.0, 0.0, i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "sid bigint, idx bigint, z int, px double, py double, pz double, tag int")

    def exchanges(found):
        return found._jdf.queryExecution().executedPlan().toString().count("Exchange ")

    assert exchanges(geometry.neighbour_list(df)) <= 4
    assert exchanges(catalyst.adsorbate_structure_valid(df)) <= 20
