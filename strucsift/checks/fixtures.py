"""Structure-shaped projections of the driver's tables.

An order stands for a structure, a line item for an atom, an event for a source path, an
embedding for a fingerprint. Everything is lazy and covers the whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strucsift.functions import elements
from strucsift.functions.keys import build_key, normalize_name
from strucsift.operators import atoms as atom_ops
from strucsift.operators.geometry import neighbour_list
from strucsift.operators.ranking import rank_in_groups, rank_within
from strucsift.session import cut_lineage
from strucsift.sources.landing import number_frames
from strucsift.sources.querydb import source_registry

FILE = ["raw_database_name", "raw_split_name", "source_file_name"]
# Line items of one order are numbered in buckets of this many part keys.
PART_BUCKET = 4096


class Fixtures:
    """Lazy frames over one directory of driver tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def _atom_columns(self, lineitem: DataFrame, *extra) -> DataFrame:
        supp = F.col("l_suppkey")
        z = F.when(supp % 2 == 0, 1).when(supp % 4 == 1, 8).otherwise(6)
        return lineitem.select(
            F.col("l_orderkey").alias("sid"), *extra, z.alias("z"),
            (F.col("l_quantity") / 25.0).alias("px"), (F.col("l_discount") * 15.0).alias("py"),
            (F.col("l_tax") * 15.0).alias("pz"),
            (F.col("l_extendedprice") / 10000.0 - 5.0).alias("fx"),
            (F.col("l_quantity") / 10.0 - 2.5).alias("fy"),
            ((F.col("l_linenumber") - 4) / 2.0).alias("fz"),
            (F.col("l_discount") - 0.05).alias("charge"),
            (F.col("l_linenumber") % 3).alias("tag"),
        )

    @cached_property
    def plain_atoms(self) -> DataFrame:
        """Atoms without their number, for measures that do not need one: no shuffle."""
        return self._atom_columns(self.table("lineitem"))

    @cached_property
    def atoms(self) -> DataFrame:
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
        numbered = rank_in_groups(
            self.table("lineitem"), ["l_orderkey"],
            [F.col("l_linenumber"), F.floor(F.col("l_partkey") / PART_BUCKET)], order, "idx")
        return self._atom_columns(numbered, "idx")

    @cached_property
    def raw_structures(self) -> DataFrame:
        """Structures before frames are numbered."""
        key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.table("orders").select(
            key.alias("sid"), cust.alias("custkey"),
            F.when(status == "F", "OMOL25").when(status == "O", "oc20_s2ef").otherwise("omat24-rattled_1000").alias("raw_database_name"),
            F.when(key % 10 < 8, "Train").otherwise("val_id").alias("raw_split_name"),
            F.concat(F.lit("data_"), F.lpad((cust % 20).cast("string"), 4, "0")).alias("source_file_name"),
            F.when(priority == "1-URGENT", "rgd").when(priority == "2-HIGH", "spice")
            .when(priority == "3-MEDIUM", "biomolecules").when(priority == "4-NOT SPECIFIED", "elytes").alias("subset"),
            (0.0 - price / 100.0).alias("info_energy"),
            F.when(key % 3 != 0, 0.0 - price / 100.0).alias("calc_energy"),
            ((cust % 3) - 1).alias("info_charge"),
            (cust % 5).cast("int").alias("class_code"), (cust % 6).cast("int").alias("anomaly_code"),
            F.concat(F.lit("frame"), (key % 300).cast("string")).alias("frame_number"),
            F.lit(10.0).alias("ax"), ((cust % 5).cast("double") / 10.0).alias("az"),
            F.lit(10.0).alias("bvy"), F.lit(30.0).alias("cz"),
            (price / 1000.0).alias("s0"), (price / 2000.0).alias("s1"), (price / 3000.0).alias("s2"),
            (cust % 7).cast("double").alias("s3"), (cust % 11).cast("double").alias("s4"),
            (cust % 13).cast("double").alias("s5"),
        )

    @cached_property
    def structures(self) -> DataFrame:
        numbered = number_frames(self.raw_structures, "sid", FILE)
        return numbered.withColumns({
            "database_name": normalize_name(F.col("raw_database_name")),
            "split_name": normalize_name(F.col("raw_split_name")),
        })

    @cached_property
    def keyed_structures(self) -> DataFrame:
        return self.structures.withColumn("entry_key", build_key(
            F.col("database_name"), F.col("split_name"), F.col("source_file_name"), F.col("frame_idx")))

    @cached_property
    def cells(self) -> DataFrame:
        zero = F.lit(0.0)
        return self.raw_structures.select("sid", F.array(
            F.array("ax", zero, "az"), F.array(zero, "bvy", zero), F.array(zero, zero, "cz")).alias("cell"))

    @cached_property
    def query_table(self) -> DataFrame:
        symbol = elements.symbol(F.col("z"))
        measures = self.plain_atoms.groupBy("sid").agg(
            F.count(F.lit(1)).alias("num_atoms"),
            F.round(atom_ops.net_force_norm(), 6).alias("net_force_norm"),
            F.round(atom_ops.max_force_norm(), 6).alias("max_force_norm"),
            F.round(atom_ops.molecular_weight(), 6).alias("molecular_weight"),
            atom_ops.atomic_symbols().alias("atomic_symbols"),
            F.bool_or(symbol == "H").alias("has_h"),
        )
        return self.keyed_structures.join(measures, "sid").select(
            "entry_key", "sid", "database_name", "split_name", "subset",
            F.col("info_energy").alias("energy"), F.col("info_charge").alias("net_charge"),
            "num_atoms", "net_force_norm", "max_force_norm", "molecular_weight", "atomic_symbols", "has_h")

    @cached_property
    def bonds(self) -> DataFrame:
        return neighbour_list(self.atoms)

    @cached_property
    def pathways(self) -> DataFrame:
        status = F.col("o_orderstatus")
        group = ["reaction_id", "reaction_pathway_id"]
        rows = self.table("orders").select(
            F.concat(F.lit("rx_"), F.col("o_orderkey").cast("string")).alias("entry_key"),
            F.col("o_custkey").alias("reaction_id"),
            F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("reaction_pathway_id"),
            "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("energy"))
        month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
        placed = rank_within(rows, group, [month], ["o_orderdate", "o_orderkey"], "reaction_step_idx")
        last = rows.groupBy(*group).agg((F.count(F.lit(1)) - 1).alias("last_step_idx"))
        return placed.join(last, group).select(
            "entry_key", *group, "reaction_step_idx", "last_step_idx", "energy")

    @cached_property
    def source_strings(self) -> DataFrame:
        kind, e, u = F.col("event_type"), F.col("event_id"), F.col("user_id").cast("string")

        def text(*parts) -> F.Column:
            return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

        mech = e % 3 != 0
        source = (
            F.when(e % 97 == 0, "bad")
            .when(kind == "click", text("rgd_uks/MR_", u, "_", e % 4, "_", e % 19, "_0_1/orca.tar.zst"))
            .when(kind == "view", text(
                F.when(mech, "pmechdb/r_").otherwise("ani1xbb/r_"), u, "_",
                F.when(mech, "step").otherwise(""), e % 12, "/f.tar"))
            .when(kind == "signup", text("ani2x/r_", u, "_", e % 25, "/f.tar"))
            .when(kind == "purchase", text("trans1x/r_", u, "_2_", e % 27, "/f.tar"))
            .when(e % 2 == 0, text("tm_react/mc_", u, "_step", e % 9, "_x/orca.tar"))
            .otherwise(text("omol/mc_", u, "/orca.tar"))
        )
        return self.table("events").select(
            "event_id",
            F.when(kind == "click", "rgd").when(kind == "view", "reactivity").when(kind == "signup", "ani1")
            .when(kind == "purchase", "trans1x").otherwise("metal_complexes").alias("data_id"),
            source.alias("source"),
            F.when((kind == "error") & (e % 5 == 0), "ref/step1_incomplete")
            .when((kind == "error") & (e % 5 == 1), "ref/step2_ok").alias("reference_source"))

    @cached_property
    def states(self) -> DataFrame:
        electrons = self.plain_atoms.groupBy("sid").agg(F.sum("z").alias("electrons"))
        candidates = electrons.withColumn("net_charge", F.explode(F.array(*[F.lit(q) for q in range(-3, 4)])))
        q, sid = F.col("net_charge"), F.col("sid")
        return candidates.filter(((sid + q + 30) % 3 != 0) & (sid % 11 != 0)).select(
            "sid", "net_charge",
            (1 + ((F.col("electrons") - q + 300) % 2) + F.when((sid + q + 30) % 5 == 0, 2).otherwise(0)).alias("spin_multiplicity"))

    @cached_property
    def matches(self) -> DataFrame:
        line = F.col("l_linenumber").cast("bigint")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("code"),
            F.col("l_linestatus").alias("pattern"), line.alias("s"),
            (line + F.floor("l_quantity") % 3).alias("e")).distinct()

    @cached_property
    def sidecar(self) -> DataFrame:
        return self.structures.filter(F.col("raw_database_name") == "oc20_s2ef").select(
            "source_file_name", "database_name", "split_name", "frame_idx",
            F.concat(F.lit("random"), F.col("custkey").cast("string")).alias("oc_sid"),
            "frame_number", (F.col("info_energy") / 2.0).alias("ref_energy"))

    @cached_property
    def sid_mapping(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.table("customer").filter(c % 50 != 7).select(
            F.concat(F.lit("random"), c.cast("string")).alias("oc_sid"), F.col("c_nationkey").alias("bulk_id"),
            (c % 80).cast("int").alias("ads_id"), F.col("c_mktsegment").alias("bulk_symbols"),
            (F.col("c_nationkey") % 5).cast("int").alias("class_code"))

    @cached_property
    def sources(self) -> DataFrame:
        pair = self.raw_structures.select(
            normalize_name(F.col("raw_database_name")).alias("database_name"),
            normalize_name(F.col("raw_split_name")).alias("split_name"))
        missing = (F.col("database_name") == "oc20-s2ef") & (F.col("split_name") == "val-id")
        return pair.filter(~missing).withColumn(
            "files_path", F.concat_ws("/", F.lit("/landing"), "database_name", "split_name"))

    @cached_property
    def registry(self) -> DataFrame:
        return source_registry(self.sources)

    @cached_property
    def fingerprints(self) -> DataFrame:
        return self.table("embeddings").select(
            F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("entry_key"), "vec_id",
            F.transform("embedding", lambda x: F.when(x > 0, 1).otherwise(0)).alias("bits"))

    @cached_property
    def landing(self) -> DataFrame:
        """Structure rows with their atoms as arrays, as an ingest job leaves them."""
        per_atom = F.sort_array(F.collect_list(F.struct(
            "idx", "z", F.array("px", "py", "pz").alias("p"), F.array("fx", "fy", "fz").alias("f"), "charge", "tag")))
        arrays = self.atoms.groupBy("sid").agg(per_atom.alias("a"))
        stress = F.array("s0", "s1", "s2", "s3", "s4", "s5")
        return self.keyed_structures.join(arrays, "sid").join(self.cells, "sid").select(
            "sid", "entry_key", "database_name", "split_name", "source_file_name", "frame_idx",
            F.col("a.z").alias("numbers"), F.col("a.p").alias("positions"), F.col("a.f").alias("forces"),
            F.col("a.tag").alias("tags"), F.col("a.charge").alias("charges"), "cell",
            F.array(*[F.lit(False)] * 3).alias("pbc"), F.col("info_energy").alias("energy"), stress.alias("stress"),
            F.create_map(
                F.lit("sid"), F.col("sid").cast("string"), F.lit("charge"), F.col("info_charge").cast("string"),
                F.lit("data_id"), F.coalesce("subset", F.lit("none")),
                F.lit("frame_number"), F.col("frame_number")).alias("info"))

    @cached_property
    def landed(self) -> DataFrame:
        """The landing table as written, for what reads it more than once."""
        return cut_lineage(self.landing, "landing")
