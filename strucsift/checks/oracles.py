"""Independent SQL for every query, for an engine that holds the driver's tables as views."""

from __future__ import annotations

import re

from strucsift.checks.views import VIEWS

DEBYE = "0.20819433442462576"


def r(expression: str) -> str:
    """Round to 6 digits; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, 6) + 0.0)"


def seeded(seed: object, key: str) -> str:
    return f"md5(concat('{seed}|', cast({key} AS varchar)))"


def hex_long(digest: str, digits: int) -> str:
    return f"cast(('0x' || substr({digest}, 1, {digits})) AS bigint)"


# Selected keys shared by many statements.
SELECTED = "SELECT * FROM V_query_db WHERE energy < -1000 AND num_atoms >= 3"
SPLIT_PARTS = "split_part({0}, '/', {1})"

ORACLES: dict[str, str] = {}


def _frames() -> str:
    return f"""
SELECT a.sid, count(*) AS num_atoms, cast(sum(a.z) AS bigint) AS electrons, {r('max(s.info_energy)')} AS energy,
       coalesce(max(s.subset), 'none') AS data_id, {r('sum(a.px)')} AS sum_px, {r('sum(a.fy)')} AS sum_fy,
       cast(sum(CASE WHEN a.tag = 2 THEN 1 ELSE 0 END) AS bigint) AS n_adsorbate
FROM V_atoms a JOIN V_structures s ON a.sid = s.sid GROUP BY a.sid"""


KEYED = """SELECT *, concat(database_name, '_', split_name, '_', replace(source_file_name, '_', '$'), '_',
           cast(frame_idx AS varchar)) AS entry_key FROM V_structures"""

ORACLES["ingest_extxyz"] = _frames()
ORACLES["ingest_extxyz_xz"] = _frames()
ORACLES["ingest_landing"] = f"""
SELECT q.entry_key, q.num_atoms, {r('q.energy')} AS energy, {r('s.s1')} AS stress_yy,
       cast(s.info_charge AS varchar) AS charge
FROM V_query_db q JOIN V_structures s ON q.sid = s.sid"""
ORACLES["rehydrate_results"] = f"SELECT o_orderkey AS sid, {r('0.0 - o_totalprice / 100.0')} AS energy FROM orders"
ORACLES["scan_sidecar"] = f"""
SELECT concat(database_name, '-', split_name, '-', source_file_name, '-', cast(frame_idx // 1000 AS varchar)) AS shard,
       frame_idx % 1000 AS frame_idx, oc_sid, frame_number, {r('ref_energy')} AS ref_energy
FROM V_sidecar"""
ORACLES["scan_query_db"] = f"""
SELECT entry_key, database_name, num_atoms, {r('energy')} AS energy, cast(NULL AS varchar) AS smiles,
       cast(NULL AS boolean) AS is_protein FROM V_query_db"""
ORACLES["load_allowlist"] = "SELECT DISTINCT subset, net_charge FROM V_query_db"
ORACLES["source_registry"] = "SELECT database_name, split_name, files_path FROM V_sources_registry"
ORACLES["load_keys"] = f"SELECT entry_key FROM ({KEYED})"

ORACLES["append_check"] = "SELECT entry_key FROM V_query_db WHERE num_atoms >= 4 AND net_charge = 0"
ORACLES["append_dedup"] = f"""
SELECT entry_key, num_atoms, {r('energy')} AS energy FROM V_query_db WHERE num_atoms >= 4 AND net_charge <> 0"""
ORACLES["save_keys"] = f"SELECT entry_key FROM ({SELECTED})"
ORACLES["export_records"] = f"""
SELECT q.entry_key, q.num_atoms AS n_elements, a.electrons, {r('a.fx0')} AS fx0, cast(3 AS bigint) AS n_pbc,
       {r('q.energy')} AS energy, {r('s.s5')} AS stress_xy, {r('s.s3')} AS stress_zy,
       cast(s.info_charge AS varchar) AS charge, coalesce(s.subset, 'none') AS subset
FROM ({SELECTED}) q JOIN V_structures s ON q.sid = s.sid
JOIN (SELECT sid, cast(sum(z) AS bigint) AS electrons, max(CASE WHEN idx = 0 THEN fx END) AS fx0
      FROM V_atoms GROUP BY sid) a ON a.sid = q.sid"""


def _describe(source: str, columns: list[str], booleans: list[str], label: str | None = None) -> str:
    by = f"{label}, " if label else ""
    parts = []
    for c in columns:
        flag = c in booleans
        value = f"cast({c} AS int)" if flag else c
        quart = [
            "cast(NULL AS double)" if flag else r(f"max(CASE WHEN rn = round({q} * (n - 1)) THEN v END)")
            for q in ("0.25::double", "0.5::double", "0.75::double")
        ]
        over = f"PARTITION BY {label}" if label else ""
        parts.append(f"""
SELECT {by}'{c}' AS "column", count(v) AS "count", count(*) - count(v) AS null_count, {r('avg(v)')} AS mean,
       {'cast(NULL AS double)' if flag else r('stddev_samp(v)')} AS std, {r('min(v)')} AS "min",
       {quart[0]} AS p25, {quart[1]} AS p50, {quart[2]} AS p75, {r('max(v)')} AS "max"
FROM (SELECT {by}v, count(v) OVER ({over}) AS n,
             row_number() OVER ({over} ORDER BY v ASC NULLS LAST) - 1 AS rn
      FROM (SELECT {by}cast({value} AS double) AS v FROM ({source}))) {'GROUP BY ' + label if label else ''}""")
    return " UNION ALL ".join(parts)


STATISTICS = ["energy", "net_charge", "num_atoms", "max_force_norm", "has_h"]
ORACLES["make_statistics"] = _describe(SELECTED, STATISTICS, ["has_h"])
ORACLES["extract_text_column"] = f"SELECT subset FROM ({SELECTED}) WHERE subset IS NOT NULL"

_FILE_RANKS = f"""
SELECT q.entry_key, dense_rank() OVER (ORDER BY concat(s.database_name, '_', s.split_name, '_', s.source_file_name)) - 1 AS rk,
       concat(s.database_name, '_', s.split_name, '_', s.source_file_name) AS file_group
FROM ({SELECTED}) q JOIN V_structures s ON q.sid = s.sid"""


def _parts(n: int) -> str:
    return f"""
SELECT f.entry_key, max(p.part) AS part
FROM (SELECT *, (SELECT count(DISTINCT file_group) FROM ({_FILE_RANKS})) AS g FROM ({_FILE_RANKS})) f
JOIN (SELECT cast(unnest(range(0, {n})) AS int) AS part) p
  ON p.part < least({n}, f.g) AND (p.part * f.g) // least({n}, f.g) <= f.rk
GROUP BY f.entry_key"""


ORACLES["export_parts"] = f"""
SELECT entry_key, part, concat('train_part_', lpad(cast(part AS varchar), 3, '0')) AS part_name FROM ({_parts(7)})"""
ORACLES["export_resume"] = f"SELECT entry_key, part FROM ({_parts(7)}) WHERE part % 2 = 1"
ORACLES["merge_shards"] = f"SELECT entry_key, {r('energy')} AS energy, net_charge FROM V_query_db"

ORACLES["normalize_names"] = "SELECT sid, database_name, split_name FROM V_structures"
ORACLES["build_entry_key"] = f"SELECT sid, entry_key FROM ({KEYED})"
ORACLES["frame_index"] = "SELECT sid, source_file_name, frame_idx FROM V_structures"
ORACLES["parse_entry_key"] = f"""
SELECT entry_key, database_name, split_name, source_file_name, frame_idx FROM ({KEYED})"""
ORACLES["subset_from_name"] = """
SELECT sid, CASE WHEN len(t) > 1 THEN t[1] END AS database_name,
       CASE WHEN len(t) > 1 THEN array_to_string(t[2:], '-') END AS subset
FROM (SELECT sid, regexp_split_to_array(raw_database_name, '[^a-zA-Z0-9]+') AS t FROM V_structures)"""

ORACLES["map_fields"] = f"""
SELECT sid, info_charge AS net_charge, {r('info_energy')} AS energy, frame_number AS catalyst_frame FROM V_structures"""
ORACLES["attach_metadata"] = """
SELECT sid, subset, 'def2-TZVPD' AS basis_set, 'wB97M-V' AS functional, 'VV10' AS correction_term FROM V_structures"""
ORACLES["conform_schema"] = f"""
SELECT entry_key, database_name, split_name, subset, info_charge AS net_charge, {r('info_energy')} AS energy,
       cast(NULL AS bigint) AS num_atoms, cast(NULL AS varchar) AS smiles, cast(NULL AS boolean) AS is_protein
FROM ({KEYED})"""
ORACLES["enforce_charge_spin"] = """
SELECT s.sid, cast(CASE WHEN s.raw_database_name = 'OMOL25' THEN s.info_charge ELSE 0 END AS bigint) AS net_charge,
       cast(CASE s.raw_database_name WHEN 'OMOL25' THEN 1 + abs(s.info_charge)
            WHEN 'oc20_s2ef' THEN 1 + p.electrons % 2 END AS double) AS spin_multiplicity
FROM V_structures s LEFT JOIN (SELECT sid, sum(z) AS electrons FROM V_atoms GROUP BY sid) p ON s.sid = p.sid"""

# Tokens of the second path component; an out-of-range list index gives NULL.
_TOKENS = """
SELECT event_id, data_id, source, reference_source, string_split(source, '/') AS p,
       CASE WHEN len(string_split(source, '/')) > 1 THEN string_split(string_split(source, '/')[2], '_') END AS t
FROM V_source_strings"""
_NULL_FIELDS = {
    "subset": "cast(NULL AS varchar)", "reaction_id": "cast(NULL AS varchar)",
    "reaction_pathway_id": "cast(NULL AS bigint)", "reaction_step_idx": "cast(NULL AS bigint)",
    "is_reactant": "cast(NULL AS boolean)", "is_product": "cast(NULL AS boolean)",
}
_RGD_OK = "(len(t) >= 5 AND regexp_full_match(t[len(t) - 2], '[0-9]+'))"
_FAMILIES = {
    "parse_rgd": {
        "reaction_id": f"CASE WHEN {_RGD_OK} THEN array_to_string(t[1:len(t) - 4], '_') END",
        "reaction_pathway_id": f"CASE WHEN {_RGD_OK} THEN try_cast(t[len(t) - 3] AS bigint) END",
        "reaction_step_idx": f"CASE WHEN {_RGD_OK} THEN try_cast(t[len(t) - 2] AS bigint) END",
        "is_reactant": f"CASE WHEN {_RGD_OK} THEN try_cast(t[len(t) - 2] AS bigint) = 0 END",
        "is_product": f"CASE WHEN {_RGD_OK} THEN try_cast(t[len(t) - 2] AS bigint) = 18 END",
    },
    "parse_reactivity": {
        "subset": "CASE WHEN len(p) > 1 THEN p[1] END",
        "reaction_id": "CASE WHEN len(t) >= 3 AND p[1] IN ('pmechdb', 'rmechdb', 'ani1xbb') THEN t[2] ELSE '' END",
        "reaction_pathway_id": "cast(0 AS bigint)",
        "reaction_step_idx": """CASE WHEN len(t) >= 3 AND p[1] IN ('pmechdb', 'rmechdb') THEN try_cast(trim(t[3], 'step') AS bigint)
            WHEN len(t) >= 3 AND p[1] = 'ani1xbb' THEN try_cast(t[3] AS bigint) ELSE 0 END""",
        "is_reactant": "false", "is_product": "false",
    },
    "parse_ani": {"reaction_id": "t[2]", "reaction_step_idx": "try_cast(t[3] AS bigint)"},
    "parse_trans1x": {
        "reaction_id": "t[2]",
        "reaction_pathway_id": """CASE WHEN try_cast(t[4] AS bigint) < 10 THEN 0
            ELSE cast(floor((try_cast(t[4] AS bigint) - 2) / 8.0) AS bigint) END""",
        "reaction_step_idx": """CASE try_cast(t[4] AS bigint) WHEN 0 THEN 0 WHEN 9 THEN 10
            ELSE ((try_cast(t[4] AS bigint) - 2) % 8 + 8) % 8 + 1 END""",
        "is_reactant": "CASE WHEN try_cast(t[4] AS bigint) = 0 THEN true END",
        "is_product": "CASE WHEN try_cast(t[4] AS bigint) = 9 THEN true END",
    },
    "parse_metal_complexes": {
        "subset": """CASE WHEN reference_source IS NULL THEN
                CASE WHEN NOT contains(source, 'tm_react') THEN 'ground_state_metal_complexes'
                     WHEN regexp_matches(p[2], 'step[0-9]+(_|$)') THEN 'reactivity_metal_complexes' END
            WHEN contains(reference_source, 'step') AND regexp_matches(reference_source, 'incomplete|failed')
                THEN 'failed_metal_complexes' ELSE 'ground_state_metal_complexes' END""",
        "reaction_id": """CASE WHEN reference_source IS NULL AND contains(source, 'tm_react') AND regexp_matches(p[2], 'step[0-9]+(_|$)')
            THEN replace(regexp_extract(p[2], '^(.*?)step', 1), '_', '') END""",
        "reaction_step_idx": """CASE WHEN reference_source IS NULL AND contains(source, 'tm_react') AND regexp_matches(p[2], 'step[0-9]+(_|$)')
            THEN try_cast(regexp_extract(p[2], 'step([0-9]+)', 1) AS bigint) END""",
    },
}


def _family(name: str, source: str = _TOKENS, extra: dict[str, str] | None = None) -> str:
    fields = {**_NULL_FIELDS, **_FAMILIES.get(name, {}), **(extra or {})}
    listed = ", ".join(f"{e} AS {c}" for c, e in fields.items())
    return f"SELECT event_id, {listed} FROM ({source})"


for _name in _FAMILIES:
    ORACLES[_name] = _family(_name)
_DISPATCH = {
    "rgd": ("parse_rgd", {"subset": "data_id"}), "reactivity": ("parse_reactivity", {}),
    "ani1": ("parse_ani", {"subset": "data_id"}), "trans1x": ("parse_trans1x", {"subset": "data_id"}),
    "metal_complexes": ("parse_metal_complexes", {}),
}
ORACLES["parse_source_dispatch"] = " UNION ALL ".join(
    _family(name, f"SELECT * FROM ({_TOKENS}) WHERE data_id = '{data_id}'", extra)
    for data_id, (name, extra) in _DISPATCH.items())

_CLASS = """CASE class_code WHEN 0 THEN 'intermetallics' WHEN 1 THEN 'metalloids' WHEN 2 THEN 'non-metals'
    WHEN 3 THEN 'halides' END"""
_ANOMALY = """CASE anomaly_code WHEN 0 THEN 'no_anomaly' WHEN 1 THEN 'adsorbate_dissociation'
    WHEN 2 THEN 'adsorbate_desorption' WHEN 3 THEN 'surface_reconstruction' WHEN 4 THEN 'uninteracting_hydrogen' END"""
ORACLES["decode_labels"] = f"SELECT sid, {_CLASS} AS catalyst_class, {_ANOMALY} AS catalyst_anomaly FROM V_structures"
ORACLES["catalyst_fields"] = f"""
SELECT sid, cast(custkey AS varchar) AS catalyst_bulk_id, cast(custkey % 80 AS varchar) AS catalyst_adsorbate_id,
       subset AS catalyst_bulk_symbols, cast(NULL AS varchar) AS catalyst_adsorbate_symbols,
       {r('coalesce(calc_energy, 0.0)')} AS catalyst_reference_energy,
       {_CLASS} AS catalyst_class, {_ANOMALY} AS catalyst_anomaly, '1,1,0' AS catalyst_miller_index,
       cast(sid % 300 AS bigint) AS catalyst_relaxation_frame_idx FROM V_structures"""
ORACLES["graph_candidate"] = """
SELECT entry_key, num_atoms <= 5 AND coalesce(subset NOT IN ('biomolecules', 'elytes'), true) AS graph_properties_candidate
FROM V_query_db"""
ORACLES["derivation_error"] = """
SELECT sid, subset IS NULL OR calc_energy IS NULL AS error_graph_properties FROM V_structures"""
_VOIGT = [["s0", "s5", "s4"], ["s5", "s1", "s3"], ["s4", "s3", "s2"]]
ORACLES["voigt_to_full"] = "SELECT sid, " + ", ".join(
    f"{r(_VOIGT[i][j])} AS t{i}{j}" for i in range(3) for j in range(3)) + " FROM V_structures"

ORACLES["net_force_norm"] = f"""
SELECT sid, {r('sqrt(sum(fx) ** 2 + sum(fy) ** 2 + sum(fz) ** 2)')} AS net_force_norm FROM V_atoms GROUP BY sid"""
ORACLES["max_force_norm"] = f"""
SELECT sid, {r('max(sqrt(fx * fx + fy * fy + fz * fz))')} AS max_force_norm FROM V_atoms GROUP BY sid"""
_DIPOLE = " + ".join(
    f"(sum(charge * p{a}) - sum(charge) * (sum(e.mass * p{a}) / sum(e.mass))) ** 2" for a in "xyz")
ORACLES["dipole_moment"] = f"""
SELECT v.sid, {r(f'sqrt({_DIPOLE}) / {DEBYE}')} AS dipole_moment_magnitude
FROM V_atoms v JOIN V_elements e ON v.z = e.z GROUP BY v.sid"""
ORACLES["molecular_weight"] = f"""
SELECT v.sid, {r('sum(e.mass)')} AS molecular_weight FROM V_atoms v JOIN V_elements e ON v.z = e.z GROUP BY v.sid"""
ORACLES["atomic_symbols"] = """
SELECT sid, string_agg(symbol, '' ORDER BY symbol) AS atomic_symbols
FROM (SELECT DISTINCT v.sid, e.symbol FROM V_atoms v JOIN V_elements e ON v.z = e.z) GROUP BY sid"""
_COMPOSITION = """
SELECT sid, string_agg(concat(symbol, CASE WHEN n > 1 THEN cast(n AS varchar) ELSE '' END), ''
       ORDER BY CASE WHEN carbon AND symbol = 'C' THEN 0 WHEN carbon AND symbol = 'H' THEN 1 ELSE 2 END, symbol) AS composition
FROM (SELECT *, bool_or(symbol = 'C') OVER (PARTITION BY sid) AS carbon
      FROM (SELECT v.sid, e.symbol, count(*) AS n FROM V_atoms v JOIN V_elements e ON v.z = e.z GROUP BY v.sid, e.symbol))
GROUP BY sid"""
ORACLES["composition"] = _COMPOSITION
ORACLES["atom_counts"] = """
SELECT sid, count(*) AS num_atoms, string_agg(cast(z AS varchar), ',' ORDER BY idx) AS atomic_numbers FROM V_atoms GROUP BY sid"""
ORACLES["parity_spin"] = "SELECT sid, cast(1 + sum(z) % 2 AS bigint) AS spin_multiplicity FROM V_atoms GROUP BY sid"
ORACLES["tag_slice"] = """
SELECT sid, count(*) FILTER (tag = 2) AS n_adsorbate, count(*) FILTER (tag IN (0, 1)) AS n_slab,
       count(*) FILTER (tag = 1) AS n_surface FROM V_atoms GROUP BY sid"""
ORACLES["lowest_state"] = """
SELECT a.sid, coalesce(b.net_charge, 0)::bigint AS net_charge, coalesce(b.spin_multiplicity, a.parity)::bigint AS spin_multiplicity
FROM (SELECT sid, 1 + sum(z) % 2 AS parity FROM V_atoms GROUP BY sid) a
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY
             round(net_charge * net_charge + 0.3::double * net_charge + (spin_multiplicity - 1), 9), net_charge) AS rn FROM V_states) WHERE rn = 1) b
ON a.sid = b.sid"""
_NORMAL = {
    "x": "(0.0 - az * bvy) / sqrt((az * bvy) ** 2 + (ax * bvy) ** 2)", "y": "0.0",
    "z": "(ax * bvy) / sqrt((az * bvy) ** 2 + (ax * bvy) ** 2)",
}
ORACLES["surface_normal"] = f"""
SELECT sid, {r(_NORMAL['x'])} AS nx, {r('0.0::double')} AS ny, {r(_NORMAL['z'])} AS nz FROM V_structures"""
_HEIGHTS = f"""
SELECT a.sid, a.z, a.tag, a.px, a.py, e.mass, e.vdw_radius, s.ax, s.az, s.bvy,
       a.px * ({_NORMAL['x']}) + a.pz * ({_NORMAL['z']}) AS h,
       a.px / s.ax AS u, a.py / s.bvy AS v
FROM V_atoms a JOIN V_structures s ON a.sid = s.sid JOIN V_elements e ON a.z = e.z"""
ORACLES["substrate_height"] = f"""
SELECT sid, {r('''coalesce(sum(mass * h) FILTER (tag = 2) / sum(mass) FILTER (tag = 2) - avg(h) FILTER (tag = 1), 0.0)''')}
       AS catalyst_substrate_height FROM ({_HEIGHTS}) GROUP BY sid"""
ORACLES["adsorbate_valid"] = f"""
SELECT sid, CASE WHEN count(*) FILTER (tag = 2) > 0 AND count(*) FILTER (tag < 2) > 0 THEN
         round(min(h) FILTER (tag = 2), 9) > round(max(h) FILTER (tag < 2)
               - (max(vdw_radius) FILTER (tag < 2) + max(vdw_radius) FILTER (tag = 2)), 9)
     AND round(min(un) FILTER (tag = 2), 9) >= round(min(uw) FILTER (tag < 2) - max(vdw_radius) FILTER (tag = 2) / max(la), 9)
     AND round(max(un) FILTER (tag = 2), 9) <= round(max(uw) FILTER (tag < 2) + max(vdw_radius) FILTER (tag = 2) / max(la), 9)
     AND round(min(vn) FILTER (tag = 2), 9) >= round(min(vw) FILTER (tag < 2) - max(vdw_radius) FILTER (tag = 2) / max(bvy), 9)
     AND round(max(vn) FILTER (tag = 2), 9) <= round(max(vw) FILTER (tag < 2) + max(vdw_radius) FILTER (tag = 2) / max(bvy), 9)
     END AS catalyst_xyz_adsorbate_is_valid
FROM (SELECT *, sqrt(ax * ax + az * az) AS la, u - floor(u) AS uw, v - floor(v) AS vw,
             u - round_even(u - avg(u - floor(u)) FILTER (tag < 2) OVER (PARTITION BY sid), 0) AS un,
             v - round_even(v - avg(v - floor(v)) FILTER (tag < 2) OVER (PARTITION BY sid), 0) AS vn
      FROM ({_HEIGHTS})) GROUP BY sid"""
ORACLES["max_vdw_radius"] = f"""
SELECT v.sid, {r('max(coalesce(e.vdw_radius, 1.7))')} AS max_vdw_radius
FROM V_atoms v LEFT JOIN V_elements e ON v.z = e.z GROUP BY v.sid"""

ORACLES["neighbour_list"] = f"SELECT sid, i, j, zi, zj, {r('dist')} AS dist FROM V_bonds"
ORACLES["neighbour_list_periodic"] = f"""
SELECT sid, i, j, {r('min(dist)')} AS dist
FROM (SELECT a.sid, a.idx AS i, b.idx AS j, round(sqrt((4.9 * (a.px - b.px) - m.i * s.ax) ** 2
               + (6.5 * (a.py - b.py) - n.i * s.bvy) ** 2
               + (24.0 * (a.pz - b.pz) - m.i * s.az - o.i * s.cz) ** 2), 9) AS dist,
             round(1.2 * (ea.cov_radius + eb.cov_radius), 9) AS cutoff
      FROM V_atoms a JOIN V_atoms b ON a.sid = b.sid AND a.idx < b.idx
      JOIN V_structures s ON s.sid = a.sid
      JOIN V_elements ea ON a.z = ea.z JOIN V_elements eb ON b.z = eb.z,
      (SELECT unnest([-1, 0, 1]) AS i) m, (SELECT unnest([-1, 0, 1]) AS i) n, (SELECT unnest([-1, 0, 1]) AS i) o)
WHERE dist < cutoff GROUP BY sid, i, j"""
_IMAGES = """
SELECT a.sid, a.idx AS i, a.z AS zi, b.idx AS j, b.z AS zj, round(sqrt(
         (4.9 * (a.px - b.px) - m.i * s.ax - 0.01 * n.i - 0.01 * o.i) ** 2
         + (6.5 * (a.py - b.py) - 0.01 * m.i - n.i * s.bvy - 0.01 * o.i) ** 2
         + (24.0 * (a.pz - b.pz) - m.i * (s.az + 0.02) - 0.01 * n.i - o.i * s.cz) ** 2), 9) AS dist
FROM V_atoms a JOIN V_atoms b ON a.sid = b.sid JOIN V_structures s ON s.sid = a.sid,
  (SELECT unnest([-2, -1, 0, 1, 2]) AS i) m, (SELECT unnest([-2, -1, 0, 1, 2]) AS i) n, (SELECT unnest([-2, -1, 0, 1, 2]) AS i) o
WHERE a.idx <> b.idx OR m.i <> 0 OR n.i <> 0 OR o.i <> 0"""
ORACLES["structure_valid_periodic"] = f"""
SELECT sid, count(*) >= 2 AND min(others) >= 1 AND bool_and(z <> 1 OR degree = 1) AS is_molecular_structure_valid
FROM (SELECT a.sid, a.idx, a.z, count(DISTINCT p.j) AS degree, count(DISTINCT p.j) FILTER (p.j <> a.idx) AS others
      FROM V_atoms a LEFT JOIN (
        SELECT p.* FROM ({_IMAGES}) p JOIN V_elements ei ON p.zi = ei.z JOIN V_elements ej ON p.zj = ej.z
        WHERE p.dist < round(1.2 * (ei.cov_radius + ej.cov_radius), 9)) p ON a.sid = p.sid AND a.idx = p.i
      GROUP BY a.sid, a.idx, a.z) GROUP BY sid"""
ORACLES["water_count_periodic"] = f"""
SELECT a.sid, count(*) FILTER (h = 2) AS num_water_molecules FROM (
  SELECT a.sid, a.idx, count(p.j) AS h FROM V_atoms a
  LEFT JOIN (SELECT * FROM ({_IMAGES}) WHERE zi = 8 AND zj = 1 AND dist < 1.2) p ON a.sid = p.sid AND a.idx = p.i
  GROUP BY a.sid, a.idx) a GROUP BY a.sid"""
_ENDS = "SELECT sid, i AS u, j AS v FROM V_bonds UNION ALL SELECT sid, j AS u, i AS v FROM V_bonds"
_DEGREES = f"""
SELECT a.sid, a.idx, a.z, a.tag, count(e.v) AS degree
FROM V_atoms a LEFT JOIN ({_ENDS}) e ON a.sid = e.sid AND a.idx = e.u GROUP BY a.sid, a.idx, a.z, a.tag"""
ORACLES["structure_valid"] = f"""
SELECT sid, count(*) >= 2 AND min(degree) >= 1 AND bool_and(z <> 1 OR degree = 1) AS is_molecular_structure_valid
FROM ({_DEGREES}) GROUP BY sid"""
ORACLES["fragments"] = f"""
WITH RECURSIVE reach(sid, idx, other) AS (
  SELECT sid, idx, idx FROM V_atoms
  UNION
  SELECT reach.sid, reach.idx, e.v FROM reach JOIN ({_ENDS}) e ON reach.sid = e.sid AND reach.other = e.u)
SELECT sid, root, count(*) AS n_atoms
FROM (SELECT sid, idx, min(other) AS root FROM reach GROUP BY sid, idx) GROUP BY sid, root"""
_WATER = """
SELECT a.sid, count(*) FILTER (h = 2) AS num_water_molecules FROM (
  SELECT a.sid, a.idx, count(b.idx) AS h
  FROM V_atoms a LEFT JOIN V_atoms b ON a.z = 8 AND b.z = 1 AND a.sid = b.sid
   AND round(sqrt((a.px - b.px) ** 2 + (a.py - b.py) ** 2 + (a.pz - b.pz) ** 2), 9) < 1.2
  GROUP BY a.sid, a.idx) a GROUP BY a.sid"""
ORACLES["water_count"] = _WATER
ORACLES["n_hop_walks"] = f"""
SELECT e.sid, e.u AS start, f.v AS at, concat(e.u, '-', e.v, '-', f.v) AS path
FROM ({_ENDS}) e JOIN ({_ENDS}) f ON e.sid = f.sid AND e.v = f.u"""
ORACLES["valence_diff"] = f"""
SELECT d.sid, d.idx, d.degree, cast(CASE WHEN e.valence < 0 THEN 0 ELSE d.degree - e.valence END AS bigint) AS valence_diff,
       CASE WHEN e.valence < 0 THEN 0 ELSE d.degree - e.valence END = 0 AS has_expected_valence
FROM ({_DEGREES}) d JOIN V_elements e ON d.z = e.z"""
_NEARBY = """
SELECT DISTINCT a.sid, a.idx FROM V_bonds x
JOIN V_atoms a ON x.sid = a.sid AND a.idx IN (x.i, x.j) AND a.tag = 1
JOIN V_atoms b ON x.sid = b.sid AND b.idx IN (x.i, x.j) AND b.idx <> a.idx AND b.tag = 2"""
ORACLES["nearby_surface"] = _NEARBY
ORACLES["adsorbate_structure_valid"] = f"""
WITH kept AS (SELECT a.sid, a.idx, a.z FROM V_atoms a LEFT JOIN ({_NEARBY}) n ON a.sid = n.sid AND a.idx = n.idx
              WHERE a.tag = 2 OR n.idx IS NOT NULL)
SELECT sid, count(*) >= 2 AND min(degree) >= 1 AND bool_and(z <> 1 OR degree = 1) AS adsorbate_structure_valid
FROM (SELECT k.sid, k.idx, k.z, count(o.idx) AS degree
      FROM kept k LEFT JOIN ({_ENDS}) e ON k.sid = e.sid AND k.idx = e.u
      LEFT JOIN kept o ON o.sid = e.sid AND o.idx = e.v GROUP BY k.sid, k.idx, k.z) GROUP BY sid"""

_ID0 = hex_long("md5(concat_ws('|', 'atom', z, degree))", 8)


def _round(prev: str, k: int) -> str:
    digest = f"md5(concat_ws('|', {k}, p.id, coalesce(n.total, 0), coalesce(n.met, 0)))"
    return f"""
SELECT p.sid, p.idx, {hex_long(digest, 8)} AS id
FROM {prev} p LEFT JOIN (SELECT e.sid, e.u, cast(sum(q.id) AS bigint) AS total, count(*) AS met
                         FROM ends e JOIN {prev} q ON e.sid = q.sid AND e.v = q.idx GROUP BY e.sid, e.u) n
ON p.sid = n.sid AND p.idx = n.u"""


ORACLES["circular_fingerprint"] = f"""
WITH ends AS ({_ENDS}), r0 AS (SELECT sid, idx, {_ID0} AS id FROM ({_DEGREES})),
     r1 AS ({_round('r0', 1)}), r2 AS ({_round('r1', 2)}),
     bits AS (SELECT DISTINCT sid, id % 1024 AS bit FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2))
SELECT sid, count(*) AS n_bits, string_agg(cast(bit AS varchar), ',' ORDER BY bit) AS set_bits FROM bits GROUP BY sid"""
ORACLES["fingerprint_rowwise"] = ORACLES["circular_fingerprint"]
ORACLES["pack_fingerprint"] = "SELECT entry_key, array_to_string(bits, '') AS bits FROM V_fp"


def _distance(a: str, b: str) -> str:
    common = f"list_inner_product({a}.bits::double[], {b}.bits::double[])"
    return f"1.0 - {common} / (list_sum({a}.bits) + list_sum({b}.bits) - {common} + 1e-8)"


ORACLES["min_tanimoto"] = f"""
SELECT c.entry_key, {r('min(' + _distance('c', 'p') + ')')} AS distance FROM V_fp c, (SELECT * FROM V_fp WHERE label = 0) p
GROUP BY c.entry_key"""
_POSITIONED = """
SELECT entry_key, bits, vec_id, row_number() OVER (ORDER BY md5(entry_key), entry_key) - 1 AS pos FROM V_fp"""
ORACLES["greedy_diverse"] = f"""
WITH RECURSIVE placed AS MATERIALIZED (SELECT entry_key, pos, pos // 200 AS block, bits FROM ({_POSITIONED})),
clash AS MATERIALIZED (
  SELECT a.pos AS member, b.pos AS row FROM placed a JOIN placed b ON a.block < b.block OR a.pos = 0
  WHERE {_distance('a', 'b')} <= 0.65),
grown(block, pool) AS (
  SELECT cast(-1 AS bigint), [cast(0 AS bigint)]
  UNION ALL
  SELECT g.block + 1, list_concat(g.pool, coalesce(
    (SELECT list(p.pos) FROM placed p WHERE p.block = g.block + 1 AND p.pos <> 0
      AND NOT EXISTS (SELECT 1 FROM clash c WHERE c.row = p.pos AND list_contains(g.pool, c.member))), []))
  FROM grown g WHERE g.block < (SELECT max(block) FROM placed))
SELECT entry_key FROM placed WHERE pos IN (
  SELECT unnest(pool) FROM grown WHERE block = (SELECT max(block) FROM placed))"""
ORACLES["pick_row"] = f"SELECT entry_key, vec_id FROM ({_POSITIONED}) WHERE pos = 42"
ORACLES["motif_counts"] = """
SELECT id, count(*) FILTER (code = 'A') AS num_a, count(*) FILTER (code = 'N') AS num_n,
       count(*) FILTER (code = 'R') AS num_r, count(*) > 3 AS is_protein
FROM V_matches m WHERE NOT EXISTS (
  SELECT 1 FROM V_matches o WHERE o.id = m.id AND o.code = m.code AND m.s >= o.s AND m.e <= o.e AND (m.s > o.s OR m.e < o.e))
GROUP BY id"""


def _keys_where(predicate: str) -> str:
    return f"SELECT entry_key FROM V_query_db WHERE {predicate}"


ORACLES["filter_range"] = _keys_where("net_force_norm > 1.5 AND max_force_norm < 15 AND num_atoms < 6")
ORACLES["filter_in"] = _keys_where("subset = 'spice' OR subset = 'rgd' OR subset = 'biomolecules'")
ORACLES["filter_between"] = _keys_where("energy >= -2500.5 AND energy <= -500 AND net_charge IN (-1, 0)")
ORACLES["filter_regex"] = _keys_where("atomic_symbols IN ('C', 'H', 'CH') AND entry_key NOT LIKE '%val-id%'")
ORACLES["filter_bool"] = _keys_where("contains(atomic_symbols, 'H') AND net_charge <> 0")
ORACLES["filter_combined"] = _keys_where(
    "num_atoms > 3 AND has_h AND (subset = 'spice' OR subset = 'elytes') AND contains(atomic_symbols, 'O')")
ORACLES["supported_columns"] = """
SELECT 'energy' AS "column", count(energy) AS n FROM V_query_db UNION ALL
SELECT 'num_atoms', count(num_atoms) FROM V_query_db UNION ALL SELECT 'has_h', count(has_h) FROM V_query_db"""
ORACLES["fetch_by_keys"] = f"SELECT {r('energy')} AS energy, num_atoms, entry_key FROM ({SELECTED})"
ORACLES["restrict_single"] = "SELECT entry_key, subset FROM V_query_db WHERE subset IN ('spice', 'rgd')"
ORACLES["restrict_composite"] = """
SELECT q.entry_key FROM V_query_db q WHERE EXISTS (
  SELECT 1 FROM V_query_db o WHERE o.num_atoms > 7 AND o.subset = q.subset AND o.net_charge = q.net_charge
     AND o.atomic_symbols = q.atomic_symbols)"""
ORACLES["lookup_records"] = f"""
SELECT q.entry_key, s.sid, s.source_file_name, s.frame_idx FROM ({SELECTED}) q JOIN V_structures s ON q.sid = s.sid"""
ORACLES["attach_extras"] = f"""
SELECT k.entry_key, q.num_atoms, {r('q.molecular_weight')} AS molecular_weight, q.entry_key IS NOT NULL AS has_extras
FROM ({KEYED}) k LEFT JOIN ({SELECTED}) q ON k.entry_key = q.entry_key"""
ORACLES["retrieve_field"] = f"SELECT q.entry_key, s.frame_number FROM ({SELECTED}) q JOIN V_structures s ON q.sid = s.sid"
ORACLES["unregistered_keys"] = f"""
SELECT entry_key, database_name, split_name FROM ({KEYED}) k WHERE NOT EXISTS (
  SELECT 1 FROM V_sources_registry g WHERE g.database_name = k.database_name AND g.split_name = k.split_name)"""
ORACLES["sidecar_mapping"] = f"""
SELECT s.database_name, s.split_name, s.source_file_name, s.frame_idx, s.oc_sid, m.bulk_id, m.ads_id, m.bulk_symbols,
       {r('s.ref_energy')} AS ref_energy, m.oc_sid IS NOT NULL AS known
FROM V_sidecar s LEFT JOIN V_sid_mapping m ON s.oc_sid = m.oc_sid"""
ORACLES["attach_sidecar"] = f"""
SELECT s.sid, s.frame_number, {r("CASE WHEN raw_database_name = 'oc20_s2ef' THEN info_energy / 2.0 ELSE 0.0 END")} AS ref_energy,
       CASE WHEN raw_database_name = 'oc20_s2ef' THEN concat('random', cast(custkey AS varchar)) END AS oc_sid FROM V_structures s"""

ORACLES["attach_sidecar_strict"] = f"""
SELECT t.sid, {r('s.ref_energy')} AS ref_energy, s.oc_sid FROM V_structures t LEFT JOIN V_sidecar s
ON t.database_name = s.database_name AND t.split_name = s.split_name AND t.source_file_name = s.source_file_name AND t.frame_idx = s.frame_idx
WHERE t.database_name = 'oc20-s2ef' AND t.source_file_name IN (SELECT source_file_name FROM V_sidecar)"""
ORACLES["describe_stats"] = _describe("SELECT * FROM V_query_db", STATISTICS, ["has_h"])


def _histogram(source: str, column: str, bins: int, label: str | None = None) -> str:
    by = f"{label}, " if label else ""
    v = f"(SELECT {by}cast({column} AS double) AS v FROM ({source}) WHERE {column} IS NOT NULL)"
    bounds = f"""(SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                         CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM {v})"""
    counts = f"""(SELECT {by}cast(least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS int) AS bin, count(*) AS n
                  FROM {v}, {bounds} GROUP BY ALL)"""
    labels = f", (SELECT DISTINCT {label} FROM {v}) l" if label else ""
    match = f" AND l.{label} = c.{label}" if label else ""
    pick = f"l.{label}, " if label else ""
    return f"""
SELECT {pick}'{column}' AS "column", g.bin, {r(f'lo + g.bin * ((hi - lo) / {bins})')} AS bin_start, coalesce(c.n, 0) AS n
FROM (SELECT cast(unnest(range(0, {bins})) AS int) AS bin) g{labels} CROSS JOIN {bounds} b
LEFT JOIN {counts} c ON g.bin = c.bin{match}"""


ORACLES["histogram_100"] = " UNION ALL ".join(
    _histogram("SELECT * FROM V_query_db", c, 100) for c in ("energy", "num_atoms")
) + " UNION ALL " + _histogram("SELECT cast(has_h AS int) AS has_h FROM V_query_db", "has_h", 100)
ORACLES["kde_curve"] = f"""
WITH f AS (SELECT min(energy) AS lo, max(energy) AS hi, count(*) AS n,
                  stddev_samp(energy) * (count(*)::double ** (-0.2)) AS h FROM V_query_db)
SELECT cast(g.point AS int) AS point, {r('max(lo + g.point * ((hi - lo) / 499))')} AS x,
       {r('sum(exp(0.0 - ((lo + g.point * ((hi - lo) / 499) - q.energy) / h) ** 2 / 2)) / max(n * h * sqrt(2 * pi()))')} AS density
FROM (SELECT unnest(range(0, 500)) AS point) g, f, V_query_db q GROUP BY g.point"""
_COMPARED = f"""
SELECT 'baseline' AS selection, * FROM (SELECT * FROM V_query_db ORDER BY {seeded(7, 'entry_key')}, entry_key LIMIT 300)
UNION ALL SELECT 'light', * FROM V_query_db WHERE max_force_norm < 4 AND regexp_matches(atomic_symbols, '^[HO]+$')"""
ORACLES["compare_selections"] = _describe(_COMPARED, ["num_atoms", "molecular_weight"], [], "selection")
ORACLES["compare_histograms"] = _histogram(_COMPARED, "molecular_weight", 20, "selection")
ORACLES["identity_coverage"] = """
SELECT reaction_pathway_id, count(*) AS n_rows, count(DISTINCT reaction_id) AS n_identities FROM V_pathways
GROUP BY reaction_pathway_id"""

_LABELLED = """
SELECT *, energy = max(energy) OVER (PARTITION BY reaction_id, reaction_pathway_id) AS is_ts,
       reaction_step_idx = 0 AS is_reactant, reaction_step_idx = last_step_idx AS is_product FROM V_pathways"""
ORACLES["class_shares"] = " UNION ALL ".join(
    f"SELECT '{f}' AS flag, {r(f'avg(CASE WHEN {f} THEN 1.0 ELSE 0.0 END)')} AS share, count(*) AS n_rows FROM ({_LABELLED})"
    for f in ("is_ts", "is_reactant", "is_product"))
_ENDPOINTS = f"""
SELECT DISTINCT reaction_id, reaction_pathway_id FROM ({_LABELLED}) WHERE is_ts AND (is_reactant OR is_product)"""
_KEPT = f"""
SELECT p.* FROM V_pathways p WHERE NOT EXISTS (SELECT 1 FROM ({_ENDPOINTS}) e
  WHERE e.reaction_id = p.reaction_id AND e.reaction_pathway_id = p.reaction_pathway_id)"""


def _single(source: str) -> str:
    over = "OVER (PARTITION BY reaction_id, reaction_pathway_id ORDER BY reaction_step_idx)"
    return f"""
SELECT reaction_id, reaction_pathway_id FROM (
  SELECT *, lag(energy) {over} AS before, lead(energy) {over} AS after FROM ({source}))
GROUP BY reaction_id, reaction_pathway_id HAVING count(*) FILTER (energy > before AND energy > after) = 1"""


ORACLES["removed_share"] = f"""
SELECT n_before, n_after, {r('(n_before - n_after) / n_before::double')} AS removed_share FROM
  (SELECT count(*) AS n_before FROM (SELECT DISTINCT reaction_id, reaction_pathway_id FROM V_pathways)),
  (SELECT count(*) AS n_after FROM ({_single(_KEPT)}))"""
ORACLES["keys_by_file"] = f"SELECT file_group, entry_key FROM ({_FILE_RANKS})"
ORACLES["label_ts"] = f"SELECT entry_key, energy > 50000 AND is_ts AS is_ts FROM ({_LABELLED})"
ORACLES["endpoint_pathways"] = _ENDPOINTS
ORACLES["drop_endpoint_pathways"] = f"SELECT entry_key, reaction_id, reaction_pathway_id FROM ({_KEPT})"
ORACLES["single_peak_pathways"] = _single("SELECT * FROM V_pathways")

ORACLES["sample_random"] = f"SELECT entry_key FROM V_query_db ORDER BY {seeded(42, 'entry_key')}, entry_key LIMIT 500"
ORACLES["sample_random_large"] = f"""
SELECT entry_key FROM (SELECT entry_key, row_number() OVER (ORDER BY {hex_long(seeded(42, 'entry_key'), 13)}, entry_key) AS rn,
                              count(*) OVER () AS n FROM V_query_db) WHERE rn <= n // 3"""
ORACLES["sample_all"] = "SELECT entry_key FROM V_query_db WHERE num_atoms > 2"
ORACLES["sample_custom"] = """
SELECT entry_key FROM V_query_db WHERE num_atoms > 2 AND molecular_weight >= 20.0
ORDER BY molecular_weight DESC, entry_key LIMIT 100"""
ORACLES["sample_weighted"] = f"""
WITH c AS (SELECT entry_key, CASE WHEN is_ts THEN 'is_ts' WHEN is_product THEN 'is_product' WHEN is_reactant THEN 'is_reactant' END AS class
           FROM ({_LABELLED})),
w AS (SELECT entry_key, class, CASE class WHEN 'is_ts' THEN 0.2::double ELSE 0.4::double END / count(*) OVER (PARTITION BY class) AS weight
      FROM c WHERE class IS NOT NULL)
SELECT entry_key, class FROM w
ORDER BY round(ln(-ln(({hex_long(seeded(11, 'entry_key'), 13)} + 1) / 4503599627370497.0::double)) - ln(weight), 12), entry_key LIMIT 400"""
_SPLIT = f"""
SELECT p.*, CASE WHEN i.rn <= floor(0.9::double * i.n) THEN 'train' ELSE 'validation' END AS split
FROM V_pathways p JOIN (
  SELECT reaction_id, row_number() OVER (ORDER BY {seeded(42, 'reaction_id')}) AS rn, count(*) OVER () AS n
  FROM (SELECT DISTINCT reaction_id FROM V_pathways)) i ON p.reaction_id = i.reaction_id"""
ORACLES["leakfree_split"] = f"SELECT entry_key, reaction_id, split FROM ({_SPLIT})"
ORACLES["leakfree_split_counts"] = f"""
SELECT split, count(*) AS n_rows, count(DISTINCT reaction_id) AS n_identities FROM ({_SPLIT}) GROUP BY split"""
ORACLES["sample_per_split"] = f"""
SELECT entry_key, split FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {seeded(42, 'entry_key')}, entry_key) AS k
  FROM ({_SPLIT})) WHERE k <= CASE split WHEN 'train' THEN 200 ELSE 20 END"""

ORACLES["union_sources"] = f"""
SELECT entry_key, CASE WHEN database_name <> 'oc20-s2ef' THEN subset END AS subset,
       CASE WHEN database_name <> 'omol25' THEN frame_number END AS frame_number FROM ({KEYED})"""
ORACLES["dedup_keys"] = f"SELECT DISTINCT entry_key FROM ({SELECTED})"

ORACLES["process_end_to_end"] = f"""
SELECT k.entry_key, 'PBE' AS functional, k.subset, k.info_charge AS net_charge, {r('k.info_energy')} AS energy,
       coalesce(q.num_atoms, 0) AS num_atoms, c.composition,
       q.atomic_symbols, {r('q.net_force_norm')} AS net_force_norm, {r('q.max_force_norm')} AS max_force_norm,
       d.dipole_moment_magnitude, {r('q.molecular_weight')} AS molecular_weight,
       coalesce(v.is_molecular_structure_valid, false) AS is_molecular_structure_valid,
       coalesce(w.num_water_molecules, 0) AS num_water_molecules, false AS graph_properties_candidate
FROM ({KEYED}) k LEFT JOIN V_query_db q ON k.sid = q.sid
LEFT JOIN ({_COMPOSITION}) c ON k.sid = c.sid LEFT JOIN ({ORACLES['dipole_moment']}) d ON k.sid = d.sid
LEFT JOIN ({ORACLES['structure_valid']}) v ON k.sid = v.sid LEFT JOIN ({_WATER}) w ON k.sid = w.sid"""
ORACLES["process_landed"] = ORACLES["process_end_to_end"] + " WHERE q.sid IS NOT NULL"


def _ingested(file: str, key: str, columns: str) -> str:
    """Structures with atoms numbered in ``file``, their key, and what is derived of them."""
    return f"""
WITH placed AS (
  SELECT s.*, cast(row_number() OVER (PARTITION BY {file} ORDER BY s.sid) - 1 AS bigint) AS place
  FROM V_structures s WHERE s.sid IN (SELECT sid FROM V_query_db))
SELECT concat({key}, '_', cast(k.place AS varchar)) AS entry_key, {columns}
FROM placed k JOIN V_query_db q ON k.sid = q.sid JOIN ({_COMPOSITION}) c ON k.sid = c.sid
JOIN ({ORACLES['dipole_moment']}) d ON k.sid = d.sid JOIN ({ORACLES['structure_valid']}) v ON k.sid = v.sid
JOIN ({_WATER}) w ON k.sid = w.sid JOIN ({ORACLES['parity_spin']}) p ON k.sid = p.sid
JOIN ({ORACLES['tag_slice']}) t ON k.sid = t.sid"""


_DERIVED = f"""{r('k.info_energy')} AS energy, q.num_atoms, q.atomic_symbols,
       {r('q.net_force_norm')} AS net_force_norm, {r('q.max_force_norm')} AS max_force_norm, d.dipole_moment_magnitude,
       {r('q.molecular_weight')} AS molecular_weight, v.is_molecular_structure_valid, w.num_water_molecules"""
ORACLES["process_xyz"] = _ingested("s.source_file_name", "'fixture-db_full_' || replace(k.source_file_name, '_', '$')", f"""
       'fixture-db' AS database_name, 'full' AS split_name, 'PBE' AS functional, coalesce(k.subset, 'none') AS subset,
       k.info_charge AS net_charge, cast(1 AS double) AS spin_multiplicity, c.composition, 'extxyz' AS file_extension, {_DERIVED}""")
ORACLES["process_omat"] = _ingested("s.source_file_name", "'omat24-rattled-1000_train_' || replace(k.source_file_name, '_', '$')", f"""
       'omat24' AS database_name, 'train' AS split_name, 'PBE' AS functional, 'rattled-1000' AS subset, cast(0 AS bigint) AS net_charge,
       cast(NULL AS double) AS spin_multiplicity, 'X' AS composition, 'parquet' AS file_extension, {_DERIVED}""")
ORACLES["process_oc_xz"] = _ingested("s.sid // 4096", "'oc20-fixture_s2ef_shard-' || cast(k.sid // 4096 AS varchar)", """
       'oc20-fixture' AS database_name, 's2ef' AS split_name, 'RPBE' AS functional, cast(0 AS bigint) AS net_charge,
       cast(p.spin_multiplicity AS double) AS spin_multiplicity, q.num_atoms, c.composition, cast(k.info_charge AS varchar) AS catalyst_bulk_id,
       CASE q.num_atoms % 5 WHEN 0 THEN 'intermetallics' WHEN 1 THEN 'metalloids' WHEN 2 THEN 'non-metals' WHEN 3 THEN 'halides' END
         AS catalyst_class,
       CASE q.num_atoms % 6 WHEN 0 THEN 'no_anomaly' WHEN 1 THEN 'adsorbate_dissociation' WHEN 2 THEN 'adsorbate_desorption'
         WHEN 3 THEN 'surface_reconstruction' WHEN 4 THEN 'uninteracting_hydrogen' END AS catalyst_anomaly,
       k.sid % 300 AS catalyst_relaxation_frame_idx, t.n_adsorbate AS catalyst_num_adsorbate_atoms,
       t.n_slab AS catalyst_num_bulk_atoms, 'extxyz.xz' AS file_extension""")
ORACLES["motifs_of_text"] = """
WITH places AS (SELECT doc_id AS id, text, unnest(range(0, len(text))) AS s FROM documents WHERE text <> ''),
patterns AS (SELECT * FROM (VALUES ('ala', 'thed'), ('ala', 'the'), ('gly', 'ana'), ('gly', 'anan'), ('ser', 'on'), ('ade', 'ti'),
  ('ade', 'tion'), ('cyt', 'de la')) AS t(code, pattern)),
letters AS (SELECT id, s, substr(text, s + 1, 5) AS ahead FROM places),
found AS (SELECT l.id, p.code, l.s, l.s + len(p.pattern) - 1 AS e FROM letters l JOIN patterns p ON starts_with(l.ahead, p.pattern)),
kept AS (SELECT * FROM found m WHERE NOT EXISTS (
  SELECT 1 FROM found o WHERE o.id = m.id AND o.code = m.code AND m.s >= o.s AND m.e <= o.e AND (m.s > o.s OR m.e < o.e)))
SELECT id, count(*) FILTER (code = 'ala') AS num_ala, count(*) FILTER (code = 'gly') AS num_gly, count(*) FILTER (code = 'ser') AS num_ser,
       count(*) FILTER (code IN ('ala', 'gly', 'ser')) > 3 AS is_protein, count(*) FILTER (code = 'ade') AS num_ade,
       count(*) FILTER (code = 'cyt') AS num_cyt, count(*) FILTER (code IN ('ade', 'cyt')) > 2 AS is_nucleobase
FROM kept GROUP BY id"""
ORACLES["scalars_rowwise"] = f"""
SELECT q.sid, q.num_atoms, q.atomic_symbols, c.composition, p.spin_multiplicity AS parity_spin,
       {r('q.net_force_norm')} AS net_force_norm, {r('q.max_force_norm')} AS max_force_norm, d.dipole_moment_magnitude,
       {r('q.molecular_weight')} AS molecular_weight
FROM V_query_db q JOIN ({_COMPOSITION}) c ON q.sid = c.sid JOIN ({ORACLES['parity_spin']}) p ON q.sid = p.sid
JOIN ({ORACLES['dipole_moment']}) d ON q.sid = d.sid"""
ORACLES["validity_rowwise"] = f"""
SELECT v.sid, v.is_molecular_structure_valid, w.num_water_molecules
FROM ({ORACLES['structure_valid']}) v JOIN ({_WATER}) w ON v.sid = w.sid"""
ORACLES["process_catalyst"] = f"""
SELECT k.entry_key, 'oc20' AS database_name, 's2ef' AS subset, 'RPBE' AS functional, cast(0 AS bigint) AS net_charge,
       cast(p.spin_multiplicity AS double) AS spin_multiplicity, c.composition, f.catalyst_bulk_id, f.catalyst_class,
       f.catalyst_anomaly, f.catalyst_relaxation_frame_idx, t.n_adsorbate AS catalyst_num_adsorbate_atoms,
       t.n_slab AS catalyst_num_bulk_atoms, h.catalyst_substrate_height, v.catalyst_xyz_adsorbate_is_valid,
       cast(0.0 AS double) AS catalyst_reference_energy
FROM ({KEYED}) k JOIN ({ORACLES['parity_spin']}) p ON k.sid = p.sid JOIN ({_COMPOSITION}) c ON k.sid = c.sid
JOIN ({ORACLES['catalyst_fields']}) f ON k.sid = f.sid JOIN ({ORACLES['tag_slice']}) t ON k.sid = t.sid
JOIN ({ORACLES['substrate_height']}) h ON k.sid = h.sid JOIN ({ORACLES['adsorbate_valid']}) v ON k.sid = v.sid
WHERE k.raw_database_name = 'oc20_s2ef'"""
ORACLES["query_end_to_end"] = f"""
SELECT {r('energy')} AS energy, atomic_symbols, {r('max_force_norm')} AS max_force_norm, entry_key FROM V_query_db
WHERE max_force_norm < 4 AND regexp_matches(atomic_symbols, '^[HO]+$') AND subset IN ('rgd', 'spice', 'biomolecules')
ORDER BY {seeded(42, 'entry_key')}, entry_key LIMIT 50"""
ORACLES["export_end_to_end"] = f"""
SELECT q.entry_key, p.part, q.num_atoms AS n_elements, {r('q.energy')} AS energy, cast(q.net_charge AS varchar) AS charge,
       q.num_atoms, {r('q.net_force_norm')} AS net_force_norm
FROM ({SELECTED}) q JOIN ({_parts(4)}) p ON q.entry_key = p.entry_key"""
ORACLES["export_omol"] = f"""
SELECT x.entry_key, x.part, k.info_charge AS charge, cast(2 AS double) AS spin_multiplicity, q.num_atoms AS n_atoms, k.subset,
       m.mulliken, m.mulliken AS lowdin, q.num_atoms AS extra_atoms
FROM ({ORACLES['export_end_to_end']}) x JOIN ({KEYED}) k ON x.entry_key = k.entry_key JOIN V_query_db q ON q.sid = k.sid
JOIN (SELECT sid, {r('sum(charge)')} AS mulliken FROM V_atoms GROUP BY sid) m ON m.sid = k.sid"""
ORACLES["ingest_incremental"] = f"SELECT entry_key, subset, {r('info_energy')} AS energy FROM ({KEYED})"


def _needed(sql: str, found: list[str]) -> list[str]:
    """Views a statement uses, each after the views it builds on."""
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            found.append(name)
    return found


def oracle_statements() -> dict[str, str]:
    """Each oracle as one self-contained statement."""
    statements = {}
    for name, body in ORACLES.items():
        views = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in _needed(body, []))
        stripped = body.strip()
        recursive = ""
        if stripped.startswith("WITH RECURSIVE "):
            recursive, stripped = "RECURSIVE ", stripped[len("WITH RECURSIVE "):]
            head = ",\n"
        elif stripped.startswith("WITH "):
            stripped, head = stripped[len("WITH "):], ",\n"
        else:
            head = "\n"
        prefix = f"WITH {recursive}{views}{head}" if views else ("" if head == "\n" else f"WITH {recursive}")
        statements[name] = prefix + stripped
    return statements
