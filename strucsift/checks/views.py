"""SQL definitions of the structure-shaped views, as the oracles see them."""

VIEWS = {
    "V_elements": """
SELECT z, symbol, cast(mass AS double) AS mass, cast(cov AS double) AS cov_radius, cast(vdw AS double) AS vdw_radius, valence
FROM (VALUES (1,'H',1.008,0.31,1.20,1), (6,'C',12.011,0.76,1.70,4), (7,'N',14.007,0.71,1.55,3),
             (8,'O',15.999,0.66,1.52,2), (29,'Cu',63.546,1.32,1.40,-1)) AS t(z, symbol, mass, cov, vdw, valence)
""",
    "V_atoms": """
SELECT l_orderkey AS sid,
       cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS bigint) AS idx,
       CASE WHEN l_suppkey % 2 = 0 THEN 1 WHEN l_suppkey % 4 = 1 THEN 8 ELSE 6 END AS z,
       l_quantity / 25.0 AS px, l_discount * 15.0 AS py, l_tax * 15.0 AS pz,
       l_extendedprice / 10000.0 - 5.0 AS fx, l_quantity / 10.0 - 2.5 AS fy, cast((l_linenumber - 4) / 2.0 AS double) AS fz,
       l_discount - 0.05 AS charge,
       l_linenumber % 3 AS tag
FROM lineitem
""",
    "V_structures": """
SELECT o_orderkey AS sid, raw_database_name, raw_split_name,
       lower(replace(raw_database_name, '_', '-')) AS database_name,
       lower(replace(raw_split_name, '_', '-')) AS split_name,
       source_file_name,
       cast(row_number() OVER (PARTITION BY raw_database_name, raw_split_name, source_file_name ORDER BY o_orderkey) - 1 AS bigint) AS frame_idx,
       subset, info_energy, calc_energy, info_charge, class_code, anomaly_code, frame_number, custkey,
       ax, az, bvy, cz, s0, s1, s2, s3, s4, s5
FROM (
  SELECT o_orderkey, o_custkey AS custkey,
         CASE o_orderstatus WHEN 'F' THEN 'OMOL25' WHEN 'O' THEN 'oc20_s2ef' ELSE 'omat24-rattled_1000' END AS raw_database_name,
         CASE WHEN o_orderkey % 10 < 8 THEN 'Train' ELSE 'val_id' END AS raw_split_name,
         concat('data_', lpad(cast(o_custkey % 20 AS string), 4, '0')) AS source_file_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'rgd' WHEN '2-HIGH' THEN 'spice' WHEN '3-MEDIUM' THEN 'biomolecules'
                              WHEN '4-NOT SPECIFIED' THEN 'elytes' END AS subset,
         0.0 - o_totalprice / 100.0 AS info_energy,
         CASE WHEN o_orderkey % 3 <> 0 THEN 0.0 - o_totalprice / 100.0 END AS calc_energy,
         cast(o_custkey % 3 AS bigint) - 1 AS info_charge,
         cast(o_custkey % 5 AS int) AS class_code, cast(o_custkey % 6 AS int) AS anomaly_code,
         concat('frame', cast(o_orderkey % 300 AS string)) AS frame_number,
         cast(10.0 AS double) AS ax, cast(o_custkey % 5 AS double) / 10.0 AS az, cast(10.0 AS double) AS bvy, cast(30.0 AS double) AS cz,
         o_totalprice / 1000.0 AS s0, o_totalprice / 2000.0 AS s1, o_totalprice / 3000.0 AS s2,
         cast(o_custkey % 7 AS double) AS s3, cast(o_custkey % 11 AS double) AS s4, cast(o_custkey % 13 AS double) AS s5
  FROM orders
) AS t
""",
    "V_query_db": """
SELECT concat(s.database_name, '_', s.split_name, '_', replace(s.source_file_name, '_', '$'), '_', cast(s.frame_idx AS string)) AS entry_key,
       s.sid, s.database_name, s.split_name, s.subset, s.info_energy AS energy, s.info_charge AS net_charge,
       a.num_atoms, a.net_force_norm, a.max_force_norm, a.molecular_weight, a.atomic_symbols, a.has_h
FROM V_structures s
JOIN (SELECT v.sid, count(*) AS num_atoms,
             round(sqrt(sum(fx) * sum(fx) + sum(fy) * sum(fy) + sum(fz) * sum(fz)), 6) AS net_force_norm,
             round(max(sqrt(fx * fx + fy * fy + fz * fz)), 6) AS max_force_norm,
             round(sum(e.mass), 6) AS molecular_weight,
             concat(max(CASE WHEN v.z = 6 THEN 'C' ELSE '' END), max(CASE WHEN v.z = 1 THEN 'H' ELSE '' END), max(CASE WHEN v.z = 8 THEN 'O' ELSE '' END)) AS atomic_symbols,
             max(CASE WHEN v.z = 1 THEN 1 ELSE 0 END) = 1 AS has_h
      FROM V_atoms v JOIN V_elements e ON v.z = e.z GROUP BY v.sid) a
ON s.sid = a.sid
""",
    "V_bonds": """
SELECT a.sid, a.idx AS i, b.idx AS j, a.z AS zi, b.z AS zj,
       round(sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py) + (a.pz - b.pz) * (a.pz - b.pz)), 9) AS dist
FROM V_atoms a JOIN V_atoms b ON a.sid = b.sid AND a.idx < b.idx
JOIN V_elements ea ON a.z = ea.z JOIN V_elements eb ON b.z = eb.z
WHERE round(sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py) + (a.pz - b.pz) * (a.pz - b.pz)), 9)
      < round(1.2 * (ea.cov_radius + eb.cov_radius), 9)
""",
    "V_pathways": """
SELECT concat('rx_', cast(o_orderkey AS string)) AS entry_key, o_custkey AS reaction_id,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS reaction_pathway_id,
       cast(row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS bigint) AS reaction_step_idx,
       cast(count(*) OVER (PARTITION BY o_custkey, o_orderstatus) - 1 AS bigint) AS last_step_idx,
       o_totalprice AS energy
FROM orders
""",
    "V_source_strings": """
SELECT event_id,
       CASE event_type WHEN 'click' THEN 'rgd' WHEN 'view' THEN 'reactivity' WHEN 'signup' THEN 'ani1'
                       WHEN 'purchase' THEN 'trans1x' ELSE 'metal_complexes' END AS data_id,
       CASE WHEN event_id % 97 = 0 THEN 'bad'
            WHEN event_type = 'click' THEN concat('rgd_uks/MR_', cast(user_id AS string), '_', cast(event_id % 4 AS string), '_', cast(event_id % 19 AS string), '_0_1/orca.tar.zst')
            WHEN event_type = 'view' THEN concat(CASE WHEN event_id % 3 = 0 THEN 'ani1xbb/r_' ELSE 'pmechdb/r_' END, cast(user_id AS string), '_', CASE WHEN event_id % 3 = 0 THEN '' ELSE 'step' END, cast(event_id % 12 AS string), '/f.tar')
            WHEN event_type = 'signup' THEN concat('ani2x/r_', cast(user_id AS string), '_', cast(event_id % 25 AS string), '/f.tar')
            WHEN event_type = 'purchase' THEN concat('trans1x/r_', cast(user_id AS string), '_2_', cast(event_id % 27 AS string), '/f.tar')
            WHEN event_id % 2 = 0 THEN concat('tm_react/mc_', cast(user_id AS string), '_step', cast(event_id % 9 AS string), '_x/orca.tar')
            ELSE concat('omol/mc_', cast(user_id AS string), '/orca.tar') END AS source,
       CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'ref/step1_incomplete'
            WHEN event_type = 'error' AND event_id % 5 = 1 THEN 'ref/step2_ok' END AS reference_source
FROM events
""",
    "V_states": """
SELECT t.sid, q.net_charge, 1 + ((t.electrons - q.net_charge + 300) % 2) + CASE WHEN (t.sid + q.net_charge + 30) % 5 = 0 THEN 2 ELSE 0 END AS spin_multiplicity
FROM (SELECT sid, cast(sum(z) AS bigint) AS electrons FROM V_atoms GROUP BY sid) t
CROSS JOIN (SELECT net_charge FROM (VALUES (-3), (-2), (-1), (0), (1), (2), (3)) AS v(net_charge)) q
WHERE (t.sid + q.net_charge + 30) % 3 <> 0 AND t.sid % 11 <> 0
""",
    "V_matches": """
SELECT DISTINCT l_orderkey AS id, l_returnflag AS code, l_linestatus AS pattern,
       cast(l_linenumber AS bigint) AS s, cast(l_linenumber + floor(l_quantity) % 3 AS bigint) AS e
FROM lineitem
""",
    "V_sidecar": """
SELECT source_file_name, database_name, split_name, frame_idx, concat('random', cast(custkey AS string)) AS oc_sid,
       frame_number, info_energy / 2.0 AS ref_energy
FROM V_structures WHERE raw_database_name = 'oc20_s2ef'
""",
    "V_sid_mapping": """
SELECT concat('random', cast(c_custkey AS string)) AS oc_sid, c_nationkey AS bulk_id, cast(c_custkey % 80 AS int) AS ads_id,
       c_mktsegment AS bulk_symbols, cast(c_nationkey % 5 AS int) AS class_code
FROM customer WHERE c_custkey % 50 <> 7
""",
    "V_sources_registry": """
SELECT DISTINCT database_name, split_name, concat('/landing/', database_name, '/', split_name) AS files_path
FROM V_structures WHERE NOT (database_name = 'oc20-s2ef' AND split_name = 'val-id')
""",
    "V_fp": """
SELECT concat('vec_', cast(vec_id AS string)) AS entry_key, vec_id, label,
       list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits
FROM embeddings
""",
}
