"""SQL for those llm queries that SQL can express on whole tables."""

from __future__ import annotations

_SIZES = """
sizes AS (
  SELECT id, max_by(k, s) AS k, max(s) AS s FROM (
    SELECT id, regexp_replace(lower(source), '[\\s\\-_]', '', 'g') AS k,
           coalesce(list_sum(map_values(training_weights)), 0) AS s
    FROM veribugbench_5q WHERE id IS NOT NULL) GROUP BY id),
source_sizes AS (SELECT k, sum(s) AS s FROM sizes GROUP BY k),
plans AS (
  SELECT plan_id, source, target_share, max_repeats, regexp_replace(lower(source), '[\\s\\-_]', '', 'g') AS k FROM mix_plans),
totals AS (
  SELECT plan_id, sum(s) AS total FROM (SELECT DISTINCT plan_id, k FROM plans) LEFT JOIN source_sizes USING (k) GROUP BY plan_id)
"""

_CLEAN = "CASE WHEN lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) NOT IN ('', '-', 'n/a', 'unknown') THEN lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) END"

_LINKS = f"""
ids AS (SELECT DISTINCT id FROM veribugbench_5q WHERE id IS NOT NULL),
links AS (
  SELECT id, 'g' AS kind, {_CLEAN.format("source_group")} AS v FROM veribugbench_5q
  UNION SELECT id, 'm', {_CLEAN.format("provenance.maintainer")} FROM veribugbench_5q
  UNION SELECT id, 'p', {_CLEAN.format("provenance.project_id")} FROM veribugbench_5q
  UNION SELECT id, 'p', {_CLEAN.format("project")} FROM batch_06_mux_4_1 WHERE id IN (SELECT id FROM ids)),
keys AS (SELECT id, kind || ':' || v AS k, v FROM links WHERE v IS NOT NULL AND id IS NOT NULL),
first_key AS (SELECT id, min(k) AS k FROM keys GROUP BY id),
edges AS (SELECT f.k AS u, keys.k AS v FROM first_key f JOIN keys USING (id) UNION SELECT keys.k, f.k FROM first_key f JOIN keys USING (id)),
reach AS (SELECT u AS node, u AS other FROM edges UNION SELECT reach.node, edges.v FROM reach JOIN edges ON edges.u = reach.other),
names AS (SELECT node, min(substr(other, 3)) AS name FROM reach GROUP BY node)
"""

#: Ids that share a run of three tokens, with how many, from all designs.
_LIKE = """
designs AS (
  SELECT id, buggy_rtl AS rtl FROM batch_06_mux_4_1
  UNION SELECT id, CASE WHEN NOT json_valid(state) THEN state ELSE CASE json_type(state)
      WHEN 'OBJECT' THEN state ->> '$.buggy_rtl' WHEN 'ARRAY' THEN state ->> '$[0].buggy_rtl'
      WHEN 'VARCHAR' THEN CASE WHEN json_valid(state ->> '$') THEN (state ->> '$') ->> '$.buggy_rtl' ELSE state ->> '$' END END END FROM veribugbench_5q),
tokens AS (
  SELECT id, regexp_extract_all(lower(regexp_replace(rtl, '//[^\\n]*|/\\*(?s:.)*?\\*/', ' ', 'g')), '[\\p{L}\\p{N}_]+|[^\\s\\x0b\\p{L}\\p{N}_]') AS t
  FROM designs WHERE id IS NOT NULL AND rtl IS NOT NULL AND trim(rtl) <> ''),
runs AS (SELECT DISTINCT id, hash(t[i], t[i + 1], t[i + 2]) AS h FROM tokens, range(1, 100000) r(i) WHERE i <= len(t) - 2),
sizes AS (SELECT id, count(*) AS n FROM runs GROUP BY id),
shared AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS s FROM runs a JOIN runs b ON a.h = b.h AND a.id < b.id GROUP BY 1, 2),
alike AS (SELECT id_a, id_b FROM shared JOIN sizes x ON x.id = id_a JOIN sizes y ON y.id = id_b WHERE s >= 0.7 * (x.n + y.n - s))
"""

#: What a query of checks must give.
_ZEROS = "SELECT * FROM (VALUES {}) t(check_name, n_bad)"


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"""
WITH RECURSIVE {_LINKS}
SELECT ids.id, coalesce(names.name, ids.id) AS group_key FROM ids LEFT JOIN first_key USING (id) LEFT JOIN names ON names.node = first_key.k""",
        "p3_incremental": f"""
WITH RECURSIVE {_LINKS}
SELECT ids.id, coalesce(names.name, ids.id) AS group_key FROM ids LEFT JOIN first_key USING (id) LEFT JOIN names ON names.node = first_key.k""",
        "p3_split_checks": _ZEROS.format("('without a split', 0::BIGINT), ('in several splits', 0), ('components parted', 0), ('proportions missed', 0)"),
        "p4_found": f"WITH {_LIKE} SELECT id_a, id_b FROM alike",
        "p4_groups": f"""
WITH RECURSIVE {_LIKE},
cls AS (SELECT id, md5(string_agg(h::VARCHAR, ',' ORDER BY h)) AS c FROM runs GROUP BY id),
names AS (SELECT c, min(id) AS name, count(*) AS copies FROM cls GROUP BY c),
lk AS (SELECT DISTINCT a.c AS ca, b.c AS cb FROM alike JOIN cls a ON a.id = id_a JOIN cls b ON b.id = id_b WHERE a.c <> b.c),
ways AS (SELECT ca, cb FROM lk UNION SELECT cb, ca FROM lk),
degrees AS (SELECT ca AS c, count(*) AS links FROM ways GROUP BY ca),
reach AS (SELECT c AS node, c AS root FROM names UNION SELECT ways.cb, reach.root FROM reach JOIN ways ON ways.ca = reach.node),
groups AS (SELECT root AS c, min(name) AS group_id FROM reach JOIN names ON names.c = reach.node GROUP BY root)
SELECT id, group_id, copies, coalesce(links, 0) AS links FROM cls JOIN names USING (c) JOIN groups USING (c) LEFT JOIN degrees USING (c)""",
        "p5_checks": _ZEROS.format("('taken too often', 0::BIGINT), ('target missed', 0), ('report differs', 0), ('less than all taken', 0)"),
        "p7_checks": _ZEROS.format("('overlapping tiles', 0::BIGINT), ('too little shared', 0), ('long runs apart', 0)"),
        "p8_checks": _ZEROS.format("('rows lost', 0::BIGINT), ('nulls changed', 0), ('mentions apart', 0), ('rest changed', 0)"),
        "p1_found": f"""
WITH {_LIKE}, s AS (SELECT id, lower(regexp_replace(provenance.split, '^\\s+|\\s+$', '', 'g')) AS split FROM veribugbench_5q WHERE id IS NOT NULL),
sides AS (SELECT id, bool_or(split = 'train') AS t, bool_or(split IN ('validation', 'calibration', 'test')) AS h FROM s WHERE split IN ('train', 'validation', 'calibration', 'test') GROUP BY id)
SELECT id_a, id_b FROM alike JOIN sides a ON a.id = id_a JOIN sides b ON b.id = id_b WHERE a.t AND b.h OR a.h AND b.t
UNION ALL SELECT id, id FROM sides WHERE t AND h""",
        "p1_report": f"""
WITH {_LIKE}, s AS (SELECT DISTINCT id, lower(regexp_replace(provenance.split, '^\\s+|\\s+$', '', 'g')) AS split, coalesce(source, 'unknown') AS source FROM veribugbench_5q WHERE id IS NOT NULL),
held AS (SELECT * FROM s WHERE split IN ('validation', 'calibration', 'test')), trained AS (SELECT DISTINCT id FROM s WHERE split = 'train'),
both_ways AS (SELECT id_a AS id, id_b AS other FROM alike UNION SELECT id_b, id_a FROM alike UNION SELECT id, id FROM held),
n AS (SELECT b.id, count(*) AS n FROM both_ways b JOIN trained t ON t.id = b.other WHERE b.id IN (SELECT id FROM held) GROUP BY b.id)
SELECT split, source, count(*) AS records, count(n) AS overlapping, coalesce(sum(n), 0)::BIGINT AS pairs FROM held LEFT JOIN n USING (id) GROUP BY split, source""",
        "p7_found": """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
q AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM test_items WHERE text IS NOT NULL),
dg AS (SELECT doc_id, array_to_string(w[i:i + 11], ' ') AS g FROM d, range(1, 1000000) r(i) WHERE i <= len(w) - 11),
qg AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 11], ' ') AS g FROM q, range(1, 1000) r(i) WHERE i <= len(w) - 11)
SELECT DISTINCT doc_id, item_id FROM dg JOIN qg USING (g)""",
        "p5_found": f"""
WITH {_SIZES}
SELECT plan_id, source FROM plans JOIN totals USING (plan_id) LEFT JOIN source_sizes USING (k)
WHERE max_repeats * coalesce(s, 0) < target_share * total""",
        "p6_round_trip": "SELECT doc_id, TRUE AS same FROM documents",
    }
