"""Splits, merges, counts and fingerprints."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decidra.functions import hashing
from decidra.operators import nested
from decidra.operators import records as R
from decidra.operators import windows
from decidra.plans.base import Catalogue, decoded_sql, table

C = Catalogue()
SEED = 42

_HEAD = "('0x' || substr({0}, 1, 8))::BIGINT"
_STABLE = f"""CASE WHEN {{g}} IS NULL THEN NULL
  WHEN {_HEAD.format("sha256('42:' || {g})")} / 4294967295.0 < 0.70 THEN 'train'
  WHEN {_HEAD.format("sha256('42:' || {g})")} / 4294967295.0 < 0.85 THEN 'validation' ELSE 'test' END"""
_CALIBRATION = f"CASE WHEN {_HEAD.format("sha256('calibration:42:' || {g})")} % 2 = 1 THEN 'calibration' ELSE 'validation' END"
_ID_HASH = " || ".join(f"printf('%08x', (sum(('0x' || substr(sha256({{i}}::VARCHAR), {8 * i + 1}, 8))::BIGINT) % 4294967296)::BIGINT)" for i in range(8)).replace("{i}", "{x}")
_WEIGHTS = "(CASE label_source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in R.LABEL_WEIGHTS.items()) + f" ELSE {R.UNKNOWN_WEIGHT} END)::DOUBLE"
#: A row per record and head of gold, keyed or listed, plain or re-encoded; probabilities that are lists of options become objects.
HEADS_SQL = f"""
d AS (SELECT id, source, {decoded_sql("gold")} AS g FROM veribugbench_5q),
hs AS (SELECT d.id AS id, d.source AS source, CASE WHEN json_type(g) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, e.value AS value, e.value -> '$.probabilities' AS c
  FROM d, json_each(CASE WHEN json_type(g) IN ('OBJECT', 'ARRAY') THEN g END) e),
heads AS (SELECT id, source, qid, value ->> '$.label_source' AS label_source,
  CASE WHEN json_type(c) = 'ARRAY' THEN (SELECT json_group_object(e.value ->> '$.option', (e.value ->> '$.p')::DOUBLE) FROM json_each(CASE WHEN json_type(c) = 'ARRAY' THEN c END) e WHERE e.value ->> '$.option' IS NOT NULL) ELSE c END AS probs,
  (value ->> '$.score')::DOUBLE AS score, value ->> '$.label' AS label, (value ->> '$.confidence')::DOUBLE AS confidence FROM hs WHERE qid IS NOT NULL)"""


@C.add(f"""
SELECT {_STABLE.format(g="source")} AS split, count(*) AS records, count(DISTINCT source) AS groups,
       {_ID_HASH.format(x="doc_id")} AS id_hash
FROM documents GROUP BY 1""")
def split_statistics(spark, d):
    """Records, groups and the fingerprint of the ids of each split; documents split by source."""
    docs = table(spark, d, "documents").withColumn("split", hashing.stable_split(F.col("source"), SEED))
    return docs.groupBy("split").agg(F.count("*").alias("records"), F.count_distinct("source").alias("groups"), hashing.id_set_hash(F.col("doc_id")).alias("id_hash"))


@C.add(f"""
SELECT doc_id, CASE WHEN b < 75 THEN 'train' WHEN b < 88 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT doc_id, {_HEAD.format("sha1(doc_id::VARCHAR)")} % 100 AS b FROM documents)""")
def split_sha1_buckets(spark, d):
    return table(spark, d, "documents").select("doc_id", hashing.bucket_split(F.col("doc_id").cast("string")).alias("split"))


@C.add(f"""
SELECT split, count(*) AS records FROM (
  SELECT CASE WHEN project_id = 'latchup_soc_core' THEN 'test' WHEN s = 'validation' THEN c ELSE s END AS split
  FROM (SELECT project_id, {_STABLE.format(g="source_group")} AS s, {_CALIBRATION.format(g="source_group")} AS c
        FROM (SELECT *, provenance.project_id AS project_id FROM veribugbench_5q)))
GROUP BY split""")
def split_four_way(spark, d):
    """Lineage groups split four ways; one project is held out by a fixed table."""
    held = F.create_map(F.lit("latchup_soc_core"), F.lit("test"))
    s = hashing.stable_split(F.col("source_group"), SEED)
    four = F.when(s == "validation", hashing.calibration_half(F.col("source_group"), SEED)).otherwise(s)
    return table(spark, d, "veribugbench_5q").select(F.coalesce(F.try_element_at(held, F.col("provenance.project_id")), four).alias("split")).groupBy("split").agg(F.count("*").alias("records"))


@C.add("""
SELECT source_group, count(DISTINCT split) AS splits, count(*) AS records FROM (
  SELECT source_group, lower(regexp_replace(provenance.split, '^\\s+|\\s+$', '', 'g')) AS split FROM veribugbench_5q)
WHERE source_group IS NOT NULL AND split IS NOT NULL GROUP BY source_group HAVING count(DISTINCT split) > 1""")
def split_leakage_check(spark, d):
    """Groups whose records stand in several splits."""
    split = F.lower(F.regexp_replace(F.col("provenance.split"), r"^\s+|\s+$", ""))
    rows = table(spark, d, "veribugbench_5q").select("source_group", split.alias("split")).dropna()
    return rows.groupBy("source_group").agg(F.count_distinct("split").alias("splits"), F.count("*").alias("records")).filter("splits > 1")


@C.add("""
WITH g AS (SELECT source_group, count(DISTINCT id) AS size FROM veribugbench_5q WHERE source_group IS NOT NULL GROUP BY 1),
r AS (SELECT *, coalesce(sum(size) OVER (ORDER BY sha256(source_group), source_group ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER () AS total FROM g)
SELECT source_group, size, before < ceil(total * 0.25) AS held_out FROM r""")
def split_quarter_holdout(spark, d):
    """Whole groups in hash order until they hold a quarter of the ids."""
    groups = table(spark, d, "veribugbench_5q").filter("source_group is not null").groupBy("source_group").agg(F.count_distinct("id").alias("size"))
    return windows.whole_groups_until(groups, "source_group", "size", 0.25)


@C.add(f"""
WITH {HEADS_SQL},
w AS (SELECT *, {_WEIGHTS} AS weight FROM heads)
SELECT source, label_source, count(DISTINCT id) AS records, count(*) AS decisions, round(sum(weight), 6) AS mass, round(avg(weight), 6) AS mean_weight,
       round(100.0 * sum(weight) / sum(sum(weight)) OVER (), 6) AS percent
FROM w GROUP BY source, label_source""")
def training_mass(spark, d):
    """Weight of the decisions by source and label source, and its part of all."""
    heads = R.decisions(table(spark, d, "veribugbench_5q")).withColumn("weight", R.label_weight(F.col("label_source")))
    by = heads.groupBy("source", "label_source").agg(F.count_distinct("id").alias("records"), F.count("*").alias("decisions"), F.sum("weight").alias("m"), F.avg("weight").alias("w"))
    whole = F.sum("m").over(Window.partitionBy())  # a row per source and label source
    return by.select("source", "label_source", "records", "decisions", F.round("m", 6).alias("mass"), F.round("w", 6).alias("mean_weight"), F.round(100.0 * F.col("m") / whole, 6).alias("percent"))


@C.add("""
(SELECT DISTINCT id, 'left' AS side FROM veribugbench_5q WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM batch_06_mux_4_1 WHERE id IS NOT NULL))
UNION ALL
(SELECT DISTINCT id, 'right' AS side FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM veribugbench_5q WHERE id IS NOT NULL))""")
def merge_integrity(spark, d):
    """Ids that only the records or only the batches have."""
    return R.key_differences(table(spark, d, "veribugbench_5q"), table(spark, d, "batch_06_mux_4_1"), "id")


@C.add("""
WITH s AS (SELECT project_id, min(swept_at) AS swept_at, arg_min(golden_rc, swept_at) AS golden_rc, arg_min(len(instances), swept_at) AS n FROM sim_sweep GROUP BY project_id)
SELECT p.project_id, p.maintainer, p.benchmark_root, s.golden_rc, s.n::BIGINT AS instances, s.project_id IS NOT NULL AS swept FROM projects p LEFT JOIN s USING (project_id)""")
def merge_additive(spark, d):
    """Projects with the fields of their first sweep added, their own left as they are."""
    first = table(spark, d, "sim_sweep").groupBy("project_id").agg(F.min_by("golden_rc", "swept_at").alias("golden_rc"), F.min_by(F.size("instances"), F.col("swept_at")).cast("long").alias("instances"), F.lit(True).alias("swept"))
    return table(spark, d, "projects").join(first, "project_id", "left").select("project_id", "maintainer", "benchmark_root", "golden_rc", "instances", F.coalesce("swept", F.lit(False)).alias("swept"))


_ONE = "SELECT id, row_no, batch_index, project FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sent_at {0} NULLS {1}, row_no {0}) AS k FROM batch_06_mux_4_1 WHERE id IS NOT NULL) WHERE k = 1"


@C.add(_ONE.format("ASC", "FIRST"))
def dedup_first(spark, d):
    """The first delivery of each id."""
    return R.first_delivery(table(spark, d, "batch_06_mux_4_1").select("id", "row_no", "batch_index", "project", "sent_at"), "id", ("sent_at", "row_no")).drop("sent_at")


@C.add(_ONE.format("DESC", "LAST"))
def dedup_last(spark, d):
    """The last delivery of each id."""
    return R.first_delivery(table(spark, d, "batch_06_mux_4_1").select("id", "row_no", "batch_index", "project", "sent_at"), "id", ("sent_at", "row_no"), last=True).drop("sent_at")


@C.add("SELECT id, count(*) AS n, count(DISTINCT project) AS projects FROM batch_06_mux_4_1 WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return table(spark, d, "batch_06_mux_4_1").filter("id is not null").groupBy("id").agg(F.count("*").alias("n"), F.count_distinct("project").alias("projects")).filter("n > 1")


@C.add("""
SELECT source, flag, count(*) AS n FROM (SELECT source, unnest(provenance.trust_flags) AS flag FROM veribugbench_5q) WHERE flag IS NOT NULL GROUP BY source, flag""")
def flag_counts(spark, d):
    return table(spark, d, "veribugbench_5q").select("source", F.explode("provenance.trust_flags").alias("flag")).filter("flag is not null").groupBy("source", "flag").agg(F.count("*").alias("n"))


@C.add(f"""
WITH d AS (SELECT source, {decoded_sql("questions")} AS q, {decoded_sql("gold")} AS g FROM veribugbench_5q),
qs AS (SELECT source, g, CASE WHEN json_type(q) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid FROM d, json_each(CASE WHEN json_type(q) IN ('OBJECT', 'ARRAY') THEN q END) e),
s AS (SELECT source, qid, g, (SELECT max(CASE WHEN json_type(h.value -> '$.probabilities') IN ('OBJECT', 'ARRAY') THEN 2 ELSE 1 END) FROM json_each(CASE WHEN json_type(g) IN ('OBJECT', 'ARRAY') THEN g END) h
  WHERE CASE WHEN json_type(g) = 'OBJECT' THEN h.key ELSE h.value ->> '$.qid' END = qid) AS found FROM qs WHERE qid IS NOT NULL)
SELECT source, qid, CASE WHEN g IS NULL OR json_type(g) NOT IN ('OBJECT', 'ARRAY') THEN 'no gold' WHEN found IS NULL THEN 'no head' WHEN found = 1 THEN 'no probabilities' ELSE 'kept' END AS reason, count(*) AS n FROM s GROUP BY ALL""")
def skip_ledger(spark, d):
    """Questions by why they have no usable gold head."""
    v = table(spark, d, "veribugbench_5q").select("source", "questions", nested.heads(F.col("gold")).alias("g"))
    rows = R.question_heads(v, ("source", "g"))
    own = F.filter("g", lambda h: h["qid"] == F.col("qid"))
    reason = F.when(F.col("g").isNull(), "no gold").when(F.size(own) == 0, "no head").when(F.forall(own, lambda h: h["probabilities"].isNull()), "no probabilities").otherwise("kept")
    return rows.select("source", "qid", reason.alias("reason")).groupBy("source", "qid", "reason").agg(F.count("*").alias("n"))


@C.add("""
WITH r AS (SELECT id, coalesce(outcome.verification IN ('verified', 'passed') OR outcome.resolved, FALSE) AS a,
  coalesce(len(coalesce(provenance.trust_flags, [])) = 0, FALSE) AS b,
  coalesce(provenance.label_source NOT IN ('codex_pseudo_unverified', 'distilled_unverified', 'llm_judge'), FALSE) AS c FROM veribugbench_5q)
SELECT id, bool_or(a) AS verified, bool_or(a AND b) AS unflagged, bool_or(a AND b AND c) AS trusted FROM r WHERE id IS NOT NULL GROUP BY id""")
def usage_gates(spark, d):
    """Nested gates by id: verified, of these without flags, of these without a pseudo label."""
    gates = {
        "verified": F.col("outcome.verification").isin("verified", "passed") | F.col("outcome.resolved"),
        "unflagged": F.size(F.coalesce("provenance.trust_flags", F.array().cast("array<string>"))) == 0,
        "trusted": ~F.col("provenance.label_source").isin(*R.PSEUDO_SOURCES),
    }
    rows = R.usage_gates(table(spark, d, "veribugbench_5q").filter("id is not null"), gates)
    return rows.groupBy("id").agg(*[F.bool_or(g).alias(g) for g in gates])


@C.add("""
SELECT id, ceil(row_number() OVER (ORDER BY id) / 3.0)::BIGINT AS batch FROM (
  SELECT DISTINCT id FROM veribugbench_5q WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM batch_06_mux_4_1 WHERE id IS NOT NULL))""")
def anti_next_batch(spark, d):
    """Records not yet in a batch, numbered in batches of three in the order of their ids."""
    todo = table(spark, d, "veribugbench_5q").select("id").filter("id is not null").distinct().join(table(spark, d, "batch_06_mux_4_1").select("id"), "id", "left_anti")
    return windows.ordered_number(todo, [F.col("id")], None, "n").select("id", F.ceil(F.col("n") / 3).alias("batch"))


@C.add("""
SELECT id FROM (SELECT DISTINCT id FROM veribugbench_5q WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM batch_06_mux_4_1 WHERE id IS NOT NULL)) ORDER BY id LIMIT 3""")
def next_three(spark, d):
    """The next batch: the first three ids that are in none (a top-k by definition)."""
    return table(spark, d, "veribugbench_5q").select("id").filter("id is not null").join(table(spark, d, "batch_06_mux_4_1").select("id"), "id", "left_anti").distinct().orderBy("id").limit(3)


@C.add("SELECT id, source FROM veribugbench_5q v WHERE EXISTS (SELECT 1 FROM batch_06_mux_4_1 b WHERE b.id = v.id)")
def semi_trusted(spark, d):
    return table(spark, d, "veribugbench_5q").select("id", "source").join(table(spark, d, "batch_06_mux_4_1").select("id"), "id", "left_semi")


@C.add(f"SELECT count(*) AS n, {_ID_HASH.format(x='doc_id')} AS fingerprint FROM documents")
def id_fingerprint(spark, d):
    """A fingerprint of the set of document ids."""
    return table(spark, d, "documents").agg(F.count("*").alias("n"), hashing.id_set_hash(F.col("doc_id")).alias("fingerprint"))


@C.add("SELECT doc_id, 'case_' || lpad((doc_id % 1000)::VARCHAR, 3, '0') || '_' || substr(sha256(coalesce(text, '')), 1, 8) AS case_id, substr(sha1(coalesce(text, '')), 1, 16) AS short_id FROM documents")
def content_ids(spark, d):
    """Stable ids from a number and the content."""
    text = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", hashing.numbered_id(F.col("doc_id") % 1000, text).alias("case_id"), hashing.short_id(text).alias("short_id"))


@C.add("""
SELECT benchmark, split, sha256(string_agg(h, '' ORDER BY h)) AS fingerprint FROM (
  SELECT benchmark, split, sha256(item_id::VARCHAR || ':' || coalesce(text, '')) AS h FROM test_items) GROUP BY benchmark, split""")
def hierarchical_fingerprint(spark, d):
    """Fingerprint of each part of the held-out items, a fixed small table, from the hashes of its rows."""
    h = F.sha2(F.concat(F.col("item_id").cast("string"), F.lit(":"), F.coalesce("text", F.lit(""))), 256)
    return table(spark, d, "test_items").select("benchmark", "split", h.alias("h")).groupBy("benchmark", "split").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("fingerprint"))


@C.add("""
SELECT source, count(*) AS records, round(avg(len(map_values(training_weights))), 6) AS mean_heads,
  round(100.0 * count(*) FILTER (WHERE provenance.eval_excluded) / greatest(count(*), 1), 2) AS excluded_percent,
  count(*) FILTER (WHERE provenance.eval_excluded IS NOT TRUE) AS kept
FROM veribugbench_5q GROUP BY source""")
def exclusion_report(spark, d):
    """Records kept and excluded from evaluation by source."""
    out = F.col("provenance.eval_excluded").eqNullSafe(True)
    return table(spark, d, "veribugbench_5q").groupBy("source").agg(F.count("*").alias("records"), F.round(F.avg(F.when(F.col("training_weights").isNotNull(), F.size("training_weights"))), 6).alias("mean_heads"), F.round(100.0 * F.count_if(out) / F.greatest(F.count("*"), F.lit(1)), 2).alias("excluded_percent"), F.count_if(~out).alias("kept"))


@C.add("""
SELECT v.id, v.source, coalesce(p.source_group, v.id) AS lineage, p.maintainer FROM veribugbench_5q v LEFT JOIN projects p ON p.project_id = v.provenance.project_id""")
def group_default_join(spark, d):
    """Records with their project's lineage group, or their own id if the project is unknown."""
    p = table(spark, d, "projects").select("project_id", "source_group", "maintainer")
    v = table(spark, d, "veribugbench_5q").select("id", "source", F.col("provenance.project_id").alias("project_id"))
    return v.join(p, "project_id", "left").select("id", "source", F.coalesce("source_group", "id").alias("lineage"), "maintainer")


_CHANGED = "SELECT id, '{0}' AS field FROM (SELECT id, source, provenance.split AS split FROM veribugbench_5q WHERE id IS NOT NULL) GROUP BY id HAVING count(DISTINCT {0}) + max(({0} IS NULL)::INT) > 1"


@C.add(_CHANGED.format("source") + " UNION ALL " + _CHANGED.format("split"))
def field_immutability(spark, d):
    """Fields that differ between any deliveries of one id, null a value of its own."""
    v = table(spark, d, "veribugbench_5q").filter("id is not null").select("id", "source", F.col("provenance.split").alias("split"))
    changed = lambda c: F.when(F.min(c).isNotNull() & ((F.min(c) != F.max(c)) | (F.count(c) < F.count("*"))), F.lit(c))
    fields = v.groupBy("id").agg(F.array_compact(F.array(changed("source"), changed("split"))).alias("fields"))
    return fields.select("id", F.explode("fields").alias("field"))


@C.add("""
(SELECT 'ids present' AS check_name, count(*) FILTER (WHERE id IS NULL) AS n_bad FROM veribugbench_5q)
UNION ALL (SELECT 'ids unique', count(*) FROM (SELECT id FROM veribugbench_5q WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1))
UNION ALL (SELECT 'state present', count(*) FILTER (WHERE state IS NULL OR trim(state) = '') FROM veribugbench_5q)
UNION ALL (SELECT 'split known', count(*) FILTER (WHERE coalesce(lower(trim(provenance.split)), '') NOT IN ('train', 'validation', 'calibration', 'test')) FROM veribugbench_5q)
UNION ALL (SELECT 'judged before ingested', count(*) FILTER (WHERE judged_at > ingested_at) FROM veribugbench_5q)""")
def named_checks(spark, d):
    """A report of named checks and how many rows fail each; one scan and one count of ids."""
    v = table(spark, d, "veribugbench_5q")
    bad = {
        "ids present": F.col("id").isNull(),
        "state present": F.col("state").isNull() | (F.trim("state") == ""),
        "split known": ~F.coalesce(F.lower(F.trim("provenance.split")), F.lit("")).isin("train", "validation", "calibration", "test"),
        "judged before ingested": F.coalesce(F.col("judged_at") > F.col("ingested_at"), F.lit(False)),
    }
    wide = v.agg(*[F.count_if(c).alias(n) for n, c in bad.items()])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n_bad")) for n in bad])).alias("r")).select("r.*")
    twice = v.filter("id is not null").groupBy("id").count().filter("count > 1").agg(F.lit("ids unique").alias("check_name"), F.count("*").alias("n_bad"))
    return long.unionByName(twice)


@C.add("""
SELECT kind, count(*) AS n FROM (SELECT 'record' AS kind, id FROM veribugbench_5q UNION ALL SELECT 'batch' AS kind, id FROM batch_06_mux_4_1 UNION ALL SELECT 'document' AS kind, doc_id::VARCHAR FROM documents) GROUP BY kind""")
def union_sources(spark, d):
    """A bag union of sources by name."""
    a = table(spark, d, "veribugbench_5q").select(F.lit("record").alias("kind"), "id")
    b = table(spark, d, "batch_06_mux_4_1").select("id", F.lit("batch").alias("kind"))
    c = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("document").alias("kind"))
    return a.unionByName(b).unionByName(c).groupBy("kind").agg(F.count("*").alias("n"))
