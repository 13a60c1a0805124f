"""Targets, judgments, reviews, patches, contracts and chains of subsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from decidra.functions import dist
from decidra.operators import judgments as J
from decidra.operators import metrics as M
from decidra.operators import nested, windows
from decidra.operators import records as R
from decidra.plans.base import Catalogue, decoded_sql, table
from decidra.plans.decision_queries import _PROBS, BIN_SQL
from decidra.plans.split_queries import HEADS_SQL

C = Catalogue()

_OBJECT = "CASE WHEN json_type({0}) = 'ARRAY' THEN (SELECT json_group_object(e.value ->> '$.option', (e.value ->> '$.p')::DOUBLE) FROM json_each(CASE WHEN json_type({0}) = 'ARRAY' THEN {0} END) e WHERE e.value ->> '$.option' IS NOT NULL) ELSE {0} END"
_TREE = "CASE WHEN json_type({0}) IN ('OBJECT', 'ARRAY') THEN {0} END"
#: A row per record, question and its gold head: id, source, split, weights, type, criteria keys, probabilities as an object.
PAIRS_SQL = f"""
d AS (SELECT row_number() OVER () AS n, id, source, training_weights AS tw, {decoded_sql("questions")} AS q, {decoded_sql("gold")} AS g FROM veribugbench_5q),
qs AS (SELECT d.n AS n, d.id AS id, d.source AS source, d.tw AS tw, CASE WHEN json_type(q) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, e.value ->> '$.type' AS type, e.value -> '$.criteria' AS c FROM d, json_each({_TREE.format("q")}) e),
gs AS (SELECT d.n AS n, CASE WHEN json_type(g) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, e.value -> '$.probabilities' AS c, e.value ->> '$.label_source' AS label_source FROM d, json_each({_TREE.format("g")}) e),
pairs AS (SELECT qs.n AS n, id, source, tw, qs.qid AS qid, type, label_source, gs.n IS NOT NULL AS found, {_OBJECT.format("gs.c")} AS probs,
  CASE WHEN json_type(qs.c) = 'OBJECT' THEN json_keys(qs.c) WHEN json_type(qs.c) = 'ARRAY' THEN (SELECT list(coalesce(CASE WHEN json_type(x.value) = 'OBJECT' THEN x.value ->> '$.key' ELSE x.key::VARCHAR END) ORDER BY x.key::INT) FROM json_each(CASE WHEN json_type(qs.c) = 'ARRAY' THEN qs.c END) x) ELSE [] END AS ks
  FROM qs LEFT JOIN gs ON gs.n = qs.n AND gs.qid = qs.qid WHERE qs.qid IS NOT NULL)"""
_P = "(probs ->> ('$.\"' || {0} || '\"'))::DOUBLE"


@C.add(f"""
WITH {PAIRS_SQL},
t AS (SELECT id, qid, found, CASE type WHEN 'choice' THEN list_transform(ks, lambda k: coalesce({_P.format('k')}, 0.0)) WHEN 'noul' THEN [coalesce({_P.format("'false'")}, 0.5), coalesce({_P.format("'true'")}, 0.5)]
  WHEN 'score' THEN list_transform(range(0, len(ks)), lambda i: coalesce({_P.format('i::VARCHAR')}, 0.0)) END AS t FROM pairs),
o AS (SELECT id, qid, t, CASE WHEN NOT found THEN 'no target' WHEN t IS NULL THEN 'type' WHEN len(t) > 0 AND len(list_filter(t, lambda x: x < 0)) = 0 AND abs(list_sum(t) - 1) <= 0.001 THEN 'ok' ELSE 'distribution' END AS outcome FROM t)
SELECT id, qid, outcome, CASE WHEN outcome = 'ok' THEN len(t) ELSE 0 END::INT AS options, CASE WHEN outcome = 'ok' THEN list_position(t, list_max(t)) - 1 END::INT AS top, CASE WHEN outcome = 'ok' THEN round(list_max(t) / list_sum(t), 9) END AS p FROM o""")
def target_vectors(spark, d):
    """The target of each question by its type, or why there is none."""
    t = J.targets(table(spark, d, "veribugbench_5q"))
    return t.select("id", "qid", "outcome", F.when(F.col("target").isNotNull(), F.size("target")).otherwise(0).alias("options"), dist.argmax(F.col("target")).alias("top"), F.round(F.array_max("target"), 9).alias("p"))


@C.add(f"""
WITH {HEADS_SQL}, j AS (SELECT id, qid, label, confidence, label_source, CASE WHEN json_type(probs) = 'OBJECT' THEN list_sort(json_keys(probs)) ELSE [] END AS ks, CASE WHEN json_type(probs) = 'OBJECT' THEN {_PROBS} ELSE [] END AS ps FROM heads WHERE qid IN ('risk', 'urgency')),
e AS (SELECT id, qid, CASE WHEN len(ps) = 0 THEN ['missing'] ELSE list_filter([CASE WHEN ks <> ['0', '1', '2', '3'] THEN 'keys' END, CASE WHEN len(list_filter(ps, lambda x: x IS NULL OR x < 0)) > 0 THEN 'negative' END,
  CASE WHEN ks = ['0', '1', '2', '3'] AND abs(list_sum(ps) - 1) > 0.001 THEN 'sum' END, CASE WHEN coalesce(label NOT IN ('0', '1', '2', '3'), TRUE) THEN 'label' WHEN ks = ['0', '1', '2', '3'] AND label <> ks[list_position(ps, list_max(ps))] THEN 'argmax' END,
  CASE WHEN coalesce(NOT (confidence >= 0 AND confidence <= 1), TRUE) THEN 'confidence' END, CASE WHEN coalesce(trim(label_source) = '', TRUE) THEN 'rationale' END], lambda x: x IS NOT NULL) END AS problems FROM j)
SELECT qid, p AS problem, count(*) AS n FROM (SELECT qid, unnest(problems) AS p FROM e) GROUP BY ALL""")
def judgment_problems(spark, d):
    """What is wrong with the judged scores, where the label source stands for the rationale."""
    j = R.decisions(table(spark, d, "veribugbench_5q")).filter(F.col("qid").isin("risk", "urgency"))
    bad = J.judgment_problems(F.col("keys"), F.col("probabilities"), F.col("label"), F.col("confidence"), F.col("label_source"), F.array(F.lit("gold")))
    return j.select("qid", F.explode(bad).alias("problem")).groupBy("qid", "problem").agg(F.count("*").alias("n"))


@C.add(f"""
WITH {HEADS_SQL}, s AS (SELECT id, qid, score, label, confidence, list_transform(['0', '1', '2', '3'], lambda k: coalesce(CASE WHEN json_type(probs) = 'OBJECT' THEN (probs ->> ('$."' || k || '"'))::DOUBLE END, 0.0)) AS p FROM heads WHERE qid IN ('risk', 'urgency') AND id IS NOT NULL),
m AS (SELECT *, list_transform(p, lambda x: greatest(x, 0.0)) AS c FROM s),
r AS (SELECT *, CASE WHEN list_sum(c) > 0 THEN list_transform(c, lambda x: x / list_sum(c)) ELSE [0.25, 0.25, 0.25, 0.25] END AS np FROM m),
x AS (SELECT *, (list_position(np, list_max(np)) - 1)::VARCHAR AS new_label, np[2] + 2 * np[3] + 3 * np[4] AS new_score FROM r)
SELECT DISTINCT id, qid, new_label, round(new_score, 6) AS new_score, array_to_string(list_filter([CASE WHEN len(list_filter(range(1, 5), lambda i: abs(p[i] - np[i]) > 1e-6)) > 0 THEN 'probabilities' END, CASE WHEN label IS DISTINCT FROM new_label THEN 'label' END,
  CASE WHEN abs(coalesce(score, new_score) - new_score) > 1e-5 THEN 'score' END], lambda v: v IS NOT NULL), ',') AS corrections,
  array_to_string(list_filter([CASE WHEN coalesce(NOT (confidence >= 0 AND confidence <= 1), TRUE) THEN 'invalid_confidence' END, CASE WHEN confidence < 0.5 THEN 'low_confidence' END], lambda v: v IS NOT NULL), ',') AS flags FROM x""")
def score_review(spark, d):
    """Scores after review: repaired label and expectation, what was corrected, and what is flagged."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter(F.col("qid").isin("risk", "urgency") & F.col("id").isNotNull())
    r = J.reviewed(h)
    return r.select("id", "qid", "new_label", F.round("new_score", 6).alias("new_score"), F.array_join("corrections", ",").alias("corrections"), F.array_join("flags", ",").alias("flags")).distinct()


@C.add("""
SELECT 'person_names' AS name, 260::BIGINT AS expected, count(*) AS got, count(*) = 260 AS kept FROM person_names
UNION ALL SELECT 'test_items', 300, count(*), count(*) = 300 FROM test_items UNION ALL SELECT 'region', 5, count(*), count(*) = 5 FROM region""")
def row_count_contract(spark, d):
    """The fixed tables have the rows that are promised."""
    return J.row_counts({n: table(spark, d, n) for n in ("person_names", "test_items", "region")}, {"person_names": 260, "test_items": 300, "region": 5})


@C.add("""
SELECT DISTINCT v.id, coalesce(p.maintainer, v.provenance.maintainer) AS maintainer, coalesce(v.provenance.license, '') AS license, coalesce(p.upstream_repo, v.provenance.source_instance_id) AS instance
FROM veribugbench_5q v LEFT JOIN projects p ON p.project_id = v.provenance.project_id WHERE v.id IS NOT NULL AND v.provenance IS NOT NULL""")
def provenance_patch(spark, d):
    """Provenance with what the project's table knows; the patch wins where it has a value."""
    p = table(spark, d, "projects").select("project_id", F.col("maintainer").alias("m"), F.col("upstream_repo").alias("u"))
    v = table(spark, d, "veribugbench_5q").filter("id is not null and provenance is not null").withColumn("project_id", F.col("provenance.project_id"))
    new = J.patched(F.col("provenance"), {"maintainer": F.col("m"), "source_instance_id": F.col("u")})
    out = v.join(p, "project_id", "left").select("id", new.alias("n"))
    return out.select("id", "n.maintainer", F.coalesce("n.license", F.lit("")).alias("license"), F.col("n.source_instance_id").alias("instance")).distinct()


@C.add("""
SELECT DISTINCT id, source, coalesce(provenance.eval_exclusion_reason, 'marked as excluded') AS reason FROM veribugbench_5q WHERE provenance.eval_excluded""")
def exclusion_sidecar(spark, d):
    """The records that evaluation leaves out, with the reason."""
    _, sidecar = J.excluded(table(spark, d, "veribugbench_5q"), F.col("provenance.eval_excluded"), F.col("provenance.eval_exclusion_reason"))
    return sidecar.select("id", "source", "reason").distinct()


@C.add("""
WITH v AS (SELECT id, outcome.resolved AS a, provenance.synthetic AS b FROM veribugbench_5q WHERE id IS NOT NULL),
s1 AS (SELECT DISTINCT id FROM v WHERE a AND NOT b), s2 AS (SELECT DISTINCT id FROM v WHERE a), s3 AS (SELECT DISTINCT id FROM v), s4 AS (SELECT DISTINCT id FROM batch_06_mux_4_1)
SELECT 'resolved and real' AS inner, 'resolved' AS outer, count(*) FILTER (WHERE id NOT IN (SELECT id FROM s2)) AS missing FROM s1
UNION ALL SELECT 'resolved', 'all', count(*) FILTER (WHERE id NOT IN (SELECT id FROM s3)) FROM s2
UNION ALL SELECT 'all', 'judged', (SELECT count(*) FROM s3 WHERE id NOT IN (SELECT id FROM s4 WHERE id IS NOT NULL)) """.replace(" AS inner,", ' AS "inner",').replace(" AS outer,", ' AS "outer",'))
def subset_chain(spark, d):
    """How many ids of each set the next one lacks."""
    v = table(spark, d, "veribugbench_5q").filter("id is not null")
    sets = [("resolved and real", v.filter("outcome.resolved and not provenance.synthetic")), ("resolved", v.filter("outcome.resolved")), ("all", v), ("judged", table(spark, d, "batch_06_mux_4_1"))]
    return J.subset_chain(sets, "id")


@C.add(f"""
WITH {PAIRS_SQL}, s AS (SELECT source, CASE WHEN NOT found THEN 1 ELSE 0 END AS skipped FROM pairs)
SELECT source, count(*) AS seen, sum(skipped)::BIGINT AS skipped, round(sum(skipped) / count(*)::DOUBLE, 9) AS ratio, sum(skipped) / count(*)::DOUBLE > 0.02 AS refused FROM s GROUP BY source""")
def skip_ratio_gate(spark, d):
    """Sources of which more than 2 % of the questions have no gold head."""
    t = J.targets(table(spark, d, "veribugbench_5q"), ("source",)).groupBy("source", (F.col("outcome") == "no target").alias("lost")).agg(F.count("*").alias("n"))
    return J.skip_gate(t, "source", F.col("lost"), "n", 0.02)


@C.add(f"""
WITH {PAIRS_SQL}, h AS (SELECT coalesce(source, 'unknown') AS source, coalesce(label_source, 'unspecified') AS label_source, id, coalesce(list_extract(map_extract(tw, qid), 1), 1.0) AS w FROM pairs WHERE found),
k AS (SELECT 'by_source' AS kind, source AS value, id, w FROM h UNION ALL SELECT 'by_label_source', label_source, id, w FROM h)
SELECT kind, value, count(DISTINCT id) AS records, count(*) AS decisions, round(sum(w), 6) AS mass, round(avg(w), 9) AS mean_weight, round(100.0 * sum(w) / sum(sum(w)) OVER (PARTITION BY kind), 6) AS percent FROM k GROUP BY kind, value""")
def training_mass_report(spark, d):
    """The weight of the asked decisions by source and by label source: their training weights, 1 where none is given."""
    v = table(spark, d, "veribugbench_5q").select("id", "source", "training_weights", F.explode(nested.heads(F.col("questions"))).alias("q"), nested.heads(F.col("gold")).alias("g"))
    h = v.withColumn("h", F.get(F.filter("g", lambda x: x["qid"] == F.col("q.qid")), F.lit(0))).filter("h is not null")
    h = h.select("id", F.coalesce("source", F.lit("unknown")).alias("by_source"), F.coalesce("h.label_source", F.lit("unspecified")).alias("by_label_source"), F.coalesce(F.try_element_at("training_weights", "q.qid"), F.lit(1.0)).alias("w"))
    long = h.select("id", "w", F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("by_source", "by_label_source")])).alias("k")).select("id", "w", "k.*")
    sums = long.groupBy("kind", "value").agg(F.count_distinct("id").alias("records"), F.count("*").alias("decisions"), F.sum("w").alias("m"), F.avg("w").alias("a"))
    from pyspark.sql import Window

    return sums.select("kind", "value", "records", "decisions", F.round("m", 6).alias("mass"), F.round("a", 9).alias("mean_weight"), F.round(100.0 * F.col("m") / F.sum("m").over(Window.partitionBy("kind")), 6).alias("percent"))


@C.add("""
WITH b AS (SELECT id, arg_min(source_group, row(ingested_at, source)) AS grp FROM veribugbench_5q WHERE id IS NOT NULL AND source IS NOT NULL AND ingested_at IS NOT NULL GROUP BY id),
a AS (SELECT id, count(*) AS judgments, max(batch_index) AS last_batch FROM batch_06_mux_4_1 WHERE id IS NOT NULL GROUP BY id),
m AS (SELECT source_group AS grp, min(project_id) AS project FROM projects GROUP BY source_group)
SELECT b.id, b.grp AS source_group, judgments, last_batch, project FROM b JOIN a USING (id) LEFT JOIN m ON m.grp = b.grp""")
def three_way_merge(spark, d):
    """Records with their judgments, and the project of their group where one is known."""
    v = table(spark, d, "veribugbench_5q").filter("id is not null and source is not null and ingested_at is not null")
    base = v.groupBy("id").agg(F.min_by("source_group", F.struct("ingested_at", "source")).alias("source_group"))
    judged = table(spark, d, "batch_06_mux_4_1").filter("id is not null").groupBy("id").agg(F.count("*").alias("judgments"), F.max("batch_index").alias("last_batch"))
    m = table(spark, d, "projects").groupBy("source_group").agg(F.min("project_id").alias("project"))
    return base.join(judged, "id").join(m, "source_group", "left").select("id", "source_group", "judgments", "last_batch", "project")


@C.add("""
WITH g AS (SELECT source_group, count(DISTINCT id) AS size, min(id) AS first FROM veribugbench_5q WHERE source_group IS NOT NULL AND id IS NOT NULL GROUP BY source_group)
SELECT source_group, size, first, row_number() OVER (ORDER BY size DESC, first, source_group) AS place FROM g""")
def groups_by_size(spark, d):
    """Groups in the order of size, the largest first, and of their first member."""
    g = table(spark, d, "veribugbench_5q").filter("source_group is not null and id is not null").groupBy("source_group").agg(F.count_distinct("id").alias("size"), F.min("id").alias("first"))
    return windows.ordered_number(g, [F.col("size").desc(), F.col("first"), F.col("source_group")], None, "place")


@C.add(f"""
WITH {HEADS_SQL}, h AS (SELECT id, coalesce(source, 'unknown') AS source, coalesce(label_source, 'unspecified') AS label_source, qid, {_PROBS} AS ps FROM heads WHERE json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 1 AND qid IN ('evidence_sufficient', 'next_action', 'root_cause_type', 'risk', 'urgency')),
n AS (SELECT source, label_source, CASE qid WHEN 'evidence_sufficient' THEN 'noul' WHEN 'risk' THEN 'score' WHEN 'urgency' THEN 'score' ELSE 'choice' END AS qtype, list_transform(ps, lambda x: greatest(x, 0.0) / list_sum(list_transform(ps, lambda y: greatest(y, 0.0)))) AS g FROM h WHERE list_sum(list_transform(ps, lambda y: greatest(y, 0.0))) > 0),
z AS (SELECT *, list_transform(g, lambda x: sqrt(greatest(x, 0.02))) AS e FROM n),
o AS (SELECT source, label_source, qtype, g, list_transform(e, lambda x: x / list_sum(e)) AS p FROM z),
m AS (SELECT source, label_source, qtype, CASE WHEN qtype = 'noul' THEN ((p[2] >= 0.5) = (g[2] >= 0.5))::INT::DOUBLE ELSE (list_position(p, list_max(p)) = list_position(g, list_max(g)))::INT::DOUBLE END AS correct, list_max(p) AS confidence,
  list_sum(list_transform(range(1, len(g) + 1), lambda i: (p[i] - g[i]) * (p[i] - g[i]))) AS brier FROM o),
b AS (SELECT *, {BIN_SQL} AS bin FROM m),
r AS (SELECT CASE WHEN grouping(qtype) = 0 THEN 'qtype' WHEN grouping(label_source) = 0 THEN 'label_source' WHEN grouping(source) = 0 THEN 'source' ELSE 'overall' END AS grouping, coalesce(qtype, label_source, source, '') AS value, bin, count(*) AS n, sum(correct) AS correct, sum(confidence) AS confidence, sum(brier) AS bs FROM b GROUP BY GROUPING SETS ((bin), (qtype, bin), (label_source, bin), (source, bin)))
SELECT grouping, value, sum(n)::BIGINT AS n, round(sum(correct) / sum(n), 8) AS accuracy, round(sum(bs) / sum(n), 8) AS brier_score, round(sum(CASE WHEN bin IS NULL THEN 0 ELSE abs(confidence - correct) END) / sum(n), 8) AS ece FROM r GROUP BY grouping, value""")
def metrics_four_ways(spark, d):
    """Metrics of a flattened gold as the prediction, overall, by type, label source and source, from one pass."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter((F.size("probabilities") > 1) & F.col("qid").isin(*R.QUESTION_TYPES) & (dist.total(F.transform("probabilities", lambda x: F.greatest(x, F.lit(0.0)))) > 0))
    kinds = F.create_map(*[F.lit(x) for kv in R.QUESTION_TYPES.items() for x in kv])
    h = h.select(F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("label_source", F.lit("unspecified")).alias("label_source"), kinds[F.col("qid")].alias("qtype"), dist.normalize(F.col("probabilities")).alias("g"))
    h = h.withColumn("p", F.transform("g", lambda x: F.sqrt(F.greatest(x, F.lit(0.02)))))
    r = M.grouped_report(M.observations(h, F.col("qtype"), F.col("p"), F.col("g")), ["qtype", "label_source", "source"])
    return r.select("grouping", "value", "n", *[F.round(c, 8).alias(c) for c in ("accuracy", "brier_score", "ece")])


@C.add(f"""
WITH {HEADS_SQL}, l AS (SELECT id, min(label) FILTER (WHERE qid = 'risk') AS risk, min(label) FILTER (WHERE qid = 'urgency') AS urgency, min(label_source) FILTER (WHERE qid = 'next_action') AS action_source FROM heads WHERE id IS NOT NULL GROUP BY id),
f AS (SELECT id, list_sort(list_distinct(flatten(list(coalesce(provenance.trust_flags, []))))) AS flags, min(source_group) AS repository FROM veribugbench_5q WHERE id IS NOT NULL GROUP BY id)
SELECT f.id, array_to_string(flags, ',') AS flags, repository, risk, urgency, action_source FROM f LEFT JOIN l USING (id)""")
def evidence_view(spark, d):
    """What a reviewer sees of a record: its flags and group, the labels it has, and where its action label comes from."""
    v = table(spark, d, "veribugbench_5q").filter("id is not null")
    none = F.array().cast("array<string>")
    f = v.groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("provenance.trust_flags", none))))).alias("flags"), F.min("source_group").alias("repository"))
    own = lambda qid, c: F.min(F.when(F.col("qid") == qid, F.col(c)))
    labels = R.decisions(v).groupBy("id").agg(own("risk", "label").alias("risk"), own("urgency", "label").alias("urgency"), own("next_action", "label_source").alias("action_source"))
    return f.join(labels, "id", "left").select("id", F.array_join("flags", ",").alias("flags"), "repository", "risk", "urgency", "action_source")


_BANNED = ("buggy_rtl", "fix", "patch", "probabilities", "diff")


@C.add(f"""
SELECT k AS banned, count(*) AS n FROM (SELECT unnest(list_filter([{", ".join(f"CASE WHEN regexp_matches(coalesce(state, ''), '\"{k}\\\\*\"\\s*:') THEN '{k}' END" for k in _BANNED)}], lambda x: x IS NOT NULL)) AS k FROM veribugbench_5q) GROUP BY k""")
def banned_keys(spark, d):
    """States that carry a key of a list, by key."""
    return table(spark, d, "veribugbench_5q").select(F.explode(J.banned_keys(F.col("state"), _BANNED)).alias("banned")).groupBy("banned").agg(F.count("*").alias("n"))
