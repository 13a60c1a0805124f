"""Checks, gates, ladders and excerpts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decidra.functions import dist
from decidra.functions import text as tx
from decidra.operators import excerpts, fingerprints, quality
from decidra.operators import records as R
from decidra.plans.base import Catalogue, decoded_sql, table
from decidra.plans.decision_queries import _PROBS
from decidra.plans.split_queries import HEADS_SQL

C = Catalogue()
_SPLIT = "lower(regexp_replace(provenance.split, '^\\s+|\\s+$', '', 'g'))"
_FIVE = "['evidence_sufficient', 'next_action', 'risk', 'root_cause_type', 'urgency']"


_JSON_TREE = "CASE WHEN json_type({0}) IN ('OBJECT', 'ARRAY') THEN {0} END"
_KEYED = "SELECT r.n AS n, CASE WHEN json_type({0}) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, e.value AS v FROM r, json_each({0}) e"
_PROB_SUM = "(SELECT coalesce(sum(CASE WHEN json_type(p.value) = 'OBJECT' THEN (p.value ->> '$.p')::DOUBLE ELSE (p.value ->> '$')::DOUBLE END), 0) FROM json_each(CASE WHEN json_type(v -> '$.probabilities') IN ('OBJECT', 'ARRAY') THEN v -> '$.probabilities' END) p)"


@C.add(f"""
WITH d AS (SELECT row_number() OVER () AS n, id, state, {decoded_sql("questions")} AS q0, {decoded_sql("gold")} AS g0 FROM veribugbench_5q),
r AS (SELECT n, id, state, {_JSON_TREE.format("q0")} AS q, {_JSON_TREE.format("g0")} AS g FROM d),
qs AS ({_KEYED.format("q")}), gs AS ({_KEYED.format("g")}),
qk AS (SELECT n, list_sort(list_distinct(list(qid))) AS ks FROM qs WHERE qid IS NOT NULL GROUP BY n), gk AS (SELECT n, list_sort(list_distinct(list(qid))) AS ks FROM gs WHERE qid IS NOT NULL GROUP BY n),
types AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{t}')" for k, t in sorted(R.QUESTION_TYPES.items()))}) t(qid, kind)),
e AS (SELECT CASE WHEN id IS NULL THEN 'id' END AS e FROM r UNION ALL SELECT CASE WHEN state IS NULL THEN 'state' END FROM r
  UNION ALL SELECT CASE WHEN q IS NULL THEN 'questions' WHEN coalesce(ks, []) <> {_FIVE} THEN 'question keys' END FROM r LEFT JOIN qk USING (n)
  UNION ALL SELECT CASE WHEN g IS NULL THEN 'gold' WHEN coalesce(ks, []) <> {_FIVE} THEN 'gold keys' END FROM r LEFT JOIN gk USING (n)
  UNION ALL SELECT qid || ': type' FROM qs JOIN types USING (qid) WHERE (v ->> '$.type') IS DISTINCT FROM kind
  UNION ALL SELECT qid || ': sum' FROM gs JOIN types USING (qid) WHERE json_type(v -> '$.probabilities') IN ('OBJECT', 'ARRAY') AND abs({_PROB_SUM} - 1) > 0.001)
SELECT e AS error, count(*) AS n FROM e WHERE e IS NOT NULL GROUP BY e""")
def contract_errors(spark, d):
    """Records by how they break the question contract."""
    return quality.contract_errors(table(spark, d, "veribugbench_5q")).groupBy("error").agg(F.count("*").alias("n"))


@C.add(f"""
WITH g AS (SELECT source_group, list_sort(list_distinct(list({_SPLIT}))) AS s FROM veribugbench_5q WHERE source_group IS NOT NULL AND provenance.split IS NOT NULL GROUP BY source_group)
SELECT a AS split_a, b AS split_b, count(*) AS groups FROM (SELECT s, unnest(s) AS a FROM g), unnest(s) u(b) WHERE a < b GROUP BY a, b""")
def shared_groups(spark, d):
    """Lineage groups that each two splits share."""
    rows = table(spark, d, "veribugbench_5q").select("source_group", F.lower(F.regexp_replace(F.col("provenance.split"), r"^\s+|\s+$", "")).alias("split"))
    return quality.shared_between_splits(rows, "source_group", "split")


@C.add("""
SELECT flag, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN length(coalesce(text, '')) < 200 THEN 'short' END, CASE WHEN lang IS NULL THEN 'no language' END, CASE WHEN n_chars IS DISTINCT FROM length(text) THEN 'stale length' END, CASE WHEN crawled_at < created_at THEN 'crawled early' END], lambda x: x IS NOT NULL)) AS flag FROM documents) GROUP BY flag""")
def document_flags(spark, d):
    """Documents by flags that independent conditions raise."""
    conditions = {"short": F.length(F.coalesce("text", F.lit(""))) < 200, "no language": F.col("lang").isNull(), "stale length": ~F.col("n_chars").eqNullSafe(F.length("text").cast("long")), "crawled early": F.col("crawled_at") < F.col("created_at")}
    return table(spark, d, "documents").select(F.explode(quality.flags(conditions)).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@C.add("SELECT flag, count(*) AS n, count(DISTINCT id) AS ids FROM (SELECT id, unnest(list_intersect(coalesce(provenance.trust_flags, []), ['oracle_hidden', 'log_clipped'])) AS flag FROM veribugbench_5q) GROUP BY flag")
def evaluation_exclusions(spark, d):
    """Records by those of their flags that exclude from evaluation."""
    f = quality.excluded_by(F.col("provenance.trust_flags"), ["oracle_hidden", "log_clipped"])
    return table(spark, d, "veribugbench_5q").select("id", F.explode(f).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@C.add("""
SELECT p AS p_true, count(*) AS n FROM (SELECT CASE WHEN outcome.verification = 'verified' THEN 0.95 WHEN outcome.resolved THEN 0.8 WHEN outcome.fault_operator IS NOT NULL THEN 0.6 ELSE 0.3 END::DOUBLE AS p FROM veribugbench_5q) GROUP BY p""")
def evidence_ladder(spark, d):
    """Records by the fixed evidence distribution that their outcome gives."""
    pair = quality.fixed_pair([(F.col("outcome.verification") == "verified", 0.95), (F.col("outcome.resolved"), 0.8), (F.col("outcome.fault_operator").isNotNull(), 0.6)], 0.3)
    return table(spark, d, "veribugbench_5q").select(pair["true"].alias("p_true")).groupBy("p_true").agg(F.count("*").alias("n"))


@C.add("""
WITH m AS (SELECT id, unnest(map_keys(coalesce(training_weights, MAP {}))) AS k FROM veribugbench_5q), x AS (SELECT DISTINCT id, k FROM m WHERE id IS NOT NULL UNION SELECT id, 'audit' FROM veribugbench_5q WHERE id IS NOT NULL)
SELECT k AS head, count(*) AS n FROM x GROUP BY k""")
def map_extension(spark, d):
    """Weights with an added entry that never overwrites, counted by entry."""
    base = F.coalesce("training_weights", F.from_json(F.lit("{}"), "map<string,double>"))
    m = quality.extended(base, F.create_map(F.lit("audit"), F.lit(0.1), F.lit("risk"), F.lit(9.0)))
    kept = F.map_filter(m, lambda k, v: ~((k == "risk") & (v == 9.0)))
    return table(spark, d, "veribugbench_5q").filter("id is not null").select("id", F.explode(F.map_keys(kept)).alias("head")).distinct().groupBy("head").agg(F.count("*").alias("n"))


@C.add(f"""
WITH {HEADS_SQL}, l AS (SELECT qid, label FROM heads WHERE qid IN ('risk', 'urgency'))
SELECT qid, lv AS level, count(*) FILTER (WHERE label = lv) AS n FROM l, (VALUES ('0'), ('1'), ('2'), ('3'), ('4')) v(lv) GROUP BY qid, lv""")
def level_counts(spark, d):
    """Stated score levels, each counted, also those that never occur."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter(F.col("qid").isin("risk", "urgency"))
    return quality.filled_levels(h, "qid", F.col("label"), ["0", "1", "2", "3", "4"])


@C.add(f"""
WITH {HEADS_SQL}, p AS (SELECT qid, score, {_PROBS} AS ps FROM heads WHERE qid IN ('risk', 'urgency') AND json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 0),
x AS (SELECT qid, abs((list_position(ps, list_max(ps)) - 1) - round(score)) AS off FROM p WHERE score IS NOT NULL)
SELECT qid, count(*) AS n, count(*) FILTER (WHERE off <= 1) AS within_one, count(*) FILTER (WHERE off = 0) AS exact FROM x GROUP BY qid""")
def within_one_level(spark, d):
    """Scores whose rounded value is at most one level from the likeliest."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter(F.col("qid").isin("risk", "urgency") & (F.size("probabilities") > 0) & F.col("score").isNotNull())
    off = F.abs(dist.argmax(F.col("probabilities")) - F.round("score"))
    return h.withColumn("off", off).groupBy("qid").agg(F.count("*").alias("n"), F.count_if(F.col("off") <= 1).alias("within_one"), F.count_if(F.col("off") == 0).alias("exact"))


@C.add("""
WITH e AS (SELECT user_id, event_id, count(*) FILTER (WHERE event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events WHERE user_id IS NOT NULL)
SELECT user_id, count(*) AS attempts FROM e WHERE before = 0 GROUP BY user_id""")
def sequential_fallback(spark, d):
    """Each user's events in order up to the first purchase: what a fallback with an early stop would run."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    e = table(spark, d, "events").filter("user_id is not null").withColumn("before", F.coalesce(F.max(F.col("event_type") == "purchase").over(order), F.lit(False)))
    return e.filter("not before").groupBy("user_id").agg(F.count("*").alias("attempts"))


@C.add("""
WITH p AS (SELECT project_id, 1 AS k FROM projects WHERE project_id IS NOT NULL),
m AS (SELECT DISTINCT p.project_id AS member, p.source_group AS family, CASE WHEN p.testbench IS NULL THEN NULL ELSE 'bench' END AS signal FROM projects p WHERE p.source_group IS NOT NULL AND p.project_id IS NOT NULL
  UNION SELECT p.project_id, p.source_group, CASE WHEN p.maintainer IS NULL THEN NULL ELSE 'maintained' END FROM projects p WHERE p.source_group IS NOT NULL AND p.project_id IS NOT NULL),
s AS (SELECT family, count(DISTINCT member) AS size FROM m GROUP BY family)
SELECT family, signal, count(DISTINCT member) AS n, count(DISTINCT member) = any_value(size) AS uniform FROM m JOIN s USING (family) WHERE signal IS NOT NULL GROUP BY family, signal""")
def family_signals(spark, d):
    """Signals that all or some projects of a lineage group show."""
    p = table(spark, d, "projects").filter("source_group is not null and project_id is not null")
    signals = F.array(F.when(F.col("testbench").isNotNull(), F.lit("bench")), F.when(F.col("maintainer").isNotNull(), F.lit("maintained")))
    m = p.select(F.col("project_id").alias("member"), F.col("source_group").alias("family"), F.explode(signals).alias("signal"))
    return quality.uniform_signals(m, "family", "signal")


@C.add("""
WITH c AS (SELECT DISTINCT doc_id, source AS class FROM documents WHERE lang IS NOT NULL)
SELECT 'unassigned' AS check_name, count(*) AS n_bad FROM (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL EXCEPT SELECT doc_id FROM c) HAVING count(*) > 0""")
def partition_check(spark, d):
    """Whether sources partition the documents with a language, against all documents."""
    docs = table(spark, d, "documents")
    return quality.is_partition(docs.filter("lang is not null").select("doc_id", "source").distinct(), "doc_id", docs.select("doc_id"))


@C.add("""
WITH l AS (SELECT row_no, len(string_split(replace(replace(regexp_replace(buggy_rtl, '(\\r\\n|\\r|\\n)$', ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))) AS n FROM batch_06_mux_4_1 WHERE buggy_rtl IS NOT NULL)
SELECT row_no, n::BIGINT AS lines FROM l WHERE n > 60""")
def long_designs(spark, d):
    """Designs that don't fit the header of an excerpt."""
    n = F.size(tx.lines(F.col("buggy_rtl"))).cast("long")
    return table(spark, d, "batch_06_mux_4_1").filter("buggy_rtl is not null").select("row_no", n.alias("lines")).filter("lines > 60")


@C.add()
def excerpt_windows(spark, d):
    """Excerpts of designs around their always blocks: lines shown, windows, whether they overlap, length rendered."""
    b = table(spark, d, "batch_06_mux_4_1").filter("buggy_rtl is not null")
    ls = tx.lines(F.col("buggy_rtl"))
    anchors = F.filter(F.sequence(F.lit(1), F.greatest(F.size(ls), F.lit(1))), lambda i: F.coalesce(F.get(ls, i - 1).contains("always"), F.lit(False)))
    w = b.select("row_no", "buggy_rtl", F.size(ls).alias("n"), anchors.alias("anchors")).withColumn("ranges", excerpts.windows_of(F.col("n"), F.lit(12), F.col("anchors")))
    return w.select("row_no", "n", excerpts.covered_lines(F.col("ranges")).alias("shown"), F.size("ranges").alias("windows"), excerpts.overlapping(F.col("ranges")).alias("overlapping"), F.length(excerpts.rendered(F.col("buggy_rtl"), F.col("ranges"))).alias("chars"))


@C.add()
def file_fingerprints(spark, d):
    """Hash and size of the files of all tables, by name."""
    files = fingerprints.file_digests(spark, d, "*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "sha256", "bytes")
