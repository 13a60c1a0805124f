"""Transcripts, runs, pairs of runs, fingerprints and small reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decidra.functions import dist, hashing, schedule
from decidra.functions import text as tx
from decidra.operators import fingerprints, leakage, metrics, quality, replay
from decidra.operators import records as R
from decidra.plans.base import Catalogue, table
from decidra.plans.decision_queries import _PROBS
from decidra.plans.split_queries import _CALIBRATION, _STABLE, HEADS_SQL, SEED

C = Catalogue()

_PASS, _FAIL, _SUMMARY, _ERROR = "PASS|clean|passes", "FAIL|mismatch|[0-9]+ ns ERROR", "retry ([0-9]+)", "ERROR|fatal"
_LINES = "string_split(replace(replace(regexp_replace(coalesce(text, ''), '(\\r\\n|\\r|\\n)$', ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
_LAST = "CASE WHEN regexp_matches(t, '{0}') THEN length(t) - length(regexp_split_to_array(t, '{0}')[-1]) ELSE -1 END"


@C.add(f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract(coalesce(text, ''), '{_SUMMARY}', 1) AS n, len(list_filter({_LINES}, lambda x: regexp_matches(x, '{_ERROR}'))) AS errors FROM documents),
p AS (SELECT *, CASE WHEN n <> '' THEN length(regexp_extract(t, '(?s)^.*?(?:{_SUMMARY})')) ELSE -1 END AS e FROM d),
s AS (SELECT doc_id, errors, n, greatest({_LAST.format(_PASS)}, CASE WHEN n <> '' AND n::BIGINT = 0 THEN e ELSE -1 END) AS pass_at, greatest({_LAST.format(_FAIL)}, CASE WHEN n <> '' AND n::BIGINT > 0 THEN e ELSE -1 END, CASE WHEN errors > 0 THEN 0 ELSE -1 END) AS fail_at FROM p)
SELECT doc_id, pass_at::INT AS pass_at, fail_at::INT AS fail_at, CASE WHEN n <> '' THEN n::BIGINT END AS summary, errors::INT AS error_lines, CASE WHEN fail_at >= 0 THEN 'failed' WHEN pass_at >= 0 THEN 'passed' ELSE 'unknown' END AS verdict FROM s""")
def verdict_signals(spark, d):
    """Where the last pass and fail marks of each text end, its summary count, its error lines, and what follows."""
    return table(spark, d, "documents").select("doc_id", replay.signals(F.col("text"), _PASS, _FAIL, _SUMMARY, _ERROR).alias("s")).select("doc_id", "s.*")


_RUNS = "SELECT project_id, golden_rc, deterministic, unnest(instances) AS i FROM sim_sweep"


@C.add(f"""
WITH r AS ({_RUNS})
SELECT project_id, i.instance AS instance, CASE WHEN golden_rc IS NULL THEN 'tool_missing' WHEN i.rc = 124 THEN 'timeout' WHEN golden_rc <> 0 THEN 'compile_failed' WHEN i.rc IS NULL THEN 'unknown' WHEN i.verdict = 'killed' THEN 'failed' WHEN i.verdict = 'survived' THEN 'passed'
  WHEN coalesce(regexp_matches(i.err, 'stopped|licen[cs]e'), FALSE) THEN 'tool_error' WHEN i.rc = 137 THEN 'timeout' WHEN i.rc <> 0 THEN 'failed' ELSE 'unknown' END AS verdict FROM r""")
def run_verdicts(spark, d):
    """What each mutant's run came to, from its project's golden run as the compile step and its own code, verdict and messages."""
    r = table(spark, d, "sim_sweep").select("project_id", "golden_rc", F.explode("instances").alias("i"))
    told = F.when(F.col("i.verdict") == "killed", "failed").when(F.col("i.verdict") == "survived", "passed").otherwise("unknown")
    v = replay.run_verdict(tool=F.col("golden_rc").isNotNull(), compile_timeout=F.col("i.rc") == 124, compile_rc=F.col("golden_rc"), ran=F.col("i.rc").isNotNull(), told=told, tool_error=F.col("i.err").rlike("stopped|licen[cs]e"), run_timeout=F.col("i.rc") == 137, run_rc=F.col("i.rc"))
    return r.select("project_id", "i.instance", v.alias("verdict"))


_ATTEMPTS = f"""
r AS ({_RUNS}),
attempts AS (SELECT project_id AS c, i.operator_id AS b, 'before' AS side, CASE i.verdict WHEN 'killed' THEN 'failed' WHEN 'survived' THEN 'passed' WHEN 'error' THEN 'compile_failed' ELSE 'unknown' END AS v FROM r
  UNION ALL SELECT project_id, i.operator_id, 'after', CASE WHEN golden_rc IS NULL THEN 'unknown' WHEN golden_rc = 0 THEN 'passed' ELSE 'compile_failed' END FROM r),
ranked AS (SELECT *, CASE WHEN v = 'passed' THEN 0 WHEN v IN ('failed', 'compile_failed') THEN 1 ELSE 2 END AS k FROM attempts),
pairs AS (SELECT c, b, arg_min(v, row(k, v)) FILTER (WHERE side = 'before') AS x, arg_min(v, row(k, v)) FILTER (WHERE side = 'after') AS y FROM ranked GROUP BY c, b)"""


def _attempts(spark, d):
    r = table(spark, d, "sim_sweep").select(F.col("project_id").alias("case"), "golden_rc", F.explode("instances").alias("i"))
    v = F.col("i.verdict")
    before = r.select("case", F.col("i.operator_id").alias("backend"), F.lit("before").alias("side"), F.when(v == "killed", "failed").when(v == "survived", "passed").when(v == "error", "compile_failed").otherwise("unknown").alias("verdict"))
    after = r.select("case", F.col("i.operator_id").alias("backend"), F.lit("after").alias("side"), F.when(F.col("golden_rc").isNull(), "unknown").when(F.col("golden_rc") == 0, "passed").otherwise("compile_failed").alias("verdict"))
    return before.unionByName(after)


@C.add(f"WITH {_ATTEMPTS} SELECT c AS \"case\", b AS backend, x AS before, y AS after FROM pairs")
def replay_pairs(spark, d):
    """Runs before and after a change paired by case and backend."""
    return replay.paired(_attempts(spark, d))


_FAILS = "IN ('failed', 'compile_failed')"


@C.add(f"""
WITH {_ATTEMPTS},
g AS (SELECT c, list_sort(list(DISTINCT b) FILTER (WHERE x {_FAILS} AND y = 'passed')) AS verified, list_sort(list(DISTINCT b) FILTER (WHERE x {_FAILS} AND y {_FAILS})) AS both_failed, list_sort(list(DISTINCT b) FILTER (WHERE x = 'passed')) AS passing,
  bool_and((x IS NULL OR x = 'compile_failed') AND (y IS NULL OR y = 'compile_failed')) AS no_build FROM pairs GROUP BY c)
SELECT c AS "case", CASE WHEN coalesce(len(verified), 0) > 0 THEN 'verified' WHEN coalesce(len(passing), 0) > 0 THEN 'undetected' WHEN no_build THEN 'cannot build' WHEN coalesce(len(both_failed), 0) > 0 THEN 'survives' ELSE 'unusable' END AS class, verified[1] AS deciding,
  coalesce(array_to_string(verified, ','), '') AS verified, coalesce(array_to_string(both_failed, ','), '') AS both_failed, coalesce(array_to_string(passing, ','), '') AS passing FROM g""")
def replay_classes(spark, d):
    """What the pairs of each case show, and the backends that show it."""
    c = replay.classified(_attempts(spark, d))
    return c.select("case", "class", "deciding", *[F.array_join(n, ",").alias(n) for n in ("verified", "both_failed", "passing")])


@C.add(f"""
WITH {_ATTEMPTS}, g AS (SELECT c, count(*) FILTER (WHERE x {_FAILS} AND y = 'passed') > 0 AS verified, min(b) FILTER (WHERE x {_FAILS} AND y = 'passed') AS deciding, string_agg(b || '=' || x, ',' ORDER BY b) FILTER (WHERE x IS NOT NULL) AS verdicts FROM pairs GROUP BY c)
SELECT c AS "case", verified, deciding, verdicts FROM g""")
def replay_summary(spark, d):
    """What may be told of a case without its state after: whether a failure was confirmed, by which backend, and the verdicts before."""
    a = _attempts(spark, d)
    s = replay.summaries(a, replay.classified(a))
    return s.select("case", "verified", "deciding", F.array_join(F.transform(F.map_entries("verdicts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("verdicts"))


@C.add(f"""
WITH r AS ({_RUNS}), o AS (SELECT project_id, i.operator_id AS op, i.instance AS instance, i.verdict AS v, count(*) FILTER (WHERE i.verdict IN ('killed', 'survived')) OVER (PARTITION BY project_id ORDER BY i.operator_id, i.instance, i.verdict, i.rc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS settled FROM r)
SELECT project_id, count(*) AS attempts, count(*) FILTER (WHERE v IN ('killed', 'survived')) AS decisive FROM o WHERE settled = 0 GROUP BY project_id""")
def fallback_attempts(spark, d):
    """The attempts of each project, in order, up to the first decisive verdict."""
    r = table(spark, d, "sim_sweep").select("project_id", F.explode("instances").alias("i")).select("project_id", "i.operator_id", "i.instance", "i.verdict", "i.rc")
    tried = replay.decisive_prefix(r, "project_id", ["operator_id", "instance", "verdict", "rc"], "verdict", ["killed", "survived"])
    return tried.groupBy("project_id").agg(F.count("*").alias("attempts"), F.count_if(F.col("verdict").isin("killed", "survived")).alias("decisive"))


@C.add(f"""
WITH s AS (SELECT id, CASE WHEN s = 'validation' THEN c ELSE s END AS split FROM (SELECT id, {_STABLE.format(g="source_group")} AS s, {_CALIBRATION.format(g="source_group")} AS c FROM veribugbench_5q WHERE id IS NOT NULL))
SELECT coalesce(split, 'none') AS split, count(*) AS n, sha256(string_agg(id, chr(10) ORDER BY id)) AS record_ids FROM s GROUP BY 1""")
def split_digests(spark, d):
    """The digest of the sorted ids of each split, to be compared with a published one."""
    s = hashing.stable_split(F.col("source_group"), SEED)
    four = F.when(s == "validation", hashing.calibration_half(F.col("source_group"), SEED)).otherwise(s)
    rows = table(spark, d, "veribugbench_5q").filter("id is not null").select("id", F.coalesce(four, F.lit("none")).alias("split"))
    return fingerprints.sorted_digest(rows, "split", "id").withColumnRenamed("sha256", "record_ids")


@C.add("""
WITH s AS (SELECT coalesce(split, 'none') AS k, sha256(string_agg(item_id::VARCHAR, chr(10) ORDER BY item_id::VARCHAR)) AS v FROM test_items GROUP BY 1)
SELECT sha256('{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}') AS fingerprint FROM s""")
def dataset_fingerprint(spark, d):
    """One fingerprint of the held-out items from those of their splits."""
    return fingerprints.rolled_up(fingerprints.sorted_digest(table(spark, d, "test_items"), "split", "item_id"), "split", "sha256")


@C.add("""
SELECT item_id, 'case_' || lpad((item_id % 1000)::VARCHAR, 3, '0') || '_' || substr(sha256('{"benchmark":"' || benchmark || '","item_id":' || item_id || ',"split":"' || split || '"}'), 1, 8) AS case_id FROM test_items WHERE benchmark IS NOT NULL AND split IS NOT NULL""")
def canonical_ids(spark, d):
    """Ids from the canonical JSON of a record, whatever the order of its members."""
    i = table(spark, d, "test_items").filter("benchmark is not null and split is not null")
    text = fingerprints.canonical_json(F.to_json(F.struct("split", "item_id", "benchmark")))
    return i.select("item_id", hashing.numbered_id(F.col("item_id") % 1000, text).alias("case_id"))


@C.add("""
SELECT event_id, round(sum(value * w) OVER s, 4) AS total, (sum(CASE WHEN value IS NOT NULL THEN w END) OVER s)::BIGINT AS weight FROM (SELECT *, 1 + event_id % 7 AS w FROM events WHERE user_id IS NOT NULL) WINDOW s AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")
def rolling_weighted_100(spark, d):
    """Each user's last hundred values, summed by their sizes, and the sizes: a size-weighted mean is their quotient."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-99, 0)
    size = 1 + F.col("event_id") % 7
    return table(spark, d, "events").filter("user_id is not null").select("event_id", F.round(F.sum(F.col("value") * size).over(w), 4).alias("total"), F.sum(F.when(F.col("value").isNotNull(), size)).over(w).alias("weight"))


@C.add("""
WITH d AS (SELECT event_type, ts::DATE AS day, max(value) AS v FROM events GROUP BY 1, 2)
SELECT event_type, day::VARCHAR AS day, round(v, 6) AS v, coalesce(v > max(v) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS improved FROM d""")
def best_so_far_max(spark, d):
    """Daily maxima by type, and whether each is above all before."""
    days = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("v"))
    before = F.max("v").over(Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    return days.select("event_type", F.col("day").cast("string").alias("day"), F.round("v", 6).alias("v"), F.coalesce(F.col("v") > before, F.lit(True)).alias("improved"))


@C.add("SELECT event_id, user_id, round(value, 6) AS value FROM events WHERE event_id % 10 = 0 OR event_id = (SELECT max(event_id) FROM events)")
def periodic_metrics(spark, d):
    """The values of every tenth step and of the last one."""
    e = table(spark, d, "events")
    last = e.agg(F.max("event_id").alias("last"))
    rows = e.join(F.broadcast(last), (F.col("event_id") % 10 == 0) | (F.col("event_id") == F.col("last")))  # last is one row
    return rows.select("event_id", "user_id", F.round("value", 6).alias("value"))


@C.add("""
WITH c AS (SELECT plan_id, count(*) AS epochs, sum(max_repeats)::BIGINT AS examples FROM mix_plans GROUP BY plan_id)
SELECT plan_id, ceil(examples / 4.0)::BIGINT AS micro_batches, ceil(ceil(examples / 4.0) / 3.0)::BIGINT AS updates, least(ceil(ceil(examples / 4.0) / 3.0)::BIGINT * epochs, 40)::BIGINT AS steps FROM c""")
def training_steps(spark, d):
    """Steps of runs with the repeats of each plan as examples, batches of four, three to an update, 40 steps at most."""
    runs = table(spark, d, "mix_plans").groupBy("plan_id").agg(F.count("*").alias("epochs"), F.sum("max_repeats").alias("examples")).withColumns({"micro_batch": F.lit(4), "accumulate": F.lit(3), "cap": F.lit(40)})
    return schedule.training_steps(runs).select("plan_id", "micro_batches", "updates", "steps")


@C.add(f"""
WITH {HEADS_SQL}, h AS (SELECT CASE qid WHEN 'evidence_sufficient' THEN 'noul' WHEN 'risk' THEN 'score' WHEN 'urgency' THEN 'score' ELSE 'choice' END AS qtype, {_PROBS} AS ps FROM heads WHERE json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 1 AND qid IN ('evidence_sufficient', 'next_action', 'root_cause_type', 'risk', 'urgency')),
n AS (SELECT qtype, list_transform(ps, lambda x: greatest(x, 0.0) / list_sum(list_transform(ps, lambda y: greatest(y, 0.0)))) AS g FROM h WHERE list_sum(list_transform(ps, lambda y: greatest(y, 0.0))) > 0),
l AS (SELECT qtype, g, list_transform(g, lambda x: ln(greatest(x, 0.02)) * 1.4) AS z FROM n),
t AS (SELECT qtype, g, z, list_max(z) AS top, i FROM l, range(0, 901) r(i)),
c AS (SELECT qtype, i, avg(list_sum(list_transform(range(1, len(g) + 1), lambda j: g[j] * (ln(list_sum(list_transform(z, lambda x: exp((x - top) / (0.5 + i * 0.005))))) - (z[j] - top) / (0.5 + i * 0.005))))) AS nll, count(*) AS n FROM t GROUP BY qtype, i)
SELECT qtype, max(n) AS n, round(0.5 + arg_min(i, row(round(nll, 9), i)) * 0.005, 6)::DOUBLE AS temperature FROM c GROUP BY qtype""")
def temperature_by_type(spark, d):
    """The temperature of the lowest mean cross-entropy by head type, to 0.005, from three nested grids."""
    kinds = F.create_map(*[F.lit(x) for kv in R.QUESTION_TYPES.items() for x in kv])
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter((F.size("probabilities") > 1) & F.col("qid").isin(*R.QUESTION_TYPES) & (dist.total(F.transform("probabilities", lambda x: F.greatest(x, F.lit(0.0)))) > 0))
    h = h.select(kinds[F.col("qid")].alias("qtype"), dist.normalize(F.col("probabilities")).alias("g"))
    z = F.transform("g", lambda x: F.log(F.greatest(x, F.lit(0.02))) * 1.4)
    return metrics.fitted_temperatures(h.withColumn("z", z), "qtype", F.col("z"), F.col("g")).select("qtype", "n", "temperature")


_NORMAL = "list_filter(list_transform({0}, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: TRUE)"


_SENT = "SELECT id, coalesce(arg_{0}(buggy_rtl, row_no), '') AS text FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND buggy_rtl IS NOT NULL GROUP BY id HAVING count(*) > 1"


@C.add(f"""
WITH f AS ({_SENT.format("min")}), l AS ({_SENT.format("max")}),
x AS (SELECT id, line, count(*) AS n FROM (SELECT id, unnest({_NORMAL.format(_LINES)}) AS line FROM f) GROUP BY ALL), y AS (SELECT id, line, count(*) AS m FROM (SELECT id, unnest({_NORMAL.format(_LINES)}) AS line FROM l) GROUP BY ALL),
lost AS (SELECT id FROM x LEFT JOIN y USING (id, line) WHERE n > coalesce(m, 0) UNION SELECT id FROM y LEFT JOIN x USING (id, line) WHERE m > coalesce(n, 0))
SELECT id, id NOT IN (SELECT id FROM lost) AS same FROM f""")
def multiset_equality(spark, d):
    """Whether the first and the last design sent for an id have the same bag of lines, blanks collapsed."""
    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null and buggy_rtl is not null")
    sent = b.groupBy("id").agg(F.min_by("buggy_rtl", "row_no").alias("first"), F.max_by("buggy_rtl", "row_no").alias("last"), F.count("*").alias("k")).filter("k > 1")
    return leakage.same_bags(leakage.line_bag(sent, "id", F.col("first"), squeeze=True), leakage.line_bag(sent, "id", F.col("last"), squeeze=True), sent.select("id"), "id")


@C.add("""
SELECT doc_id, substr(regexp_replace(lower(regexp_replace(regexp_extract(regexp_replace(coalesce(text, ''), '^[\\s\\x0b]+', ''), '^[^\\r\\n]*'), '[\\s\\x0b]+$', '')), '[\\s\\x0b]+', ' ', 'g'), 1, 120) AS title FROM documents""")
def title_keys(spark, d):
    """The normalised first line of each document, by which reports of one change are linked."""
    return table(spark, d, "documents").select("doc_id", tx.title_key(F.col("text")).alias("title"))


@C.add("""
SELECT row_no, coalesce(starts_with(rtrim(buggy_rtl, chr(10)) || chr(10), array_to_string(list_slice(string_split(rtrim(buggy_rtl, chr(10)), chr(10)), 1, 3), chr(10)) || chr(10)), FALSE) AS prefix FROM batch_06_mux_4_1 WHERE buggy_rtl IS NOT NULL AND NOT contains(buggy_rtl, chr(13)) AND NOT ends_with(buggy_rtl, chr(10) || chr(10))""")
def prefix_lines(spark, d):
    """Whether the first three lines of a design are its first lines: the check of excerpts from the top."""
    b = table(spark, d, "batch_06_mux_4_1").filter("buggy_rtl is not null and not contains(buggy_rtl, '\\r') and not endswith(buggy_rtl, '\\n\\n')")
    head = F.array_join(F.slice(tx.lines(F.col("buggy_rtl")), 1, 3), "\n")
    return b.select("row_no", quality.is_prefix(head, F.col("buggy_rtl")).alias("prefix"))


@C.add("""
SELECT id, CASE WHEN q THEN '[code]' || chr(10) || buggy_rtl ELSE '' END || CASE WHEN q AND r THEN chr(10) ELSE '' END || CASE WHEN r THEN '[repo]' || chr(10) || upstream_repo ELSE '' END AS text FROM (
  SELECT *, length(trim(coalesce(buggy_rtl, ''))) > 0 AS q, length(trim(coalesce(upstream_repo, ''))) > 0 AS r FROM batch_06_mux_4_1)""")
def stream_texts(spark, d):
    """Labelled streams of a row, blank ones left out."""
    return table(spark, d, "batch_06_mux_4_1").select("id", tx.labelled_streams(code=F.col("buggy_rtl"), repo=F.col("upstream_repo")).alias("text"))


@C.add("SELECT plan_id, source, round(exp((target_share - m) / 0.25) / sum(exp((target_share - m) / 0.25)) OVER (PARTITION BY plan_id), 9) AS p FROM (SELECT *, max(target_share) OVER (PARTITION BY plan_id) AS m FROM mix_plans)")
def softmax_shares(spark, d):
    """Each plan's shares as logits, as a distribution of temperature 0.25."""
    g = table(spark, d, "mix_plans").groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("source", "target_share"))).alias("x"))
    p = dist.softmax(F.transform("x", lambda s: s["target_share"]), F.lit(0.25))
    return g.select("plan_id", F.explode(F.arrays_zip(F.transform("x", lambda s: s["source"]).alias("source"), p.alias("p"))).alias("r")).select("plan_id", "r.source", F.round("r.p", 9).alias("p"))


@C.add("SELECT plan_id, count(*) = 3 AND min(target_share * 10) >= 0.5 AND max(target_share * 10) <= 5 AS valid FROM mix_plans GROUP BY plan_id")
def valid_temperatures(spark, d):
    """Plans whose shares, ten times, are three valid temperatures."""
    return table(spark, d, "mix_plans").groupBy("plan_id").agg(F.collect_list(F.col("target_share") * 10).alias("t")).select("plan_id", schedule.valid_temperatures(F.col("t")).alias("valid"))


@C.add("SELECT DISTINCT project_id, sha FROM (SELECT project_id, unnest([source_group, upstream_repo]) AS sha FROM projects) WHERE project_id IS NOT NULL AND sha IS NOT NULL AND sha <> ''")
def commit_columns(spark, d):
    """The distinct names that two columns of a project hold, as a cache builder asks for them."""
    from decidra.sources import readers

    return readers.commit_list(table(spark, d, "projects"), "project_id", ["source_group", "upstream_repo"]).withColumnRenamed("repository", "project_id")


@C.add("""
WITH l AS (SELECT DISTINCT id, sign, line FROM (SELECT id, '-' AS sign, unnest(string_split(replace(b, chr(13), ''), chr(10))) AS line FROM p UNION ALL SELECT id, '+', unnest(string_split(replace(a, chr(13), ''), chr(10))) FROM p))
SELECT sign, count(*) AS n, count(DISTINCT line) AS distinct_lines FROM l GROUP BY sign""".replace("WITH l", "WITH p AS (SELECT id, arg_min(buggy_rtl, row_no) AS b, arg_max(buggy_rtl, row_no) AS a FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND length(buggy_rtl) > 0 GROUP BY id), l"))
def diff_table(spark, d):
    """Patches that take out the first design of an id and put in the last, as a table of signed lines."""
    from decidra.sources import readers

    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null and length(buggy_rtl) > 0")
    p = b.groupBy("id").agg(F.replace(F.min_by("buggy_rtl", "row_no"), F.lit("\r"), F.lit("")).alias("b"), F.replace(F.max_by("buggy_rtl", "row_no"), F.lit("\r"), F.lit("")).alias("a"))
    signed = lambda c, sign: F.transform(F.split(c, "\n"), lambda x: F.concat(F.lit(sign), x))
    lines = readers.diff_lines(p, F.concat(F.array_join(F.concat(signed(F.col("b"), "-"), signed(F.col("a"), "+")), "\n")), "id")
    return lines.select("id", "sign", "line").distinct().groupBy("sign").agg(F.count("*").alias("n"), F.count_distinct("line").alias("distinct_lines"))


@C.add("SELECT event_id, round(ln(1 + value), 6) AS score FROM events WHERE value IS NOT NULL AND value >= 0")
def predicted_scores(spark, d):
    """Events through a model outside of the engine, in Arrow batches."""
    import numpy as np

    e = table(spark, d, "events").filter("value is not null and value >= 0").select("event_id", "value")
    return metrics.predicted(e, "event_id long, score double", lambda b: b.assign(score=np.log1p(b["value"]).round(6))[["event_id", "score"]])


@C.add("SELECT count(*) AS n FROM (SELECT DISTINCT id FROM veribugbench_5q WHERE id IS NOT NULL AND provenance.source_instance_id IS NOT NULL AND contains(state, provenance.source_instance_id))")
def leaked_instances(spark, d):
    """Records whose state names the instance that they were made from."""
    v = table(spark, d, "veribugbench_5q").filter("id is not null and provenance.source_instance_id is not null")
    return v.filter(F.contains("state", "provenance.source_instance_id")).select("id").distinct().agg(F.count("*").alias("n"))
