"""Distributions, metrics, calibration and audits of decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from decidra.functions import dist, schedule
from decidra.operators import metrics as M
from decidra.operators import records as R
from decidra.plans.base import Catalogue, table
from decidra.plans.split_queries import HEADS_SQL

C = Catalogue()

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_TYPES = "['click', 'error', 'purchase', 'signup', 'view']"

_P = [f"count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16' AND event_type = '{t}')::DOUBLE" for t in EVENT_TYPES]
_G = [f"count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16' AND event_type = '{t}')::DOUBLE" for t in EVENT_TYPES]
OBS_SQL = f"""
raw AS (SELECT user_id, [{", ".join(_P)}] AS p0, [{", ".join(_G)}] AS g0 FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
norm AS (SELECT user_id, CASE WHEN list_sum(p0) > 0 THEN list_transform(p0, lambda x: x / list_sum(p0)) ELSE list_transform(p0, lambda x: 0.2) END AS p,
                CASE WHEN list_sum(g0) > 0 THEN list_transform(g0, lambda x: x / list_sum(g0)) ELSE list_transform(g0, lambda x: 0.2) END AS g FROM raw),
obs AS (SELECT user_id, {_TYPES}[list_position(g, list_max(g))] AS top,
  (list_position(p, list_max(p)) = list_position(g, list_max(g)))::INT::DOUBLE AS correct, list_max(p) AS confidence,
  list_sum(list_transform([1,2,3,4,5], lambda i: p[i] * g[i])) AS soft_accuracy,
  list_sum(list_transform([1,2,3,4,5], lambda i: (p[i] - g[i]) * (p[i] - g[i]))) AS brier_score,
  list_sum(list_transform([1,2,3,4,5], lambda i: g[i] * ln(greatest(least(g[i], 1.0), 1e-12) / greatest(least(p[i], 1.0), 1e-12)))) AS kl_divergence,
  0.5 * list_sum(list_transform([1,2,3,4,5], lambda i: abs(p[i] - g[i]))) AS total_variation FROM norm)"""
BIN_SQL = "CASE WHEN confidence > 0 AND confidence <= 1 THEN 1 + len(list_filter([k * (1.0::DOUBLE / 15) for k in range(1, 15)], lambda e: e < confidence)) END"


def _user_shares(spark, d):
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    share = lambda when: F.array(*[F.count_if(when & (F.col("event_type") == t)).cast("double") for t in EVENT_TYPES])
    return table(spark, d, "events").filter("user_id is not null").groupBy("user_id").agg(share(early).alias("p"), share(~early).alias("g"))


def _observations(spark, d):
    obs = M.observations(_user_shares(spark, d), F.lit("choice"), F.col("p"), F.col("g"))
    return obs.withColumn("top", F.get(F.array(*map(F.lit, EVENT_TYPES)), dist.argmax(dist.normalize(F.col("g"))))).drop("p", "g")


@C.add(f"WITH {OBS_SQL} SELECT user_id, correct, round(confidence, 9) AS confidence, round(soft_accuracy, 9) AS soft_accuracy, round(brier_score, 9) AS brier_score, round(kl_divergence, 9) AS kl_divergence, round(total_variation, 9) AS total_variation FROM obs")
def decision_observations(spark, d):
    """Each user's first half of the month as a prediction of the second."""
    o = _observations(spark, d)
    return o.select("user_id", "correct", *[F.round(c, 9).alias(c) for c in ("confidence", "soft_accuracy", "brier_score", "kl_divergence", "total_variation")])


@C.add(f"""
WITH {OBS_SQL}, b AS (SELECT *, {BIN_SQL} AS bin FROM obs),
r AS (SELECT CASE WHEN grouping(top) = 1 THEN 'overall' ELSE 'top' END AS grouping, coalesce(top, '') AS value, bin, count(*) AS n, sum(correct) AS correct, sum(confidence) AS confidence,
  sum(soft_accuracy) AS sa, sum(brier_score) AS bs, sum(kl_divergence) AS kl, sum(total_variation) AS tv FROM b GROUP BY GROUPING SETS ((bin), (top, bin)))
SELECT grouping, value, sum(n)::BIGINT AS n, round(sum(correct) / sum(n), 8) AS accuracy, round(sum(sa) / sum(n), 8) AS soft_accuracy, round(sum(bs) / sum(n), 8) AS brier_score,
  round(sum(kl) / sum(n), 8) AS kl_divergence, round(sum(tv) / sum(n), 8) AS total_variation,
  round(sum(CASE WHEN bin IS NULL THEN 0 ELSE abs(confidence - correct) END) / sum(n), 8) AS ece FROM r GROUP BY grouping, value""")
def metrics_grouping_sets(spark, d):
    """Mean metrics and calibration error overall and by dominant type."""
    r = M.grouped_report(_observations(spark, d), ["top"])
    return r.select("grouping", "value", "n", *[F.round(c, 8).alias(c) for c in ("accuracy", "soft_accuracy", "brier_score", "kl_divergence", "total_variation", "ece")])


@C.add(f"""
WITH {OBS_SQL}, b AS (SELECT *, {BIN_SQL} AS bin FROM obs)
SELECT bin, count(*) AS n, round(avg(confidence), 8) AS confidence, round(avg(correct), 8) AS accuracy FROM b GROUP BY bin""")
def ece_bins(spark, d):
    o = _observations(spark, d).withColumn("bin", M.calibration_bin(F.col("confidence")).cast("long"))
    return o.groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 8).alias("confidence"), F.round(F.avg("correct"), 8).alias("accuracy"))


@C.add("""SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.95), 8) AS p95, round(quantile_cont(value, 0.99), 8) AS p99, round(max(value), 8) AS top FROM events GROUP BY event_type""")
def latency_percentiles(spark, d):
    q = F.percentile("value", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), q.alias("q"), F.round(F.max("value"), 8).alias("top")).select("event_type", "n", *[F.round(F.col("q")[i], 8).alias(n) for i, n in enumerate(("p50", "p95", "p99"))], "top")


_PROBS = "list_transform(list_sort(json_keys(probs)), lambda k: (probs ->> ('$.\"' || k || '\"'))::DOUBLE)"


@C.add(f"""
WITH {HEADS_SQL}, p AS (SELECT qid, score, label, list_sort(json_keys(probs)) AS ks, {_PROBS} AS ps FROM heads WHERE qid IN ('risk', 'urgency') AND json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 0),
e AS (SELECT qid, score, label, ks, ps, list_sum(list_transform(range(1, len(ps) + 1), lambda i: (i - 1) * ps[i])) AS expected, list_position(ps, list_max(ps)) AS pos FROM p)
SELECT qid, count(*) AS n, round(avg(expected), 8) AS mean_score, round(avg(abs(expected - score)), 8) AS mae, count(*) FILTER (WHERE ks[pos] IS DISTINCT FROM label) AS relabelled FROM e GROUP BY qid""")
def score_expectation(spark, d):
    """Ordered scores: expectation, its distance from the stated score, and labels that aren't the lowest of the likeliest levels."""
    s = R.decisions(table(spark, d, "veribugbench_5q")).filter(F.col("qid").isin("risk", "urgency") & (F.size("probabilities") > 0)).withColumn("expected", dist.expectation(F.col("probabilities")))
    moved = ~F.get("keys", dist.argmax(F.col("probabilities"))).eqNullSafe(F.col("label"))
    return s.groupBy("qid").agg(F.count("*").alias("n"), F.round(F.avg("expected"), 8).alias("mean_score"), F.round(F.avg(F.abs(F.col("expected") - F.col("score"))), 8).alias("mae"), F.count_if(moved).alias("relabelled"))


@C.add(f"""
WITH {HEADS_SQL}, p AS (SELECT qid, {_PROBS} AS ps, probs FROM heads),
f AS (SELECT qid, unnest(list_filter([CASE WHEN probs IS NULL OR json_type(probs) <> 'OBJECT' OR len(ps) = 0 THEN 'missing' END, CASE WHEN len(list_filter(ps, lambda x: x < 0)) > 0 THEN 'negative' END,
  CASE WHEN len(ps) > 0 AND abs(list_sum(ps) - 1) > 0.0005 THEN 'sum' END, 'all'], lambda x: x IS NOT NULL)) AS problem FROM p)
SELECT qid, problem, count(*) AS n FROM f GROUP BY qid, problem""")
def probability_audit(spark, d):
    """Heads with missing, negative or badly summing probabilities, and all heads."""
    a = R.audited(R.decisions(table(spark, d, "veribugbench_5q")), tolerance=0.0005)
    return a.select("qid", F.explode(F.concat("problems", F.array(F.lit("all")))).alias("problem")).groupBy("qid", "problem").agg(F.count("*").alias("n"))


@C.add(f"""
WITH {HEADS_SQL}, p AS (SELECT id, qid, list_sort(json_keys(probs)) AS ks, {_PROBS} AS ps FROM heads WHERE qid = 'next_action' AND json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 0),
m AS (SELECT ks[list_position(ps, list_max(ps))] AS top, list_max(ps) AS p1, list_sort(ps, 'DESC') AS s FROM p)
SELECT top, count(*) AS n, count(*) FILTER (WHERE p1 >= 0.8 AND p1 - coalesce(s[2], 0) >= 0.35) AS named, round(avg(p1 - coalesce(s[2], 0)), 8) AS margin FROM m GROUP BY top""")
def dominant_category(spark, d):
    """Decisions by their likeliest option, how many name it clearly, and the mean margin."""
    p = R.decisions(table(spark, d, "veribugbench_5q")).filter((F.col("qid") == "next_action") & (F.size("probabilities") > 0))
    sharp = F.array_max(dist.one_hot_or_soft(F.col("probabilities"))) == 1.0
    named = (F.array_max("probabilities") >= 0.8) & (dist.margin(F.col("probabilities")) >= 0.35) & sharp
    return p.withColumn("top", F.get("keys", dist.argmax(F.col("probabilities")))).groupBy("top").agg(F.count("*").alias("n"), F.count_if(named).alias("named"), F.round(F.avg(dist.margin(F.col("probabilities"))), 8).alias("margin"))


@C.add(f"""
WITH a AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS active FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
SELECT user_id, t AS event_type, CASE WHEN list_contains(active, t) THEN round(1.0 / len(active), 9) ELSE 0.0 END AS p FROM (SELECT *, unnest({_TYPES}) AS t FROM a)""")
def uniform_active(spark, d):
    """For each user the uniform distribution over the types of their events."""
    keys = F.array(*map(F.lit, EVENT_TYPES))
    a = table(spark, d, "events").filter("user_id is not null").groupBy("user_id").agg(F.collect_set("event_type").alias("active"))
    pairs = F.arrays_zip(keys.alias("event_type"), dist.uniform_over(keys, F.col("active")).alias("p"))
    return a.select("user_id", F.explode(pairs).alias("x")).select("user_id", F.col("x.event_type").alias("event_type"), F.round("x.p", 9).alias("p"))


@C.add(f"""
WITH {HEADS_SQL}, l AS (SELECT id, qid, label_source FROM heads WHERE qid = 'evidence_sufficient' AND label_source IS NOT NULL)
SELECT l.id, l.label_source AS stated, v.ls AS prior, count(*) AS n FROM l JOIN (SELECT DISTINCT id, provenance.label_source AS ls FROM veribugbench_5q) v ON v.id = l.id WHERE v.ls <> l.label_source GROUP BY ALL""")
def prior_disagreement(spark, d):
    """Label sources of the evidence head that differ from those stated for the record by any delivery."""
    v = table(spark, d, "veribugbench_5q")
    h = R.decisions(v).filter((F.col("qid") == "evidence_sufficient") & F.col("label_source").isNotNull()).select("id", F.col("label_source").alias("stated"))
    prior = v.select("id", F.col("provenance.label_source").alias("prior")).distinct()
    return h.join(prior, "id").filter("stated <> prior").groupBy("id", "stated", "prior").agg(F.count("*").alias("n"))


@C.add(f"""
WITH {HEADS_SQL}, base AS (SELECT id, qid FROM heads WHERE qid IN ('evidence_sufficient', 'next_action', 'root_cause_type'))
SELECT qid, count(*) AS n, count(DISTINCT id) AS records FROM base GROUP BY qid""")
def base_questions(spark, d):
    """The projection of five heads to the three base ones."""
    keep = ("evidence_sufficient", "next_action", "root_cause_type")
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter(F.col("qid").isin(*keep))
    return h.groupBy("qid").agg(F.count("*").alias("n"), F.count_distinct("id").alias("records"))


@C.add(f"""
WITH {HEADS_SQL}, x AS (SELECT id, bool_or(label_source IN ('codex_pseudo_unverified', 'distilled_unverified', 'llm_judge')) AS pseudo, count(*) AS n, count(*) FILTER (WHERE qid IN ('risk', 'urgency')) AS scores FROM heads WHERE id IS NOT NULL GROUP BY id)
SELECT CASE WHEN scores = 0 THEN '3q_only' WHEN pseudo THEN '5q_pseudo' ELSE '5q_verified' END AS tier, count(*) AS n FROM x GROUP BY 1""")
def tier_counts(spark, d):
    """Ids by tier: no score heads, some pseudo label, none."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter("id is not null")
    x = h.groupBy("id").agg(F.bool_or(F.col("label_source").isin(*R.PSEUDO_SOURCES)).alias("pseudo"), F.count_if(F.col("qid").isin("risk", "urgency")).alias("scores"))
    return x.select(F.when(F.col("scores") == 0, "3q_only").when(F.col("pseudo"), "5q_pseudo").otherwise("5q_verified").alias("tier")).groupBy("tier").agg(F.count("*").alias("n"))


_GRID = [round(0.5 + i * 0.05, 6) for i in range(91)]


@C.add(f"""
WITH {HEADS_SQL}, h AS (SELECT qid, {_PROBS} AS ps FROM heads WHERE json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 1),
n AS (SELECT qid, list_transform(ps, lambda x: x / list_sum(ps)) AS g FROM h WHERE list_sum(ps) > 0),
l AS (SELECT qid, g, list_transform(g, lambda x: ln(greatest(x, 0.02) * 3)) AS z FROM n),
t AS (SELECT qid, g, z, list_max(z) AS top, i, 0.5 + i * 0.05 AS temp FROM l, range(0, 91) r(i)),
c AS (SELECT qid, i, list_sum(list_transform(range(1, len(g) + 1), lambda j: g[j] * (ln(list_sum(list_transform(z, lambda x: exp((x - top) / round(temp, 6)))))- (z[j] - top) / round(temp, 6)))) AS loss FROM t),
m AS (SELECT qid, i, avg(loss) AS nll, count(*) AS n FROM c GROUP BY qid, i)
SELECT qid, max(n) AS n, round(0.5 + arg_min(i, row(round(nll, 9), i)) * 0.05, 6)::DOUBLE AS temperature, round(min(nll), 7) AS nll FROM m GROUP BY qid""")
def temperature_grid(spark, d):
    """Temperature of the lowest mean cross-entropy by question, for logits that are floored logarithms."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter("size(probabilities) > 1").withColumn("g", dist.normalize(F.col("probabilities"))).filter(dist.total(F.col("probabilities")) > 0)
    z = F.transform("g", lambda x: F.log(F.greatest(x, F.lit(0.02)) * 3))
    t = M.temperature_grid(h.withColumn("z", z), "qid", F.col("z"), F.col("g"))
    return t.select("qid", "n", "temperature", F.round("nll", 7).alias("nll"))


@C.add("""
SELECT step, round(CASE WHEN step < 5 THEN greatest(1e-8, (step + 1) / 5.0) ELSE 0.5 * (1 + cos(pi() * least(1.0, greatest(0.0, (step - 5) / 95.0)))) END, 9) AS rate,
  round(0.4 + (0.05 - 0.4) * least(1.0, step / 100.0), 9) AS sigma FROM range(0, 101) r(step)""")
def lr_schedule(spark, d):
    """Warm-up and cosine over 100 steps, and a linear anneal."""
    s = spark.range(101).withColumnRenamed("id", "step")
    return s.select("step", F.round(schedule.warmup_cosine(F.col("step"), 100, 0.05), 9).alias("rate"), F.round(schedule.linear_anneal(F.col("step"), 100, 0.4, 0.05), 9).alias("sigma"))


@C.add("SELECT * FROM (VALUES ('dtype')) t(problem)")
def config_diff(spark, d):
    """Settings whose change forbids resuming: epochs may grow, loader settings may change."""
    saved = F.create_map(*map(F.lit, ("dtype", "bf16", "epochs", "4", "num_workers", "2", "seed", "7")))
    now = F.create_map(*map(F.lit, ("dtype", "fp16", "epochs", "5", "num_workers", "8", "seed", "7")))
    return spark.range(1).select(F.explode(schedule.config_problems(saved, now)).alias("problem"))


@C.add(f"""
WITH {HEADS_SQL}, p AS (SELECT id, list_sort(json_keys(probs)) AS ks, {_PROBS} AS ps FROM heads WHERE qid = 'root_cause_type' AND id IS NOT NULL AND json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 0),
x AS (SELECT id, ks[i] AS option, ps[i] AS p, row_number() OVER (PARTITION BY id, ks, ps ORDER BY sha256(id || ks[i])) - 1 AS place FROM (SELECT DISTINCT id, ks, ps FROM p), range(1, 65) r(i) WHERE i <= len(ks))
SELECT id, option, p, place FROM x""")
def option_permute(spark, d):
    """Options and their probabilities in an order by hash."""
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter((F.col("qid") == "root_cause_type") & (F.size("probabilities") > 0) & F.col("id").isNotNull()).select("id", "keys", "probabilities").distinct()
    order = F.transform(F.array_sort(F.transform("keys", lambda k, i: F.struct(F.sha2(F.concat("id", k), 256).alias("h"), i.alias("i")))), lambda s: s["i"])
    moved = h.withColumn("order", order).select("id", F.posexplode(F.arrays_zip(F.transform("order", lambda i: F.get("keys", i)).alias("option"), dist.permuted(F.col("probabilities"), F.col("order")).alias("p"))).alias("place", "x"))
    return moved.select("id", F.col("x.option").alias("option"), F.col("x.p").alias("p"), F.col("place").cast("long").alias("place"))


@C.add(f"""
WITH {HEADS_SQL}, x AS (SELECT source, qid, {_PROBS} AS ps, CASE WHEN label_source IN ('verified_repair', 'validated_mutation') THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS w FROM heads WHERE json_type(probs) = 'OBJECT' AND len(json_keys(probs)) > 0)
SELECT qid, round(sum(w * list_max(ps)) / greatest(sum(w), 1e-8), 8) AS weighted_confidence, round(sum(w), 6) AS weight FROM x GROUP BY qid""")
def weighted_mean(spark, d):
    """Confidence weighted by label provenance."""
    w = F.when(F.col("label_source").isin("verified_repair", "validated_mutation"), 1.0).otherwise(0.25)
    h = R.decisions(table(spark, d, "veribugbench_5q")).filter("size(probabilities) > 0").withColumn("w", w)
    return h.groupBy("qid").agg(F.round(F.sum(F.col("w") * F.array_max("probabilities")) / F.greatest(F.sum("w"), F.lit(1e-8)), 8).alias("weighted_confidence"), F.round(F.sum("w"), 6).alias("weight"))


@C.add("""
WITH s AS (SELECT DISTINCT project_id, i.operator_id AS op, i.instance AS instance, i.verdict AS verdict FROM (SELECT project_id, unnest(instances) AS i FROM sim_sweep))
SELECT op AS operator_id, count(*) FILTER (WHERE verdict = 'killed') AS killed, count(*) FILTER (WHERE verdict = 'not_killed') AS not_killed, count(*) FILTER (WHERE verdict = 'survived') AS survived, count(*) FILTER (WHERE verdict = 'error') AS error FROM s GROUP BY op""")
def kill_matrix(spark, d):
    """Verdicts of the distinct swept mutants by operator."""
    s = table(spark, d, "sim_sweep").select("project_id", F.explode("instances").alias("i")).select("project_id", F.col("i.operator_id").alias("operator_id"), "i.instance", "i.verdict").distinct()
    return s.groupBy("operator_id").pivot("verdict", ["killed", "not_killed", "survived", "error"]).agg(F.count("instance")).fillna(0)


@C.add("""
WITH s AS (SELECT DISTINCT project_id, i.instance AS instance, coalesce(i.behaviour_hash, i.verdict || ':' || i.rc) AS h FROM (SELECT project_id, unnest(instances) AS i FROM sim_sweep))
SELECT project_id, h AS behaviour, count(*) AS n, min(instance) AS first_instance FROM s WHERE h IS NOT NULL GROUP BY project_id, h""")
def behaviour_classes(spark, d):
    """Mutants of a project that behave alike: by behaviour hash, or verdict and code where there is none."""
    h = F.coalesce(F.col("i.behaviour_hash"), F.concat(F.col("i.verdict"), F.lit(":"), F.col("i.rc").cast("string")))
    s = table(spark, d, "sim_sweep").select("project_id", F.explode("instances").alias("i")).select("project_id", "i.instance", h.alias("behaviour")).filter("behaviour is not null").distinct()
    return s.groupBy("project_id", "behaviour").agg(F.count("*").alias("n"), F.min("instance").alias("first_instance"))


@C.add("""
WITH s AS (SELECT project_id, golden_rc, i.rc AS rc, i.verdict AS v, i.operator_id AS op FROM (SELECT project_id, golden_rc, unnest(instances) AS i FROM sim_sweep))
SELECT project_id, op AS operator_id, CASE WHEN bool_and(v = 'error') THEN 'no verdict' WHEN bool_or(v = 'killed' AND golden_rc = 0) THEN 'attributable' WHEN bool_or(v = 'not_killed') THEN 'undetected' WHEN bool_or(v = 'survived') THEN 'survives' ELSE 'unusable' END AS class FROM s GROUP BY project_id, op""")
def pair_classify(spark, d):
    """Classes of runs paired with the golden run of their project: a ladder over any and all of the verdicts."""
    s = table(spark, d, "sim_sweep").select("project_id", "golden_rc", F.explode("instances").alias("i")).select("project_id", "golden_rc", F.col("i.verdict").alias("v"), F.col("i.operator_id").alias("operator_id"))
    ladder = F.when(F.bool_and(F.col("v") == "error"), "no verdict").when(F.bool_or((F.col("v") == "killed") & (F.col("golden_rc") == 0)), "attributable").when(F.bool_or(F.col("v") == "not_killed"), "undetected").when(F.bool_or(F.col("v") == "survived"), "survives").otherwise("unusable")
    return s.groupBy("project_id", "operator_id").agg(ladder.alias("class"))


@C.add("""
WITH s AS (SELECT project_id, i.instance AS instance, i.operator_id AS op, CASE i.verdict WHEN 'killed' THEN 0 WHEN 'not_killed' THEN 1 WHEN 'survived' THEN 2 ELSE 3 END AS pr, i.verdict AS v FROM (SELECT project_id, unnest(instances) AS i FROM sim_sweep))
SELECT project_id, op AS operator_id, arg_min(instance, row(pr, instance)) AS instance, arg_min(v, row(pr, instance)) AS verdict FROM s GROUP BY project_id, op""")
def best_attempt(spark, d):
    """The attempt of the most decisive verdict of each project and operator."""
    s = table(spark, d, "sim_sweep").select("project_id", F.explode("instances").alias("i"))
    rank = F.when(F.col("i.verdict") == "killed", 0).when(F.col("i.verdict") == "not_killed", 1).when(F.col("i.verdict") == "survived", 2).otherwise(3)
    best = F.min_by(F.struct("i.instance", "i.verdict"), F.struct(rank, F.col("i.instance")))
    return s.groupBy("project_id", F.col("i.operator_id").alias("operator_id")).agg(best.alias("b")).select("project_id", "operator_id", "b.instance", "b.verdict")
