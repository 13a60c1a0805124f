"""Labels from rule tables: distributions, ladders, traces, evidence and anchors."""

from __future__ import annotations

from pyspark.sql import functions as F

from decidra.functions import text as tx
from decidra.operators import quality, rules
from decidra.operators import records as R
from decidra.plans.base import Catalogue, table

C = Catalogue()

#: Rules of the queries below (category, channel, pattern, weight, why); a table like any other.
CAUSE_RULES = (
    ("timing", "title", "handshake|latency|too (?:early|late)", 2.0, "the headline speaks of timing"),
    ("timing", "body", "clock|cycle|beats", 1.5, "cycles or clocks are named"),
    ("reset", "title", "reset|rst_n", 2.5, "the headline speaks of reset"),
    ("reset", "body", "rst_n|aresetn|presetn|reset", 2.0, "a reset signal is named"),
    ("width", "body", r"\bwidth\b|\bbits\b|truncat|overflow", 1.5, "widths are named"),
    ("tooling", "body", "license|waveform|simulator|seed", 1.0, "tools are named"),
    ("tooling", "kind", "^log$", 0.5, "the text is a tool's"),
)
CAUSES = ("timing", "reset", "width", "tooling", "unknown")
CHANNEL_WEIGHTS = {"title": 1.25, "kind": 0.5}
ACTION_RULES = (
    ("rtl", "body", r"\.sv\b|\brtl\b|assign|always", 1.6, "design sources are named"),
    ("waveform", "body", r"\bns\b|waveform|drops to|\bwave\b", 1.4, "times or waves are named"),
    ("simulation", "body", r"seed|simulat|emulator|\bruns?\b", 0.8, "a run is named"),
    ("specification", "title", "table|specification|should|must", 1.2, "the headline cites a rule"),
    ("simulation", "kind", "^log$", 1.0, "the text is a log"),
)
ACTIONS = ("rtl", "waveform", "simulation", "specification", "abstain")
#: Rules of the ladders: (level, channel, pattern, weight, name of the rule).
URGENCY_RULES = (
    ("3", "labels", "^en-.*ticket$", 0.0, "L_TICKET"),
    ("2", "labels", "review", 0.0, "L_REVIEW"),
    ("3", "body", "freeze|deadline|friday|tape-?out", 0.0, "T_DEADLINE"),
    ("1", "body", "before merging|before you merge|regress", 0.0, "T_MERGE"),
)
RISK_RULES = (
    ("3", "body", "passport|password|license server", 0.0, "T_SENSITIVE"),
    ("2", "body", "reset|power|undefined", 0.0, "T_STATE"),
    ("1", "labels", "commit|code", 0.0, "L_CODE"),
)

_TITLE = "CASE WHEN text IS NULL THEN NULL ELSE regexp_extract(text, '^[^\\n\\r]*') END"
_BODY = "regexp_replace(text, '^[^\\n\\r]*', '')"
_CHANNELS = {"title": _TITLE, "body": _BODY, "kind": "doc_kind"}
_DOCS = f"docs AS (SELECT doc_id, coalesce({_TITLE}, '') AS title, coalesce({_BODY}, '') AS body, coalesce(doc_kind, '') AS kind, [coalesce(lang, '') || '-' || coalesce(doc_kind, ''), doc_kind] AS labels FROM documents)"


def _documents(spark, d):
    docs = table(spark, d, "documents")
    title = F.regexp_extract("text", r"^[^\n\r]*", 0)
    labels = F.array(F.concat(F.coalesce("lang", F.lit("")), F.lit("-"), F.coalesce("doc_kind", F.lit(""))), F.col("doc_kind"))
    return docs.select("doc_id", title.alias("title"), F.regexp_replace("text", r"^[^\n\r]*", "").alias("body"), F.col("doc_kind").alias("kind"), labels.alias("labels"))


def _channels():
    return {c: F.col(c) for c in ("title", "body", "kind")}


def _sum_sql(table_rows, category, weights):
    hits = [f"CASE WHEN regexp_matches({ch}, '(?im){p}') THEN {w} * {weights.get(ch, 1.0)} ELSE 0.0 END" for c, ch, p, w, _ in table_rows if c == category]
    return "(" + (" + ".join(hits) or "0.0") + ")::DOUBLE"


def _scores_sql(table_rows, categories, weights):
    return "[" + ", ".join(_sum_sql(table_rows, c, weights) for c in categories) + "]"


_TOP = "list_max(t)"
_RIVALS = "len(list_filter(t, lambda x: x > 0 AND x >= list_max(t) * 0.5))"


@C.add(f"""
WITH {_DOCS}, s AS (SELECT doc_id, kind, {_scores_sql(CAUSE_RULES, CAUSES, CHANNEL_WEIGHTS)} AS t FROM docs),
r AS (SELECT doc_id, t, list_sum(t) AS mass, CASE WHEN kind = 'log' THEN b ELSE greatest(b, 0.15) END AS reserve FROM (SELECT *, CASE WHEN {_RIVALS} = 1 AND {_TOP} >= 4.0 THEN 0.05 WHEN {_TOP} >= 3.0 THEN 0.15 ELSE 0.30 END AS b FROM s))
SELECT doc_id, c AS category, round(CASE WHEN mass > 0 THEN t[i] / mass * (1 - reserve) + CASE WHEN c = 'unknown' THEN reserve ELSE 0 END ELSE (c = 'unknown')::INT END, 9)::DOUBLE AS p
FROM (SELECT *, unnest({list(CAUSES)}) AS c, unnest(range(1, {len(CAUSES) + 1})) AS i FROM r)""")
def root_cause_distribution(spark, d):
    """Documents' causes by weighted rules over headline, body and kind; what is kept for 'unknown' depends on how clearly one cause leads."""
    docs = _documents(spark, d)
    hits = rules.fired(rules.rule_table(spark, CAUSE_RULES), _channels())
    t = docs.select("doc_id", "kind", rules.scores(hits, CAUSES, CHANNEL_WEIGHTS).alias("t"))
    p = rules.with_reserve(F.col("t"), CAUSES, rules.reserve_of(F.col("t"), F.col("kind") == "log"))
    pairs = F.arrays_zip(F.array(*map(F.lit, CAUSES)).alias("category"), p.alias("p"))
    return t.select("doc_id", F.explode(pairs).alias("x")).select("doc_id", "x.category", F.round("x.p", 9).alias("p"))


@C.add(f"""
WITH {_DOCS}, s AS (SELECT doc_id, {_scores_sql(ACTION_RULES, ACTIONS, {})} AS t FROM docs)
SELECT doc_id, c AS action, round(CASE WHEN list_sum(t) > 0 THEN t[i] / list_sum(t) ELSE (c = 'abstain')::INT END, 9)::DOUBLE AS p FROM (SELECT *, unnest({list(ACTIONS)}) AS c, unnest(range(1, {len(ACTIONS) + 1})) AS i FROM s)""")
def action_distribution(spark, d):
    """Where to look next, by weighted rules; all on 'abstain' if none fires."""
    hits = rules.fired(rules.rule_table(spark, ACTION_RULES), _channels())
    p = rules.with_reserve(rules.scores(hits, ACTIONS), ACTIONS, F.lit(0.0), "abstain")
    pairs = F.arrays_zip(F.array(*map(F.lit, ACTIONS)).alias("action"), p.alias("p"))
    return _documents(spark, d).select("doc_id", F.explode(pairs).alias("x")).select("doc_id", "x.action", F.round("x.p", 9).alias("p"))


@C.add(f"""
WITH {_DOCS}, h AS (SELECT doc_id, list_filter([{", ".join(f"CASE WHEN regexp_matches({ch}, '(?im){p}') THEN '{c}: +{w:.1f} ({ch}: {why.replace(chr(39), chr(39) * 2)})' END" for c, ch, p, w, why in CAUSE_RULES)}], lambda x: x IS NOT NULL) AS t FROM docs)
SELECT doc_id, len(t)::INT AS fired, array_to_string(t, '; ') AS trace, CASE WHEN len(list_filter(t, lambda x: contains(x, '(title: '))) > 0 THEN 'title' WHEN len(list_filter(t, lambda x: contains(x, '(body: '))) > 0 THEN 'body' WHEN len(t) > 0 THEN 'kind' ELSE 'none' END AS channel FROM h""")
def rule_trace(spark, d):
    """Why each document has its causes, and the strongest channel that spoke."""
    docs = _documents(spark, d).select("doc_id", rules.fired(rules.rule_table(spark, CAUSE_RULES), _channels()).alias("h"))
    return docs.select("doc_id", F.size("h").alias("fired"), F.array_join(rules.trace(F.col("h")), "; ").alias("trace"), rules.strongest_channel(F.col("h"), ("title", "body", "kind")).alias("channel"))


def _ladder_sql(table_rows, default):
    test = lambda ch, p: f"len(list_filter(labels, lambda x: x IS NOT NULL AND regexp_matches(x, '(?im){p}'))) > 0" if ch == "labels" else f"regexp_matches({ch}, '(?im){p}')"
    arms = lambda pick: "CASE " + " ".join(f"WHEN {test(ch, p)} THEN '{pick(lv, ch, why)}'" for lv, ch, p, _, why in table_rows) + " ELSE '{}' END"
    return f"""
WITH {_DOCS}, r AS (SELECT {arms(lambda lv, ch, why: why).format(default[0])} AS rule, {arms(lambda lv, ch, why: lv).format(default[1])} AS level, {arms(lambda lv, ch, why: 'label' if ch == 'labels' else 'text').format(default[2])} AS basis FROM docs)
SELECT rule, level, basis, count(*) AS n FROM r GROUP BY ALL"""


def _ladder(spark, d, table_rows, default):
    docs = _documents(spark, d)
    found = rules.priority_ladder(rules.rule_table(spark, table_rows), {"title": F.col("title"), "body": F.col("body")}, {"labels": F.col("labels")}, default)
    return docs.select(found.alias("x")).groupBy("x.rule", "x.level", "x.basis").agg(F.count("*").alias("n"))


@C.add(_ladder_sql(URGENCY_RULES, ("NONE", "0", "default")))
def urgency_ladder(spark, d):
    """Documents by the first urgency rule that holds: labels before texts."""
    return _ladder(spark, d, URGENCY_RULES, ("NONE", "0", "default"))


@C.add(_ladder_sql(RISK_RULES, ("NONE", "1", "default")))
def risk_ladder(spark, d):
    """Documents by the first risk rule that holds."""
    return _ladder(spark, d, RISK_RULES, ("NONE", "1", "default"))


@C.add("SELECT count(*) AS records, '0' AS urgency, '1' AS risk FROM veribugbench_5q")
def rubric_levels(spark, d):
    """Records that a fixed rubric gives one level each, whatever they say."""
    return table(spark, d, "veribugbench_5q").agg(F.count("*").alias("records")).select("records", F.lit("0").alias("urgency"), F.lit("1").alias("risk"))


@C.add("""
WITH i AS (SELECT project_id, unnest(instances) AS i FROM sim_sweep),
p AS (SELECT project_id, 'log' AS channel, i.operator_id AS a, i.instance AS b, i.err AS t FROM i UNION ALL SELECT project_id, 'golden', '', '', golden_err FROM sim_sweep)
SELECT project_id, channel, string_agg(t, chr(10) ORDER BY a NULLS FIRST, b NULLS FIRST, t) AS text FROM p WHERE length(trim(t)) > 0 GROUP BY project_id, channel""")
def channel_assembly(spark, d):
    """The evidence channels of a project: what its mutants' runs printed in the order of operator and instance, and what its golden runs printed."""
    s = table(spark, d, "sim_sweep")
    runs = s.select("project_id", F.lit("log").alias("c"), F.explode("instances").alias("i")).select("project_id", "c", F.col("i.operator_id").alias("a"), F.col("i.instance").alias("b"), F.col("i.err").alias("t"))
    golden = s.select("project_id", F.lit("golden").alias("c"), F.lit("").alias("a"), F.lit("").alias("b"), F.col("golden_err").alias("t"))
    return rules.channel_text(runs.unionByName(golden), "project_id", F.col("c"), [F.col("a"), F.col("b")], F.col("t"))


_STOP = ("this", "that", "with", "when", "have", "should", "from", "which", "before", "after")
_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in _STOP) + ")"
_IDENTS = "list_distinct(regexp_extract_all(coalesce({0}, ''), '[A-Za-z_][A-Za-z0-9_]{{3,}}'))"


@C.add(f"""
WITH p AS (SELECT project_id, testbench FROM projects),
j AS (SELECT doc_id, text, testbench, list_sort(list_filter({_IDENTS.format('text')}, lambda x: list_contains({_IDENTS.format('testbench')}, x) AND lower(x) NOT IN {_STOP_SQL})) AS named FROM documents LEFT JOIN p USING (project_id))
SELECT doc_id, len(named)::INT AS named, array_to_string(named, ' ') AS names, round(CASE WHEN regexp_matches(text, '(?i)[a-z_0-9/]+\\.svh?\\b') AND len(named) > 0 THEN 0.9 WHEN len(named) > 0 THEN 0.75 WHEN length(trim(coalesce(text, ''))) < 200 THEN 0.22 ELSE 0.45 END, 6)::DOUBLE AS sufficient,
  CASE WHEN regexp_matches(text, '(?i)[a-z_0-9/]+\\.svh?\\b') AND len(named) > 0 THEN 'manual_issue_label' WHEN len(named) > 0 THEN 'inferred_from_verified_repair' ELSE 'codex_pseudo_unverified' END AS label_source FROM j""")
def evidence_from_text(spark, d):
    """Whether a document's words name what its project's testbench has, and where the label then comes from: a file and a symbol, a symbol, or nothing."""
    p = table(spark, d, "projects").select("project_id", "testbench")
    j = table(spark, d, "documents").select("doc_id", "text", "project_id").join(p, "project_id", "left")
    j = j.withColumn("names", rules.visible_identifiers(F.col("text"), F.col("testbench"), _STOP))
    file, named = F.coalesce(F.col("text").rlike(r"(?i)[a-z_0-9/]+\.svh?\b"), F.lit(False)), F.size("names") > 0
    p_true = quality.fixed_pair([(file & named, 0.9), (named, 0.75), (F.length(F.trim(F.coalesce("text", F.lit("")))) < 200, 0.22)], 0.45)["true"]
    source = rules.label_source([(file & named, "manual_issue_label"), (named, "inferred_from_verified_repair")], "codex_pseudo_unverified")
    return j.select("doc_id", F.size("names").alias("named"), F.array_join("names", " ").alias("names"), F.round(p_true, 6).alias("sufficient"), source.alias("label_source"))


@C.add("""
SELECT CASE WHEN v AND t THEN 'verified_repair' WHEN t THEN 'manual_bug_label' ELSE 'codex_pseudo_unverified' END AS label_source, count(*) AS n FROM (
  SELECT coalesce(outcome.verification IN ('verified', 'passed') OR outcome.resolved, FALSE) AS v, coalesce(outcome.fault_operator IS NOT NULL AND outcome.fault_operator <> '', FALSE) AS t FROM veribugbench_5q) GROUP BY 1""")
def label_source_gate(spark, d):
    """Records by where a label may come from: confirmed and named, named, or neither."""
    v = table(spark, d, "veribugbench_5q")
    confirmed = F.coalesce(F.col("outcome.verification").isin("verified", "passed") | F.col("outcome.resolved"), F.lit(False))
    named = F.col("outcome.fault_operator").isNotNull() & (F.col("outcome.fault_operator") != "")
    return v.groupBy(rules.label_source([(confirmed & named, "verified_repair"), (named, "manual_bug_label")], "codex_pseudo_unverified").alias("label_source")).agg(F.count("*").alias("n"))


@C.add(f"""
WITH t AS (SELECT p.project_id, coalesce(p.benchmark_root, '') AS title, coalesce(p.source_group, '') AS body, coalesce(p.testbench, '') AS text FROM projects p),
ids AS (SELECT project_id, ident, bool_or(tt) AS in_title FROM (SELECT project_id, TRUE AS tt, unnest({_IDENTS.format('title')}) AS ident FROM t UNION ALL SELECT project_id, FALSE, unnest({_IDENTS.format('body')}) FROM t UNION ALL SELECT project_id, FALSE, unnest({_IDENTS.format("regexp_replace(text, 'begin', '', 'g')")}) FROM t) WHERE lower(ident) NOT IN {_STOP_SQL} GROUP BY 1, 2),
ls AS (SELECT project_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM t),
w AS (SELECT project_id, line, unnest(regexp_extract_all(l, '\\w+')) AS ident FROM ls),
seen AS (SELECT project_id, ident, count(*) AS n, min(line) AS line FROM w GROUP BY 1, 2),
b AS (SELECT project_id, line, min(row(NOT in_title, n, ident)) AS b FROM ids JOIN seen USING (project_id, ident) GROUP BY 1, 2)
SELECT project_id, line::INT AS line, struct_extract_at(b, 3) AS ident, NOT struct_extract_at(b, 1) AS in_title, struct_extract_at(b, 2) AS n, row_number() OVER (PARTITION BY project_id ORDER BY struct_extract_at(b, 1), struct_extract_at(b, 2), line)::INT AS place FROM b""")
def anchor_lines(spark, d):
    """Lines of a project's testbench at which the names of its folder, group and signals point, the title's and the rare ones first."""
    p = table(spark, d, "projects")
    body = F.concat_ws(" ", "source_group", F.regexp_replace(F.coalesce("testbench", F.lit("")), "begin", ""))
    return rules.ranked_anchors(p, "project_id", F.col("benchmark_root"), body, F.col("testbench"), _STOP)


@C.add("""
WITH v AS (SELECT id, provenance.trust_flags AS f FROM veribugbench_5q WHERE id IS NOT NULL)
SELECT id, array_to_string(list_sort(list_filter(list_distinct(f), lambda x: NOT regexp_matches(x, '(?i)^(unreviewed|stale)'))), ',') AS kept, array_to_string(list_sort(list_distinct(list_filter(f, lambda x: regexp_matches(x, '(?i)^(unreviewed|stale)')))), ',') AS dropped FROM v WHERE f IS NOT NULL""")
def label_redaction(spark, d):
    """Flags of each delivery without those of a kind, and the ones taken out."""
    v = table(spark, d, "veribugbench_5q").select("id", F.col("provenance.trust_flags").alias("f")).filter("id is not null and f is not null")
    kept, dropped = quality.redacted_labels(F.col("f"), "^(unreviewed|stale)")
    return v.select("id", F.array_join(kept, ",").alias("kept"), F.array_join(dropped, ",").alias("dropped"))
