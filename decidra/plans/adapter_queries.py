"""The six source adapters over tables of the test data, their records compared in full, and the questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from decidra.functions import text as tx
from decidra.plans.base import Catalogue, table
from decidra.plans.text_queries import _case, _path_case
from decidra.sources import adapters as A

C = Catalogue()


def _clip(text: str, limit: int) -> str:
    t = f"regexp_replace(replace(coalesce({text}, ''), chr(0), ' '), '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')"
    return f"CASE WHEN length({t}) > {limit} THEN substr({t}, 1, {limit}) || chr(10) || '...[truncated]' ELSE {t} END"


def _cause(text: str) -> str:
    return _case(tx.ROOT_CAUSE_RULES, f"lower({text})", "unknown")


def _told(records):
    """The records in columns: their state's members, the options of the gold with a probability, and the facts."""
    heads = "struct<evidence_sufficient: struct<probabilities: map<string,double>>, next_action: struct<probabilities: map<string,double>, label_source: string>, root_cause_type: struct<probabilities: map<string,double>>>"
    g = F.from_json("gold", heads)
    live = lambda m: F.array_join(F.array_sort(F.map_keys(F.map_filter(m, lambda k, v: v > 0))), ",")
    state = F.from_json("state", "map<string,string>")
    told = F.array_join(F.transform(F.array_sort(F.map_keys(state)), lambda k: F.concat(k, F.lit("="), F.coalesce(state[k], F.lit("~")))), "\u0001")
    return records.select(
        "id", "source_group", F.sha2(told, 256).alias("state"),
        live(g["next_action"]["probabilities"]).alias("actions"), F.round(F.array_max(F.map_values(g["next_action"]["probabilities"])), 9).alias("action_p"),
        live(g["root_cause_type"]["probabilities"]).alias("cause"), live(g["evidence_sufficient"]["probabilities"]).alias("evidence"),
        g["next_action"]["label_source"].alias("label_source"), "provenance.license", "provenance.synthetic", "provenance.quality", "outcome.resolved", "outcome.verification",
    )


def _state_sql(**fields: str) -> str:
    named = sorted({**fields, "previous_actions": "'[]'"}.items())
    return "sha256(" + " || chr(1) || ".join(f"'{k}=' || coalesce({v}, '~')" for k, v in named) + ")"


def _sql(frame: str, *, record_id: str, group: str, state: str, cause: str, actions: str = "['rtl']", evidence: str = "TRUE", label_source: str, licence: str, synthetic: str, quality: str, resolved: str, verification: str) -> str:
    return f"""
WITH src AS ({frame}), x AS (SELECT *, list_sort(list_distinct({actions})) AS live FROM src)
SELECT {record_id} AS id, {group} AS source_group, {state} AS state, CASE WHEN len(live) > 0 THEN array_to_string(live, ',') ELSE 'abstain' END AS actions, round(1.0 / greatest(len(live), 1), 9)::DOUBLE AS action_p, {cause} AS cause,
  CASE WHEN {evidence} THEN 'true' ELSE 'false' END AS evidence, {label_source} AS label_source, '{licence}' AS license, {synthetic} AS synthetic, '{quality}' AS quality, {resolved} AS resolved, '{verification}' AS verification FROM x"""


_PATHS = "rtl/[a-z_0-9]+/[a-z_0-9]+\\.sv|[a-z_0-9]+\\.(?:v|md|sdc|tcl)"
_TITLE = "regexp_extract(text, '^[^\\n\\r]*')"


@C.add(_sql(
    f"SELECT doc_id, source, text, {_TITLE} AS title, doc_kind, lang, regexp_extract_all(coalesce(text, ''), '{_PATHS}') AS files FROM documents",
    record_id="'hwe:' || doc_id", group="'hwe:' || source", state=_state_sql(repository="source", base_commit="''", issue_title=_clip("title", 1200), issue_body=_clip("text", 5000), bug_scope="doc_kind"),
    cause=_cause("concat_ws(' ', title, text, doc_kind)"), actions=f"list_transform(files, lambda f: {_path_case('lower(f)')})", evidence="length(coalesce(lang, '')) > 0", label_source="'verified_repair'", licence="Apache-2.0 metadata; upstream repositories retained", synthetic="FALSE", quality="gold", resolved="TRUE", verification="hwe_fail_to_pass"))
def adapter_issues(spark, d):
    """Documents as issues of repositories."""
    docs = table(spark, d, "documents")
    files = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"rtl/[a-z_0-9]+/[a-z_0-9]+\.sv|[a-z_0-9]+\.(?:v|md|sdc|tcl)"), F.lit(0))
    src = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("repo"), F.lit(None).cast("string").alias("base_commit"), F.regexp_extract("text", r"^[^\n\r]*", 0).alias("title"), F.col("text").alias("body"), F.col("doc_kind").alias("level2"), files.alias("modified_files"), F.col("lang").alias("reproducer_signal"), F.lit(None).cast("string").alias("test_patch"))
    return _told(A.issues(src))


@C.add(_sql(
    "SELECT row_no, CASE WHEN batch_index % 2 = 0 THEN 'runtime' ELSE 'synthesis' END AS kind, project, upstream_repo, source_group, buggy_rtl FROM batch_06_mux_4_1",
    record_id="'rootcause:' || kind || ':' || row_no", group="'rootcause:' || kind || ':' || row_no", state=_state_sql(source_kind="kind", language="'verilog'", bug_type="project", description=_clip("source_group", 2500), error_message=_clip("upstream_repo", 3000), rtl_context=_clip("buggy_rtl", 5000)),
    cause=_cause("concat_ws(' ', 'verilog', project, source_group, upstream_repo)"), label_source="'manual_bug_label'", licence="Apache-2.0 repository; fixture audit required", synthetic="FALSE", quality="silver", resolved="NULL::BOOLEAN", verification="benchmark_case"))
def adapter_bug_fixtures(spark, d):
    """Judged designs as rows of bug tables."""
    b = table(spark, d, "batch_06_mux_4_1")
    src = b.select(F.when(F.col("batch_index") % 2 == 0, "runtime").otherwise("synthesis").alias("kind"), F.col("row_no").alias("bug_id"), F.lit("verilog").alias("language"), F.col("project").alias("bug_type"), F.col("source_group").alias("description"), F.col("upstream_repo").alias("error"), F.col("buggy_rtl").alias("rtl"))
    return _told(A.bug_fixtures(src))


@C.add(_sql(
    "SELECT item_id, coalesce(text, '') AS text FROM test_items",
    record_id="'origen:' || item_id", group="'origen:' || substr(sha1(text), 1, 16)", state=_state_sql(task=_clip("text", 11000), response_available="'false'"),
    cause=_cause("text"), evidence="regexp_matches(text, '(?i)error message|error|syntax|compile')", label_source="'repair_pair_unvalidated'", licence="GPL-3.0 dataset metadata", synthetic="TRUE", quality="bronze", resolved="NULL::BOOLEAN", verification="not_replayed"))
def adapter_instructions(spark, d):
    """Held-out items as design requests."""
    return _told(A.instructions(table(spark, d, "test_items").select(F.col("item_id").alias("line"), F.col("text").alias("instruction"))))


@C.add(_sql(
    "SELECT DISTINCT project_id, tb, i.instance AS module, coalesce(i.operator_id, 'unknown') AS kind, i.err AS log FROM (SELECT project_id, tb, unnest(instances) AS i FROM sim_sweep) WHERE i.verdict = 'killed'",
    record_id="'rtl-augmented:' || project_id || ':' || module || ':' || kind", group="'rtl-augmented:' || project_id || ':' || module", state=_state_sql(repository="project_id", module="module", rtl_context=_clip("tb", 9000), simulation_log=_clip("log", 3000), tool="'simulator'"),
    cause=_cause("kind"), label_source="'validated_mutation'", licence="MIT", synthetic="TRUE", quality="silver_validated", resolved="TRUE", verification="sim_ok"))
def adapter_mutants(spark, d):
    """Killed mutants as simulated ones."""
    s = table(spark, d, "sim_sweep").select("project_id", "tb", F.explode("instances").alias("i"))
    src = s.select(F.col("project_id").alias("repo"), F.col("i.instance").alias("module"), F.col("i.operator_id").alias("bug_type"), F.when(F.col("i.verdict") == "killed", "sim_ok").alias("simulation_status"), F.col("tb").alias("rtl"), F.col("i.err").alias("log")).distinct()
    return _told(A.simulated_mutants(src))


@C.add(_sql(
    "SELECT project_id, benchmark_root, testbench, CASE WHEN maintainer IS NULL THEN 'buggy_rtl2' ELSE 'buggy_rtl' END AS variant, upstream_repo FROM projects WHERE benchmark_root IS NOT NULL",
    record_id="'hiersva:' || variant || ':' || benchmark_root || '/' || project_id || '.sv'", group="'hiersva:' || regexp_extract(benchmark_root, '[^/]*$') || ':' || project_id", state=_state_sql(module="project_id", hierarchy_group="regexp_extract(benchmark_root, '[^/]*$')", rtl_context=_clip("testbench", 9000)),
    cause=_cause("coalesce(upstream_repo, '')"), label_source="CASE WHEN variant = 'buggy_rtl' THEN 'synthetic_bug_pattern' ELSE 'historical_bug' END", licence="Solderpad Hardware License 2.1 plus BaseJump provenance", synthetic="variant = 'buggy_rtl'", quality="silver_formal_context", resolved="NULL::BOOLEAN", verification="formal_benchmark"))
def adapter_assertions(spark, d):
    """Testbenches as the designs of an assertion benchmark."""
    p = table(spark, d, "projects").filter("benchmark_root is not null")
    return _told(A.assertion_tree(p.select(F.when(F.col("maintainer").isNull(), "buggy_rtl2").otherwise("buggy_rtl").alias("variant"), F.concat("benchmark_root", F.lit("/"), "project_id", F.lit(".sv")).alias("path"), F.col("testbench").alias("text"), F.col("upstream_repo").alias("notes"))))


@C.add(_sql(
    "SELECT item_id, benchmark, text FROM test_items WHERE benchmark IS NOT NULL",
    record_id="'chipbench:' || benchmark || ':' || item_id", group="'chipbench:' || benchmark || ':' || item_id", state=_state_sql(benchmark_task="'chipbench_debug'", bug_family="benchmark", problem=_clip("text", 11000), tool="'Icarus/functional simulation'"),
    cause=_cause("benchmark || ' ' || item_id"), label_source="'benchmark_bug_family'", licence="MIT harness; benchmark artifact audit required", synthetic="TRUE", quality="silver_benchmark", resolved="NULL::BOOLEAN", verification="reference_and_test_artifacts_present"))
def adapter_prompts(spark, d):
    """Held-out items as prompt files."""
    t = table(spark, d, "test_items").filter("benchmark is not null")
    return _told(A.prompt_tree(t.select(F.concat(F.lit("data/"), "benchmark", F.lit("/"), F.col("item_id").cast("string"), F.lit("_prompt.txt")).alias("path"), "text")))


@C.add("SELECT * FROM (VALUES " + ", ".join(f"('{q}', '{t}', '{i}', {n}::INT)" for (q, t, i), n in zip(A.QUESTIONS, (len(A.ACTIONS), len(A.CAUSES), 2, 4, 4))) + ") t(qid, type, instructions, options)")
def question_definitions(spark, d):
    """The five questions as a dimension table."""
    return A.question_table(spark).select("qid", "type", "instructions", F.size("criteria").alias("options"))
