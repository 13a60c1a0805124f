"""Source adapters: one projection each onto the decision record, and the questions that records ask."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decidra.functions import dist, hashing
from decidra.functions import text as tx

#: Options of the three base questions, in their order.
ACTIONS = ("rtl", "testbench", "waveform", "formal", "specification", "simulation", "constraints", "ask_human", "abstain")
CAUSES = ("syntax_compile", "type_width", "combinational_logic", "sequential_assignment", "reset_initialization", "timing_protocol", "state_machine", "formal_property", "security", "unknown")
#: The questions (qid, type, instructions); base ones first, ordered scores last.
QUESTIONS = (
    ("next_action", "choice", "What diagnostic direction should be investigated next?"),
    ("root_cause_type", "choice", "Which root-cause category best describes the available evidence?"),
    ("evidence_sufficient", "noul", "Is there enough evidence to choose a likely root cause?"),
    ("risk", "score", "How risky would the recommended diagnostic or agent action be?"),
    ("urgency", "score", "How quickly does this hardware issue require attention?"),
)
LEVELS = ("0", "1", "2", "3")
BASE = 3
#: The licence that a record states, by its source; any other is to be audited.
LICENCES = {
    "hwe-bench": "Apache-2.0 metadata; upstream repositories retained",
    "RootCause-Bench": "Apache-2.0 repository; fixture audit required",
    "OriGen": "GPL-3.0 dataset metadata",
    "RTL-augmented": "MIT",
    "HierSVA": "Solderpad Hardware License 2.1 plus BaseJump provenance",
    "Inspect-Eval-ChipBench": "MIT harness; benchmark artifact audit required",
}


def question_table(spark: SparkSession, scores: bool = True) -> DataFrame:
    """(qid, type, instructions, criteria): the questions as a dimension table, criteria being their options; without scores the base ones."""
    options = {"next_action": ACTIONS, "root_cause_type": CAUSES, "evidence_sufficient": ("false", "true")}
    rows = [(*q, list(options.get(q[0], LEVELS))) for q in QUESTIONS[: None if scores else BASE]]
    return spark.createDataFrame(rows, "qid string, type string, instructions string, criteria array<string>")


def questions_json(questions: DataFrame) -> str:
    """The questions as one JSON object by qid; a score's criteria are a list, those of the others an object."""
    import json

    rows = questions.orderBy("qid").collect()  # a handful by definition
    return json.dumps({r["qid"]: {"criteria": list(r["criteria"]) if r["type"] == "score" else dict.fromkeys(r["criteria"], ""), "instructions": r["instructions"], "type": r["type"]} for r in rows}, sort_keys=True)


def _weights(keys: Sequence[str], p: Column) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, keys)), p)


def decision_record(df: DataFrame, *, record_id: Column, source: str, group: Column, state: dict[str, Column], cause: Column, actions: Column, evidence: Column, label_source: Column, synthetic: Column, quality: str, resolved: Column, verification: str, outcome: dict[str, Column] | None = None) -> DataFrame:
    """(id, source, source_group, state, gold, outcome, provenance): state and gold as JSON texts, state with its fields and an empty list of previous actions.

    cause is one category, actions an array of active ones (uniform over these;
    without any, all on 'abstain'); evidence says whether the evidence suffices,
    null as not.
    """
    # texts are searched once, before the options are told apart
    df = df.withColumns({"_cause": cause, "_actions": actions})
    cause_p = F.array(*[(F.col("_cause") == c).cast("double") for c in CAUSES])
    action_p = dist.uniform_over(F.array(*map(F.lit, ACTIONS)), F.col("_actions"))
    enough = F.coalesce(evidence, F.lit(False)).cast("double")
    head = lambda p: F.struct(p.alias("probabilities"), label_source.alias("label_source"))
    gold = F.struct(
        head(_weights(("false", "true"), F.array(1 - enough, enough))).alias("evidence_sufficient"),
        head(_weights(ACTIONS, action_p)).alias("next_action"),
        head(_weights(CAUSES, cause_p)).alias("root_cause_type"),
    )
    fields = F.struct(*[c.alias(n) for n, c in sorted({**state, "previous_actions": F.array().cast("array<string>")}.items())])
    facts = F.struct(resolved.cast("boolean").alias("resolved"), F.lit(verification).alias("verification"), *[c.alias(n) for n, c in (outcome or {}).items()])
    provenance = F.struct(F.lit(LICENCES.get(source, "audit required")).alias("license"), synthetic.alias("synthetic"), F.lit(quality).alias("quality"), label_source.alias("label_source"))
    keep = {"ignoreNullFields": "false"}
    return df.select(record_id.alias("id"), F.lit(source).alias("source"), group.alias("source_group"), F.to_json(fields, keep).alias("state"), F.to_json(gold).alias("gold"), facts.alias("outcome"), provenance.alias("provenance"))


def _cause(*texts: Column) -> Column:
    return tx.first_match(F.concat_ws(" ", *texts), tx.ROOT_CAUSE_RULES, "unknown")


def issues(df: DataFrame) -> DataFrame:
    """Repository issues: id, repo, base_commit, title, body, level2, modified_files, reproducer_signal, test_patch."""
    files = F.coalesce("modified_files", F.array().cast("array<string>"))
    state = {"repository": F.col("repo"), "base_commit": F.coalesce("base_commit", F.lit("")), "issue_title": tx.clip(F.col("title"), 1200), "issue_body": tx.clip(F.col("body"), 5000), "bug_scope": F.col("level2")}
    told = lambda c: F.length(F.coalesce(c, F.lit(""))) > 0
    return decision_record(df, record_id=F.concat(F.lit("hwe:"), F.col("id").cast("string")), source="hwe-bench", group=F.concat(F.lit("hwe:"), F.col("repo")), state=state, cause=_cause(F.col("title"), F.col("body"), F.col("level2")), actions=F.transform(files, tx.path_action), evidence=told(F.col("reproducer_signal")) | told(F.col("test_patch")), label_source=F.lit("verified_repair"), synthetic=F.lit(False), quality="gold", resolved=F.lit(True), verification="hwe_fail_to_pass", outcome={"modified_files": files})


def bug_fixtures(df: DataFrame) -> DataFrame:
    """Bug tables: kind (runtime or synthesis), bug_id, language, bug_type, description, error, rtl."""
    state = {"source_kind": F.col("kind"), "language": F.col("language"), "bug_type": F.col("bug_type"), "description": tx.clip(F.col("description"), 2500), "error_message": tx.clip(F.col("error"), 3000), "rtl_context": tx.clip(F.col("rtl"), 5000)}
    name = F.concat_ws(":", F.lit("rootcause"), "kind", F.trim(F.col("bug_id").cast("string")))
    return decision_record(df, record_id=name, source="RootCause-Bench", group=name, state=state, cause=_cause(F.col("language"), F.col("bug_type"), F.col("description"), F.col("error")), actions=F.array(F.lit("rtl")), evidence=F.lit(True), label_source=F.lit("manual_bug_label"), synthetic=F.lit(False), quality="silver", resolved=F.lit(None), verification="benchmark_case")


def instructions(df: DataFrame) -> DataFrame:
    """Design requests: line, instruction. The group is the hash of the text."""
    text = F.coalesce("instruction", F.lit(""))
    state = {"task": tx.clip(text, 11000), "response_available": F.lit(False)}
    return decision_record(df, record_id=F.concat(F.lit("origen:"), F.col("line").cast("string")), source="OriGen", group=F.concat(F.lit("origen:"), hashing.short_id(text)), state=state, cause=_cause(text), actions=F.array(F.lit("rtl")), evidence=text.rlike("(?i)error message|error|syntax|compile"), label_source=F.lit("repair_pair_unvalidated"), synthetic=F.lit(True), quality="bronze", resolved=F.lit(None), verification="not_replayed")


def simulated_mutants(df: DataFrame) -> DataFrame:
    """Mutants that simulated: repo, module, bug_type, simulation_status, rtl, log. Others are left out; a missing repo or type is 'unknown'."""
    ok = df.filter(F.col("simulation_status") == "sim_ok")
    repo, kind = F.coalesce("repo", F.lit("unknown")), F.coalesce("bug_type", F.lit("unknown"))
    state = {"repository": F.col("repo"), "module": F.col("module"), "rtl_context": tx.clip(F.col("rtl"), 9000), "simulation_log": tx.clip(F.col("log"), 3000), "tool": F.lit("simulator")}
    return decision_record(ok, record_id=F.concat_ws(":", F.lit("rtl-augmented"), repo, "module", kind), source="RTL-augmented", group=F.concat_ws(":", F.lit("rtl-augmented"), repo, "module"), state=state, cause=_cause(kind), actions=F.array(F.lit("rtl")), evidence=F.lit(True), label_source=F.lit("validated_mutation"), synthetic=F.lit(True), quality="silver_validated", resolved=F.lit(True), verification="sim_ok", outcome={"bug_type": kind})


def assertion_tree(df: DataFrame) -> DataFrame:
    """Designs of an assertion benchmark with notes: variant, path, text, notes. The variant 'buggy_rtl' is synthetic."""
    folder, stem = F.regexp_extract("path", r"([^/]+)/[^/]*$", 1), F.regexp_extract("path", r"([^/]+?)(?:\.[^/.]*)?$", 1)
    made = F.col("variant") == "buggy_rtl"
    state = {"module": stem, "hierarchy_group": folder, "rtl_context": tx.clip(F.col("text"), 9000)}
    return decision_record(df, record_id=F.concat_ws(":", F.lit("hiersva"), "variant", "path"), source="HierSVA", group=F.concat_ws(":", F.lit("hiersva"), folder, stem), state=state, cause=_cause(F.col("notes")), actions=F.array(F.lit("rtl")), evidence=F.lit(True), label_source=F.when(made, "synthetic_bug_pattern").otherwise("historical_bug"), synthetic=made, quality="silver_formal_context", resolved=F.lit(None), verification="formal_benchmark")


def prompt_tree(df: DataFrame) -> DataFrame:
    """Prompt files of a debugging benchmark: path, text; the family is the folder, the case the name without its ending."""
    family, stem = F.regexp_extract("path", r"([^/]+)/[^/]*$", 1), F.regexp_extract("path", r"([^/]+?)(?:_prompt\.txt)?$", 1)
    name = F.concat_ws(":", F.lit("chipbench"), family, stem)
    state = {"benchmark_task": F.lit("chipbench_debug"), "bug_family": family, "problem": tx.clip(F.col("text"), 11000), "tool": F.lit("Icarus/functional simulation")}
    return decision_record(df, record_id=name, source="Inspect-Eval-ChipBench", group=name, state=state, cause=_cause(family, stem), actions=F.array(F.lit("rtl")), evidence=F.lit(True), label_source=F.lit("benchmark_bug_family"), synthetic=F.lit(True), quality="silver_benchmark", resolved=F.lit(None), verification="reference_and_test_artifacts_present")


def with_status(df: DataFrame, column: str, statuses: Sequence[str]) -> DataFrame:
    """The rows of some statuses; null ones are left out."""
    return df.filter(F.col(column).isin(*statuses))
