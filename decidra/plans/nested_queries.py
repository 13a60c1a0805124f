"""Queries over the nested fields of the decision records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decidra.operators import nested
from decidra.plans.base import decoded_sql


def _records(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/veribugbench_5q.parquet")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.child_rows(nested.flatten_decisions(_records(spark, d)))


def _node(node: str, columns: dict[str, str], parent: str | None, item: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: nested.node_table(nested.flatten_decisions(_records(spark, d)), node, columns, parent, item)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p2_found": p2_found,
        "p2_questions": _node("question", {"type": "type:string", "instructions": "instructions:string"}, None, "qid"),
        "p2_criteria": lambda spark, d: nested.node_table(nested.flatten_decisions(_records(spark, d)), "criterion", {"plain": ":string", "text": "text:string"}, "qid", "criterion").select("id", "qid", "criterion", "ordinal", F.coalesce("plain", "text").alias("text")),
        "p2_gold": _node("gold", {"label_source": "label_source:string", "score": "score:double", "label": "label:string", "confidence": "confidence:double", "defensible": "defensible:boolean"}, None, "qid"),
        "p2_probabilities": lambda spark, d: nested.node_table(nested.flatten_decisions(_records(spark, d)), "probability", {"plain": ":double", "p": "p:double"}, "qid", "option").select("id", "qid", "option", "ordinal", F.coalesce("plain", "p").alias("probability")),
        "p2_trust_flags": _node("trust_flag", {"flag": ":string"}, None, "position"),
        "p2_reviews": _node("review", {"reviewer": "reviewer:string", "verdict": "verdict:string"}, None, "position"),
        "p2_findings": _node("finding", {"code": "code:string", "line": "line:int"}, "review", "position"),
    }


#: The child rows of decision records.
CHILDREN_SQL = f"""
WITH d AS (SELECT id, {decoded_sql("questions")} AS q, {decoded_sql("gold")} AS g, provenance FROM veribugbench_5q WHERE id IS NOT NULL),
qs AS (SELECT d.id AS id, CASE WHEN json_type(q) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, e.value -> '$.criteria' AS c FROM d, json_each(CASE WHEN json_type(q) IN ('OBJECT', 'ARRAY') THEN q END) e),
cs AS (SELECT qs.id AS id, qid, CASE WHEN json_type(c) = 'OBJECT' THEN e.key WHEN json_type(e.value) = 'OBJECT' THEN e.value ->> '$.key' ELSE e.key END AS k FROM qs, json_each(CASE WHEN json_type(c) IN ('OBJECT', 'ARRAY') THEN c END) e),
gs AS (SELECT d.id AS id, CASE WHEN json_type(g) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, e.value -> '$.probabilities' AS c FROM d, json_each(CASE WHEN json_type(g) IN ('OBJECT', 'ARRAY') THEN g END) e),
ps AS (SELECT gs.id AS id, qid, CASE WHEN json_type(c) = 'OBJECT' THEN e.key WHEN json_type(e.value) = 'OBJECT' THEN e.value ->> '$.option' ELSE e.key END AS k FROM gs, json_each(CASE WHEN json_type(c) IN ('OBJECT', 'ARRAY') THEN c END) e),
rs AS (SELECT id, unnest(provenance.reviews) AS r, generate_subscripts(provenance.reviews, 1) - 1 AS i FROM d)
SELECT DISTINCT id, 'question' AS node, '' AS parent_key, qid AS item_key FROM qs WHERE qid IS NOT NULL
UNION SELECT id, 'criterion', qid, k::VARCHAR FROM cs WHERE qid IS NOT NULL AND k IS NOT NULL
UNION SELECT id, 'gold', '', qid FROM gs WHERE qid IS NOT NULL
UNION SELECT id, 'probability', qid, k::VARCHAR FROM ps WHERE qid IS NOT NULL AND k IS NOT NULL
UNION SELECT id, 'trust_flag', '', (generate_subscripts(provenance.trust_flags, 1) - 1)::VARCHAR FROM d
UNION SELECT id, 'review', '', i::VARCHAR FROM rs
UNION SELECT id, 'finding', i::VARCHAR, (generate_subscripts(r.findings, 1) - 1)::VARCHAR FROM rs"""


_TREE = "CASE WHEN json_type({0}) IN ('OBJECT', 'ARRAY') THEN {0} END"
_PLAIN = "CASE WHEN json_type(v) NOT IN ('OBJECT', 'ARRAY') THEN v ->> '$' END"
#: Elements (n, id, key, ordinal, v) of the questions or gold, and of a container within each.
_ELEMENTS = f"""
WITH d AS (SELECT row_number() OVER () AS n, id, {{part}} AS t FROM veribugbench_5q WHERE id IS NOT NULL),
es AS (SELECT d.n AS n, d.id AS rid, CASE WHEN json_type(t) = 'OBJECT' THEN e.key ELSE e.value ->> '$.qid' END AS qid, row_number() OVER (PARTITION BY d.n ORDER BY e.id) - 1 AS ordinal, e.value AS v FROM d, json_each({_TREE.format("t")}) e)"""
_WITHIN = f"""{_ELEMENTS},
ws AS (SELECT es.rid AS rid, es.qid AS qid, es.n AS n, es.ordinal AS o, v -> '$.{{inside}}' AS c FROM es WHERE qid IS NOT NULL),
cs AS (SELECT ws.rid AS rid, ws.qid AS qid, CASE WHEN json_type(c) = 'OBJECT' THEN e.key WHEN json_type(e.value) = 'OBJECT' THEN e.value ->> '$.{{key}}' ELSE e.key::VARCHAR END AS k, row_number() OVER (PARTITION BY ws.n, ws.o ORDER BY e.id) - 1 AS ordinal, e.value AS v FROM ws, json_each({_TREE.format("c")}) e)"""


def oracle_sql() -> dict[str, str]:
    questions = _ELEMENTS.format(part=decoded_sql("questions"))
    gold = _ELEMENTS.format(part=decoded_sql("gold"))
    criteria = _WITHIN.format(part=decoded_sql("questions"), inside="criteria", key="key")
    probabilities = _WITHIN.format(part=decoded_sql("gold"), inside="probabilities", key="option")
    return {
        "p2_found": CHILDREN_SQL,
        "p2_questions": f"{questions} SELECT DISTINCT rid AS id, qid, ordinal::INT AS ordinal, v ->> '$.type' AS type, v ->> '$.instructions' AS instructions FROM es WHERE qid IS NOT NULL",
        "p2_criteria": f"{criteria} SELECT DISTINCT rid AS id, qid, k AS criterion, ordinal::INT AS ordinal, coalesce({_PLAIN}, v ->> '$.text') AS text FROM cs WHERE k IS NOT NULL",
        "p2_gold": f"{gold} SELECT DISTINCT rid AS id, qid, ordinal::INT AS ordinal, v ->> '$.label_source' AS label_source, TRY_CAST(v ->> '$.score' AS DOUBLE) AS score, v ->> '$.label' AS label, TRY_CAST(v ->> '$.confidence' AS DOUBLE) AS confidence, TRY_CAST(v ->> '$.defensible' AS BOOLEAN) AS defensible FROM es WHERE qid IS NOT NULL",
        "p2_probabilities": f"{probabilities} SELECT DISTINCT rid AS id, qid, k AS option, ordinal::INT AS ordinal, coalesce(TRY_CAST({_PLAIN} AS DOUBLE), TRY_CAST(v ->> '$.p' AS DOUBLE)) AS probability FROM cs WHERE k IS NOT NULL",
        "p2_trust_flags": "SELECT DISTINCT id, (i - 1)::VARCHAR AS position, (i - 1)::INT AS ordinal, f[i] AS flag FROM (SELECT id, provenance.trust_flags AS f, unnest(range(1, len(provenance.trust_flags) + 1)) AS i FROM veribugbench_5q WHERE id IS NOT NULL)",
        "p2_reviews": "SELECT DISTINCT id, (i - 1)::VARCHAR AS position, (i - 1)::INT AS ordinal, r[i].reviewer AS reviewer, r[i].verdict AS verdict FROM (SELECT id, provenance.reviews AS r, unnest(range(1, len(provenance.reviews) + 1)) AS i FROM veribugbench_5q WHERE id IS NOT NULL)",
        "p2_findings": """SELECT DISTINCT id, (i - 1)::VARCHAR AS review, (j - 1)::VARCHAR AS position, (j - 1)::INT AS ordinal, f[j].code AS code, f[j].line AS line FROM (
  SELECT id, i, r[i].findings AS f, unnest(range(1, len(r[i].findings) + 1)) AS j FROM (SELECT id, provenance.reviews AS r, unnest(range(1, len(provenance.reviews) + 1)) AS i FROM veribugbench_5q WHERE id IS NOT NULL))""",
    }
