"""Decision records: keyed heads as rows, merges with integrity, gates, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decidra.functions import dist
from decidra.operators import nested

GOLD_SCHEMA = T.MapType(T.StringType(), T.StructType([
    T.StructField("probabilities", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("label_source", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("label", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("defensible", T.BooleanType()),
]))
QUESTION_SCHEMA = T.MapType(T.StringType(), T.StructType([T.StructField("type", T.StringType()), T.StructField("instructions", T.StringType())]))

#: The five questions and their head types.
QUESTION_TYPES = {"evidence_sufficient": "noul", "next_action": "choice", "root_cause_type": "choice", "risk": "score", "urgency": "score"}
#: Training weight of a label by where it comes from; any other counts 0.20.
LABEL_WEIGHTS = {
    "verified_repair": 1.0,
    "benchmark_bug_family": 1.0,
    "validated_mutation": 1.0,
    "manual_bug_label": 1.0,
    "manual_issue_label": 1.0,
    "historical_bug": 1.0,
    "inferred_from_verified_repair": 0.75,
    "llm_judge": 0.25,
    "distilled_unverified": 0.25,
    "codex_pseudo_unverified": 0.20,
    "repair_pair_unvalidated": 0.20,
    "synthetic_bug_pattern": 0.20,
}
UNKNOWN_WEIGHT = 0.20
PSEUDO_SOURCES = ("codex_pseudo_unverified", "distilled_unverified", "llm_judge")


def first_delivery(records: DataFrame, key: str, order: Sequence[str], last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) by the order columns, nulls lowest; null keys are dropped."""
    pick = F.max_by if last else F.min_by
    rank = F.struct(*[F.struct(F.col(c).isNotNull().alias("there"), F.col(c).alias("v")) for c in order])
    whole = F.struct(*[F.col(c) for c in records.columns])
    return records.filter(F.col(key).isNotNull()).groupBy(key).agg(pick(whole, rank).alias("_row")).select("_row.*")


def label_weight(label_source: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in LABEL_WEIGHTS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, label_source), F.lit(UNKNOWN_WEIGHT))


def decisions(records: DataFrame, carry: Sequence[str] = ("id", "source")) -> DataFrame:
    """A row per record and gold head: the carried columns, qid, label_source, keys and probabilities in sorted key order, score, label, confidence.

    Gold may be keyed by question, a list whose elements carry qid, or either re-encoded; probabilities likewise.
    Records whose gold is none of these give no rows.
    """
    rows = records.select(*carry, F.explode(nested.heads(F.col("gold"))).alias("h"))
    return rows.select(*carry, *[F.col(f"h.{c}").alias(c) for c in ("qid", "label_source", "keys", "probabilities", "score", "label", "confidence")])


def question_heads(records: DataFrame, carry: Sequence[str] = ("id", "source")) -> DataFrame:
    """A row per record and question, in any of the forms of decisions: carried columns, qid, type."""
    return records.select(*carry, F.explode(nested.heads(F.col("questions"))).alias("q")).select(*carry, F.col("q.qid").alias("qid"), F.col("q.type").alias("type"))


def key_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): keys of only one side, 'left' or 'right'; null keys are left out."""
    x, y = (d.select(key).filter(F.col(key).isNotNull()).distinct() for d in (a, b))
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))


def checked_merge(base: DataFrame, extra: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """base with columns of extra, which must have the same keys; the differences are named in the error otherwise."""
    bad = key_differences(base, extra, key)
    sample = bad.limit(5).collect()
    if sample:
        raise ValueError(f"keys of one side only, such as {[tuple(r) for r in sample]}")
    return base.join(extra.select(key, *columns), key)


def changed_fields(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, field) of fields that differ between two versions, null equal to null."""
    a = before.select(key, *[F.col(c).alias(f"a_{c}") for c in columns])
    b = after.select(key, *[F.col(c).alias(f"b_{c}") for c in columns])
    flags = F.array_compact(F.array(*[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns]))
    return a.join(b, key).select(key, F.explode(flags).alias("field"))


def usage_gates(records: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """Nested gates: each admits only what all before it admit; null conditions don't admit. One boolean column per gate."""
    out, so_far = records, F.lit(True)
    for name, condition in gates.items():
        so_far = so_far & F.coalesce(condition, F.lit(False))
        out = out.withColumn(name, so_far)
    return out


def audited(heads: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Heads with problems of their probabilities, and the repaired distribution, label (lowest level of the largest), score and confidence."""
    p = dist.normalize(F.col("probabilities"))
    return heads.withColumn("problems", dist.problems(F.col("probabilities"), tolerance)).withColumn("repaired", p).withColumn("new_label", F.get(F.col("keys"), dist.argmax(F.col("repaired")))).withColumn("new_score", dist.expectation(F.col("repaired"))).withColumn("top", F.array_max("repaired"))
