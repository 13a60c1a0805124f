"""Targets, judgments and reviews: what a head's numbers must fulfil, and what is done about those that don't.

Defined results: null heads, keys or probabilities give an outcome or a problem,
never an error; order of rows doesn't matter; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.functions import dist
from decidra.operators import nested

LEVELS = ("0", "1", "2", "3")


def target_of(kind: Column, criteria: Column, keys: Column, probabilities: Column) -> Column:
    """The target array of a head by its type: a choice over its criteria, absent ones 0; a yes/no as (false, true), absent ones one half; a score over the places of its criteria. Null for other types."""
    p = F.map_from_arrays(keys, probabilities)
    told = lambda k, other: F.coalesce(F.try_element_at(p, k), F.lit(other))
    return (
        F.when(kind == "choice", F.transform(F.coalesce(criteria, F.array().cast("array<string>")), lambda k: told(k, 0.0)))
        .when(kind == "noul", F.array(told(F.lit("false"), 0.5), told(F.lit("true"), 0.5)))
        .when(kind == "score", F.transform(F.coalesce(criteria, F.array().cast("array<string>")), lambda k, i: told(i.cast("string"), 0.0)))
    )


def targets(records: DataFrame, carry: Sequence[str] = ("id",), tolerance: float = 1e-3) -> DataFrame:
    """(carry, qid, type, outcome, target): a row per question; outcome is 'ok', or why there is no target: 'no target', 'type', 'distribution'.

    A target must be finite, nonnegative and sum to 1 within the tolerance, and is
    divided by its sum.  Questions and gold may have any of the forms of heads.
    """
    rows = records.select(*carry, F.explode(nested.heads(F.col("questions"))).alias("q"), nested.heads(F.col("gold")).alias("g"))
    own = F.get(F.filter("g", lambda h: h["qid"] == F.col("q.qid")), F.lit(0))
    rows = rows.withColumn("h", own).withColumn("t", F.when(F.col("h").isNotNull(), target_of(F.col("q.type"), F.col("q.criteria"), F.coalesce("h.keys", F.array().cast("array<string>")), F.coalesce("h.probabilities", F.array().cast("array<double>")))))
    total = dist.total(F.col("t"))
    sound = (F.size("t") > 0) & ~F.exists("t", lambda x: F.isnan(x) | (x < 0)) & (F.abs(total - 1) <= tolerance)
    outcome = F.when(F.col("h").isNull(), "no target").when(F.col("t").isNull(), "type").when(sound, "ok").otherwise("distribution")
    return rows.select(*carry, F.col("q.qid").alias("qid"), F.col("q.type").alias("type"), outcome.alias("outcome"), F.when(outcome == "ok", F.transform("t", lambda x: x / total)).alias("target"))


def judgment_problems(keys: Column, probabilities: Column, label: Column, confidence: Column, rationale: Column, evidence: Column, levels: Sequence[str] = LEVELS, tolerance: float = 1e-3) -> Column:
    """Array of what is wrong with a judgment: 'keys', 'negative', 'sum', 'label', 'argmax', 'confidence', 'rationale', 'evidence'; ['missing'] without any probabilities.

    Of equal probabilities the lowest level is the label.
    """
    want = F.array(*map(F.lit, levels))
    p = F.map_from_arrays(keys, probabilities)
    ordered = F.transform(want, lambda k: F.try_element_at(p, k))
    same = (F.size(F.array_except(keys, want)) == 0) & (F.size(F.array_except(want, keys)) == 0)
    top = F.get(want, dist.argmax(ordered))
    blank = lambda t: F.coalesce(F.length(F.trim(t)) == 0, F.lit(True))
    found = F.array_compact(
        F.array(
            F.when(~same, F.lit("keys")),
            F.when(F.exists(probabilities, lambda x: F.coalesce(x < 0, F.lit(True))), F.lit("negative")),
            F.when(same & (F.abs(dist.total(ordered) - 1) > tolerance), F.lit("sum")),
            F.when(~F.coalesce(label.isin(*levels), F.lit(False)), F.lit("label")).when(same & (label != top), F.lit("argmax")),
            F.when(~F.coalesce((confidence >= 0) & (confidence <= 1), F.lit(False)), F.lit("confidence")),
            F.when(blank(rationale), F.lit("rationale")),
            F.when(~F.exists(F.coalesce(evidence, F.array().cast("array<string>")), lambda x: ~blank(x)), F.lit("evidence")),
        )
    )
    return F.when(probabilities.isNull() | (F.size(probabilities) == 0), F.array(F.lit("missing"))).otherwise(found)


def reviewed(heads: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Score heads with probabilities over the levels (negatives and absent ones 0, uniform if nothing is left), label, score, and what was corrected and flagged.

    Adds new_probabilities, new_label, new_score, corrections (of 'probabilities',
    'label', 'score') and flags (of 'invalid_confidence', 'low_confidence').
    """
    want = F.array(*map(F.lit, levels))
    p = F.map_from_arrays(F.coalesce("keys", F.array().cast("array<string>")), F.coalesce("probabilities", F.array().cast("array<double>")))
    stated = F.transform(want, lambda k: F.coalesce(F.try_element_at(p, k), F.lit(0.0)))
    out = heads.withColumn("_p", stated).withColumn("new_probabilities", dist.normalize(F.col("_p")))
    out = out.withColumn("new_label", F.get(want, dist.argmax(F.col("new_probabilities")))).withColumn("new_score", dist.expectation(F.col("new_probabilities")))
    moved = F.exists(F.zip_with("_p", "new_probabilities", lambda a, b: F.abs(a - b) > 1e-6), lambda x: x)
    corrections = F.array_compact(F.array(F.when(moved, F.lit("probabilities")), F.when(~F.col("label").eqNullSafe(F.col("new_label")), F.lit("label")), F.when(F.abs(F.coalesce("score", "new_score") - F.col("new_score")) > 1e-5, F.lit("score"))))
    flags = F.array_compact(F.array(F.when(~F.coalesce((F.col("confidence") >= 0) & (F.col("confidence") <= 1), F.lit(False)), F.lit("invalid_confidence")), F.when(F.col("confidence") < 0.5, F.lit("low_confidence"))))
    return out.withColumn("corrections", corrections).withColumn("flags", flags).drop("_p")


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """(name, expected, got, kept): whether each table has the rows its contract names."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("got")).select(F.lit(name).alias("name"), F.lit(expected[name]).cast("long").alias("expected"), "got")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables")
    return out.withColumn("kept", F.col("expected") == F.col("got"))


def patched(struct: Column, fields: dict[str, Column]) -> Column:
    """A struct with fields replaced where the patch has a value; the patch wins, its nulls change nothing."""
    for name, value in fields.items():
        struct = struct.withField(name, F.coalesce(value, struct[name]))
    return struct


def excluded(records: DataFrame, mark: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, sidecar): rows that the mark doesn't exclude (null as not), and those it does, with the reason or a standing one."""
    out = mark.eqNullSafe(F.lit(True))
    return records.filter(~out), records.filter(out).withColumn("reason", F.coalesce(reason, F.lit("marked as excluded")))


def subset_chain(sets: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """(inner, outer, missing): how many keys of each set its successor lacks; all 0 for a chain of subsets."""
    out = None
    for (a, x), (b, y) in zip(sets, sets[1:]):
        lost = x.select(key).filter(F.col(key).isNotNull()).distinct().join(y.select(key).distinct(), key, "left_anti")
        one = lost.agg(F.count("*").alias("missing")).select(F.lit(a).alias("inner"), F.lit(b).alias("outer"), "missing")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("a chain has two sets or more")
    return out


def skip_gate(ledger: DataFrame, by: str, skipped: Column, n: str, most: float) -> DataFrame:
    """(by, seen, skipped, ratio, refused): the part that was skipped, and whether it is more than allowed."""
    sums = ledger.groupBy(by).agg(F.sum(n).alias("seen"), F.coalesce(F.sum(F.when(skipped, F.col(n))), F.lit(0)).alias("skipped"))
    ratio = F.col("skipped") / F.greatest(F.col("seen"), F.lit(1))
    return sums.select(by, "seen", "skipped", F.round(ratio, 9).alias("ratio"), (ratio > most).alias("refused"))


def banned_keys(text: Column, names: Sequence[str]) -> Column:
    """The names that stand as keys, in quotes, in a JSON text; a word as part of a value doesn't count."""
    t = F.coalesce(text, F.lit(""))
    return F.array_compact(F.array(*[F.when(t.rlike('"' + n.replace(".", r"\.") + r'\\*"\s*:'), F.lit(n)) for n in names]))
