"""Checks of records, texts and sets; each gives rows or error arrays, none raises on bad data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.functions import dist
from decidra.functions import text as tx
from decidra.operators import nested
from decidra.operators import records as R


def contract_errors(records: DataFrame, types: dict[str, str] = R.QUESTION_TYPES, tolerance: float = 1e-3) -> DataFrame:
    """(id, error) of each way a record breaks the question contract, whichever form its JSON has; records whose questions or gold are neither keyed nor listed have 'questions' or 'gold'."""
    want = F.array(*map(F.lit, sorted(types)))
    rows = records.select("id", nested.heads(F.col("questions")).alias("q"), nested.heads(F.col("gold")).alias("g"), F.col("state").isNotNull().alias("stated"))
    same_keys = lambda m: F.array_sort(F.array_distinct(F.transform(m, lambda h: h["qid"]))) == want
    of_type = F.create_map(*[F.lit(x) for kv in sorted(types.items()) for x in kv])
    ill_typed = lambda h: F.when(~F.coalesce(h["type"] == F.try_element_at(of_type, h["qid"]), h["type"].isNotNull() & F.try_element_at(of_type, h["qid"]).isNull()), F.concat(h["qid"], F.lit(": type")))
    ill_summed = lambda h: F.when(F.abs(dist.total(h["probabilities"]) - 1) > tolerance, F.concat(h["qid"], F.lit(": sum")))
    whole = F.array_compact(F.array(
        F.when(F.col("id").isNull(), F.lit("id")),
        F.when(~F.col("stated"), F.lit("state")),
        F.when(F.col("q").isNull(), F.lit("questions")).when(~same_keys(F.col("q")), F.lit("question keys")),
        F.when(F.col("g").isNull(), F.lit("gold")).when(~same_keys(F.col("g")), F.lit("gold keys")),
    ))
    known = lambda m: F.filter(F.coalesce(m, F.array().cast(rows.schema["g"].dataType)), lambda h: h["qid"].isin(*sorted(types)))
    by_head = F.array_compact(F.concat(F.transform(known(F.col("q")), ill_typed), F.transform(known(F.col("g")), ill_summed)))
    return rows.select("id", F.explode(F.concat(whole, by_head)).alias("error"))


def flags(conditions: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in their order; null conditions don't."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()]))


def excluded_by(flag_array: Column, excluding: Sequence[str]) -> Column:
    """Those of the flags that exclude from evaluation; null flags as none."""
    return F.array_intersect(F.coalesce(flag_array, F.array().cast("array<string>")), F.array(*map(F.lit, excluding)))


def fixed_pair(steps: Sequence[tuple[Column, float]], default: float) -> Column:
    """A (false, true) distribution from a ladder of (condition, probability of true); the first that holds counts."""
    p = F.lit(default)
    for condition, true in reversed(steps):
        p = F.when(condition, F.lit(true)).otherwise(p)
    return F.create_map(F.lit("false"), 1 - p, F.lit("true"), p)


def extended(base: Column, extra: Column) -> Column:
    """Two maps as one; base stays as it is, keys it has already are not overwritten."""
    return F.map_concat(base, F.map_filter(extra, lambda k, v: ~F.map_contains_key(base, k)))


def shared_between_splits(df: DataFrame, group: str, split: str) -> DataFrame:
    """(split_a, split_b, groups): how many groups each two splits share, from one pass over the splits of a group (few by nature)."""
    sets = df.filter(F.col(group).isNotNull() & F.col(split).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_set(split)).alias("s")).filter("size(s) > 1")
    pairs = F.explode(F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("split_a"), b.alias("split_b"))))))
    return sets.select(pairs.alias("p")).groupBy("p.split_a", "p.split_b").agg(F.count("*").alias("groups"))


def is_partition(classes: DataFrame, member: str, base: DataFrame) -> DataFrame:
    """(check_name, n_bad): members in several classes, members that base lacks, and members of base in no class."""
    twice = classes.groupBy(member).count().filter("count > 1").agg(F.lit("in several").alias("check_name"), F.count("*").alias("n_bad"))
    diff = R.key_differences(classes, base, member).groupBy("side").count().select(F.when(F.col("side") == "left", "unknown").otherwise("unassigned").alias("check_name"), F.col("count").alias("n_bad"))
    return twice.filter("n_bad > 0").unionByName(diff)


def is_prefix(part: Column, whole: Column) -> Column:
    """Whether the lines of part are the first lines of whole; null texts give null."""
    a, b = tx.lines(part), tx.lines(whole)
    return F.slice(b, 1, F.size(a)) == a


def self_answering(rows: DataFrame, key: str, patch: Column, body: Column, least: int = 12) -> DataFrame:
    """(key, line): added lines of a patch, of at least ``least`` characters, that stand in the text which asks for it."""
    added = F.array_distinct(F.filter(F.transform(tx.patch_lines(patch, "+"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: (F.length(x) >= least) & ~x.rlike(r"^(//|/\*|\*|end\b|begin\b)")))
    return rows.select(key, F.explode(added).alias("line"), body.alias("_body")).filter(F.contains("_body", "line")).select(key, "line")


def uniform_signals(members: DataFrame, family: str, signal: str) -> DataFrame:
    """(family, signal, n, uniform): how many members of a family show a signal, and whether all do. members has a row per member and signal, and null signals for members without any."""
    sizes = members.groupBy(family).agg(F.count_distinct("member").alias("size"))
    shown = members.filter(F.col(signal).isNotNull()).groupBy(family, signal).agg(F.count_distinct("member").alias("n"))
    return shown.join(sizes, family).select(family, signal, "n", (F.col("n") == F.col("size")).alias("uniform"))


def filled_levels(df: DataFrame, by: str, level: Column, levels: Sequence[str]) -> DataFrame:
    """(by, level, n): counts with a row for every level, 0 where none."""
    counts = df.groupBy(by).agg(*[F.count_if(level == x).alias(x) for x in levels])
    return counts.select(by, F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.col(x).alias("n")) for x in levels])).alias("x")).select(by, "x.level", "x.n")


def redacted_labels(labels: Column, pattern: str) -> tuple[Column, Column]:
    """(kept, dropped): the sorted distinct labels in which a pattern, case ignored, does not and does occur; null labels are in neither."""
    told = lambda x: x.rlike("(?i)" + pattern)
    return F.array_sort(F.array_distinct(F.filter(labels, lambda x: ~told(x)))), F.array_sort(F.array_distinct(F.filter(labels, told)))
