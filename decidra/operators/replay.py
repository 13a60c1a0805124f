"""Runs of tools: what a transcript says, what a run came to, and what pairs of runs show.

An attempt is a row (case, side, backend, verdict), side 'before' or 'after' a
change.  Defined results: null texts say nothing; a backend that ran on one side
only makes no pair; several attempts of a side under one backend count as one
each; cases without attempts don't appear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.functions import text as tx

FAILING = ("failed", "compile_failed")


def signals(text: Column, passed: str, failed: str, summary: str, error: str) -> Column:
    """Struct (pass_at, fail_at, summary, error_lines, verdict) of a transcript.

    Positions are ends of the last marks, -1 without any.  A summary, whose first
    group is a number of failures, is a pass mark if that is 0, else a fail mark;
    error lines are a failure though at no position.  Any failure outweighs a pass.
    """
    t = F.coalesce(text, F.lit(""))
    n = F.regexp_extract(t, summary, 1)
    has = n != ""
    summary_end = F.when(has, F.length(F.regexp_extract(t, "(?s)^.*?(?:" + summary + ")", 0))).otherwise(F.lit(-1))
    errors = F.size(F.filter(tx.lines(t), lambda x: x.rlike(error)))
    pass_at = F.greatest(tx.last_match_end(t, passed), F.when(has & (n.try_cast("long") == 0), summary_end).otherwise(F.lit(-1)))
    fail_at = F.greatest(tx.last_match_end(t, failed), F.when(has & (n.try_cast("long") > 0), summary_end).otherwise(F.lit(-1)), F.when(errors > 0, 0).otherwise(F.lit(-1)))
    verdict = F.when(fail_at >= 0, "failed").when(pass_at >= 0, "passed").otherwise("unknown")
    return F.struct(pass_at.alias("pass_at"), fail_at.alias("fail_at"), F.when(has, n.try_cast("long")).alias("summary"), errors.alias("error_lines"), verdict.alias("verdict"))


def run_verdict(*, tool: Column, compile_timeout: Column, compile_rc: Column, ran: Column, told: Column, tool_error: Column, run_timeout: Column, run_rc: Column) -> Column:
    """What a compile and a run step came to: the first of no tool, time out, failed compile, no run, what the transcript told, a tool error, time out, failure by code; else unknown. Null conditions don't hold."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~yes(tool), "tool_missing")
        .when(yes(compile_timeout), "timeout")
        .when(yes(compile_rc != 0), "compile_failed")
        .when(~yes(ran), "unknown")
        .when(yes(told != "unknown"), told)
        .when(yes(tool_error), "tool_error")
        .when(yes(run_timeout), "timeout")
        .when(yes(run_rc != 0), "failed")
        .otherwise("unknown")
    )


def paired(attempts: DataFrame) -> DataFrame:
    """(case, backend, before, after): the least failing verdict of each side under a backend; null for a side that didn't run."""
    rank = F.when(F.col("verdict") == "passed", 0).when(F.col("verdict").isin(*FAILING), 1).otherwise(2)
    side = lambda s: F.min_by("verdict", F.when(F.col("side") == s, F.struct(rank, F.col("verdict")))).alias(s)
    return attempts.groupBy("case", "backend").agg(side("before"), side("after"))


def classified(attempts: DataFrame) -> DataFrame:
    """(case, class, deciding, verified, both_failed, passing): what the pairs of a case show, by the first class that holds.

    'tool missing': no verdict, or one that says so. 'verified': under some backend
    the state before fails and that after passes. 'undetected': the state before
    passes somewhere. 'cannot build': all verdicts are failed compiles. 'survives':
    both fail somewhere. Else 'unusable'. deciding is the first verified backend;
    the others list backends in order.
    """
    p = paired(attempts)
    fails = lambda c: F.coalesce(F.col(c).isin(*FAILING), F.lit(False))
    verified, both = fails("before") & F.coalesce(F.col("after") == "passed", F.lit(False)), fails("before") & fails("after")
    passing = F.coalesce(F.col("before") == "passed", F.lit(False))
    names = lambda c, n: F.array_sort(F.collect_set(F.when(c, F.col("backend")))).alias(n)
    built = lambda c: F.col(c).isNull() | (F.col(c) == "compile_failed")
    g = p.groupBy("case").agg(
        names(verified, "verified"),
        names(both, "both_failed"),
        names(passing, "passing"),
        F.bool_and(built("before") & built("after")).alias("no_build"),
        F.bool_or(F.coalesce((F.col("before") == "tool_missing") | (F.col("after") == "tool_missing"), F.lit(False))).alias("no_tool"),
    )
    of = F.when(F.col("no_tool"), "tool missing").when(F.size("verified") > 0, "verified").when(F.size("passing") > 0, "undetected").when(F.col("no_build"), "cannot build").when(F.size("both_failed") > 0, "survives").otherwise("unusable")
    return g.select("case", of.alias("class"), F.get("verified", F.lit(0)).alias("deciding"), "verified", "both_failed", "passing")


def summaries(attempts: DataFrame, classes: DataFrame) -> DataFrame:
    """(case, class, verified, deciding, verdicts): of each case what may be told without the state after: its class, whether a failure was confirmed, and the verdicts before by backend, sorted."""
    ran = F.when(F.col("before").isNotNull(), F.struct("backend", F.col("before").alias("verdict")))
    verdicts = paired(attempts).groupBy("case").agg(F.map_from_entries(F.array_sort(F.collect_list(ran))).alias("verdicts"))
    return classes.join(verdicts, "case", "left").select("case", "class", (F.col("class") == "verified").alias("verified"), "deciding", "verdicts")


def decisive_prefix(attempts: DataFrame, by: str, order: Sequence[str], verdict: str, decisive: Sequence[str]) -> DataFrame:
    """The attempts that a fallback over backends makes: those in order up to the first decisive verdict of their group."""
    from pyspark.sql import Window

    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    settled = F.coalesce(F.max(F.col(verdict).isin(*decisive)).over(before), F.lit(False))
    return attempts.withColumn("_settled", settled).filter("not _settled").drop("_settled")
