"""Observations of predicted against gold distributions, calibration error, and reports over several groupings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.functions import dist
from decidra.session import scratch

BINS = 15
#: Options up to which a sum over them is written out, so that it is compiled.
UNROLLED = 16


def observations(df: DataFrame, qtype: Column, pred: Column, gold: Column) -> DataFrame:
    """df with correct, confidence, soft_accuracy, brier_score, kl_divergence and total_variation."""
    d = df.withColumn("_p", dist.normalize(pred)).withColumn("_g", dist.normalize(gold))
    p, g = F.col("_p"), F.col("_g")
    return d.withColumns({
        "correct": dist.correct(qtype, p, g),
        "confidence": F.array_max(p),
        "soft_accuracy": dist.dot(p, g),
        "brier_score": dist.brier(p, g),
        "kl_divergence": dist.kl(g, p),
        "total_variation": dist.total_variation(p, g),
    }).drop("_p", "_g")


def calibration_bin(confidence: Column, bins: int = BINS) -> Column:
    """Number (from 1) of the equal bin (low, high] that holds a confidence; null at or below 0 and above 1."""
    edges = F.array(*[F.lit(k * (1.0 / bins)) for k in range(1, bins)])
    return F.when((confidence > 0) & (confidence <= 1), F.size(F.filter(edges, lambda e: e < confidence)) + 1)


def calibration_error(df: DataFrame, by: Sequence[str], confidence: str = "confidence", correct: str = "correct", bins: int = BINS) -> DataFrame:
    """(by..., n, ece): the mean over all rows of a group of their bin's gap between confidence and correctness; rows in no bin count in n only."""
    binned = df.withColumn("_bin", calibration_bin(F.col(confidence), bins)).groupBy(*by, "_bin").agg(F.count("*").alias("k"), F.avg(confidence).alias("c"), F.avg(correct).alias("a"))
    gap = F.when(F.col("_bin").isNotNull(), F.col("k") * F.abs(F.col("c") - F.col("a"))).otherwise(F.lit(0.0))
    return binned.groupBy(*by).agg(F.sum("k").alias("n"), (F.sum(gap) / F.sum("k")).alias("ece"))


def grouped_report(obs: DataFrame, groupings: Sequence[str]) -> DataFrame:
    """(grouping, value, n, accuracy, soft_accuracy, brier_score, kl_divergence, total_variation, ece) overall and by each grouping column.

    One pass: rows are pre-aggregated by all groupings and bin, then by each grouping.
    """
    sums = obs.withColumn("_bin", calibration_bin(F.col("confidence"))).groupBy(*groupings, "_bin").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("correct", "confidence", "soft_accuracy", "brier_score", "kl_divergence", "total_variation")])
    options = [F.struct(F.lit("overall").alias("grouping"), F.lit("").alias("value"))] + [F.struct(F.lit(g).alias("grouping"), F.coalesce(F.col(g).cast("string"), F.lit("")).alias("value")) for g in groupings]
    long = sums.withColumn("g", F.explode(F.array(*options))).groupBy("g", "_bin").agg(*[F.sum(c).alias(c) for c in ("n", "correct", "confidence", "soft_accuracy", "brier_score", "kl_divergence", "total_variation")])
    gap = F.when(F.col("_bin").isNotNull(), F.abs(F.col("confidence") - F.col("correct"))).otherwise(F.lit(0.0))
    mean = lambda c: (F.sum(c) / F.sum("n")).alias(c)
    return long.groupBy("g").agg(F.sum("n").alias("n"), (F.sum("correct") / F.sum("n")).alias("accuracy"), mean("soft_accuracy"), mean("brier_score"), mean("kl_divergence"), mean("total_variation"), (F.sum(gap) / F.sum("n")).alias("ece")).select("g.grouping", "g.value", "n", "accuracy", "soft_accuracy", "brier_score", "kl_divergence", "total_variation", "ece")


def _losses(heads: DataFrame, k: int, options: int) -> DataFrame:
    """(_by, n, t, nll): for each group and each of the k temperatures in _ts, the same in a group, the rows and their mean loss.

    One sum per place, combined before the shuffle; no row is repeated.  Options
    beyond ``options`` are folded, the others are written out so that they compile.
    """
    # cross-entropy is mass * log(sum of exp(x / t)) - (target . x) / t with x the logits below their largest
    def loss(i: int) -> Column:
        t = F.get("_ts", F.lit(i))
        parts = [F.when(F.size("_x") > j, F.exp(F.get("_x", F.lit(j)) / t)).otherwise(F.lit(0.0)) for j in range(options)]
        while len(parts) > 1:
            parts = [sum(parts[j : j + 2][1:], parts[j]) for j in range(0, len(parts), 2)]
        mass = F.when(F.size("_x") <= options, parts[0]).otherwise(dist.total(F.transform("_x", lambda x: F.exp(x / t))))
        return F.col("_m") * F.log(mass) - F.col("_d") / t

    sums = heads.groupBy("_by").agg(F.count("*").alias("n"), F.first("_ts").alias("ts"), *[F.avg(loss(i)).alias(f"l{i}") for i in range(k)])
    return sums.select("_by", "n", F.explode(F.array(*[F.struct(F.get("ts", F.lit(i)).alias("t"), F.col(f"l{i}").alias("nll")) for i in range(k)])).alias("x")).select("_by", "n", "x.*")


def fitted_temperatures(heads: DataFrame, by: str, logits: Column, target: Column, low: float = 0.5, high: float = 5.0, steps: Sequence[float] = (0.5, 0.05, 0.005), least: int = 10) -> DataFrame:
    """(by, n, temperature, nll): for each group the temperature of the lowest mean cross-entropy, the lower of equals; groups of fewer than least rows get 1.

    The loss has one valley over the temperatures, so a coarse grid leaves the
    interval around its best one, which the next step's grid refines.
    """
    top = F.array_max("_z")
    rows = heads.select(F.col(by).alias("_by"), logits.alias("_z"), target.alias("_t")).select("_by", F.transform("_z", lambda x: x - top).alias("_x"), dist.dot(F.transform("_z", lambda x: x - top), F.col("_t")).alias("_d"), dist.total(F.col("_t")).alias("_m"))
    rows = scratch(rows, "heads")
    options = min(UNROLLED, rows.agg(F.coalesce(F.max(F.size("_x")), F.lit(1)).alias("k")).first()["k"])
    grid = lambda a, step, k: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.round(F.least(F.lit(high), F.greatest(F.lit(low), a + i * step)), 6))
    k = round((high - low) / steps[0]) + 1
    tried = _losses(rows.withColumn("_ts", grid(F.lit(low), steps[0], k)), k, max(1, options))
    for wide, step in zip(steps, steps[1:]):
        best = tried.groupBy("_by").agg(F.min_by("t", F.struct(F.round("nll", 9), "t")).alias("t"))
        k = round(2 * wide / step) + 1
        near = best.select(F.col("_by").alias("_of"), grid(F.col("t") - wide, step, k).alias("_ts"))
        tried = _losses(rows.join(near, F.col("_by").eqNullSafe(F.col("_of"))).drop("_of"), k, max(1, options))
    found = tried.groupBy("_by").agg(F.max("n").alias("n"), F.min_by("t", F.struct(F.round("nll", 9), "t")).alias("t"), F.min("nll").alias("nll"))
    return found.select(F.col("_by").alias(by), "n", F.when(F.col("n") < least, F.lit(1.0)).otherwise(F.col("t")).alias("temperature"), "nll")


def temperature_grid(heads: DataFrame, by: str, logits: Column, target: Column, step: float = 0.05, least: int = 10) -> DataFrame:
    """fitted_temperatures to a step of the grid from 0.5 to 5."""
    return fitted_temperatures(heads, by, logits, target, steps=(0.5, step), least=least)


def predicted(df: DataFrame, schema: str, model: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """df through a model outside of the engine, batch by batch: a function from the rows of a batch to as many rows of the schema."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = model(batch)
            if len(out) != len(batch):
                raise ValueError(f"{len(batch)} rows went in, {len(out)} came out")
            yield out

    return df.mapInPandas(run, schema)
