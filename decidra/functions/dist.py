"""Algebra of probability distributions as array expressions; everything stays in the JVM.

A distribution is an array<double> over options in a fixed order.  Null arrays
give null; an empty array has no argmax and sums of 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(p: Column) -> Column:
    """Sum of an array of doubles, nulls as 0."""
    return F.aggregate(p, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))


def normalize(p: Column) -> Column:
    """Negatives, nulls and NaN to 0, divided by the sum; a zero sum gives the uniform distribution."""
    clipped = F.transform(p, lambda x: F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(F.greatest(x, F.lit(0.0))))
    mass = total(clipped)
    return F.when(mass > 0, F.transform(clipped, lambda x: x / mass)).otherwise(F.transform(clipped, lambda x: F.lit(1.0) / F.greatest(F.size(p), F.lit(1))))


def argmax(p: Column) -> Column:
    """Position (from 0) of the first maximum; null for an empty array."""
    return F.when(F.size(p) > 0, F.array_position(p, F.array_max(p)).cast("int") - 1)


def dot(p: Column, q: Column) -> Column:
    return total(F.zip_with(p, q, lambda a, b: a * b))


def brier(p: Column, q: Column) -> Column:
    """Sum over the options of the squared differences."""
    return total(F.zip_with(p, q, lambda a, b: (a - b) * (a - b)))


def kl(gold: Column, pred: Column, floor: float = 1e-12) -> Column:
    """Divergence of pred from gold; both are clipped to [floor, 1] inside the logarithm."""
    inside = lambda x: F.greatest(F.least(x, F.lit(1.0)), F.lit(floor))
    return total(F.zip_with(gold, pred, lambda g, p: g * F.log(inside(g) / inside(p))))


def total_variation(p: Column, q: Column) -> Column:
    return F.lit(0.5) * total(F.zip_with(p, q, lambda a, b: F.abs(a - b)))


def correct(qtype: Column, pred: Column, gold: Column) -> Column:
    """1 if the decision agrees: for a yes/no head both sides at or over one half (position 1 is yes), else the same argmax."""
    yes = lambda p: F.get(p, F.lit(1)) >= 0.5
    return F.when(qtype == "noul", (yes(pred) == yes(gold)).cast("double")).otherwise((argmax(pred) == argmax(gold)).cast("double"))


def expectation(p: Column) -> Column:
    """Expected level of an ordered score."""
    return F.aggregate(F.zip_with(p, F.sequence(F.lit(0), F.size(p) - 1), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)


def margin(p: Column) -> Column:
    """Largest minus second largest probability; the largest itself if there is one option."""
    s = F.sort_array(p, asc=False)
    return F.get(s, F.lit(0)) - F.coalesce(F.get(s, F.lit(1)), F.lit(0.0))


def one_hot_or_soft(p: Column, least: float = 0.80, least_margin: float = 0.35) -> Column:
    """A distribution that names one option clearly becomes one-hot, others stay."""
    at = argmax(p)
    return F.when((F.array_max(p) >= least) & (margin(p) >= least_margin), F.transform(p, lambda x, i: (i == at).cast("double"))).otherwise(p)


def uniform_over(keys: Column, active: Column, fallback: str = "abstain") -> Column:
    """Uniform over the active keys; without any, all on the fallback or else on the last key."""
    live = F.array_intersect(F.array_distinct(active), keys)
    chosen = F.when(F.size(live) > 0, live).when(F.array_contains(keys, fallback), F.array(F.lit(fallback))).otherwise(F.slice(keys, -1, 1))
    return F.transform(keys, lambda k: F.when(F.array_contains(chosen, k), F.lit(1.0) / F.size(chosen)).otherwise(F.lit(0.0)))


def aligned(m: Column, keys: Column) -> Column:
    """Values of a map in the order of keys, absent ones 0."""
    return F.transform(keys, lambda k: F.coalesce(F.try_element_at(m, k), F.lit(0.0)))


def softmax(logits: Column, temperature: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp((x - top) / temperature))
    mass = total(e)
    return F.transform(e, lambda x: x / mass)


def cross_entropy(logits: Column, target: Column, temperature: Column) -> Column:
    """Cross-entropy of the target under the softmax of logits."""
    top = F.array_max(logits)
    log_mass = F.log(total(F.transform(logits, lambda x: F.exp((x - top) / temperature))))
    return total(F.zip_with(logits, target, lambda x, t: t * (log_mass - (x - top) / temperature)))


def permuted(p: Column, order: Column) -> Column:
    """p in the order of positions (from 0)."""
    return F.transform(order, lambda i: F.get(p, i))


def problems(p: Column, tolerance: float) -> Column:
    """Array of what is wrong with a distribution: 'missing', 'negative', 'sum'."""
    return F.array_compact(
        F.array(
            F.when(p.isNull() | (F.size(p) == 0), F.lit("missing")),
            F.when(F.exists(p, lambda x: x < 0), F.lit("negative")),
            F.when(F.size(p) > 0, F.when(F.abs(total(p) - 1) > tolerance, F.lit("sum"))),
        )
    )
