"""Problem 5: sources mixed to target weights, by hash-threshold histograms.

Each record has a hash of its id.  Sizes are summed by source and hash bucket;
a source contributes its records as often in full as its target allows, and once
more those below a hash threshold that meets the rest of the target.  The
threshold is found in nested histograms: only the boundary bucket of each
source is cut into finer buckets, LEVELS times.  Records are then filtered by
hash; nothing is sorted, and thresholds of nested budgets nest.

Defined results: null ids are dropped; rows delivered twice count once, with
their largest size; null or empty weights are size 0; null sources belong to no
plan; a plan row without records reaches nothing; plan rows with a null plan,
source or share are dropped; repeats below 1 or null count as 0.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decidra.session import scratch

BUCKET_BITS, LEVELS = 12, 4
#: Most plan rows; they are read by the driver, with BUCKET_BITS histograms of their sources.
MOST_PLAN_ROWS = 5000


def source_key(c: Column) -> Column:
    """A source name without case, blanks, hyphens and underscores."""
    return F.regexp_replace(F.lower(c), r"(?U)[\s\-_]", "")


def record_sizes(records: DataFrame) -> DataFrame:
    """(id, key, size, hash): each distinct id once; hash has LEVELS * BUCKET_BITS bits."""
    size = F.aggregate(F.coalesce(F.map_values("training_weights"), F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    one = records.filter("id is not null").select(F.col("id").cast("string").alias("id"), source_key(F.col("source")).alias("key"), size.alias("size"))
    one = one.groupBy("id").agg(F.max(F.struct("size", "key")).alias("m")).select("id", "m.key", "m.size")
    return one.withColumn("hash", F.shiftrightunsigned(F.xxhash64("id", F.lit(5)), 64 - LEVELS * BUCKET_BITS))


@dataclass
class Portion:
    """What a plan row takes: all records `full` times, and those with a hash below `below` once more."""

    plan_id: str
    source: str
    key: str
    share: float
    max_repeats: int
    size: float
    target: float
    full: int
    below: int
    reached: float

    @property
    def unreachable(self) -> bool:
        """Whether all that may be taken was, and is less than the target."""
        return (self.full >= self.max_repeats or self.size == 0) and self.reached < self.target


def _cuts(sizes: DataFrame, level: int, wanted: list[tuple[int, str, int, float]]) -> dict[int, tuple[int, float]]:
    """For each (row, key, bucket of the level above, rest) the first bucket of this level that passes the rest, and the size of those before it.

    Sizes are summed by bucket before anything else and cumulated in Spark; one
    row for each of the wanted ones comes back.
    """
    spark, down = sizes.sparkSession, (LEVELS - 1 - level) * BUCKET_BITS
    rows = spark.createDataFrame(wanted, "row int, key string, above long, rest double")
    within = F.broadcast(rows.select("key", "above").distinct())  # as many as plan rows at most
    bucketed = sizes.withColumn("above", F.shiftright("hash", down + BUCKET_BITS)).withColumn("bucket", F.shiftright("hash", down).bitwiseAND((1 << BUCKET_BITS) - 1))
    sums = bucketed.join(within, ["key", "above"], "left_semi").groupBy("key", "above", "bucket").agg(F.sum("size").alias("size"))
    run = F.sum("size").over(Window.partitionBy("row").orderBy("bucket"))
    passed = sums.join(F.broadcast(rows), ["key", "above"]).withColumn("run", run).withColumn("over", F.col("run") > F.col("rest"))
    found = passed.groupBy("row").agg(F.min(F.when(F.col("over"), F.col("bucket"))).alias("cut"), F.coalesce(F.max(F.when(~F.col("over"), F.col("run"))), F.lit(0.0)).alias("taken"))
    return {r["row"]: (1 << BUCKET_BITS if r["cut"] is None else int(r["cut"]), r["taken"]) for r in found.collect()}


def portions(sizes: DataFrame, plans: DataFrame) -> list[Portion]:
    """What each plan row takes of its source."""
    rows = plans.filter("plan_id is not null and source is not null and target_share is not null").select("plan_id", "source", source_key(F.col("source")).alias("key"), F.col("target_share").cast("double").alias("share"), F.greatest(F.coalesce(F.col("max_repeats"), F.lit(0)), F.lit(0)).alias("max_repeats")).distinct().limit(MOST_PLAN_ROWS + 1).collect()
    if len(rows) > MOST_PLAN_ROWS:
        raise ValueError(f"more than {MOST_PLAN_ROWS} plan rows")
    keys = sorted({r["key"] for r in rows})
    sizes = sizes.filter(F.col("key").isin(keys))
    size_of = dict.fromkeys(keys, 0.0) | {r["key"]: r["size"] for r in sizes.groupBy("key").agg(F.sum("size").alias("size")).collect()}
    named = defaultdict(set)
    for r in rows:
        named[r["plan_id"]].add(r["key"])
    total = {p: sum(size_of[k] for k in ks) for p, ks in named.items()}
    out, rest = [], {}
    for r in sorted(rows, key=lambda r: (r["plan_id"], r["key"], r["source"])):
        size, target, most = float(size_of[r["key"]]), r["share"] * total[r["plan_id"]], r["max_repeats"]
        full = min(most, int(target // size)) if size > 0 else 0
        out.append(Portion(r["plan_id"], r["source"], r["key"], r["share"], most, size, target, full, 0, full * size))
        if size > 0 and full < most:
            rest[len(out) - 1] = target - full * size
    above = dict.fromkeys(rest, 0)
    for level in range(LEVELS if rest else 0):
        cuts = _cuts(sizes, level, [(i, out[i].key, above[i], rest[i]) for i in rest])
        for i in rest:
            cut, taken = cuts.get(i, (1 << BUCKET_BITS, 0.0))
            rest[i] -= taken
            out[i].reached += taken
            if cut == 1 << BUCKET_BITS and level:  # rounding: the whole boundary bucket fits
                cut -= 1
            above[i] = (above[i] << BUCKET_BITS) + cut
    for i in rest:
        out[i].below = above[i]
    return out


def share_report(records: DataFrame, plans: DataFrame) -> DataFrame:
    """A row per plan row: target and reached share and size, repeats, and whether the target can't be reached."""
    taken = portions(scratch(record_sizes(records), "sizes"), plans)
    whole = defaultdict(float)
    for p in taken:
        whole[p.plan_id] += p.reached
    rows = [(p.plan_id, p.source, p.share, p.max_repeats, p.size, p.target, p.reached, p.reached / whole[p.plan_id] if whole[p.plan_id] else 0.0, p.unreachable) for p in taken]
    return records.sparkSession.createDataFrame(rows, "plan_id string, source string, target_share double, max_repeats int, source_size double, target_size double, reached_size double, reached_share double, unreachable boolean")


def unreachable_shares(records: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id, source) of the plan rows that can't reach their share."""
    return share_report(records, plans).filter("unreachable").select("plan_id", "source")


def mixture(records: DataFrame, plans: DataFrame) -> DataFrame:
    """(plan_id, source, id, copies): the records each plan takes, and how often."""
    sizes = scratch(record_sizes(records), "sizes")
    rows = [(p.plan_id, p.source, p.key, p.full, p.below) for p in portions(sizes, plans)]
    table = records.sparkSession.createDataFrame(rows, "plan_id string, source string, key string, full int, below long")
    return sizes.join(F.broadcast(table), "key").withColumn("copies", F.col("full") + (F.col("hash") < F.col("below")).cast("int")).filter("copies > 0").select("plan_id", "source", "id", "copies")


def mixture_checks(records: DataFrame, plans: DataFrame) -> DataFrame:
    """(check_name, n_bad) of a mixture: records taken too often or of another source, plan rows farther from their target than their largest record though they can reach it, reported sizes that the records don't add up to."""
    sizes = scratch(record_sizes(records), "sizes")
    spark = records.sparkSession
    taken = portions(sizes, plans)
    told = spark.createDataFrame([(p.plan_id, p.source, p.key, p.max_repeats, p.target, p.reached, p.size, p.unreachable) for p in taken], "plan_id string, source string, key string, max_repeats int, target double, reached double, whole double, unreachable boolean")
    mixed = scratch(mixture(records, plans), "mixture").join(sizes.select("id", F.col("key").alias("own"), "size"), "id")
    rows = mixed.join(F.broadcast(told), ["plan_id", "source"])
    often = rows.filter((F.col("copies") > F.col("max_repeats")) | (F.col("own") != F.col("key"))).agg(F.count("*").alias("n_bad")).select(F.lit("taken too often").alias("check_name"), "n_bad")
    sums = told.join(rows.groupBy("plan_id", "source").agg(F.sum(F.col("size") * F.col("copies")).alias("real"), F.max("size").alias("step")), ["plan_id", "source"], "left").withColumn("real", F.coalesce("real", F.lit(0.0)))
    largest = sizes.groupBy("key").agg(F.max("size").alias("largest"))
    sums = sums.join(largest, "key", "left")
    far = sums.filter(~F.col("unreachable") & (F.abs(F.col("real") - F.col("target")) > F.coalesce("largest", F.lit(0.0)) + 1e-6)).agg(F.count("*").alias("n_bad")).select(F.lit("target missed").alias("check_name"), "n_bad")
    odd = sums.filter(F.abs(F.col("real") - F.col("reached")) > 1e-6 * F.greatest(F.lit(1.0), F.col("real"))).agg(F.count("*").alias("n_bad")).select(F.lit("report differs").alias("check_name"), "n_bad")
    short = sums.filter(F.col("unreachable") & (F.abs(F.col("real") - F.col("max_repeats") * F.col("whole")) > 1e-6 * F.greatest(F.lit(1.0), F.col("real")))).agg(F.count("*").alias("n_bad")).select(F.lit("less than all taken").alias("check_name"), "n_bad")
    return often.unionByName(far).unionByName(odd).unionByName(short)
