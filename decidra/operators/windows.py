"""Order-dependent operators: intervals, budgets, chunks, batches, running values.

Running sums over a whole table are taken in two steps, a sum by partition of
the order and offsets from these, so no task sees the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged_intervals(df: DataFrame, by: Sequence[str], start: str, end: str, gap: Column | float) -> DataFrame:
    """(by..., start, end, parts): intervals of a group joined where the next begins at most gap after all before it ended."""
    order = Window.partitionBy(*by).orderBy(start, end)
    gap = gap if isinstance(gap, Column) else F.lit(gap)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", (reach.isNull() | (F.col(start) > reach + gap)).cast("int"))
    island = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("parts")).drop("_island")


def overlaps(a: DataFrame, b: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Pairs of integer intervals (a_start, a_end) and (b_start, b_end), both inclusive, of equal keys that overlap.

    Both are cut into bins of width, so the join has the bin as a further key; a
    pair that shares several bins is kept in the first only.
    """
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    x, y = a.withColumn("_bin", bins("a_start", "a_end")), b.withColumn("_bin", bins("b_start", "b_end"))
    first = F.greatest(F.floor(F.col("a_start") / width), F.floor(F.col("b_start") / width))
    return x.join(y, [*by, "_bin"]).filter((F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end")) & (F.col("_bin") == first)).drop("_bin")


def ordered_number(df: DataFrame, order: Sequence[Column], weight: Column | None = None, name: str = "n", parts: int | None = None) -> DataFrame:
    """df with a running sum (of 1, or of weight) over the whole order, the row itself included.

    Rows are range-partitioned by the order, into as many parts as given or as the
    session shuffles to; each partition sums on its own, and the sums of the
    partitions, one row each, give the offsets.
    """
    w = weight if weight is not None else F.lit(1).cast("long")
    placed = df.withColumn("_w", w).repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id())
    placed = placed.withColumn("_run", F.sum("_w").over(Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    from decidra.session import scratch

    placed = scratch(placed, "ordered")
    sums = placed.groupBy("_pid").agg(F.sum("_w").alias("_s"))
    offsets = sums.withColumn("_off", F.coalesce(F.sum("_s").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")  # a row per partition
    return placed.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_run") + F.col("_off")).drop("_w", "_run", "_pid", "_off")


def whole_groups_until(groups: DataFrame, key: str, size: str, share: float) -> DataFrame:
    """(key, size, held_out): whole groups in the order of their key's hash until they hold the share of all, rounded up."""
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("t")).first()["t"]
    hashed = groups.withColumn("_h", F.sha2(F.col(key).cast("string"), 256))
    run = ordered_number(hashed, [F.col("_h"), F.col(key)], F.col(size), "_upto")
    return run.withColumn("held_out", F.col("_upto") - F.col(size) < F.lit(math.ceil(total * share))).select(key, size, "held_out")


def greedy_chunks(df: DataFrame, by: str, order: str, size: str, most_size: int, most_rows: int, head: int = 0) -> DataFrame:
    """df with chunk (from 1) in its group: a new chunk begins where the next row would pass most_size (with head) or most_rows.

    The rule depends on all rows before, so it folds over the sorted sizes of a
    group in bounded state; groups stream through a task sorted, none is held whole.
    """
    schema = df.select("*").schema
    names = df.columns

    def fold(batches):
        import pyarrow as pa

        group, chunk, used, rows = object(), 0, 0, 0
        for b in batches:
            keys, sizes = b.column(names.index(by)).to_pylist(), b.column(names.index(size)).to_pylist()
            out = []
            for k, s in zip(keys, sizes):
                s = s or 0
                if k != group:
                    group, chunk, used, rows = k, 1, 0, 0
                elif rows and (used + s + head > most_size or rows >= most_rows):
                    chunk, used, rows = chunk + 1, 0, 0
                used += s
                rows += 1
                out.append(chunk)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*names, "chunk"])

    from pyspark.sql.types import IntegerType, StructField, StructType

    return df.repartition(by).sortWithinPartitions(by, order).mapInArrow(fold, StructType([*schema.fields, StructField("chunk", IntegerType())]))


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, Column], least: bool = False) -> DataFrame:
    """df with running sums (or minima, with least) of values in the order of each group, the row itself included; and, as name_before, without it, null for the first row.

    A large group spreads over tasks: rows are range-partitioned by group and order,
    each part runs on its own, and the parts' results, one row for each group and
    part, give what comes before.
    """
    from decidra.session import scratch

    fold, names = (F.min if least else F.sum), list(values)
    placed = df.withColumns({f"_v_{n}": v for n, v in values.items()}).repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_pid", F.spark_partition_id())
    own = Window.partitionBy("_pid", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    past = own.rowsBetween(Window.unboundedPreceding, -1)
    placed = scratch(placed.withColumns({f"_r_{n}": fold(f"_v_{n}").over(own) for n in names} | {f"_e_{n}": fold(f"_v_{n}").over(past) for n in names}), "running")
    parts = placed.groupBy(*by, "_pid").agg(*[fold(f"_v_{n}").alias(f"_p_{n}") for n in names])
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("_pid").alias("_q"), *[F.col(c).alias(f"_b_{c}") for c in by], *[fold(f"_p_{n}").over(before).alias(f"_o_{n}") for n in names])
    same = F.col("_pid") == F.col("_q")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    both = placed.join(offsets, same)
    put = lambda r, o: F.least(r, o) if least else F.coalesce(F.col(r) + F.col(o), r, o)
    return both.select(*df.columns, *[put(f"_r_{n}", f"_o_{n}").alias(n) for n in names], *[put(f"_e_{n}", f"_o_{n}").alias(f"{n}_before") for n in names])


def prefix_budget(df: DataFrame, by: Sequence[str], order: Sequence[str], size: str, budget: int) -> DataFrame:
    """df with taken: what each row gets of a budget that its group spends in order; null sizes take nothing."""
    want = F.coalesce(F.col(size), F.lit(0))
    left = F.lit(budget) - F.coalesce("_upto_before", F.lit(0))
    return running(df, by, order, {"_upto": want}).withColumn("taken", F.least(want, F.greatest(F.lit(0), left))).drop("_upto", "_upto_before")


def reserved_budget(df: DataFrame, by: Sequence[str], order: Sequence[str], size: str, budget: int, reserve: int, cap: int) -> DataFrame:
    """df with taken: rows spend a group's budget in order, at most cap each, but leave reserve (or less if they need less) to every row after them.

    After row i at most budget - (reserves after i) is spent, so what is spent after
    row i is its running want, less the most by which any row up to it would have
    passed that.  Both follow from running values.
    """
    s = F.coalesce(F.col(size), F.lit(0))
    kept = F.least(s, F.lit(reserve))
    same = lambda c: F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    totals = df.groupBy(*[F.col(c).alias(f"_t_{c}") for c in by]).agg(F.sum(kept).alias("_all"))
    on = same(by[0])
    for c in by[1:]:
        on = on & same(c)
    rows = running(df, by, order, {"_run": F.least(s, F.lit(cap)), "_kept": kept}).join(totals, on).drop(*[f"_t_{c}" for c in by])
    slack = F.lit(budget) - (F.col("_all") - F.col("_kept")) - F.col("_run")
    rows = running(rows.withColumn("_slack", slack), by, order, {"_low": F.col("_slack")}, least=True)
    spent = lambda run, low: F.coalesce(run, F.lit(0)) + F.least(F.lit(0), low)
    taken = spent(F.col("_run"), F.col("_low")) - spent(F.col("_run_before"), F.coalesce("_low_before", F.lit(0)))
    return rows.withColumn("taken", F.greatest(F.lit(0), taken)).drop("_run", "_kept", "_all", "_slack", "_low", "_run_before", "_kept_before", "_low_before")


def length_batches(df: DataFrame, key: str, length: str, seed: int, batch: int, pools: int) -> DataFrame:
    """df with pool and batch numbers: rows in hash order are cut into pools of batch * pools rows, each pool sorted by length and cut into batches."""
    hashed = df.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256))
    numbered = ordered_number(hashed, [F.col("_h"), F.col(key)], None, "_i")
    pooled = numbered.withColumn("pool", F.floor((F.col("_i") - 1) / (batch * pools)).cast("long"))
    at = F.row_number().over(Window.partitionBy("pool").orderBy(length, "_h", key))
    return pooled.withColumn("batch", F.floor((at - 1) / batch).cast("long")).drop("_h", "_i")
