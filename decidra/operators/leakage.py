"""What of one text stands in another: shared lines, prefixes, bags of lines, patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decidra.functions import text as tx


def lines_found_in(a: DataFrame, key: str, text: Column, b: DataFrame, b_text: Column, longer_than: int = 8) -> DataFrame:
    """(key, lines): texts of a with lines that stand anywhere in b, and how many distinct ones.

    b counts as a set of lines, so a line that many texts share makes no pairs.
    """
    x = a.select(key, F.explode(tx.stripped_lines(text, longer_than)).alias("line")).distinct()
    y = b.select(F.explode(tx.stripped_lines(b_text, longer_than)).alias("line")).distinct()
    return x.join(y, "line", "left_semi").groupBy(key).agg(F.count("*").alias("lines"))


def contained_prefixes(docs: DataFrame, key: str, text: Column, items: DataFrame, item_key: str, item_text: Column, length: int = 40, most: int = 10_000) -> DataFrame:
    """(key, item_key): texts that contain the first length characters of an item; shorter items are left out.

    Every position of a text would be a join row, so the items, a stated query set
    of at most ``most`` of them, go to the tasks as one array in blocks.
    """
    rows = items.filter(F.length(item_text) >= length).select(F.col(item_key).alias("i"), F.left(item_text, F.lit(length)).alias("p")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} items")
    out = None
    for at in range(0, max(len(rows), 1), 500):
        block = F.array(*[F.struct(F.lit(r["i"]).cast(items.schema[item_key].dataType).alias("i"), F.lit(r["p"]).alias("p")) for r in rows[at : at + 500]]) if rows else F.array().cast("array<struct<i: bigint, p: string>>")
        hit = docs.select(key, F.explode(F.filter(block, lambda s: F.contains(text, s["p"]))).alias("s")).select(key, F.col("s.i").alias(item_key))
        out = hit if out is None else out.unionByName(hit)
    return out


def line_bag(df: DataFrame, key: str, text: Column, squeeze: bool = False) -> DataFrame:
    """(key, line, n): how often each line occurs; with squeeze, blanks collapsed and ends stripped."""
    line = F.explode(tx.lines(text))
    rows = df.select(key, line.alias("line"))
    if squeeze:
        rows = rows.withColumn("line", F.trim(F.regexp_replace("line", r"\s+", " ")))
    return rows.groupBy(key, "line").agg(F.count("*").alias("n"))


def bag_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, line, n): lines that a's bag has more often than b's, and by how much."""
    both = a.join(b.withColumnRenamed("n", "m"), [key, "line"], "left")
    return both.select(key, "line", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n")).filter("n > 0")


def same_bags(a: DataFrame, b: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(key, same): whether a and b, bags of lines, are equal for each of the keys; two empty bags are."""
    lost = bag_difference(a, b, key).unionByName(bag_difference(b, a, key)).select(key).distinct().withColumn("lost", F.lit(True))
    return keys.distinct().join(lost, key, "left").select(key, F.col("lost").isNull().alias("same"))


def patch_check(patches: DataFrame, key: str, patch: Column, before: Column, after: Column) -> DataFrame:
    """(key, applies, exact): whether all removed lines are in before and all added ones in after, as bags; and whether nothing else changed."""
    base = patches.select(key, patch.alias("p"), before.alias("b"), after.alias("a"))
    bag = lambda c: base.select(key, F.explode(c).alias("line")).groupBy(key, "line").agg(F.count("*").alias("n"))
    removed, added = bag(tx.patch_lines(F.col("p"), "-")), bag(tx.patch_lines(F.col("p"), "+"))
    old, new = bag(tx.lines(F.col("b"))), bag(tx.lines(F.col("a")))
    wrong = bag_difference(removed, old, key).unionByName(bag_difference(added, new, key)).select(key).distinct().withColumn("wrong", F.lit(True))
    change = removed.withColumn("n", -F.col("n")).unionByName(added)
    real = old.withColumn("n", -F.col("n")).unionByName(new)
    left = change.unionByName(real.withColumn("n", -F.col("n"))).groupBy(key, "line").agg(F.sum("n").alias("n")).filter("n <> 0").select(key).distinct().withColumn("more", F.lit(True))
    return base.select(key).distinct().join(wrong, key, "left").join(left, key, "left").select(key, F.col("wrong").isNull().alias("applies"), (F.col("wrong").isNull() & F.col("more").isNull()).alias("exact"))
