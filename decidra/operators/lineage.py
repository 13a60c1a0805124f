"""Families of records: line overlap by an inverted index, and components.

Similarity of two texts is the Jaccard similarity of their distinct stripped
lines.  Texts with equal line sets are one class.  A class of n lines with a
partner of at least t must share one of its n - ceil(t n) + 1 rarest lines, so only
these are joined; candidates are then counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decidra.session import scratch


def line_sets(df: DataFrame, key: str, lines: Column, *carry: str) -> DataFrame:
    """(key, carried columns, cls, n, ls): distinct line hashes; cls is equal for equal sets. Null texts and texts without lines give none."""
    hashed = F.array_sort(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x))))
    rows = df.select(key, *carry, hashed.alias("ls")).filter(F.size("ls") > 0)
    return rows.select(key, *carry, F.sha2(F.array_join(F.transform("ls", lambda x: x.cast("string")), ","), 256).alias("cls"), F.size("ls").alias("n"), "ls")


def similar_classes(sets: DataFrame, least: float) -> DataFrame:
    """(cls_a, cls_b, shared, jaccard), cls_a < cls_b, of line_sets' classes with at least that similarity."""
    classes = scratch(sets.groupBy("cls").agg(F.first("n").alias("n"), F.first("ls").alias("ls")), "line-classes")
    rows = classes.select("cls", "n", F.explode("ls").alias("line"))
    seen = rows.groupBy("line").agg(F.count("*").alias("df"))
    ranked = rows.join(seen.filter("df > 1"), "line").withColumn("r", F.row_number().over(Window.partitionBy("cls").orderBy("df", "line")))
    # lines of one class only are the rarest and come first; they fill the prefix without being joined
    shared = ranked.groupBy("cls").agg(F.count("*").alias("common"))
    prefix = ranked.join(shared, "cls").withColumn("at", F.col("r") + F.col("n") - F.col("common")).filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9)) + 1)
    a, b = (prefix.select("line", F.col("cls").alias(f"cls_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = a.join(b, "line").filter((F.col("cls_a") < F.col("cls_b")) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(least))).select("cls_a", "cls_b").distinct()
    left, right = (classes.select(F.col("cls").alias(f"cls_{x}"), F.col("ls").alias(f"ls_{x}")) for x in "ab")
    counted = pairs.join(left, "cls_a").join(right, "cls_b").withColumn("shared", F.size(F.array_intersect("ls_a", "ls_b")))
    return counted.withColumn("jaccard", F.col("shared") / (F.size("ls_a") + F.size("ls_b") - F.col("shared"))).filter(F.col("jaccard") >= least).select("cls_a", "cls_b", "shared", "jaccard")


def star_edges(df: DataFrame, key: str, bucket: Column) -> DataFrame:
    """(u, v): every member of a bucket linked to the bucket's smallest, never all pairs; null buckets link nothing."""
    rows = df.select(F.col(key).alias("v"), bucket.alias("bucket")).filter("bucket is not null")
    first = rows.groupBy("bucket").agg(F.min("v").alias("u"))
    return rows.join(first, "bucket").filter("u <> v").select("u", "v").distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): each node (column node) with the smallest node it is linked to, directly or through others.

    Roots hook to their smallest neighbour, chains are shortened by doubling, and
    the edges are mapped to roots until none is left; each round's tables are
    written to the shared folder.
    """
    table = scratch(nodes.select("node").distinct().withColumn("root", F.col("node")), "roots")
    edges = edges.select("u", "v")
    while True:
        edges = scratch(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
        if edges.isEmpty():
            return table
        hooks = edges.groupBy(F.col("v").alias("root")).agg(F.min("u").alias("to"))
        while True:
            hooks = scratch(hooks, "hooks")
            onward = hooks.select(F.col("root").alias("to"), F.col("to").alias("on"))
            if hooks.join(onward, "to", "left_semi").isEmpty():
                break
            hooks = hooks.join(onward, "to", "left").select("root", F.coalesce("on", "to").alias("to"))
        table = scratch(table.join(hooks, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        for end in ("u", "v"):
            edges = edges.join(hooks.select(F.col("root").alias(end), F.col("to").alias("t")), end, "left").withColumn(end, F.coalesce("t", end)).drop("t")
