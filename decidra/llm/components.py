"""Connected components as a table that is extended, not rebuilt.

Each node is written once, with the root it had when it came: ``nodes`` (node,
root) only grows.  What merges later is in the small table ``moves`` (root, to),
which leads every root that is none any more to its present one, in one step.
``extend`` maps new edges to present roots and contracts that graph: every root
hooks to its smallest neighbour, chains of hooks are shortened by pointer
jumping, and the edges are mapped to the new roots, of which only distinct ones
between different roots remain.  A delivery so costs what its own edges touch,
and the moves; the nodes are read, not written again.  Each round writes its
tables to the shared folder, so the lineage stays short and lost executors cost
one round at most.  Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decidra.session import drop_scratch, scratch


@dataclass
class Components:
    """nodes (node, root when it came); moves (root, to): to is a present root."""

    nodes: DataFrame
    moves: DataFrame

    def table(self) -> DataFrame:
        """(node, root): each node with the smallest node of its component."""
        return present(self.nodes, "root", self.moves)


def present(df: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    """df with the roots of a column led to the present ones."""
    led = moves.select(F.col("root").alias(column), F.col("to").alias("_to"))
    names = df.columns
    return df.join(led, column, "left").withColumn(column, F.coalesce("_to", column)).select(*names)


def _shortened(hooks: DataFrame) -> DataFrame:
    """Hooks (root, to), to < root, with every chain followed to its end."""
    while True:
        nxt = hooks.select(F.col("root").alias("to"), F.col("to").alias("beyond"))
        jumped = scratch(hooks.join(nxt, "to", "left").select("root", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")), "hooks")
        drop_scratch(hooks)
        hooks = jumped
        if hooks.filter("moved").isEmpty():
            return hooks.select("root", "to")


def extend(known: Components | None, edges: DataFrame) -> tuple[Components, DataFrame]:
    """The components with the edges (u, v) merged in, and the nodes (node, root) that are new; loops (u, u) add single nodes."""
    fresh = edges.select(F.explode(F.array("u", "v")).alias("node")).filter("node is not null").distinct()
    if known is not None:
        fresh = fresh.join(known.nodes.select("node"), "node", "left_anti")
    fresh = scratch(fresh.select("node", F.col("node").alias("root")), "nodes")
    edges = edges.filter("u is not null and v is not null and u <> v").select("u", "v")
    moves = edges.sparkSession.createDataFrame([], f"root {fresh.schema['node'].dataType.simpleString()}, to {fresh.schema['node'].dataType.simpleString()}")
    if known is not None:
        table, moves = known.table().filter("node <> root"), known.moves
        for end in ("u", "v"):
            edges = edges.join(table.select(F.col("node").alias(end), F.col("root").alias("r")), end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    while True:
        edges = scratch(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
        if edges.isEmpty():
            return Components(fresh if known is None else known.nodes.unionByName(fresh), moves), fresh
        hooks = _shortened(scratch(edges.groupBy(F.col("v").alias("root")).agg(F.min("u").alias("to")), "hooks"))
        moves = scratch(present(moves, "to", hooks).unionByName(hooks), "moves")
        for end in ("u", "v"):
            edges = edges.join(hooks.select(F.col("root").alias(end), F.col("to").alias("r")), end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
