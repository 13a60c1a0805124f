"""Problem 3: splits that keep related records together.

Records are linked by equal values of a lineage key.  Keys are the nodes of a
persisted component table (module ``components``); a record hangs on one of its
keys, so a key that a third of all records share is one node, not a clique.
Splits live beside the table: a component that has a split keeps it, components
that merge two different splits are quarantined, and new components fill what
the splits lack.  Tables only grow by what a delivery brings; links of ids that
no delivery has brought yet wait in the state, so any order and any cut of
deliveries ends in the components of one delivery of everything.

Defined results: null ids are dropped; a record without any linking value is a
group of its own; rows delivered twice count once; empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decidra.llm import components as C
from decidra.session import scratch

PROPORTIONS = {"train": 0.70, "validation": 0.15, "test": 0.15}
QUARANTINE = "quarantine"
#: Values that link nothing (fixed values).
PLACEHOLDERS = ("", "-", "n/a", "unknown")
#: Components of more than this part of all records are placed one by one; there are at most 1 / LARGE_PART of them.
LARGE_PART = 1 / 2000
BUCKETS = 4096


def link_value(c: Column) -> Column:
    """The value without surrounding white space and in lower case, or null for a placeholder."""
    v = F.lower(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""))
    return F.when(~v.isin(*PLACEHOLDERS), v)


def own_links(records: DataFrame) -> DataFrame:
    """(id, key): the distinct linking values that records carry themselves, a key being its kind, a colon and the value; null for ids without any."""
    keys = F.array_compact(
        F.array(
            F.concat(F.lit("g:"), link_value(F.col("source_group"))),
            F.concat(F.lit("m:"), link_value(F.col("provenance.maintainer"))),
            F.concat(F.lit("p:"), link_value(F.col("provenance.project_id"))),
        )
    )
    return records.filter("id is not null").select(F.col("id").cast("string").alias("id"), F.explode_outer(keys).alias("key")).distinct()


def batch_links(batches: DataFrame) -> DataFrame:
    """(id, key): the distinct projects that batch rows give ids."""
    return batches.filter("id is not null").select(F.col("id").cast("string").alias("id"), F.concat(F.lit("p:"), link_value(F.col("project"))).alias("key")).filter("key is not null").distinct()


def _empty(spark: SparkSession, *columns: str) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))


#: Tables of a state that only grow, and those that are written anew (small: merged roots, links that wait).
GROWING = ("nodes", "members", "splits", "sizes")
RENEWED = ("moves", "pending")
#: A growing table of more parts than this is written as one.
MOST_PARTS = 32


@dataclass
class SplitState:
    """nodes (node, root) and moves (root, to) of the components; members (id, key); splits (root, split) and sizes (root, size) of components when they came; pending (id, key)."""

    nodes: DataFrame
    moves: DataFrame
    members: DataFrame
    splits: DataFrame
    sizes: DataFrame
    pending: DataFrame
    #: Per growing table the paths of its saved parts, and the parts that no save has written.
    saved: dict[str, list[str]] = field(default_factory=dict)
    unsaved: dict[str, list[DataFrame]] = field(default_factory=dict)

    @property
    def components(self) -> C.Components:
        return C.Components(self.nodes, self.moves)

    def save(self, path: str) -> None:
        """Persist under a path: the parts that it lacks and the small tables; one file, written last, names what counts."""
        spark = self.nodes.sparkSession
        version = self._version(spark, path)[0] + 1
        for name in GROWING:
            parts, fresh = self.saved.get(name, []), self.unsaved.get(name, [])
            if parts and not parts[0].startswith(f"{path}/"):
                parts, fresh = [], [getattr(self, name)]
            if len(parts) + len(fresh) > MOST_PARTS:
                parts, fresh = [], [getattr(self, name)]
            for i, df in enumerate(fresh):
                parts = [*parts, f"{path}/{name}/v{version:06d}-{i}"]
                df.write.parquet(parts[-1])
            self.saved[name], self.unsaved[name] = parts, []
        for name in RENEWED:
            getattr(self, name).write.parquet(f"{path}/{name}/v{version:06d}")
        spark.createDataFrame([(version, json.dumps(self.saved))], "version int, parts string").coalesce(1).write.mode("errorifexists").json(f"{path}/states/v{version:06d}")

    @staticmethod
    def _version(spark: SparkSession, path: str) -> tuple[int, dict[str, list[str]]]:
        jvm = spark.sparkContext._jvm
        states = jvm.org.apache.hadoop.fs.Path(f"{path}/states")
        fs = states.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(str(x.getPath().getName()) for x in fs.listStatus(states)) if fs.exists(states) else []
        for name in reversed(names):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/states/{name}/_SUCCESS")):
                row = spark.read.json(f"{path}/states/{name}").first()
                return int(row["version"]), json.loads(row["parts"])
        return 0, {}

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SplitState:
        """The last state that was saved in full."""
        version, parts = cls._version(spark, path)
        if not version:
            raise FileNotFoundError(path)
        tables = {n: spark.read.parquet(*parts[n]) for n in GROWING} | {n: spark.read.parquet(f"{path}/{n}/v{version:06d}") for n in RENEWED}
        return cls(**tables, saved=parts)

    def component_splits(self) -> DataFrame:
        """(root, split): the split of each present component; quarantined if splits of different ones met in it."""
        met = C.present(self.splits, "root", self.moves).groupBy("root").agg(F.min("split").alias("one"), F.max("split").alias("other"))
        return met.select("root", F.when(F.col("one") == F.col("other"), F.col("one")).otherwise(F.lit(QUARANTINE)).alias("split"))

    def assignment(self) -> DataFrame:
        """(id, component, split)."""
        table = self.components.table().withColumnRenamed("node", "key")
        return self.members.join(table, "key").join(self.component_splits(), "root").select("id", F.col("root").alias("component"), "split")

    def group_keys(self) -> DataFrame:
        """(id, group_key): the smallest linking value of the group of each id, or the id itself if its group has none."""
        table = self.components.table()
        value, own = F.expr("substring(node, 3)"), F.col("node").startswith("i:")
        names = table.groupBy("root").agg(F.coalesce(F.min(F.when(~own, value)), F.min(value)).alias("group_key"))
        roots = table.join(names, "root").select(F.col("node").alias("key"), "group_key")
        return self.members.join(roots, "key").select("id", "group_key")


def deliver(state: SplitState | None, records: DataFrame, batches: DataFrame) -> tuple[SplitState, DataFrame]:
    """The state with the components and members of a delivery, splits and sizes still those before; and the new members (id, key).

    Links come from the delivered records, from batch rows of ids delivered now or
    before, and from batch rows that have waited for their id.
    """
    spark = records.sparkSession
    own = scratch(own_links(records), "own-links")
    ids = own.select("id").distinct()
    of_batches = batch_links(batches)
    waiting = of_batches if state is None else of_batches.unionByName(state.pending).distinct()
    waiting = scratch(waiting, "batch-links")
    linked = own.filter("key is not null").unionByName(waiting.join(ids, "id", "left_semi")).distinct()
    links = scratch(ids.join(linked, "id", "left").select("id", F.coalesce("key", F.concat(F.lit("i:"), "id")).alias("key")), "links")
    first = links.groupBy("id").agg(F.min("key").alias("first"))
    edges = links.join(first, "id").select(F.col("first").alias("u"), F.col("key").alias("v"))
    members = first.select("id", F.col("first").alias("key"))
    pending = waiting.join(ids, "id", "left_anti")
    if state is not None:
        held = state.members.withColumnRenamed("key", "old")
        # an id that came before: what it hangs on and what links it now belong together
        again = members.join(held, "id").select(F.col("old").alias("u"), F.col("key").alias("v"))
        late = pending.join(held, "id").select(F.col("old").alias("u"), F.col("key").alias("v"))
        edges = edges.unionByName(again).unionByName(late)
        members = members.join(state.members.select("id"), "id", "left_anti")
        pending = pending.join(state.members.select("id"), "id", "left_anti")
    members = scratch(members, "split-members")
    components, nodes = C.extend(state.components if state else None, edges.distinct())
    if state is None:
        return SplitState(components.nodes, components.moves, members, _empty(spark, "root", "split"), spark.createDataFrame([], "root string, size long"), pending, {}, {"nodes": [nodes], "members": [members]}), members
    unsaved = {n: list(state.unsaved.get(n, [])) for n in GROWING}
    unsaved["nodes"].append(nodes)
    unsaved["members"].append(members)
    return SplitState(components.nodes, components.moves, state.members.unionByName(members), state.splits, state.sizes, pending, {k: list(v) for k, v in state.saved.items()}, unsaved), members


def group_keys(records: DataFrame, batches: DataFrame) -> DataFrame:
    """(id, group_key) after one delivery of everything: the smallest linking value of the group of each id, or the id itself if its group has none."""
    return deliver(None, records, batches)[0].group_keys()


def _fill(new: DataFrame, held: dict[str, float], total: float, proportions: dict[str, float]) -> DataFrame:
    """(root, split) for new components (root, size).

    The few large ones are placed one by one, largest first, where most is
    lacking.  Of the others only the sizes by hash bucket reach the driver; each
    split takes a run of buckets that fills what it lacks.
    """
    names = list(proportions)
    lack = {s: proportions[s] * total - held.get(s, 0.0) for s in names}
    large = new.filter(F.col("size") > F.lit(LARGE_PART * total))
    chosen: list[tuple[str, str]] = []
    for r in large.orderBy(F.desc("size"), "root").collect():
        best = max(names, key=lambda s: lack[s])
        lack[best] -= r["size"]
        chosen.append((r["root"], best))
    small = new.filter(F.col("size") <= F.lit(LARGE_PART * total)).withColumn("bucket", F.pmod(F.xxhash64("root", F.lit(20)), F.lit(BUCKETS)).cast("int"))
    sizes = {r["bucket"]: r["size"] for r in small.groupBy("bucket").agg(F.sum("size").alias("size")).collect()}
    want = {s: max(v, 0.0) for s, v in lack.items()}
    scale = sum(sizes.values()) / sum(want.values()) if sum(want.values()) > 0 else 0.0
    by_bucket, order, used = [], [s for s in names if want[s] > 0] or names[:1], 0.0
    for b in range(BUCKETS):
        while len(order) > 1 and used + sizes.get(b, 0) / 2 > want[order[0]] * scale:
            used -= want[order.pop(0)] * scale
        used += sizes.get(b, 0)
        by_bucket.append(order[0])
    spark = new.sparkSession
    placed = spark.createDataFrame(chosen, "root string, split string")
    table = F.array(*[F.lit(s) for s in names])
    index = "".join(str(names.index(s)) for s in by_bucket)
    rest = small.withColumn("split", table[F.substring(F.lit(index), F.col("bucket") + 1, F.lit(1)).cast("int")])
    return placed.unionByName(rest.select("root", "split"))


def update_splits(state: SplitState | None, records: DataFrame, batches: DataFrame, proportions: dict[str, float] = PROPORTIONS) -> SplitState:
    """The state after a delivery of records and batch rows, either of which may be empty.

    Components that had a split keep it; where a delivery joins components of
    different splits the merged one is quarantined, and stays so; new components
    fill the deficits of the proportions, measured in distinct ids.
    """
    new, members = deliver(state, records, batches)
    table = new.components.table().withColumnRenamed("node", "key")
    came = scratch(members.join(table, "key").groupBy("root").agg(F.count("*").alias("size")), "split-sizes")
    new.sizes = new.sizes.unionByName(came)
    new.unsaved.setdefault("sizes", []).append(came)
    sizes = C.present(new.sizes, "root", new.moves).groupBy("root").agg(F.sum("size").alias("size"))
    sized = scratch(sizes.join(new.component_splits(), "root", "left"), "split-sizes")
    sums = {r["split"]: float(r["size"]) for r in sized.groupBy("split").agg(F.sum("size").alias("size")).collect()}
    free = sum(v for s, v in sums.items() if s != QUARANTINE)
    fresh = scratch(_fill(sized.filter("split is null").select("root", "size"), {s: v for s, v in sums.items() if s in proportions}, free, proportions), "splits")
    new.splits = new.splits.unionByName(fresh)
    new.unsaved.setdefault("splits", []).append(fresh)
    new.pending = scratch(new.pending, "pending-links")
    return new


def split_checks(state: SplitState, records: DataFrame, proportions: dict[str, float] = PROPORTIONS, slack: float = 0.02) -> DataFrame:
    """(check_name, n_bad): ids without a split, ids with several, components in several splits outside of quarantine, and splits farther from their proportion than the slack and than the largest component."""
    given = state.assignment()
    ids = records.select(F.col("id").cast("string").alias("id")).filter("id is not null").distinct()
    without = ids.join(given, "id", "left_anti").agg(F.count("*").alias("n_bad")).select(F.lit("without a split").alias("check_name"), "n_bad")
    twice = given.groupBy("id").count().filter("count > 1").agg(F.count("*").alias("n_bad")).select(F.lit("in several splits").alias("check_name"), "n_bad")
    parted = given.groupBy("component").agg(F.count_distinct("split").alias("k")).filter("k > 1").agg(F.count("*").alias("n_bad")).select(F.lit("components parted").alias("check_name"), "n_bad")
    sizes = given.filter(F.col("split") != QUARANTINE).groupBy("split", "component").agg(F.count("*").alias("k"))
    most, whole = sizes.agg(F.coalesce(F.max("k"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    want = F.create_map(*[F.lit(x) for kv in proportions.items() for x in kv])
    off = sizes.groupBy("split").agg(F.sum("k").alias("k")).filter(F.abs(F.col("k") / F.lit(max(whole, 1)) - F.try_element_at(want, F.col("split"))) > F.lit(slack + most / max(whole, 1)))
    return without.unionByName(twice).unionByName(parted).unionByName(off.agg(F.count("*").alias("n_bad")).select(F.lit("proportions missed").alias("check_name"), "n_bad"))
