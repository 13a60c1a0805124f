"""The pN_ queries of the llm operators. Each takes (spark, directory of the tables) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from decidra.llm import components, cross_split, encoding, group_splits, leaks, mixing, near_dups, pii
from decidra.session import scratch, scratch_path


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _rtl(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return _table(spark, d, "veribugbench_5q"), _table(spark, d, "batch_06_mux_4_1")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.cross_split_pairs(*_rtl(spark, d))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.overlap_report(*_rtl(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return group_splits.group_keys(*_rtl(spark, d))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    """(id, component, split) after one delivery of everything."""
    return group_splits.update_splits(None, *_rtl(spark, d)).assignment()


def p3_incremental(spark: SparkSession, d: str) -> DataFrame:
    """(id, group_key) after three deliveries, of new rows only, with the state saved and loaded between: the records ingested before 2025-10-01, the batch rows, the other records."""
    records, batches = _rtl(spark, d)
    early = F.coalesce(F.col("ingested_at") < F.lit("2025-10-01 00:00:00").cast("timestamp_ntz"), F.lit(False))
    path, state = scratch_path(spark, "split-state"), None
    for r, b in ((records.filter(early), batches.filter("false")), (records.filter("false"), batches), (records.filter(~early), batches.filter("false"))):
        group_splits.update_splits(state, r, b).save(path)
        state = group_splits.SplitState.load(spark, path)
    return state.group_keys()


def p3_split_checks(spark: SparkSession, d: str) -> DataFrame:
    """(check_name, n_bad): whether the splits of one delivery hold what they promise."""
    records, batches = _rtl(spark, d)
    return group_splits.split_checks(group_splits.update_splits(None, records, batches), records)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return near_dups.near_duplicate_pairs(*_rtl(spark, d))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """(id, group_id, copies, links): each id with RTL, the smallest id of its near-duplicate group, the ids with the same RTL, and the different texts likely to its own."""
    members, links = near_dups.near_duplicates(*_rtl(spark, d))
    names = members.groupBy("cid").agg(F.min("id").alias("name"), F.count("*").alias("copies"))
    names = scratch(names, "names")
    named = links.join(names.select(F.col("cid").alias("cid_a"), F.col("name").alias("u")), "cid_a").join(names.select(F.col("cid").alias("cid_b"), F.col("name").alias("v")), "cid_b").select("u", "v")
    named = scratch(named, "named")
    degree = named.select(F.explode(F.array("u", "v")).alias("name")).groupBy("name").agg(F.count("*").alias("links"))
    groups, _ = components.extend(None, named.unionByName(names.select(F.col("name").alias("u"), F.col("name").alias("v"))))
    rows = names.join(groups.table().select(F.col("node").alias("name"), F.col("root").alias("group_id")), "name").join(degree, "name", "left")
    return members.join(rows.select("cid", "group_id", "copies", F.coalesce("links", F.lit(0)).alias("links")), "cid").select("id", "group_id", "copies", "links")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.unreachable_shares(_table(spark, d, "veribugbench_5q"), _table(spark, d, "mix_plans"))


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(_table(spark, d, "veribugbench_5q"), _table(spark, d, "mix_plans"))


def p5_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(_table(spark, d, "veribugbench_5q"), _table(spark, d, "mix_plans"))


def p5_checks(spark: SparkSession, d: str) -> DataFrame:
    """(check_name, n_bad): whether the mixtures hold what they promise."""
    return mixing.mixture_checks(_table(spark, d, "veribugbench_5q"), _table(spark, d, "mix_plans"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_corpus(_table(spark, d, "documents"))


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, same): whether decoding gives the text back; null counts as empty."""
    docs = _table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = encoding.decode_corpus(encoding.encode_corpus(docs))
    a, b = (x.select("doc_id", F.xxhash64("text").alias(f"h{i}")) for i, x in enumerate((docs, back)))
    return a.join(b, "doc_id").select("doc_id", (F.col("h0") == F.col("h1")).alias("same"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.long_run_leaks(_table(spark, d, "documents"), _table(spark, d, "test_items"))


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(_table(spark, d, "documents"), _table(spark, d, "test_items"))


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """A row per leaked item: its documents, those with a long run, and its highest coverage."""
    found = p7_leaks(spark, d)
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.count_if(F.col("longest") >= leaks.LONG_RUN).alias("long_runs"), F.max("coverage").alias("coverage"))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """(check_name, n_bad) of the leaks: tiles that overlap in their item, pairs without enough, long runs that p7_found lacks."""
    docs, items = _table(spark, d, "documents"), _table(spark, d, "test_items")
    tiles = scratch(leaks.leak_tiles(docs, items), "leak-tiles")
    after = F.lead("item_start").over(Window.partitionBy("did", "iid").orderBy("item_start"))
    overlap = tiles.withColumn("after", after).filter(F.col("item_start") + F.col("words") > F.col("after")).agg(F.count("*").alias("n_bad")).select(F.lit("overlapping tiles").alias("check_name"), "n_bad")
    found = scratch(p7_leaks(spark, d), "leaks")
    weak = found.filter((F.col("longest") < leaks.LONG_RUN) & (F.col("coverage") < leaks.COVERAGE) | (F.col("coverage") > 1)).agg(F.count("*").alias("n_bad")).select(F.lit("too little shared").alias("check_name"), "n_bad")
    runs = found.filter(F.col("longest") >= leaks.LONG_RUN).select("doc_id", "item_id").join(p7_found(spark, d), ["doc_id", "item_id"], "left_anti").agg(F.count("*").alias("n_bad")).select(F.lit("long runs apart").alias("check_name"), "n_bad")
    return overlap.unionByName(weak).unionByName(runs)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.mentions(_table(spark, d, "documents"), _table(spark, d, "person_names")).select("doc_id", "kind", "start_pos").distinct()


def p8_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(_table(spark, d, "documents"), _table(spark, d, "person_names"))


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """(check_name, n_bad) of the redaction: rows lost, nulls changed, and texts whose length is not that of their rest and their placeholders."""
    docs, names = _table(spark, d, "documents"), _table(spark, d, "person_names")
    holders = F.create_map(*[F.lit(x) for k, v in pii.PLACEHOLDERS.items() for x in (k, len(v))])
    moved = pii.mentions(docs, names).groupBy("doc_id").agg(F.sum(holders[F.col("kind")] - (F.col("end_pos") - F.col("start_pos"))).alias("by"), F.count("*").alias("n"))
    both = docs.select("doc_id", F.col("text").alias("before")).join(pii.redact(docs, names), "doc_id", "left").join(moved, "doc_id", "left")
    bad = {
        "rows lost": F.col("n_mentions").isNull(),
        "nulls changed": F.col("before").isNull() != F.col("text").isNull(),
        "mentions apart": F.coalesce("n", F.lit(0)) != F.col("n_mentions"),
        "rest changed": F.length("text") - F.length("before") != F.coalesce("by", F.lit(0)),
    }
    wide = both.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in bad.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n_bad")) for n in bad])).alias("r")).select("r.*")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_report, p3_found, p3_splits, p3_incremental, p3_split_checks, p4_found, p4_groups, p5_found, p5_shares, p5_mix, p5_checks, p6_ids, p6_round_trip, p7_found, p7_leaks, p7_items, p7_checks, p8_found, p8_redacted, p8_checks)}
