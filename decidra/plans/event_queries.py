"""Intervals, budgets, batches and running values over events, orders and documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from decidra.operators import windows
from decidra.plans.base import Catalogue, table

C = Catalogue()

_SECONDS = "floor(epoch(ts))::BIGINT"
_MERGED = f"""
i AS (SELECT user_id, {_SECONDS} AS s, {_SECONDS} + 3600 AS e FROM events WHERE user_id IS NOT NULL),
m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
k AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + 7200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM m)"""


def _hours(spark, d):
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").filter("user_id is not null").select("user_id", s.alias("s"), (s + 3600).alias("e"))


@C.add(f"WITH {_MERGED} SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS parts FROM k GROUP BY user_id, isl")
def interval_merge(spark, d):
    """Each user's events as hours, joined where at most two hours lie between."""
    return windows.merged_intervals(_hours(spark, d), ["user_id"], "s", "e", 7200)


@C.add(f"""
WITH i AS (SELECT user_id, {_SECONDS} AS a_start, {_SECONDS} + 3599 AS a_end FROM events WHERE user_id IS NOT NULL),
w AS (SELECT DISTINCT user_id, o AS win, 1704067200 + o * 604800 AS b_start, 1704067200 + o * 604800 + 86399 AS b_end FROM i, range(0, 5) r(o))
SELECT user_id, win, count(*) AS n, sum(least(a_end, b_end) - greatest(a_start, b_start) + 1)::BIGINT AS seconds FROM i JOIN w USING (user_id) WHERE a_start <= b_end AND b_start <= a_end GROUP BY user_id, win""")
def interval_coverage(spark, d):
    """Seconds of each user's hours that lie in the first day of each week."""
    a = _hours(spark, d).select("user_id", F.col("s").alias("a_start"), (F.col("e") - 1).alias("a_end"))
    b = a.select("user_id").distinct().withColumn("win", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long")))).withColumn("b_start", F.lit(1704067200) + F.col("win") * 604800).withColumn("b_end", F.col("b_start") + 86399)
    hit = windows.overlaps(a, b, ["user_id"], 86400)
    return hit.groupBy("user_id", "win").agg(F.count("*").alias("n"), F.sum(F.least("a_end", "b_end") - F.greatest("a_start", "b_start") + 1).alias("seconds"))


@C.add("""
SELECT doc_id, n, least(n, greatest(0, 20000 - before))::BIGINT AS taken FROM (
  SELECT doc_id, n, coalesce(sum(n) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT doc_id, source, coalesce(length(text), 0)::BIGINT AS n FROM documents))""")
def budget_prefix(spark, d):
    """Characters that each document gets of its source's 20,000, in order."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    return windows.prefix_budget(docs, ["source"], ["doc_id"], "n", 20_000).select("doc_id", "n", "taken")


@C.add("""
WITH RECURSIVE b AS (SELECT doc_id, source, least(n, 4000) AS want, row_number() OVER w AS i,
    coalesce(sum(least(n, 200)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later
  FROM (SELECT doc_id, source, coalesce(length(text), 0)::BIGINT AS n FROM documents) WINDOW w AS (PARTITION BY source ORDER BY doc_id)),
r AS (SELECT doc_id, source, i, greatest(0, least(want, 30000 - later))::BIGINT AS spent, greatest(0, least(want, 30000 - later))::BIGINT AS taken FROM b WHERE i = 1
  UNION ALL SELECT b.doc_id, b.source, b.i, (r.spent + greatest(0, least(b.want, 30000 - b.later - r.spent)))::BIGINT, greatest(0, least(b.want, 30000 - b.later - r.spent))::BIGINT FROM r JOIN b ON b.source IS NOT DISTINCT FROM r.source AND b.i = r.i + 1)
SELECT doc_id, taken FROM r""")
def budget_allocate(spark, d):
    """Documents of a source spend 30,000 characters in order, at most 4,000 each, leaving 200 to each after them while there are any."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    return windows.reserved_budget(docs, ["source"], ["doc_id"], "n", 30_000, 200, 4_000).select("doc_id", "taken")


@C.add("""
WITH RECURSIVE b AS (SELECT row_no, source_group, coalesce(length(buggy_rtl), 0)::BIGINT AS n, row_number() OVER (PARTITION BY source_group ORDER BY row_no) AS i FROM batch_06_mux_4_1 WHERE source_group IS NOT NULL),
r AS (SELECT row_no, source_group, i, 1 AS chunk, n AS used, 1 AS k FROM b WHERE i = 1
  UNION ALL SELECT b.row_no, b.source_group, b.i, CASE WHEN r.used + b.n + 100 > 20000 OR r.k >= 12 THEN r.chunk + 1 ELSE r.chunk END,
    CASE WHEN r.used + b.n + 100 > 20000 OR r.k >= 12 THEN b.n ELSE r.used + b.n END, CASE WHEN r.used + b.n + 100 > 20000 OR r.k >= 12 THEN 1 ELSE r.k + 1 END
  FROM r JOIN b ON b.source_group = r.source_group AND b.i = r.i + 1)
SELECT row_no, chunk FROM r""")
def greedy_chunks(spark, d):
    """Batches of a lineage group, of at most 20,000 characters and twelve rows."""
    b = table(spark, d, "batch_06_mux_4_1").filter("source_group is not null").select("row_no", "source_group", F.coalesce(F.length("buggy_rtl"), F.lit(0)).cast("long").alias("n"))
    return windows.greedy_chunks(b, "source_group", "row_no", "n", 20_000, 12, head=100).select("row_no", "chunk")


@C.add("""
WITH h AS (SELECT doc_id, coalesce(length(text), 0)::BIGINT AS n, sha256('9:' || doc_id) AS h FROM documents),
p AS (SELECT *, floor((row_number() OVER (ORDER BY h, doc_id) - 1) / 96)::BIGINT AS pool FROM h)
SELECT doc_id, pool, floor((row_number() OVER (PARTITION BY pool ORDER BY n, h, doc_id) - 1) / 8)::BIGINT AS batch FROM p""")
def length_batches(spark, d):
    """Documents in hash order cut into pools of 96, each sorted by length and cut into batches of eight."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    return windows.length_batches(docs, "doc_id", "n", 9, 8, 12).select("doc_id", "pool", "batch")


@C.add("""
SELECT event_id, round(sum(value) OVER w, 4) AS total, count(value) OVER w AS n FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""")
def rolling_mean_100(spark, d):
    """Sum and number of each user's last hundred values."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-99, 0)
    return table(spark, d, "events").filter("user_id is not null").select("event_id", F.round(F.sum("value").over(w), 4).alias("total"), F.count("value").over(w).alias("n"))


@C.add("""
WITH d AS (SELECT event_type, ts::DATE AS day, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT event_type, day::VARCHAR AS day, round(v, 6) AS v, coalesce(v < min(v) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS improved FROM d""")
def best_so_far(spark, d):
    """Daily means by type, and whether each is below all before."""
    days = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    before = F.min("v").over(Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    return days.select("event_type", F.col("day").cast("string").alias("day"), F.round("v", 6).alias("v"), F.coalesce(F.col("v") < before, F.lit(True)).alias("improved"))


@C.add("""
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderstatus <> 'P') WHERE r > 3""")
def retention_topk(spark, d):
    """Orders that a retention of each customer's newest three removes; pending ones are protected."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return table(spark, d, "orders").filter("o_orderstatus <> 'P'").withColumn("r", F.row_number().over(w)).filter("r > 3").select("o_orderkey")


@C.add("""
SELECT l_orderkey, l_linenumber, floor((l_linenumber - 1) / 3)::BIGINT AS win, count(*) OVER (PARTITION BY l_orderkey, floor((l_linenumber - 1) / 3)) AS size FROM lineitem""")
def accumulation_windows(spark, d):
    """Lines of an order in windows of three, and the size of each."""
    win = F.floor((F.col("l_linenumber") - 1) / 3)
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", win.alias("win"))
    return rows.withColumn("size", F.count("*").over(Window.partitionBy("l_orderkey", "win")))


@C.add("""
SELECT l_orderkey, bool_and(l_returnflag = 'N') AS none_returned, bool_or(l_linestatus = 'O') AS open FROM lineitem GROUP BY l_orderkey""")
def any_all(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_and(F.col("l_returnflag") == "N").alias("none_returned"), F.bool_or(F.col("l_linestatus") == "O").alias("open"))


@C.add("""
SELECT n_name AS nation, count(*) AS suppliers, round(100.0 * sum(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END) / greatest(count(*), 1), 2) AS covered_percent, round(min(s_acctbal), 2) AS low, round(max(s_acctbal), 2) AS high, round(avg(s_acctbal), 6) AS mean
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def coverage_ratio(spark, d):
    """A dimension join with guarded ratios, extremes and means."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.groupBy(F.col("n_name").alias("nation")).agg(F.count("*").alias("suppliers"), F.round(100.0 * F.count_if(F.col("s_acctbal") > 0) / F.greatest(F.count("*"), F.lit(1)), 2).alias("covered_percent"), F.round(F.min("s_acctbal"), 2).alias("low"), F.round(F.max("s_acctbal"), 2).alias("high"), F.round(F.avg("s_acctbal"), 6).alias("mean"))


@C.add("""
SELECT batch_index, array_to_string(list_slice(list_sort(list_distinct(list(id))), 1, 5), ',') AS sample, count(*) AS n, sum(coalesce(length(buggy_rtl), 0))::BIGINT AS bytes, arg_max(project, row_no) AS last_project
FROM batch_06_mux_4_1 WHERE id IS NOT NULL GROUP BY batch_index""")
def batch_report(spark, d):
    """Batches with their first five ids, sizes and last project."""
    b = table(spark, d, "batch_06_mux_4_1").filter("id is not null")
    # the first five are found without a list of all: rank within the batch after a distinct
    ids = b.select("batch_index", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("batch_index").orderBy("id"))).filter("r <= 5")
    five = ids.groupBy("batch_index").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("sample"))
    sums = b.groupBy("batch_index").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.length("buggy_rtl"), F.lit(0))).alias("bytes"), F.max_by("project", F.when(F.col("project").isNotNull(), F.col("row_no"))).alias("last_project"))
    return sums.join(five.withColumnRenamed("batch_index", "of"), F.col("batch_index").eqNullSafe(F.col("of"))).select("batch_index", "sample", "n", "bytes", "last_project")


@C.add("SELECT user_id, event_type, count(*) AS n, round(sum(value), 4) AS value FROM (SELECT DISTINCT event_id, user_id, event_type, value FROM events) GROUP BY user_id, event_type")
def stream_ledger(spark, d):
    """Events applied to a ledger as a stream of several micro-batches, each event sent twice and applied once, and the ledger's sums."""
    from decidra.session import scratch_path
    from decidra.streaming import ledger

    sent, path = table(spark, d, "events"), scratch_path(spark, "sent")
    sent.unionByName(sent).repartition(6).write.parquet(path)
    events = ledger.replay(spark, path, key="event_id", files_per_batch=2)
    return events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@C.add("SELECT id, floor((row_number() OVER (ORDER BY id) - 1) / 3)::INT AS batch FROM (SELECT DISTINCT id FROM batch_06_mux_4_1 WHERE id IS NOT NULL ORDER BY id LIMIT 6)")
def ordered_deliveries(spark, d):
    """Two deliveries that a ledger takes because each is exactly the next batch of three (a top-k by definition)."""
    from decidra.session import scratch_path
    from decidra.streaming import ledger

    b, home = table(spark, d, "batch_06_mux_4_1").select("id").filter("id is not null").distinct(), scratch_path(spark, "ledger")
    for number in range(2):
        ids = ledger.next_batch(b, ledger.read(spark, home), "id", 3)
        ledger.apply_in_order(spark.createDataFrame([(i, number) for i in ids], "id string, number int"), number, home, "id", b, 3)
    return ledger.read(spark, home).select("id", F.col("number").alias("batch"))
