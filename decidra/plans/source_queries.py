"""Scans and sinks exercised end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from decidra.functions import hashing
from decidra.operators import nested
from decidra.plans.base import Catalogue, decoded_sql, table
from decidra.session import scratch_path
from decidra.sources import adapters, readers, sinks

C = Catalogue()


@C.add("SELECT source, count(*) AS n, count(state) AS states, sum(coalesce(length(gold), 0))::BIGINT AS gold_chars FROM veribugbench_5q GROUP BY source")
def jsonl_round_trip(spark, d):
    """Records written as ordered JSON lines and read back strictly."""
    v = table(spark, d, "veribugbench_5q").select("id", "source", "state", "gold")
    path = scratch_path(spark, "jsonl")
    sinks.write_jsonl(v, path, "id")
    back = readers.read_jsonl_strict(spark, path, v.schema)
    return back.groupBy("source").agg(F.count("*").alias("n"), F.count("state").alias("states"), F.sum(F.coalesce(F.length("gold"), F.lit(0))).alias("gold_chars"))


@C.add("SELECT DISTINCT unnest(regexp_extract_all(text, '[0-9a-f]{12}')) AS id FROM documents")
def text_id_scan(spark, d):
    """Hash-like ids anywhere in documents."""
    return readers.ids_in_text(table(spark, d, "documents"), F.col("text"), "[0-9a-f]{12}")


@C.add("SELECT substr(sha1(coalesce(text, '')), 1, 16) AS h, count(*) AS n FROM test_items GROUP BY 1")
def adapter_records(spark, d):
    """Held-out items as decision records, by the hash in their id."""
    items = table(spark, d, "test_items").select(F.col("item_id").alias("line"), F.col("text").alias("instruction"))
    return adapters.instructions(items).select(F.substring("source_group", 8, 16).alias("h")).groupBy("h").agg(F.count("*").alias("n"))


@C.add("""
WITH a AS (SELECT id, row_no, 0 AS r FROM batch_06_mux_4_1 WHERE batch_index = 0 AND id IS NOT NULL UNION ALL SELECT id, row_no, 1 AS r FROM batch_06_mux_4_1 WHERE batch_index <> 0 AND id IS NOT NULL)
SELECT id, min(r) AS source_rank FROM a GROUP BY id""")
def file_precedence(spark, d):
    """Ids by the first of two files of JSON lines that has them."""
    b = table(spark, d, "batch_06_mux_4_1").select("id", "row_no", "batch_index")
    root, found = scratch_path(spark, "files"), []
    for rank, part in enumerate((b.filter("batch_index = 0"), b.filter("batch_index <> 0"))):
        part.drop("batch_index").write.option("ignoreNullFields", "false").json(f"{root}/{rank}")
        found.append(readers.read_jsonl(spark, f"{root}/{rank}", b.drop("batch_index").schema)[0].withColumn("source_rank", F.lit(rank)))
    return readers.first_by_precedence(found, "id").select("id", "source_rank")


@C.add("""
SELECT check_name, n_bad FROM (SELECT 'missing' AS check_name, (SELECT count(DISTINCT id) FROM veribugbench_5q WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM batch_06_mux_4_1 WHERE id IS NOT NULL)) AS n_bad
UNION ALL SELECT 'extra', (SELECT count(DISTINCT id) FROM batch_06_mux_4_1 WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM veribugbench_5q WHERE id IS NOT NULL))
UNION ALL SELECT 'repeated', (SELECT count(*) FROM (SELECT id FROM batch_06_mux_4_1 GROUP BY id HAVING count(*) > 1))) WHERE n_bad > 0""")
def shard_coverage(spark, d):
    """What shards of JSON lines, one for each batch, lack of the records' ids, have beyond them, or have repeatedly."""
    path = scratch_path(spark, "shards")
    table(spark, d, "batch_06_mux_4_1").select("id", "row_no", F.coalesce("batch_index", F.lit(-1)).alias("part")).write.partitionBy("part").option("ignoreNullFields", "false").json(path)
    shards = readers.read_shards(spark, path, table(spark, d, "batch_06_mux_4_1").select("id", "row_no").schema)
    return readers.shard_coverage(shards, table(spark, d, "veribugbench_5q"), "id")


@C.add("SELECT source_group, count(*) AS n, count(testbench) AS benches FROM projects GROUP BY source_group")
def wrapped_json(spark, d):
    """Projects as the array of one JSON document, read back."""
    p = table(spark, d, "projects").select("project_id", "source_group", "testbench")
    path = scratch_path(spark, "wrapped")
    # one document by definition: the table of projects is small
    p.agg(F.to_json(F.struct(F.collect_list(F.struct(*p.columns)).alias("cases"))).alias("value")).coalesce(1).write.text(path)
    return readers.read_wrapped(spark, path, "cases", p.schema).groupBy("source_group").agg(F.count("*").alias("n"), F.count("testbench").alias("benches"))


@C.add("SELECT kind, plan_id, source, round(target_share, 9) AS target_share FROM (SELECT 'all' AS kind, * FROM mix_plans UNION ALL SELECT 'repeated', * FROM mix_plans WHERE max_repeats > 1)")
def tagged_csv(spark, d):
    """Plans in two CSV files, each row tagged with its file's kind."""
    m, root = table(spark, d, "mix_plans"), scratch_path(spark, "csv")
    parts = {"all": m, "repeated": m.filter("max_repeats > 1")}
    for kind, df in parts.items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/{kind}")
    return readers.read_tagged_csv(spark, {k: f"{root}/{k}" for k in parts}, m.schema).select("kind", "plan_id", "source", F.round("target_share", 9).alias("target_share"))


@C.add("SELECT project_id, replace(testbench, chr(13) || chr(10), chr(10)) || chr(10) || chr(10) || chr(10) || '// end of ' || project_id || chr(10) AS text FROM projects WHERE project_id IS NOT NULL AND testbench IS NOT NULL")
def text_tree(spark, d):
    """Testbenches and closing notes as files in a folder for each project, read as texts and joined by folder."""
    p, root = table(spark, d, "projects").filter("project_id is not null and testbench is not null").select("project_id", F.replace("testbench", F.lit("\r\n"), F.lit("\n")).alias("value")), scratch_path(spark, "tree")
    p.write.partitionBy("project_id").text(f"{root}/a")
    p.select("project_id", F.concat(F.lit("// end of "), "project_id").alias("value")).write.partitionBy("project_id").text(f"{root}/b")
    files = readers.read_text_tree(spark, root, "part-*").withColumn("project_id", F.regexp_extract("path", "project_id=([^/]*)/", 1))
    return readers.joined_siblings(files.select(F.concat("project_id", F.lit("/"), F.regexp_extract("path", "/([ab])/project_id", 1)).alias("path"), "text")).select(F.col("folder").alias("project_id"), "text")


@C.add("SELECT kind, count(*) AS n, count(DISTINCT v) AS distinct_values FROM (SELECT 'run' AS kind, plan_id AS v FROM mix_plans UNION ALL SELECT 'train', source FROM mix_plans UNION ALL SELECT 'run', plan_id FROM mix_plans) GROUP BY kind")
def append_log(spark, d):
    """A log that three appends write, read by its types."""
    m, path = table(spark, d, "mix_plans"), scratch_path(spark, "log")
    for kind, column in (("run", "plan_id"), ("train", "source"), ("run", "plan_id")):
        sinks.append_log(m.select(F.lit(kind).alias("type"), F.col(column).alias("v")), path)
    return spark.read.schema("type string, v string").json(path).groupBy(F.col("type").alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("v").alias("distinct_values"))


@C.add("SELECT row_no, id, n FROM batch_06_mux_4_1 LEFT JOIN (SELECT id, count(*) AS n FROM veribugbench_5q WHERE id IS NOT NULL GROUP BY id) USING (id)")
def rebuilt_order(spark, d):
    """Judged rows in the order of their numbers, with what a ledger has of their ids."""
    from decidra.streaming import ledger

    led = table(spark, d, "veribugbench_5q").filter("id is not null").groupBy("id").agg(F.count("*").alias("n"))
    return ledger.rebuilt(table(spark, d, "batch_06_mux_4_1").select("row_no", "id"), led, "id", ["n"], "row_no").select("row_no", "id", "n")


@C.add("SELECT kind, n FROM (SELECT 'refused' AS kind, 1::BIGINT AS n)")
def overwrite_refused(spark, d):
    """A second write to the path of a sink is refused."""
    from pyspark.errors import AnalysisException

    m, path = table(spark, d, "region").select("r_regionkey", "r_name"), scratch_path(spark, "once")
    sinks.write_jsonl(m, path, "r_regionkey")
    try:
        sinks.write_jsonl(m, path, "r_regionkey")
        kind = "written twice"
    except AnalysisException:
        kind = "refused"
    return spark.range(1).select(F.lit(kind).alias("kind"), F.lit(1).cast("long").alias("n"))


@C.add("SELECT split, count(*) AS n, count(DISTINCT id) AS ids FROM (SELECT id, coalesce(lower(trim(provenance.split)), 'none') AS split FROM veribugbench_5q) GROUP BY split")
def partitioned_sink(spark, d):
    """Records written in a folder per split and all together, and counted from both."""
    v = table(spark, d, "veribugbench_5q").select("id", F.coalesce(F.lower(F.trim("provenance.split")), F.lit("none")).alias("split"))
    path = scratch_path(spark, "splits")
    sinks.write_by(v, f"{path}/split", "split")
    v.write.parquet(f"{path}/all")
    apart = spark.read.parquet(f"{path}/split").groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
    whole = spark.read.parquet(f"{path}/all").groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
    return apart.intersect(whole)  # a split that differs between the two is missing


@C.add(f"""
SELECT error, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN id IS NULL THEN 'no id' END, CASE WHEN state IS NULL OR trim(state) = '' THEN 'no state' END,
  CASE WHEN q IS NULL OR json_type(q) NOT IN ('OBJECT', 'ARRAY') THEN 'questions' END, CASE WHEN g IS NULL OR json_type(g) NOT IN ('OBJECT', 'ARRAY') THEN 'gold' END], lambda x: x IS NOT NULL)) AS error
  FROM (SELECT id, state, {decoded_sql("questions")} AS q, {decoded_sql("gold")} AS g FROM veribugbench_5q)) GROUP BY error""")
def record_validation(spark, d):
    """Rejected records by error; questions and gold may be keyed or listed, plain or re-encoded."""
    v = table(spark, d, "veribugbench_5q")
    errors = F.array_compact(F.array(F.when(F.col("id").isNull(), F.lit("no id")), F.when(F.col("state").isNull() | (F.trim("state") == ""), F.lit("no state")), F.when(nested.heads(F.col("questions")).isNull(), F.lit("questions")), F.when(nested.heads(F.col("gold")).isNull(), F.lit("gold"))))
    _, rejected = sinks.split_rejects(v.select("id", "state", "questions", "gold"), errors)
    return rejected.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@C.add("SELECT count(DISTINCT project_id) AS n FROM projects WHERE project_id IS NOT NULL")
def content_snapshot(spark, d):
    """Projects published as a snapshot and read through its pointer."""
    root = scratch_path(spark, "snapshots")
    sinks.publish(table(spark, d, "projects").select("project_id", hashing.short_id(F.coalesce("testbench", F.lit(""))).alias("h")), root, "v1")
    return sinks.latest(spark, root).agg(F.count_distinct("project_id").alias("n"))
