"""Sinks: ordered JSON lines, one folder per split, append-only logs, published snapshots, rejects, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, order: str = "id", files: int | None = None) -> None:
    """JSON lines in the order of a column over the files, as many as given or as the session shuffles to, keys sorted; an existing path is an error."""
    rows = df.select(*sorted(df.columns))
    rows = (rows.repartitionByRange(files, order) if files else rows.repartitionByRange(order)).sortWithinPartitions(order)
    rows.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_by(df: DataFrame, path: str, column: str) -> None:
    """Parquet, one folder per value of a column; an existing path is an error."""
    df.write.mode("errorifexists").partitionBy(column).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def split_rejects(df: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rows without and with errors, an array of texts; rejected rows carry them."""
    marked = df.withColumn("errors", errors)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


def publish(df: DataFrame, root: str, name: str) -> str:
    """Write a snapshot so that readers see all of it or nothing: staged, checked, renamed, and named in ``latest``."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    staged, final = f"{root}/.staged-{uuid.uuid4().hex}", f"{root}/{name}"
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path(final)):
        raise FileExistsError(final)
    df.write.parquet(staged)
    if spark.read.parquet(staged).isEmpty():
        fs.delete(path(staged), True)
        raise ValueError("an empty snapshot is not published")
    if not fs.rename(path(staged), path(final)):
        raise OSError(f"{staged} can't be renamed")
    spark.createDataFrame([(name,)], "name string").coalesce(1).write.mode("overwrite").text(f"{root}/latest")
    return final


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot that ``latest`` names."""
    return spark.read.parquet(f"{root}/{spark.read.text(f'{root}/latest').first()['value']}")


def markdown(df: DataFrame, most: int = 200) -> str:
    """A small table as Markdown, for reports over aggregates; a last line says how many rows it leaves out beyond ``most``."""
    rows = df.limit(most).collect()
    left = df.count() - most if len(rows) == most else 0
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(cell(v) for v in r) + " |" for r in rows), *([f"\n{left} more rows"] if left > 0 else [])])
