"""A resumable ledger: micro-batches applied once each, duplicates rejected, state rebuilt from what was written.

Rows lie in buckets of their key's hash, ``batch=number/bucket=n``.  A micro-batch
looks for its keys in the buckets it has itself, so a small one reads a part of
the ledger.  One writer at a time holds the ledger's lock; what a run depends on,
the data and its settings, is written beside it and compared on resuming.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decidra.session import scratch_path

BUCKETS = 64
BUCKET = "_bucket"


class LedgerError(ValueError):
    """A delivery or a resume that the ledger refuses."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int"))


def apply_once(batch: DataFrame, number: int, ledger: str, key: str) -> None:
    """Write the rows of a micro-batch that the ledger lacks, as batch=number.

    A batch that is applied again after a failure overwrites its own folder, so
    applying is idempotent; a key that an earlier batch has is rejected.
    """
    spark = batch.sparkSession
    fresh = _bucketed(batch.filter(f"{key} is not null").dropDuplicates([key]), key)
    earlier = read(spark, ledger, before=number, bucketed=True)
    if earlier is not None:
        touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # BUCKETS at most
        fresh = fresh.join(earlier.filter(F.col(BUCKET).isin(touched)).select(BUCKET, key), [BUCKET, key], "left_anti")
    fresh.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{ledger}/batch={number:08d}")


def apply_in_order(batch: DataFrame, number: int, ledger: str, key: str, records: DataFrame, size: int) -> None:
    """apply_once for a delivery that must be exactly the next batch: the first ``size`` keys, in their order, that the ledger lacks; LedgerError otherwise."""
    spark = batch.sparkSession
    want = next_batch(records, read(spark, ledger, before=number), key, size)
    got = [r[key] for r in batch.select(key).limit(size + 1).collect()]
    if sorted(got, key=str) != sorted(want, key=str):
        raise LedgerError(f"the delivery has {got[:5]}, the next batch is {want[:5]}")
    apply_once(batch, number, ledger, key)


def next_batch(records: DataFrame, ledger: DataFrame | None, key: str, size: int) -> list:
    """The first ``size`` keys, in their order, that the ledger lacks."""
    return [r[key] for r in todo(records, ledger, key).select(key).distinct().orderBy(key).limit(size).collect()]


def _batches(spark: SparkSession, ledger: str) -> list[str]:
    fs, path = _fs(spark, ledger)
    if not fs.exists(path):
        return []
    found = [str(s.getPath().getName()) for s in fs.listStatus(path)]
    return sorted(n for n in found if n.startswith("batch=") and fs.exists(_fs(spark, f"{ledger}/{n}/_SUCCESS")[1]))


def read(spark: SparkSession, ledger: str, key_only: str | None = None, before: int | None = None, bucketed: bool = False) -> DataFrame | None:
    """The applied rows of all finished batches (with a number below before); None if there are none."""
    names = [n for n in _batches(spark, ledger) if before is None or int(n.split("=")[1]) < before]
    filled = [n for n in names if any(str(x.getPath().getName()).startswith(BUCKET) for x in _fs(spark, ledger)[0].listStatus(_fs(spark, f"{ledger}/{n}")[1]))]
    if not filled:  # a batch that brought nothing new has no bucket
        return None
    rows = spark.read.option("basePath", ledger).parquet(*[f"{ledger}/{n}" for n in filled]).drop("batch")
    rows = rows if bucketed else rows.drop(BUCKET)
    return rows.select(key_only) if key_only else rows


def lock(spark: SparkSession, ledger: str) -> None:
    """Take the ledger for one writer; LedgerError if another has it. What an abandoned write left is removed."""
    fs, path = _fs(spark, f"{ledger}/.lock")
    try:
        fs.create(path, False).close()
    except Exception as e:  # the file system says that it exists
        raise LedgerError(f"{ledger} has a writer") from e
    root = _fs(spark, ledger)[1]
    for s in fs.listStatus(root):
        name = str(s.getPath().getName())
        if name.startswith(".tmp_") or name.startswith("batch=") and not fs.exists(_fs(spark, f"{ledger}/{name}/_SUCCESS")[1]):
            fs.delete(s.getPath(), True)


def unlock(spark: SparkSession, ledger: str) -> None:
    fs, path = _fs(spark, f"{ledger}/.lock")
    fs.delete(path, False)


def check_resume(spark: SparkSession, ledger: str, identity: dict[str, str], may_change: tuple[str, ...] = ()) -> None:
    """Compare what a run depends on with what the ledger's first run wrote down; LedgerError names every difference, settings that may change aside."""
    fs, path = _fs(spark, f"{ledger}/.identity")
    if not fs.exists(path):
        spark.createDataFrame([(json.dumps(identity, sort_keys=True),)], "value string").coalesce(1).write.text(f"{ledger}/.identity")
        return
    saved = json.loads(spark.read.text(f"{ledger}/.identity").first()["value"])
    wrong = [f"{k}: saved {saved.get(k)!r}, now {identity.get(k)!r}" for k in sorted(saved.keys() | identity.keys()) if k not in may_change and saved.get(k) != identity.get(k)]
    if wrong:
        raise LedgerError("the run can't be resumed: " + "; ".join(wrong))


def run(stream: DataFrame, ledger: str, checkpoint: str, key: str, transform: Callable[[DataFrame], DataFrame] | None = None, identity: dict[str, str] | None = None) -> None:
    """Apply everything a stream has to the ledger, as its only writer; a second run goes on where the first ended."""
    spark = stream.sparkSession
    lock(spark, ledger)
    try:
        if identity is not None:
            check_resume(spark, ledger, identity)

        def one(batch: DataFrame, number: int) -> None:
            apply_once(transform(batch) if transform else batch, number, ledger, key)

        stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        unlock(spark, ledger)


def periodic(events: DataFrame, step: str, every: int, last: str | None = None) -> DataFrame:
    """Events of every so many steps, and those that a boolean column marks as last; also for streams."""
    due = F.col(step) % every == 0
    return events.filter(due | F.coalesce(F.col(last), F.lit(False)) if last else due)


def replay(spark: SparkSession, path: str, key: str, files_per_batch: int = 64) -> DataFrame:
    """The rows of a Parquet table after they went through a ledger of their own as a stream."""
    home = scratch_path(spark, "ledger")
    schema = spark.read.parquet(path).schema
    fs, where = _fs(spark, path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fs.getFileStatus(where).isDirectory():
        stream = reader.parquet(path)
    else:  # a stream reads folders only
        stream = reader.option("pathGlobFilter", str(where.getName())).parquet(str(where.getParent().toString()))
    run(stream, f"{home}/rows", f"{home}/checkpoint", key)
    rows = read(spark, f"{home}/rows")
    return rows if rows is not None else spark.createDataFrame([], schema)


def todo(records: DataFrame, ledger: DataFrame | None, key: str) -> DataFrame:
    """Records that the ledger lacks."""
    rows = records.filter(f"{key} is not null")
    return rows if ledger is None else rows.join(ledger.select(key).distinct(), key, "left_anti")


def rebuilt(records: DataFrame, ledger: DataFrame, key: str, columns: list[str], ordinal: str | None = None) -> DataFrame:
    """Records in their own columns with the ledger's, where it has them; in the order of an ordinal column if one is named."""
    out = records.join(ledger.select(key, *columns), key, "left")
    return out.repartitionByRange(ordinal).sortWithinPartitions(ordinal) if ordinal else out
