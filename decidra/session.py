"""Sessions and shared scratch tables.

``scratch`` cuts a lineage by writing a Parquet table into the folder that the
cluster names in ``spark.checkpoint.dir``; every executor shares that folder, so
losing executors loses nothing.  Only where the setting is absent, as in tests,
a folder of this process is used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_written: list[tuple[SparkSession, str]] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", app: str = "decidra") -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; on a local master without the setting, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="decidra-"))
        atexit.register(shutil.rmtree, _own_dir[0], True)
    return "file://" + _own_dir[0]


def scratch_path(spark: SparkSession, label: str = "t") -> str:
    """A new path in the shared folder, deleted when the process ends or by drop_path."""
    path = f"{shared_dir(spark)}/decidra-scratch/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_drop_all)
    _written.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that no later plan reads any more."""
    _delete(spark, path)
    _written[:] = [x for x in _written if x[1] != path]


def scratch(df: DataFrame, label: str = "t") -> DataFrame:
    """Write df once into the shared folder and read it back, without its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._decidra_path = path  # for drop_scratch
    return out


def drop_scratch(df: DataFrame) -> None:
    """Delete a scratch table that no later plan reads any more."""
    path = getattr(df, "_decidra_path", None)
    if path:
        drop_path(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _drop_all() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the JVM may have ended before
            pass


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="decidra-ship-")
    atexit.register(shutil.rmtree, folder, True)
    archive = Path(folder, "decidra_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, str(p.relative_to(home.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
