"""Session defaults, code shipping and shared scratch storage."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def local_session(name: str = "quaver", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benches; a cluster passes its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="quaver-"), "quaver.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores after it until no column has it (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share. A single process makes one of its own where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quaver-scratch-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{scratch(spark)}/quaver/{uuid.uuid4().hex}-{tag}"
    fs, where = _fs(spark, path)
    fs.deleteOnExit(where)
    return path


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: a cut of the lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quaver_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that materialize() wrote and nobody reads any more."""
    remove_path(df.sparkSession, df._quaver_path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Jobs started here send at most so many rows to Python in one batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now: Spark does so once the driver's garbage is collected."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that scratch_path() named."""
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
