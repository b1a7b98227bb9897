"""Session defaults and the shared folder that checkpoints go to."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
_SCOPES: list[list[str]] = []


def build_session(app_name: str = "weftline", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution and UTC timestamps; keyword arguments are extra settings
    with ``_`` written for ``.`` (``spark_sql_shuffle_partitions=8``)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), str(value))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    ``spark.checkpoint.dir`` names it on a cluster.  Only a local master, where driver and executors
    share one machine, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="weftline-checkpoint-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder, for tables written between two jobs."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def freed_afterwards(spark: SparkSession) -> Iterator[None]:
    """Whatever operators store inside is deleted at the end.

    Results are read from such tables, so write or collect them inside, to a path that is from outside.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            drop_stored(spark, path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside delete their shuffle files when they end, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint, so that a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet below the checkpoint folder; the table read back, and its path for ``drop_stored``."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: cuts the lineage like a checkpoint, in compressed columns."""
    return write_stored(df, name)[0]


def store_counted(df: DataFrame, name: str, **sums) -> tuple[DataFrame, str, dict]:
    """``write_stored`` and, from the same pass, the number of rows ``n`` and other aggregates."""
    seen = Observation()
    counted = df.observe(seen, F.count("*").alias("n"), *[column.alias(key) for key, column in sums.items()])
    return *write_stored(counted, name), seen.get


def bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` as a table in ``buckets`` by the hash of ``keys``, one file each, and what deletes it.

    Joins and aggregations on the keys with that many partitions need no shuffle of it.
    """
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"weftline_{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path)
    dealt.option("compression", "zstd").saveAsTable(table)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        drop_stored(spark, path)

    return spark.table(table), drop


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def local_folder(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` lies in the local file system, which ``open`` reaches; None where another one holds it."""
    files, where = _file_system(spark, path)
    full = files.makeQualified(where).toUri()
    return full.getPath() if full.getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def make_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.mkdirs(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(where) if entry.isDirectory()]


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a table of ``write_stored`` that nothing reads any more."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Put this package on the Python path of the workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).parent
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{root.name}", "zip", root.parent, root.name))
        _SHIPPED.add(sc.applicationId)


@contextmanager
def arrow_batches(spark: SparkSession, max_bytes: int, max_rows: int | None = None) -> Iterator[None]:
    """Jobs that run inside hand rows to Python in batches of about ``max_bytes`` and of ``max_rows`` at most; a limit of bytes
    that the session has holds.

    Spark goes over all rows of a batch again for each one it adds where a column is a list, so these want few rows.
    """
    keys = {"spark.sql.execution.arrow.maxBytesPerBatch": max_bytes}
    if spark.conf.get(next(iter(keys)), None) is not None:
        keys = {}
    rows, before = "spark.sql.execution.arrow.maxRecordsPerBatch", None
    if max_rows:
        before = spark.conf.get(rows)
        keys[rows] = min(max_rows, int(before)) if int(before) > 0 else max_rows
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in keys:
            spark.conf.set(key, before) if key == rows else spark.conf.unset(key)
