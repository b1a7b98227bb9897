"""Batch writers."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.rows import spread_rows
from weftline.session import arrow_batches, local_folder, path_exists, ship_package

#: The folder of rows without a value, as Spark names it.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Texts that a task which writes files gets at once.
BATCH_BYTES = 4 << 20

#: For writes of very many small files through Spark.  Local ones get no checksum file beside them, which costs several processes a file;
#: each task moves its own files when it commits, so that the driver does not move all of them one by one at the end.
SMALL_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.algorithm.version": "2",
}


def write_csv(df: DataFrame, path: str) -> None:
    """Headerless CSV files, replacing what is there."""
    df.write.mode("overwrite").csv(path)


def recommendation_lines(recommendations: DataFrame) -> DataFrame:
    """(user, candidates) -> ``value`` with ``user<TAB>id,id,...``."""
    return recommendations.select(
        F.concat_ws("\t", F.col("user").cast("string"), F.array_join("candidates", ",")).alias("value")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_file_each(df: DataFrame, path: str, folder: str) -> None:
    """A text file for each row of ``df(folder, text)``, in a folder per value of ``folder``; all cores write.

    Names, folders and contents are those of Spark's text files.  In a local folder the tasks write the files themselves:
    Hadoop starts a process for the permissions of each local file.
    """
    spark, rows = df.sparkSession, spread_rows(df)
    here = None if path_exists(spark, path) else local_folder(spark, path)
    if here is None:
        each = rows.write.options(**SMALL_FILES).option("maxRecordsPerFile", 1)
        each.option("lineSep", "\f").partitionBy(folder).text(path)
        return
    os.makedirs(here)
    value = F.coalesce(F.nullif(F.col(folder).cast("string"), F.lit("")), F.lit(NO_VALUE))
    ship_package(spark)
    with arrow_batches(spark, BATCH_BYTES):
        named = rows.select(value.alias("folder"), F.col("text").cast("binary").alias("text"))
        named.mapInArrow(_file_writer(here, folder, uuid.uuid4().hex), "files bigint").agg(F.sum("files")).collect()
    open(f"{here}/_SUCCESS", "w").close()


def _file_writer(root: str, folder: str, job: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes a file for each row of (folder, text).  A file appears under its name when it is whole, and a repeated task
    takes the same names."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        places, n = {}, 0
        for batch in batches:
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if value not in places:
                    places[value] = f"{root}/{_escaped(folder)}={_escaped(value)}"
                    os.makedirs(places[value], exist_ok=True)
                name = f"part-{task.partitionId():05d}-{job}.c{n:03d}.txt"
                begun = f"{places[value]}/.{name}.{task.taskAttemptId()}"
                with open(begun, "wb", buffering=0) as file:
                    left = memoryview((text.as_py() or b"") + b"\f")
                    while left:
                        left = left[file.write(left) :]
                os.replace(begun, f"{places[value]}/{name}")
                n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], ["files"])

    return write


def _escaped(name: str) -> str:
    """``name`` as Spark writes it into the name of a partition's folder."""
    return re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda found: f"%{ord(found[0]):02X}", name)
