"""Documents in one directory per label."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import local_folder, ship_package, store_counted

#: Spark counts a small file as 4 MB and plans few of them for a task; a task takes this many of these parts.
PARTS_PER_TASK = 16
#: A task that reads local files takes so many of them, or files of so many bytes.
FILES_PER_TASK, BYTES_PER_TASK = 20_000, 64 << 20
#: Contents that it gives back at once.
BATCH_BYTES = 4 << 20
SCHEME_AND_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?)?"


def read_labelled_directory(
    spark: SparkSession,
    roots: str | list[str],
    min_chars: int = 51,
    charset: str = "ISO-8859-1",
    skip_unreadable: bool = False,
) -> DataFrame:
    """(path, label, text) of all files below the absolute ``roots``, read as one collection.

    The label is the name of the directory that holds the file.  Files directly in a root have no label
    and are skipped, as are texts shorter than ``min_chars``.  Line ends become ``\\n``.  A file that cannot be
    read is an error unless ``skip_unreadable`` is set.

    Spark's own source for whole files holds the names of all files in the driver and takes milliseconds for each small file;
    it reads roots that are no local folders.  Files of local folders are listed and read by the tasks.
    """
    roots = [roots] if isinstance(roots, str) else list(roots)
    here = [local_folder(spark, root) for root in roots]
    if all(top and os.path.isdir(top) and not re.search(r"[][{}*?\\]", top) for top in here):
        files = _local_files(spark, here, skip_unreadable)
    else:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("ignoreCorruptFiles", skip_unreadable)
            .option("ignoreMissingFiles", skip_unreadable)
            .load(roots)
        )
        files = _fewer_tasks(files)
    for root in roots:
        bare = re.sub(SCHEME_AND_HOST, "", root).rstrip("/")
        files = files.filter(~F.col("path").rlike(f"{SCHEME_AND_HOST}{re.escape(bare)}/[^/]+$"))
    text = F.regexp_replace(F.decode("content", charset), "\r\n?", "\n")
    return files.select(
        "path",
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("label"),
        text.alias("text"),
    ).filter(F.length("text") >= min_chars)


def _fewer_tasks(files: DataFrame) -> DataFrame:
    """``files`` in fewer tasks where there are many times more than cores."""
    cores, parts = files.sparkSession.sparkContext.defaultParallelism, files.rdd.getNumPartitions()
    wanted = max(2 * cores, -(-parts // PARTS_PER_TASK))
    return files.coalesce(wanted) if wanted < parts else files


def _hidden(name: str) -> bool:
    """Whether Spark passes over files and folders of this name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _folders(top: str) -> Iterator[str]:
    """``top`` and the folders below it."""
    left = [top.rstrip("/") or "/"]
    while left:
        yield (folder := left.pop())
        with os.scandir(folder) as entries:
            left += [entry.path for entry in entries if not _hidden(entry.name) and entry.is_dir()]


def _local_files(spark: SparkSession, roots: list[str], skip_unreadable: bool) -> DataFrame:
    """(path, content) of all files below the local folders ``roots`` that are not empty, each file once."""
    ship_package(spark)
    folders = list(dict.fromkeys(folder for root in roots for folder in _folders(root)))
    cores = spark.sparkContext.defaultParallelism
    places = spark.createDataFrame([(folder,) for folder in folders], "folder string")
    listed = places.repartition(min(len(folders), 4 * cores)).mapInArrow(_file_names, "path string, length bigint")
    files, _, seen = store_counted(listed, "files", bytes=F.sum("length"))
    tasks = max(min(seen["n"], 2 * cores), -(-seen["n"] // FILES_PER_TASK), -(-(seen["bytes"] or 0) // BYTES_PER_TASK), 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, contents, size = [], [], 0
            for path in batch.column(0).to_pylist():
                try:
                    with open(path, "rb", buffering=0) as file:
                        content = file.readall()
                except OSError:
                    if skip_unreadable:
                        continue
                    raise
                paths.append(f"file:{path}")
                contents.append(content)
                size += len(content)
                if size > BATCH_BYTES:
                    yield _files(paths, contents)
                    paths, contents, size = [], [], 0
            yield _files(paths, contents)

    return files.select("path").repartition(tasks).mapInArrow(read, "path string, content binary")


def _file_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, length) of the files in folders, those that Spark passes over left out."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            with os.scandir(folder) as entries:
                files = ((e.path, e.stat().st_size) for e in entries if not _hidden(e.name) and e.is_file())
                while some := list(islice(files, 10_000)):
                    some = [file for file in some if file[1]]
                    columns = [pa.array([file[0] for file in some], pa.string()), pa.array([file[1] for file in some], pa.int64())]
                    yield pa.record_batch(columns, ["path", "length"])


def _files(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
