"""Several sinks of one stream, each batch in all of them exactly once.

A batch writes a folder for every sink and then, as its last step, a commit record.  Readers look only at batches that have
one.  A batch that fails between two sinks leaves folders without a record; when the stream starts again it is run
anew and replaces them, and a batch that is delivered again after its commit is passed over.  So the sinks never differ and
nothing is in them twice, whatever fails.

Old batches are folded into a base, a folder of its own that takes effect by a record too, so that a crash or a reader at any
moment finds either the batches or the base.  What the base covers is deleted later, by ``vacuum``.

Layout below the log's folder: ``<sink>/batch/<id>``, ``<sink>/base/<id>``, ``records/batch/<id>``, ``records/base/<id>``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import drop_stored, folder_names, make_folder

Fold = Callable[[DataFrame], DataFrame]


class BatchLog:
    """A log of batches in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, batch_id: int, tables: Mapping[str, DataFrame]) -> bool:
        """Write one table per sink and commit; False where the batch is committed already."""
        if batch_id in self.committed() or batch_id <= self.base():
            return False
        for sink, table in tables.items():
            table.write.mode("overwrite").parquet(f"{self.path}/{sink}/batch/{batch_id}")
        make_folder(self.spark, f"{self.path}/records/batch/{batch_id}")
        return True

    def writer(self, tables_of: Callable[[DataFrame], Mapping[str, DataFrame]]) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: ``tables_of`` makes the table of each sink from a batch, which is read once."""

        def write(batch: DataFrame, batch_id: int) -> None:
            kept = batch.persist()
            try:
                self.write(batch_id, tables_of(kept))
            finally:
                kept.unpersist()

        return write

    def committed(self) -> list[int]:
        return sorted(map(int, folder_names(self.spark, f"{self.path}/records/batch")))

    def base(self) -> int:
        """The last batch that the latest base covers, -1 without a base."""
        return max(map(int, folder_names(self.spark, f"{self.path}/records/base")), default=-1)

    def read(self, sink: str, schema: str | T.StructType, upto: int | None = None) -> DataFrame:
        """The rows of a sink in all committed batches, or those up to ``upto``, with ``batch_id``; folded ones have the
        number of their base."""
        base = self.base()
        folders = [(base, f"{self.path}/{sink}/base/{base}")] if base >= 0 else []
        later = [i for i in self.committed() if i > base and (upto is None or i <= upto)]
        folders += [(i, f"{self.path}/{sink}/batch/{i}") for i in later]
        kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        parts = [
            self.spark.read.schema(kind).parquet(folder).withColumn("batch_id", F.lit(i).cast("bigint")) for i, folder in folders
        ]
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*kind.fields, T.StructField("batch_id", T.LongType())]))
        return reduce(DataFrame.unionAll, parts)

    def fold(self, upto: int, folds: Mapping[str, tuple[str, Fold]]) -> None:
        """Make a base of the batches up to ``upto``: for each sink its schema and what becomes of its rows.

        ``upto`` has to be committed.  The record comes last; before it, nothing that is read changes.
        """
        if upto <= self.base() or upto not in self.committed():
            return
        for sink, (schema, fold) in folds.items():
            fold(self.read(sink, schema, upto)).write.mode("overwrite").parquet(f"{self.path}/{sink}/base/{upto}")
        make_folder(self.spark, f"{self.path}/records/base/{upto}")

    def vacuum(self) -> None:
        """Delete the folders that the latest base covers; nobody may still read them."""
        base = self.base()
        for sink in folder_names(self.spark, self.path):
            for kind in ("batch", "base"):
                for name in folder_names(self.spark, f"{self.path}/{sink}/{kind}"):
                    if int(name) < base or (kind == "batch" and int(name) == base):
                        drop_stored(self.spark, f"{self.path}/{sink}/{kind}/{name}")
