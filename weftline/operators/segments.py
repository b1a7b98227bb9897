"""A search index that grows: immutable segments of counts, deletions beside them, merged in tiers.

A segment has the term counts of the documents of one ``append``, nothing that depends on other documents; the weight of
a term is applied when a search takes a ``snapshot``.  So an append reads only the new texts, a delete reads none.
A deletion is a list of ids that holds for all segments before it.  When ``fanout`` segments of one tier have gathered
they are merged into one of the next tier, without what was deleted.

Every change writes new folders and at last a new version, the list of the segments and deletions that hold.  Readers
take the latest version that is complete, so a change that fails leaves the one before.  There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.wordlists import SEARCH_STOP_WORDS
from weftline.operators.search import SearchIndex, index_of_counts, term_frequency
from weftline.session import drop_stored, folder_names, path_exists

VERSION = "kind string, id bigint, tier int"
POSTINGS, DOCS = "doc_id {0}, term string, tf bigint", "doc_id {0}, n_rows bigint"


class SegmentedIndex:
    """An index in the folder ``path``; documents are named by ids of the type ``id_type``."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", stop_words: Sequence[str] = SEARCH_STOP_WORDS, fanout: int = 8):
        self.spark, self.path, self.id_type, self.stop_words, self.fanout = spark, path, id_type, stop_words, fanout

    def append(self, docs: DataFrame) -> None:
        """Add ``docs(doc_id, text)``; their ids must not be in the index.  Repeated ids in ``docs`` are one document."""
        version, number = self._version(), self._number()
        tf = term_frequency(docs, self.stop_words)
        self._write_postings(tf, number)
        docs.groupBy("doc_id").agg(F.count("*").alias("n_rows")).write.parquet(self._at("docs", number))
        self._publish([*version, ("segment", number, 0)])
        self._merge()

    def delete(self, ids: DataFrame) -> None:
        """Remove the documents of ``ids(doc_id)``; unknown ids do no harm, and an id may be appended anew afterwards."""
        version, number = self._version(), self._number()
        ids.select(F.col("doc_id").cast(self.id_type).alias("doc_id")).distinct().write.parquet(self._at("deleted", number))
        self._publish([*version, ("deleted", number, 0)])

    def counts(self) -> tuple[DataFrame, DataFrame]:
        """(postings(doc_id, term, tf), docs(doc_id, n_rows)) of the documents that are there."""
        version = self._version()
        return tuple(self._living(kind, version, self._ids(version, "segment")) for kind in ("postings", "docs"))

    def snapshot(self) -> SearchIndex:
        """The index as it is now, not yet computed; ``checkpointed`` or ``save`` fix it."""
        postings, docs = self.counts()
        rows = docs.select(F.explode(F.array_repeat(F.lit(1), F.col("n_rows").cast("int"))))
        return index_of_counts(postings, rows)

    def vacuum(self) -> None:
        """Drop the folders that only versions before the latest one name; no reader may still use these."""
        version = self._version()
        names = {"postings": self._ids(version, "segment"), "docs": self._ids(version, "segment"), "deleted": self._ids(version, "deleted")}
        for kind, kept in names.items():
            for name in folder_names(self.spark, f"{self.path}/{kind}"):
                if int(name) not in kept:
                    drop_stored(self.spark, f"{self.path}/{kind}/{name}")
        for number in self._versions()[:-1]:
            drop_stored(self.spark, f"{self.path}/versions/{number}")

    def segments(self) -> list[tuple[int, int]]:
        """(number, tier) of the segments that hold."""
        return sorted((number, tier) for kind, number, tier in self._version() if kind == "segment")

    def _merge(self) -> None:
        version = self._version()
        for tier in sorted({t for kind, _, t in version if kind == "segment"}):
            same = [number for kind, number, t in version if kind == "segment" and t == tier]
            if len(same) < self.fanout:
                continue
            merged = self._number()
            self._write_postings(self._living("postings", version, same), merged)
            self._living("docs", version, same).write.parquet(self._at("docs", merged))
            kept = [row for row in version if row[0] == "deleted" or row[1] not in same]
            oldest = min([number for kind, number, _ in kept if kind == "segment"], default=merged)
            version = [row for row in kept if row[0] == "segment" or row[1] > oldest] + [("segment", merged, tier + 1)]
            self._publish(version)
            return self._merge()

    def _write_postings(self, postings: DataFrame, number: int) -> None:
        """Each task sorts what it has: a search reads a segment as a whole, and ranges would have it computed twice."""
        sorted_rows = postings.sortWithinPartitions("term", "doc_id")
        sorted_rows.write.option("compression", "zstd").parquet(self._at("postings", number))

    def _living(self, kind: str, version: list, numbers: Sequence[int]) -> DataFrame:
        schema = (POSTINGS if kind == "postings" else DOCS).format(self.id_type)
        read = lambda what, number, columns: self.spark.read.schema(columns).parquet(self._at(what, number))
        parts = [read(kind, n, schema).withColumn("__segment", F.lit(n).cast("bigint")) for n in sorted(numbers)]
        gone = [
            read("deleted", n, f"doc_id {self.id_type}").withColumn("__deleted", F.lit(n).cast("bigint"))
            for n in sorted(self._ids(version, "deleted"))
        ]
        rows = reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], schema).withColumn("__segment", F.lit(0))
        if gone:
            last = reduce(DataFrame.unionAll, gone).groupBy("doc_id").agg(F.max("__deleted").alias("__deleted"))
            before = (rows["doc_id"].eqNullSafe(last["doc_id"])) & (rows["__segment"] < last["__deleted"])
            rows = rows.join(last, before, "left_anti")
        return rows.drop("__segment")

    def _at(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number}"

    @staticmethod
    def _ids(version: list, kind: str) -> list[int]:
        return [number for k, number, _ in version if k == kind]

    def _number(self) -> int:
        """A number above all that were ever used, by changes that failed too."""
        kinds = ("postings", "docs", "deleted")
        return 1 + max((int(n) for kind in kinds for n in folder_names(self.spark, f"{self.path}/{kind}")), default=0)

    def _versions(self) -> list[int]:
        names = folder_names(self.spark, f"{self.path}/versions")
        return sorted(int(n) for n in names if path_exists(self.spark, f"{self.path}/versions/{n}/_SUCCESS"))

    def _version(self) -> list[tuple]:
        versions = self._versions()
        if not versions:
            return []
        return [tuple(row) for row in self.spark.read.schema(VERSION).parquet(f"{self.path}/versions/{versions[-1]}").collect()]

    def _publish(self, version: list[tuple]) -> None:
        """The last step of a change: the marker file of the written list makes it the version that holds."""
        names = folder_names(self.spark, f"{self.path}/versions")
        number = 1 + max(map(int, names), default=0)
        self.spark.createDataFrame(version, VERSION).coalesce(1).write.parquet(f"{self.path}/versions/{number}")
