"""Connected components of a graph whose edges keep coming.

The labels of all vertices are stored.  New edges are contracted first: each end becomes the label of its component, or
itself where it is new, and edges within a component vanish.  Only the contracted edges go through the rounds of the
component search, so its work follows the new edges and not the graph.  Its result is a short table of components that
got another name, which is composed with the names before; the stored labels stay as they are and are renamed when read.

An append writes its folders and then a record; readers use the latest record.  There is one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.graph import connected_components, graph_vertices
from weftline.session import drop_stored, folder_names, make_folder, write_stored


class GrowingComponents:
    """Components in the folder ``path``; vertices have ids of the type ``id_type``."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint"):
        self.spark, self.path, self.id_type = spark, path, id_type

    def append(self, edges: DataFrame) -> None:
        """Add ``edges(src, dst)``; ends that are new become vertices."""
        used = [int(n) for kind in ("vertices", "renames", "records") for n in folder_names(self.spark, f"{self.path}/{kind}")]
        number = 1 + max(used, default=0)  # an append that failed has left folders
        edges, edges_at = write_stored(edges.select("src", "dst").distinct(), "new-edges")
        ends, ends_at = write_stored(self._labelled(graph_vertices(edges)), "new-ends")
        contracted, contracted_at = write_stored(self.contract(edges, ends), "contracted")
        links = contracted.select("src").unionAll(contracted.select("dst")).distinct().withColumnRenamed("src", "id")
        joined, joined_at = write_stored(connected_components(links, contracted), "joined")
        label = F.coalesce("component", "label")
        named = ends.join(joined.withColumnRenamed("id", "label"), "label", "left").select("id", "label", "known", label.alias("component"))
        named.filter("not known").select("id", "component").write.parquet(f"{self.path}/vertices/{number}")
        moved = joined.filter("id <> component").select(F.col("id").alias("old"), F.col("component").alias("new"))
        before = self._renames().join(moved.select(F.col("old").alias("new"), F.col("new").alias("newer")), "new", "left")
        renames = before.select("old", F.coalesce("newer", "new").alias("new")).unionAll(moved)
        renames.write.parquet(f"{self.path}/renames/{number}")
        make_folder(self.spark, f"{self.path}/records/{number}")
        for path in (edges_at, ends_at, contracted_at, joined_at):
            drop_stored(self.spark, path)

    def contract(self, edges: DataFrame, ends: DataFrame) -> DataFrame:
        """(src, dst): the edges between different components of ``ends(id, label)``."""
        a = ends.select(F.col("id").alias("src"), F.col("label").alias("from"))
        b = ends.select(F.col("id").alias("dst"), F.col("label").alias("to"))
        joined = edges.join(a, "src").join(b, "dst").filter(F.col("from") != F.col("to"))
        return joined.select(F.least("from", "to").alias("src"), F.greatest("from", "to").alias("dst")).distinct()

    def labels(self) -> DataFrame:
        """(id, component), components named by their smallest id."""
        records = self._records()
        schema = f"id {self.id_type}, component {self.id_type}"
        if not records:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).parquet(*[f"{self.path}/vertices/{n}" for n in records])
        renames = self._renames().withColumnRenamed("old", "component")
        return stored.join(renames, "component", "left").select("id", F.coalesce("new", "component").alias("component"))

    def _labelled(self, ids: DataFrame) -> DataFrame:
        """(id, label, known): the component of each id, itself where it is new."""
        found = ids.join(self.labels(), "id", "left")
        return found.select("id", F.coalesce("component", "id").alias("label"), F.col("component").isNotNull().alias("known"))

    def _records(self) -> list[int]:
        return sorted(map(int, folder_names(self.spark, f"{self.path}/records")))

    def _renames(self) -> DataFrame:
        """(old, new): the present name of every component that once had another."""
        records, schema = self._records(), f"old {self.id_type}, new {self.id_type}"
        if not records:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/renames/{records[-1]}")
