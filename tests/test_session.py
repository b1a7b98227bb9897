"""Stored tables are freed where the caller says so."""

import pytest
from pyspark.sql import functions as F

from weftline.operators.graph import connected_components, graph_vertices
from weftline.session import checkpoint_dir, folder_names, freed_afterwards, scratch_path, stored


def tables(spark):
    return {name for name in folder_names(spark, checkpoint_dir(spark)) if "-" in name}


def test_stored_tables_are_freed(spark, tmp_path):
    before = tables(spark)
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "src bigint, dst bigint")
    with freed_afterwards(spark):
        components = connected_components(graph_vertices(edges), edges)
        assert tables(spark) > before
        components.write.parquet(str(tmp_path / "out"))
    assert tables(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).select(F.countDistinct("component")).first()[0] == 2


def test_scopes_nest_and_end_with_an_error(spark):
    before = tables(spark)
    with pytest.raises(ZeroDivisionError), freed_afterwards(spark):
        outer = stored(spark.range(3), "outer")
        with freed_afterwards(spark):
            stored(spark.range(3), "inner")
        assert outer.count() == 3
        1 / 0
    assert tables(spark) == before
    kept = scratch_path(spark, "kept")
    with freed_afterwards(spark):
        stored(spark.range(3), "x").write.parquet(kept)
    assert spark.read.parquet(kept).count() == 3
