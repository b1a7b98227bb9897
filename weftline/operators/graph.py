"""Network analysis on ``edges(src, dst)``: degrees, PageRank, components and triangles.

Vertices of social graphs differ widely in degree.  PageRank lays its edges out once, salted by degree; the
other joins are left to Spark, which splits skewed partitions while it runs.  Every sum is combined before its
shuffle.  The two iterative operators store every round and drop the round before it; only counts reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.ranking import top_k
from weftline.operators.skew import MIN_HOT_ROWS, SALT, SALTS, hot_keys, salt_rows, salted_join
from weftline.session import bucketed, drop_stored, materialise, store_counted, stored, write_stored

EDGES_PER_PARTITION = 1_000_000
LIST_BLOCK = 1_000


def graph_vertices(edges: DataFrame) -> DataFrame:
    """(id), every end of an edge once."""
    return edges.select(F.col("src").alias("id")).unionAll(edges.select(F.col("dst").alias("id"))).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    """(id, out_degree); repeated edges count, vertices without an outgoing edge are absent."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))


def in_degrees(edges: DataFrame) -> DataFrame:
    """(id, in_degree); repeated edges count, vertices without an incoming edge are absent."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))


def graph_size(edges: DataFrame) -> DataFrame:
    """One row (n_edges, n_vertices)."""
    n_vertices = graph_vertices(edges).agg(F.count("*")).scalar()
    return edges.agg(F.count("*").alias("n_edges")).withColumn("n_vertices", n_vertices)


def top_by(df: DataFrame, score: str, k: int = 5, id_col: str = "id") -> DataFrame:
    """The ``k`` rows with the highest score, ties by id."""
    return top_k(df, k, [F.desc(score), F.asc(id_col)])


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset: float = 0.15,
    iterations: int = 10,
    checkpoint_every: int = 5,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """(id, pagerank) after a fixed number of rounds, scaled so that the ranks sum to the vertex count.

    Every vertex starts at 1.0; a round gives it ``reset + (1 - reset) * sum(rank / out-degree)`` over its
    incoming edges.  Repeated edges send once each: they are kept as one row with a weight.

    The edges are written once as a table in buckets of (src, salt), the vertices in buckets of id.  A round reads
    both where they lie: only one row per vertex goes to the edges and the sums per target back, no edge is
    shuffled again and none is kept in the memory of executors, so a lost one costs what it was doing and no more.
    There are as many buckets as the edges need.
    """
    spark = edges.sparkSession
    weighted = edges.groupBy("src", "dst").agg(F.count("*").alias("weight"))
    weighted, weighted_at, seen = store_counted(weighted, "weighted-edges")
    sources = weighted.groupBy("src").agg(F.sum("weight").alias("out_degree"), F.count("*").alias("n_rows"))
    hot, hot_at = write_stored(hot_keys(sources.select("src", "n_rows"), "src", min_hot_rows), "hot-vertices")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen["n"] // EDGES_PER_PARTITION))
    placed, drop_edges = bucketed(salt_rows(weighted, hot, "src", spread=["dst"]), "edges", ["src", SALT], width)
    base = (
        vertices.select("id")
        .distinct()
        .join(sources.select(F.col("src").alias("id"), "out_degree"), "id", "left")
        .join(F.broadcast(hot.withColumnRenamed("src", "id")), "id", "left")
        .select("id", "out_degree", F.coalesce(SALTS, F.lit(1)).alias(SALTS))
    )
    base, drop_vertices = bucketed(base, "vertices", ["id"], width)
    state = base.withColumn("rank", F.lit(1.0))
    for done in range(1, iterations + 1):
        shares = state.filter(F.col("out_degree").isNotNull()).select(
            F.col("id").alias("src"),
            (F.col("rank") / F.col("out_degree")).alias("share"),
            F.explode(F.sequence(F.lit(0), F.col(SALTS) - 1)).alias(SALT),
        )
        received = (
            placed.join(shares.hint("shuffle_hash"), ["src", SALT])
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("share") * F.col("weight")).alias("received"))
        )
        state = base.join(received.hint("shuffle_hash"), "id", "left").withColumn(
            "rank", F.lit(reset) + F.lit(1.0 - reset) * F.coalesce("received", F.lit(0.0))
        ).drop("received")
        if done == iterations or done % checkpoint_every == 0:
            state = materialise(state)
    state = state if iterations else materialise(state)
    drop_edges()
    drop_vertices()
    for path in (weighted_at, hot_at):
        drop_stored(spark, path)
    scale = state.agg(F.count("*") / F.sum("rank")).scalar()
    return state.select("id", (F.col("rank") * scale).alias("pagerank"))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): weakly connected components, named by their smallest id.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected Components in MapReduce
    and Beyond" (2014), on rows (hi, lo) with hi > lo, until every component is a star around its smallest
    vertex.  The number of rounds grows with the logarithm of the size.

    Before each round the leaves are put aside: vertices with one neighbour, which is smaller.  A leaf is in the
    component of its neighbour and never its smallest vertex, so the rounds do without it, and what they write shrinks
    from round to round.  A star consists of leaves, so the rounds end when no row is left.  Then the leaves take the
    names of their neighbours, those put aside last first.
    """
    spark = edges.sparkSession
    hi, lo = F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")
    links, path, seen = store_counted(edges.select(hi, lo).filter("hi <> lo").distinct(), "links")
    aside = []
    while seen["n"]:
        leaves, leaves_at, put = store_counted(_leaves(links), "leaves")
        aside.append((leaves, leaves_at, put["n"]))
        if put["n"] == seen["n"]:
            break
        before = path
        rest = links.join(leaves.select("hi"), "hi", "left_anti") if put["n"] else links
        links, path, seen = store_counted(_small_star(_large_star(rest, seen["n"])), "links")
        drop_stored(spark, before)
    if aside:
        drop_stored(spark, path)
    named, path, _ = aside.pop() if aside else (links, path, 0)
    while aside:
        leaves, leaves_at, n_rows = aside.pop()
        label = F.coalesce("name", "lo").alias("lo")
        found = _joined_by_lo(leaves, named.select(F.col("hi").alias("lo"), F.col("lo").alias("name")), n_rows)
        before = path
        named, path = write_stored(named.unionAll(found.select("hi", label)), "links")
        drop_stored(spark, before)
        drop_stored(spark, leaves_at)
    return vertices.select("id").distinct().join(named.select(F.col("hi").alias("id"), "lo"), "id", "left").select(
        "id", F.coalesce("lo", "id").alias("component")
    )


def _leaves(links: DataFrame) -> DataFrame:
    """The rows (hi, lo) of ``links`` whose upper end is in no other row."""
    lowest = links.groupBy("hi").agg(F.min("lo").alias("lo"), F.max("lo").alias("upper")).filter("lo = upper")
    inner = links.select(F.col("lo").alias("hi")).distinct()
    return lowest.select("hi", "lo").join(inner, "hi", "left_anti")


def _joined_by_lo(links: DataFrame, found: DataFrame, n_rows: int) -> DataFrame:
    """Left join of at most ``n_rows`` rows; a vertex may be the lower end of most of them, so many rows are salted."""
    return salted_join(links, found, "lo", spread=["hi"], how="left") if n_rows > MIN_HOT_ROWS else links.join(found, "lo", "left")


def _large_star(links: DataFrame, n_rows: int) -> DataFrame:
    """Link the larger neighbours of each vertex to the smallest vertex next to it, itself included.

    Only the lower end of a row can have a smaller neighbour, so the minimum over the lower neighbours is
    all that is needed.  Rows may repeat.
    """
    lowest = links.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("lower"))
    return _joined_by_lo(links, lowest, n_rows).select("hi", F.coalesce("lower", "lo").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link each vertex and its lower neighbours to the smallest of them."""
    lowest = links.groupBy("hi").agg(F.min("lo").alias("lower"), F.max("lo").alias("upper"))
    others = (
        links.join(lowest.filter("lower <> upper").select("hi", "lower"), "hi")
        .filter(F.col("lo") != F.col("lower"))
        .select(F.col("lo").alias("hi"), F.col("lower").alias("lo"))
    )
    return lowest.select("hi", F.col("lower").alias("lo")).unionAll(others).distinct()


def component_sizes(components: DataFrame) -> DataFrame:
    """(component, count)."""
    return components.groupBy("component").agg(F.count("*").alias("count"))


def triangle_count(vertices: DataFrame, edges: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """(id, count): the triangles each vertex is part of, 0 where it is in none.

    Directions, repeated edges and loops do not matter.  Each edge is pointed from its end of lower degree
    to the other one (ties by id).  A triangle is found once, as a common member of the lists of neighbours
    that the two ends of an edge point to.  Lists are cut into blocks of about ``block`` ids by a hash of the
    id; an edge brings together only the blocks of its two ends that can hold the same ids.  So no row is
    longer than a block, and the edges of one vertex spread over its blocks.
    """
    pointed = stored(_by_degree(edges), "pointed-edges")
    out = pointed.groupBy("src").agg(F.count("*").alias("n"))
    cuts = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("n") / F.lit(block), F.lit(1.0))))).cast("int")
    cuts = stored(out.select("src", cuts.alias("cuts")), "list-cuts")
    part = F.pmod(F.xxhash64("dst"), F.col("cuts")).cast("int")
    lists = pointed.join(cuts, "src").groupBy("src", part.alias("part")).agg(F.collect_list("dst").alias("others"))
    ends = pointed.join(cuts, "src").withColumnRenamed("cuts", "src_cuts")
    ends = ends.join(cuts.toDF("dst", "dst_cuts"), "dst")  # an end that points nowhere closes no triangle
    finest = F.greatest("src_cuts", "dst_cuts")
    ends = ends.withColumn("i", F.explode(F.sequence(F.lit(0), finest - 1)))
    ends = ends.select(
        F.col("src").alias("first"), F.col("dst").alias("second"),
        (F.col("i") % F.col("src_cuts")).alias("first_part"), (F.col("i") % F.col("dst_cuts")).alias("second_part"),
    )
    common = (
        ends.join(lists.toDF("first", "first_part", "of_first"), ["first", "first_part"])
        .join(lists.toDF("second", "second_part", "of_second"), ["second", "second_part"])
        .select("first", "second", F.array_intersect("of_first", "of_second").alias("thirds"))
        .filter(F.size("thirds") > 0)
    )
    n = F.size("thirds").cast("bigint")
    credits = F.concat(
        F.array(F.struct(F.col("first").alias("id"), n.alias("n")), F.struct(F.col("second").alias("id"), n.alias("n"))),
        F.transform("thirds", lambda third: F.struct(third.alias("id"), F.lit(1).cast("bigint").alias("n"))),
    )
    counts = common.select(F.inline(credits)).groupBy("id").agg(F.sum("n").alias("count"))
    return vertices.select("id").distinct().join(counts, "id", "left").select(
        "id", F.coalesce("count", F.lit(0)).alias("count")
    )


def _by_degree(edges: DataFrame) -> DataFrame:
    """(src, dst): undirected edges without loops and repeats, pointed to the end of higher degree."""
    a, b = F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    pairs = stored(edges.select(a, b).filter("a <> b").distinct(), "edge-pairs")
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id")))
    degree = ends.groupBy("id").agg(F.count("*").alias("degree"))
    both = pairs.join(degree.toDF("a", "degree_a"), "a").join(degree.toDF("b", "degree_b"), "b")
    a_first = F.col("degree_a") <= F.col("degree_b")  # a < b, so a comes first on a tie
    return both.select(
        F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("src"),
        F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("dst"),
    )
