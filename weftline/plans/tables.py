"""Inputs of the named queries, all derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.text import is_search_term, words
from weftline.operators.entities import capitalised_words
from weftline.operators.names import name_words
from weftline.operators.rows import spread_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search corpus (doc_id, text)."""
    return spread_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier input (doc_id, label, text): the language is the label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    return spread_rows(docs)


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier input (doc_id, label, text): the quality mark is the label."""
    marks = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return documents(spark, sf_dir).join(marks, "doc_id").select("doc_id", "label", "text")


def phrase_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries (query_id, text) of several words: the benchmark texts as they are."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")


def word_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries (query_id, text) of one word: every search term of the benchmark texts."""
    term = F.explode(words("text")).alias("query_id")
    terms = table(spark, sf_dir, "benchmark").select(term).filter(is_search_term(F.col("query_id"))).distinct()
    return terms.withColumn("text", F.col("query_id"))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title) from the page with the same number; later documents have none."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        F.col("page_id").alias("doc_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title")
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, title, description, source): title and heading of each page, its host as the source."""
    pages = table(spark, sf_dir, "pages")

    def found(pattern: str):
        return F.nullif(F.regexp_extract("html", pattern, 1), F.lit(""))

    return pages.select(
        "url",
        found("<title>([^<]*)</title>").alias("title"),
        found("<h1>([^<]*)</h1>").alias("description"),
        F.struct(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("name")).alias("source"),
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, label): the capitalised words of the benchmark texts, labelled by their length."""
    found = table(spark, sf_dir, "benchmark").select(F.explode(capitalised_words("text")).alias("m"))
    n = F.length("entity")
    label = F.when(n <= 3, "PERSON").when(n <= 5, "GPE").when(n <= 7, "ORG").when(n <= 9, "LOC").otherwise("EVENT")
    return found.select(F.col("m.text").alias("entity")).distinct().withColumn("label", label)


def name_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, label): runs of one to four words of the benchmark texts that begin with a capitalised word."""
    texts = table(spark, sf_dir, "benchmark").select(name_words("text").alias("words"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike("^[A-Z][a-z]+$")
    )
    names = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, i % 4 + 1), " "))
    found = texts.filter(F.size("words") > 0).select(F.explode(names).alias("entity")).distinct()
    n = F.length("entity")
    return found.withColumn("label", F.when(n <= 6, "PERSON").when(n <= 12, "GPE").when(n <= 18, "ORG").otherwise("EVENT"))


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed graph (src, dst): one edge per order line from the part to its supplier.

    Parts and suppliers share their numbers, so a vertex can be both; suppliers are hubs, pairs repeat.
    """
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph (src, dst) of several components with long paths: each order number points to a customer number."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``user<TAB>id, id,...``: a part with supplier, line number and supplier again.

    Odd lines come without a friend, so that the parser has something to drop.
    """
    lines = spread_rows(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber"))
    friends = F.when(
        F.col("l_linenumber") < 7,
        F.concat_ws(",", F.col("l_suppkey"), F.concat(F.lit(" "), F.col("l_linenumber")), F.lit(" "), F.col("l_suppkey")),
    ).otherwise(F.lit(" , "))
    return lines.select(F.concat(F.lit(" "), F.col("l_partkey"), F.lit("\t"), friends).alias("value"))
