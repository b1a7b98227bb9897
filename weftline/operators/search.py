"""TF-IDF index and search.

The index is kept in long form, one row per (document, term).  Queries are a table too: all of them are
answered by one join with the index instead of one pass over the documents per query.  Where the query terms
are few bytes they are broadcast, and only the postings of these terms are dealt, by document; otherwise the join
is left to Spark.  A saved index lies in buckets of terms; a search reads the buckets of its terms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.scalars import rank_value
from weftline.functions.text import is_search_term, search_tokens, words
from weftline.functions.wordlists import SEARCH_STOP_WORDS
from weftline.operators.ranking import top_k_per_group
from weftline.operators.rows import computed_once
from weftline.operators.skew import MIN_HOT_ROWS, fits_broadcast, key_counts, salted_join
from weftline.session import drop_stored, store_counted, stored

#: Postings in a bucket of a saved index, buckets at most, and asked terms that are pushed into the scan at most.
BUCKET_ROWS, MAX_BUCKETS, MAX_PUSHED = 1_000_000, 4096, 10_000


def term_frequency(docs: DataFrame, stop_words: Sequence[str] = SEARCH_STOP_WORDS) -> DataFrame:
    """(doc_id, term, tf) of ``docs(doc_id, text)``; rows with the same doc_id count as one document.

    Words are exploded first and filtered as plain columns, which keeps the test in generated code; the
    outer form of explode adds no filter of its own that would split each text a second time.
    """
    return (
        docs.select("doc_id", F.explode_outer(words("text")).alias("term"))
        .filter(is_search_term(F.col("term"), stop_words))
        .groupBy("doc_id", "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df); (doc_id, term) is unique in ``tf``, so counting rows counts documents.

    The texts are not split a second time for it: the shuffle of ``tf`` is used again.
    """
    return key_counts(tf, "term", positive="tf").withColumnRenamed("n_rows", "df")


def inverse_document_frequency(df: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln(N / df), N the number of rows of ``docs``, empty texts included."""
    n_docs = docs.agg(F.count("*").alias("n_docs")).scalar()
    return df.select("term", "df", F.log(n_docs / F.col("df")).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(doc_id, term, tf, tfidf).

    A common term has a row for every document, so the join on the term is salted; ``df`` says how many
    rows each term has.
    """
    counts = idf.select("term", F.col("df").alias("n_rows"))
    joined = salted_join(
        tf, idf.select("term", "idf"), "term", spread=["doc_id"], counts=counts, min_hot_rows=min_hot_rows
    )
    return joined.select("doc_id", "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def doc_norms(postings: DataFrame) -> DataFrame:
    """(doc_id, norm) over all terms of each document."""
    return postings.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("norm"))


def doc_vectors(postings: DataFrame) -> DataFrame:
    """(doc_id, vector): a document's terms as a map; its size is the vocabulary of one document."""
    entries = F.collect_list(F.struct("term", "tfidf"))
    return postings.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(entries)).alias("vector"))


def with_weights(postings: DataFrame) -> DataFrame:
    """Add ``weight``: tfidf divided by the norm of the document, NULL where that is 0.

    The sum of query weight times this weight is the cosine already, so a search needs no norms.  The window
    holds one document, its different terms.
    """
    square = F.col("tfidf") * F.col("tfidf")
    norm = F.sqrt(F.sum(square).over(Window.partitionBy("doc_id")))
    return postings.withColumn("weight", F.when(norm > 0, F.col("tfidf") / norm))


def term_bucket(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def buckets_for(n_rows: int) -> int:
    """A power of two with about ``BUCKET_ROWS`` rows a bucket, 1 to ``MAX_BUCKETS``."""
    return min(MAX_BUCKETS, 1 << max(0, -(-n_rows // BUCKET_ROWS) - 1).bit_length())


def write_by_term(
    rows: DataFrame, path: str, order: Sequence[str], buckets: int, grouped: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Write ``rows(term, ...)`` as Parquet, in ``buckets`` folders by term and sorted by ``order`` inside.

    The range partitioning is over the bucket and the order, so a term of many rows spans several files.  ``grouped`` may
    group the rows by bucket and order once they are dealt.
    """
    placed = rows.withColumn("bucket", term_bucket("term", buckets)).repartitionByRange("bucket", *order)
    placed = grouped(placed) if grouped else placed
    placed.sortWithinPartitions("bucket", *order).write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Keep the number of buckets beside the rows, so that a reader need not know how they were written."""
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")


def read_buckets(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/layout").first()["buckets"]


def rows_of_terms(rows: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """The rows of a table of ``write_by_term`` that can match ``asked(term)``.

    Up to ``MAX_PUSHED`` different terms are looked up first.  Their buckets become a partition filter and the terms
    a filter of the scan, which skips the files, row groups and pages of a sorted file that have none of them.  More
    terms than that leave the choice of their buckets.
    """
    if not buckets:
        return rows
    terms = [row["term"] for row in asked.select("term").distinct().limit(MAX_PUSHED + 1).collect()]
    if len(terms) <= MAX_PUSHED:
        known = asked.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        rows = rows.filter(F.col("term").isin(terms))
    else:
        known = asked
    found = known.select(term_bucket("term", buckets).alias("bucket")).distinct().collect()
    return rows.filter(F.col("bucket").isin(sorted(row["bucket"] for row in found)))


@dataclass(frozen=True)
class SearchIndex:
    """``postings(doc_id, term, tf, tfidf, weight)`` and ``terms(term, df, idf)``.

    ``buckets`` is set where the postings lie in that many folders by ``term_bucket``.
    """

    postings: DataFrame
    terms: DataFrame
    buckets: int = 0

    @property
    def norms(self) -> DataFrame:
        return doc_norms(self.postings)

    def checkpointed(self) -> SearchIndex:
        """The index with its postings stored, in compressed columns: the searches share them."""
        return SearchIndex(stored(self.postings, "postings"), self.terms, self.buckets)

    def save(self, path: str, buckets: int | None = None) -> None:
        """Write the index as Parquet, by term, in as many ``buckets`` as its size asks for.

        The postings are stored first: they are computed once, though their number and the limits of the ranges have
        to be found before they are dealt.
        """
        spark = self.postings.sparkSession
        postings, stored_at, seen = store_counted(self.postings, "postings")
        buckets = buckets or buckets_for(seen["n"])
        write_by_term(postings, f"{path}/postings", ["term", "doc_id"], buckets)
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        write_buckets(spark, path, buckets)
        drop_stored(spark, stored_at)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SearchIndex:
        """The index that ``save`` has written to ``path``."""
        postings, terms = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms")
        return SearchIndex(postings, terms, read_buckets(spark, path))

    def of_terms(self, asked: DataFrame) -> DataFrame:
        """The postings that can match ``asked(term)``."""
        return rows_of_terms(self.postings, asked, self.buckets)


def index_of_counts(tf: DataFrame, docs: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> SearchIndex:
    """Index of stored counts ``tf(doc_id, term, tf)`` over the rows of ``docs``; its terms are stored, its postings not
    yet computed."""
    terms = stored(inverse_document_frequency(document_frequency(tf), docs), "terms")
    return SearchIndex(with_weights(tfidf(tf, terms, min_hot_rows)), terms)


def build_index(
    docs: DataFrame, stop_words: Sequence[str] = SEARCH_STOP_WORDS, min_hot_rows: int = MIN_HOT_ROWS
) -> SearchIndex:
    """Index of ``docs(doc_id, text)``; its counts are stored, so the texts are split once, its postings not yet computed.

    Take it ``checkpointed`` for several searches in one job; ``save`` and ``load`` it across jobs.
    """
    return index_of_counts(stored(term_frequency(docs, stop_words), "term-counts"), docs, min_hot_rows)


def query_terms(queries: DataFrame, stop_words: Sequence[str] = SEARCH_STOP_WORDS) -> DataFrame:
    """(query_id, n_tokens, term, qtf) of ``queries(query_id, text)``."""
    tokens = computed_once(queries.select("query_id", "text"), "tokens", search_tokens("text", stop_words))
    return (
        tokens.select("query_id", F.size("tokens").alias("n_tokens"), F.explode_outer("tokens").alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("query_id", "n_tokens", "term")
        .agg(F.count("*").alias("qtf"))
    )


def query_weights(queries: DataFrame, terms: DataFrame, stop_words: Sequence[str] = SEARCH_STOP_WORDS) -> DataFrame:
    """(query_id, term, share) of the queries of several tokens: count times idf, divided by the norm of the query."""
    asked = query_terms(queries, stop_words).filter("n_tokens > 1").select("query_id", "term", "qtf")
    known = asked.join(terms.select("term", "idf"), "term").withColumn("query_weight", F.col("qtf") * F.col("idf"))
    square = F.col("query_weight") * F.col("query_weight")
    norm = F.sqrt(F.sum(square).over(Window.partitionBy("query_id")))
    share = F.when(norm > 0, F.col("query_weight") / norm)
    return known.withColumn("share", share).select("query_id", "term", "share")


def search_term(queries: DataFrame, index: SearchIndex, k: int = 10, stop_words=SEARCH_STOP_WORDS) -> DataFrame:
    """(query_id, doc_id, score, rank) of the queries that are exactly one token, ranked by TF-IDF.

    A term that is in every document scores 0 and is still listed.
    """
    single = query_terms(queries, stop_words).filter("n_tokens = 1").select("query_id", "term")
    postings = index.of_terms(single).select("term", "doc_id", F.col("tfidf").alias("score"))
    return ranked(postings.join(single, "term"), k)


def search_cosine(queries: DataFrame, index: SearchIndex, k: int = 10, stop_words=SEARCH_STOP_WORDS) -> DataFrame:
    """(query_id, doc_id, score, rank) of the queries of several tokens, ranked by cosine similarity.

    A query weighs its terms by count times idf and ignores unknown ones; a document's norm runs over all
    its terms.  Only documents that share a term can score above 0, and only those are listed.  Both sides are
    normed before the sum, so what is ranked is the cosine itself.
    """
    weighed = stored(query_weights(queries, index.terms, stop_words), "query-weights")
    postings = index.of_terms(weighed).select("doc_id", "term", "weight")
    if fits_broadcast(weighed):
        # Dealt by document before queries and postings meet: the scores, far more rows, need no shuffle.
        asked = weighed.select("term").distinct()
        postings = postings.join(F.broadcast(asked), "term", "left_semi").repartition("doc_id")
        weighed = F.broadcast(weighed)
    scores = (
        postings.join(weighed, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("share") * F.col("weight")).alias("score"))
    )
    return ranked(scores.filter("score > 0"), k)


def search(queries: DataFrame, index: SearchIndex, k: int = 10, stop_words=SEARCH_STOP_WORDS) -> DataFrame:
    """Both searches; each query takes the one that fits its number of tokens."""
    return search_term(queries, index, k, stop_words).unionByName(search_cosine(queries, index, k, stop_words))


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of ``scores(query_id, doc_id, score)`` for each query, with their rank."""
    best = top_k_per_group(scores, "query_id", k, [rank_value("score").desc(), F.col("doc_id").asc()])
    return best.select("query_id", "doc_id", "score", "rank")


def with_titles(
    results: DataFrame, titles: DataFrame, default: str = "Unknown", line: str | None = None
) -> DataFrame:
    """Add ``title`` from ``titles(doc_id, title)``, one row per result whatever ``titles`` repeats.

    Of several titles the one with the largest ``line`` is taken, without such a column the largest title.  The
    results are already cut to k rows per query, so this touches the title table once.
    """
    title = F.max("title") if line is None else F.max_by("title", line)
    return (
        results.join(titles.select("doc_id", "title", *([line] if line else [])), "doc_id", "left")
        .groupBy(*results.columns)
        .agg(F.coalesce(title, F.lit(default)).alias("title"))
    )
