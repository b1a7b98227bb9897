"""Every operator as a named query over the benchmark tables.

A query is a function (spark, sf_dir) -> DataFrame.  Doubles are rounded here, not in the operators.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.scalars import id_order
from weftline.functions.text import search_tokens
from weftline.functions.wordlists import BATCH_ENTITY_LABELS
from weftline.operators import (
    blocks, classify, entities, everyone, graph, growing_graph, names, sampling, search, segments, sketches, social, top_counts,
)
from weftline.operators.ranking import numbered
from weftline.plans import tables
from weftline.session import materialise, scratch_path, stored
from weftline.sources import directories, lines, sinks
from weftline.streaming import counts as stream_counts
from weftline.streaming import messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEED = 42
N_USERS = 10
#: Bytes of text in one file of a stream's folder, at most as far as the hash of the key deals them evenly.
FILE_BYTES = 256 << 20


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


# --- search -----------------------------------------------------------------------------------------


@query
def tokens(spark, sf_dir):
    docs = tables.documents(spark, sf_dir).select("doc_id", search_tokens("text").alias("tokens"))
    return docs.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query
def term_frequency(spark, sf_dir):
    return search.term_frequency(tables.documents(spark, sf_dir))


@query
def document_frequency(spark, sf_dir):
    return search.document_frequency(term_frequency(spark, sf_dir))


@query
def idf(spark, sf_dir):
    docs = tables.documents(spark, sf_dir)
    return rounded(search.inverse_document_frequency(document_frequency(spark, sf_dir), docs), "idf")


@query
def tfidf(spark, sf_dir):
    return rounded(search.build_index(tables.documents(spark, sf_dir)).postings.drop("weight"), "tfidf")


@query
def doc_norms(spark, sf_dir):
    return rounded(search.build_index(tables.documents(spark, sf_dir)).norms, "norm")


@query
def doc_vectors(spark, sf_dir):
    vectors = search.doc_vectors(search.build_index(tables.documents(spark, sf_dir)).postings)
    total = F.aggregate(F.map_values("vector"), F.lit(0.0), lambda total, weight: total + weight)
    return vectors.select("doc_id", F.size("vector").alias("n_terms"), F.round(total, 4).alias("total_weight"))


@query
def search_single_term(spark, sf_dir):
    index = search.build_index(tables.documents(spark, sf_dir)).checkpointed()
    return rounded(search.search_term(tables.word_queries(spark, sf_dir), index), "score")


@query
def search_cosine_topk(spark, sf_dir):
    index = search.build_index(tables.documents(spark, sf_dir)).checkpointed()
    return rounded(search.search_cosine(tables.phrase_queries(spark, sf_dir), index), "score")


@query
def search_with_titles(spark, sf_dir):
    index = search.build_index(tables.documents(spark, sf_dir)).checkpointed()
    asked = tables.phrase_queries(spark, sf_dir).unionByName(tables.word_queries(spark, sf_dir))
    found = search.search(asked, index)
    return rounded(search.with_titles(found, tables.page_titles(spark, sf_dir)), "score")


@query
def search_last_title(spark, sf_dir):
    """Titles as numbered lines, each page with an older line before; the last line of a page is its title."""
    index = search.build_index(tables.documents(spark, sf_dir)).checkpointed()
    found = search.search_cosine(tables.phrase_queries(spark, sf_dir), index)
    titles = tables.page_titles(spark, sf_dir).withColumn("line", 2 * F.col("doc_id") + 1)
    older = titles.select("doc_id", F.concat(F.lit("zz "), "title").alias("title"), (F.col("line") - 1).alias("line"))
    return rounded(search.with_titles(found, older.unionByName(titles), line="line"), "score")


@query
def search_saved_index(spark, sf_dir):
    """The same search over an index written to the shared folder and read back."""
    path = scratch_path(spark, "index")
    search.build_index(tables.documents(spark, sf_dir)).save(path)
    index = search.SearchIndex.load(spark, path)
    return rounded(search.search_cosine(tables.phrase_queries(spark, sf_dir), index), "score")


@query
def search_blockmax_topk(spark, sf_dir):
    """The same search, but blocks of postings whose largest weights cannot reach the ten best are not read."""
    path = scratch_path(spark, "block-index")
    blocks.BlockIndex.save(search.build_index(tables.documents(spark, sf_dir)), path)
    index = blocks.BlockIndex.load(spark, path)
    return rounded(blocks.search_blocks(tables.phrase_queries(spark, sf_dir), index), "score")


@query
def search_growing_index(spark, sf_dir):
    """The documents come in three parts and every seventh goes again, half of those come back; then the search."""
    docs, part = tables.documents(spark, sf_dir), F.col("doc_id") % 3
    index = segments.SegmentedIndex(spark, scratch_path(spark, "segments"), fanout=3)
    index.append(docs.filter(part == 0))
    index.append(docs.filter(part == 1))
    index.delete(docs.filter("doc_id % 7 = 0").select("doc_id"))
    index.append(docs.filter((part == 2) | (F.col("doc_id") % 14 == 0)).filter("doc_id % 7 <> 0 or doc_id % 14 = 0"))
    snapshot = index.snapshot().checkpointed()
    return rounded(search.search_cosine(tables.phrase_queries(spark, sf_dir), snapshot), "score")


@query
def query_file(spark, sf_dir):
    """The benchmark texts twice, as lines with a number of their own."""
    asked = tables.table(spark, sf_dir, "benchmark").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    number = 2 * F.col("item_id") + F.col("n")
    return lines.parse_queries(asked.select(F.concat(F.lit(" \t"), "text").alias("value"), number.alias("line")), "line")


# --- entities ---------------------------------------------------------------------------------------


@query
def search_hot_terms(spark, sf_dir):
    """The TF-IDF weights again, with every term of more than 50 documents split over salts."""
    return rounded(search.build_index(tables.documents(spark, sf_dir), min_hot_rows=50).postings.drop("weight"), "tfidf")


@query
def entity_counts_top20(spark, sf_dir):
    return entities.entity_counts(tables.documents(spark, sf_dir), labels=None)


@query
def entity_counts_labelled(spark, sf_dir):
    counts = entities.count_entities(entities.entity_mentions(tables.documents(spark, sf_dir)))
    return entities.keep_known_entities(counts, tables.gazetteer(spark, sf_dir), BATCH_ENTITY_LABELS)


@query
def entity_counts_model(spark, sf_dir):
    """Entities of a user's model; its stand-in finds capitalised words and labels them by the last letter."""

    def load_model():
        import re

        pattern = re.compile(r"(?<!\w)[A-Z][a-z]+(?!\w)")
        labels = {"e": "PERSON", "n": "GPE", "r": "ORG", "s": "LOC", "t": "DATE"}
        return lambda texts: [[(w, labels.get(w[-1], "MISC")) for w in pattern.findall(text)] for text in texts]

    return entities.entity_counts(tables.documents(spark, sf_dir), entities.model_extractor(load_model))


def found_names(spark, sf_dir) -> DataFrame:
    gazetteer = tables.name_gazetteer(spark, sf_dir)
    return names.find_names(tables.documents(spark, sf_dir), gazetteer, BATCH_ENTITY_LABELS)


@query
def name_mentions(spark, sf_dir):
    """Where names of one to four words stand in the texts."""
    return found_names(spark, sf_dir)


@query
def name_counts(spark, sf_dir):
    return names.name_counts(found_names(spark, sf_dir))


@query
def entity_counts_of_parts(spark, sf_dir):
    """The 20 most frequent entities from stored counts of each source."""
    docs = tables.table(spark, sf_dir, "documents")
    found = docs.select("source", F.explode(entities.capitalised_words("text")).alias("mention"))
    path = scratch_path(spark, "partial-counts")
    top_counts.write_partial_counts(found.select("source", F.col("mention.text").alias("entity")), path, "source", "entity")
    partials = spark.read.schema("key string, count bigint, part string").parquet(path)
    return top_counts.top_counts(partials, 20).withColumnRenamed("key", "entity")


# --- sampling and splitting -------------------------------------------------------------------------


def friend_lists(spark, sf_dir) -> DataFrame:
    members = social.memberships_from_edges(tables.supply_edges(spark, sf_dir))
    return members.select(*(F.col(name).cast("string") for name in ("list_id", "owner", "friend")))


def requested_users(spark, sf_dir) -> DataFrame:
    users = friend_lists(spark, sf_dir).select(F.col("owner").alias("user"))
    return materialise(sampling.sample_users(users, N_USERS, SEED))


@query
def first_users(spark, sf_dir):
    users = friend_lists(spark, sf_dir).select(F.col("owner").alias("user")).distinct()
    return sampling.first_rows(users, 1000, id_order("user"))


@query
def user_positions(spark, sf_dir):
    """The place of every user in id order, numbered by range and not in one group."""
    users = friend_lists(spark, sf_dir).select(F.col("owner").alias("user")).distinct()
    return numbered(users, id_order("user"), "position")


@query
def sampled_users(spark, sf_dir):
    return requested_users(spark, sf_dir)


@query
def train_test_split(spark, sf_dir):
    docs = tables.labelled_documents(spark, sf_dir)
    return docs.select("doc_id", sampling.split_flag(SEED, "doc_id", 0.2).alias("is_test"))


@query
def split_sizes(spark, sf_dir):
    docs = news(spark, sf_dir)
    part = F.when(sampling.split_flag(SEED, "doc_id", 0.2), "test").otherwise("train")
    return docs.groupBy(part.alias("part")).agg(F.count("*").alias("n_docs"))


# --- recommendations --------------------------------------------------------------------------------


@query
def existing_friendships(spark, sf_dir):
    return social.existing_friendships(friend_lists(spark, sf_dir), requested_users(spark, sf_dir))


@query
def mutual_friend_counts(spark, sf_dir):
    return social.mutual_friend_counts(friend_lists(spark, sf_dir), requested_users(spark, sf_dir))


@query
def candidate_counts(spark, sf_dir):
    return social.candidate_counts(friend_lists(spark, sf_dir), requested_users(spark, sf_dir))


@query
def recommend_topk(spark, sf_dir):
    return social.recommend(friend_lists(spark, sf_dir), requested_users(spark, sf_dir))


@query
def recommend_all(spark, sf_dir):
    """The ten best candidates of every user."""
    return everyone.recommend_everyone(friend_lists(spark, sf_dir))


@query
def recommend_lines(spark, sf_dir):
    lists = social.recommendation_lists(recommend_topk(spark, sf_dir)).orderBy(*id_order("user"))
    return sinks.recommendation_lines(lists)


@query
def recommend_from_lines(spark, sf_dir):
    """Recommendations from text lines, where a user may have many lists and a list repeats friends."""
    members = social.explode_adjacency(lines.parse_adjacency(tables.adjacency_lines(spark, sf_dir)))
    users = sampling.sample_users(members.select(F.col("friend").alias("user")), N_USERS, SEED)
    return social.recommend(members, materialise(users))


# --- classification ---------------------------------------------------------------------------------


def news(spark, sf_dir, docs=tables.labelled_documents) -> DataFrame:
    return classify.clean_news_text(docs(spark, sf_dir)).select("doc_id", "label", "tokens")


def news_train(spark, sf_dir) -> DataFrame:
    return sampling.hash_split(news(spark, sf_dir), SEED, "doc_id", 0.2)[0]


def predictions(spark, sf_dir, docs=tables.labelled_documents) -> DataFrame:
    """Train, predict, and put the true label next to the prediction; every text is tokenized once."""
    train, test = sampling.hash_split(materialise(news(spark, sf_dir, docs)), SEED, "doc_id", 0.2)
    return classify.with_truth(classify.nb_predict(classify.nb_fit(train), test), test)


@query
def news_tokens(spark, sf_dir):
    docs = news(spark, sf_dir)
    return docs.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query
def class_priors(spark, sf_dir):
    return rounded(classify.class_priors(news_train(spark, sf_dir)), "prior")


@query
def largest_priors(spark, sf_dir):
    return rounded(classify.largest_priors(classify.class_priors(news_train(spark, sf_dir))), "prior")


@query
def word_class_counts(spark, sf_dir):
    return classify.word_class_counts(news_train(spark, sf_dir))


@query
def class_word_totals(spark, sf_dir):
    return classify.class_word_totals(news_train(spark, sf_dir))


@query
def vocabulary_size(spark, sf_dir):
    """Both figures from one table of word counts: the texts are cleaned once."""
    words = classify.word_class_counts(news_train(spark, sf_dir)).groupBy("word").agg(F.sum("n").alias("n"))
    return words.agg(F.count("*").alias("n_vocabulary"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"))


@query
def vocabulary_sketches(spark, sf_dir):
    """The vocabulary from united sketches of the classes, against the exact number: off by five standard errors at most."""
    words = news_train(spark, sf_dir).select("label", F.explode("tokens").alias("word"))
    stored_sketches = stored(sketches.distinct_sketches(words, "label", "word"), "word-sketches")
    estimate = sketches.distinct_estimate(stored_sketches).scalar()
    exact = vocabulary_size(spark, sf_dir).select("n_vocabulary")
    off = F.abs(estimate - F.col("n_vocabulary")) / F.col("n_vocabulary")
    return exact.withColumn("near", off <= 5 * sketches.standard_error())


@query
def nb_predict(spark, sf_dir):
    return rounded(predictions(spark, sf_dir), "score", digits=4)


@query
def nb_accuracy(spark, sf_dir):
    return rounded(classify.accuracy(predictions(spark, sf_dir)), "accuracy")


@query
def nb_class_accuracy(spark, sf_dir):
    return rounded(classify.best_classes(classify.class_accuracy(predictions(spark, sf_dir))), "accuracy")


@query
def nb_quality_predict(spark, sf_dir):
    return rounded(predictions(spark, sf_dir, tables.rated_documents), "score", digits=4)


# --- graph ------------------------------------------------------------------------------------------


@query
def graph_vertices(spark, sf_dir):
    return graph.graph_vertices(tables.supply_edges(spark, sf_dir))


@query
def graph_size(spark, sf_dir):
    return graph.graph_size(tables.supply_edges(spark, sf_dir))


@query
def out_degrees(spark, sf_dir):
    return graph.out_degrees(tables.supply_edges(spark, sf_dir))


@query
def in_degrees(spark, sf_dir):
    return graph.in_degrees(tables.supply_edges(spark, sf_dir))


@query
def out_degree_top5(spark, sf_dir):
    return graph.top_by(out_degrees(spark, sf_dir), "out_degree")


@query
def in_degree_top5(spark, sf_dir):
    return graph.top_by(in_degrees(spark, sf_dir), "in_degree")


def supply_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    edges = tables.supply_edges(spark, sf_dir)
    return graph.graph_vertices(edges), edges


def order_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    edges = tables.order_edges(spark, sf_dir)
    return graph.graph_vertices(edges), edges


@query
def pagerank(spark, sf_dir):
    return rounded(graph.pagerank(*supply_graph(spark, sf_dir)), "pagerank")


@query
def pagerank_top5(spark, sf_dir):
    return graph.top_by(pagerank(spark, sf_dir), "pagerank")


@query
def components(spark, sf_dir):
    return graph.connected_components(*order_graph(spark, sf_dir))


@query
def component_sizes(spark, sf_dir):
    return graph.component_sizes(components(spark, sf_dir))


@query
def component_sizes_top5(spark, sf_dir):
    return graph.top_by(component_sizes(spark, sf_dir), "count", id_col="component")


@query
def components_growing(spark, sf_dir):
    """The components of the order graph, whose edges come in four parts."""
    edges = tables.order_edges(spark, sf_dir)
    growing = growing_graph.GrowingComponents(spark, scratch_path(spark, "components"))
    for part in range(4):
        growing.append(edges.filter(F.col("src") % 4 == part))
    return growing.labels()


@query
def triangle_counts(spark, sf_dir):
    return graph.triangle_count(*supply_graph(spark, sf_dir))


@query
def triangles_top5(spark, sf_dir):
    return graph.top_by(triangle_counts(spark, sf_dir), "count")


# --- line formats -----------------------------------------------------------------------------------


@query
def parse_id_text(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents")
    value = F.when(F.col("lang") == "fr", F.col("text")).otherwise(F.concat_ws("\t", "doc_id", "source", "text"))
    return lines.parse_id_text(docs.select(value.alias("value")))


@query
def parse_titles(spark, sf_dir):
    parts = tables.table(spark, sf_dir, "part")
    value = F.when(F.col("p_size") > 3, F.concat_ws("\t", "p_partkey", "p_brand", "p_name", "p_type"))
    short = F.concat_ws("\t", "p_partkey", "p_brand")
    return lines.parse_titles(parts.select(F.coalesce(value, short).alias("value")))


@query
def parse_adjacency(spark, sf_dir):
    adjacency = lines.parse_adjacency(tables.adjacency_lines(spark, sf_dir))
    return adjacency.select("user", F.array_join("friends", "|").alias("friends"))


@query
def parse_edges(spark, sf_dir):
    items = tables.table(spark, sf_dir, "lineitem")
    value = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("# "), F.col("l_orderkey")))
        .when(F.col("l_linenumber") == 2, F.lit(""))
        .when(F.col("l_linenumber") == 3, F.col("l_partkey").cast("string"))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit("  "), F.col("l_partkey"), F.lit(" "), F.col("l_suppkey")))
        .otherwise(F.concat(F.col("l_partkey"), F.lit(" \t "), F.col("l_suppkey"), F.lit("\t"), F.col("l_orderkey")))
    )
    return lines.parse_edges(items.select(value.alias("value")))


@query
def csv_out_degrees(spark, sf_dir):
    """Out-degrees through the CSV sink."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(out_degrees(spark, sf_dir), path)
    return spark.read.schema("id bigint, out_degree bigint").csv(path)


@query
def recommendation_file(spark, sf_dir):
    """Recommendation lines through the text sink."""
    path = scratch_path(spark, "lines")
    sinks.write_lines(recommend_lines(spark, sf_dir), path)
    return lines.read_lines(spark, path)


# --- messages and streams ---------------------------------------------------------------------------


@query
def json_decode(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select(F.col("props").cast("binary").alias("value"))
    decoded = messages.decode_messages(events, T.StructType([T.StructField("k", T.LongType())]))
    return decoded.groupBy("k").agg(F.count("*").alias("n"))


def document_messages(docs: DataFrame) -> DataFrame:
    """Documents as JSON text messages."""
    return messages.encode_messages(
        docs.select(
            F.col("doc_id").cast("string").alias("id"),
            F.col("source").alias("author"),
            F.lit(0.5).alias("created_utc"),
            "text",
            F.col("lang").alias("subreddit"),
        )
    )


@query
def message_round_trip(spark, sf_dir):
    return messages.decode_messages(document_messages(tables.table(spark, sf_dir, "documents")))


def judged_documents(spark, sf_dir) -> DataFrame:
    """Documents as messages of which four in seven are cut off, a list, mistyped or longer by a field."""
    docs, kind = tables.table(spark, sf_dir, "documents"), F.col("doc_id") % 7
    fields = [F.col("doc_id").cast("string").alias("id"), F.col("source").alias("author"), "text", F.col("lang").alias("subreddit")]
    good = F.to_json(F.struct(*fields, F.lit(0.5).alias("created_utc")))
    value = (
        F.when(kind == 0, F.substring(good, 1, 12)).when(kind == 1, F.concat(F.lit("["), good, F.lit("]")))
        .when(kind == 2, F.to_json(F.struct(*fields, F.lit("soon").alias("created_utc"))))
        .when(kind == 3, F.to_json(F.struct(*fields, F.lit(0.5).alias("created_utc"), F.lit(1).alias("likes"))))
        .otherwise(good)
    )
    return messages.judged_messages(docs.select(value.alias("value")))


@query
def messages_accepted(spark, sf_dir):
    return messages.accepted_messages(judged_documents(spark, sf_dir))


@query
def messages_rejected(spark, sf_dir):
    return messages.rejected_messages(judged_documents(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n"))


@query
def json_encode(spark, sf_dir):
    counts = entities.count_entities(entities.entity_mentions(tables.documents(spark, sf_dir)))
    return messages.encode_messages(counts, key="entity")


@query
def index_records(spark, sf_dir):
    counts = entities.count_entities(entities.entity_mentions(tables.documents(spark, sf_dir)))
    return messages.index_records(messages.count_messages(counts)).select("entity_name", "entity_count")


@query
def normalise_headlines(spark, sf_dir):
    return messages.normalise_headlines(tables.articles(spark, sf_dir), F.lit(0.5))


@query
def timed_count_messages(spark, sf_dir):
    """Count messages with a given time stamp, decoded again."""
    counts = entities.count_entities(entities.entity_mentions(tables.documents(spark, sf_dir)))
    stamp = F.to_timestamp_ntz(F.lit("2024-01-02 03:04:05")).cast("timestamp")
    sent = messages.count_messages(counts, stamp)
    decoded = messages.index_records(sent)
    return decoded.select("entity_name", "entity_count", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query
def clock_columns(spark, sf_dir):
    """Messages and headlines that take the time of the run: there, and no earlier than the call."""
    began = F.lit(time.time() - 1)
    counts = entities.count_entities(entities.entity_mentions(tables.documents(spark, sf_dir)))
    sent = messages.index_records(messages.count_messages(counts)).select(F.unix_timestamp("ts").alias("at"))
    headlines = messages.normalise_headlines(tables.articles(spark, sf_dir)).select(F.col("created_utc").alias("at"))
    fresh = F.coalesce(F.col("at") >= began, F.lit(False)) & (F.col("at") <= F.unix_timestamp(F.current_timestamp()))
    kinds = [df.select(F.lit(kind).alias("kind"), fresh.alias("fresh")) for kind, df in (("count", sent), ("headline", headlines))]
    return kinds[0].unionAll(kinds[1]).groupBy("kind", "fresh").agg(F.count("*").alias("n"))


def streamed_counts(spark, docs: DataFrame, path: str) -> DataFrame:
    decoded = messages.decode_messages(document_messages(docs))
    counts = stream_counts.stream_entity_counts(decoded, labels=None)
    stream_counts.run_available(stream_counts.table_writer(counts, f"{path}/counts", f"{path}/checkpoint"))
    return stream_counts.latest_counts(spark, f"{path}/counts")


@query
def stream_entity_counts(spark, sf_dir):
    """Documents as a message stream, counted in update mode, read back as the last total per entity.

    The last letter stands in brackets because a stream reads a folder or a pattern, and the table may be a
    single file.
    """
    schema = tables.table(spark, sf_dir, "documents").schema
    docs = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    return streamed_counts(spark, docs, scratch_path(spark, "stream"))


@query
def stream_two_queries(spark, sf_dir):
    """Two queries over one plan: both sinks have the last totals of all entities."""
    path = scratch_path(spark, "two")
    schema = tables.table(spark, sf_dir, "documents").schema
    docs = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    counts = stream_counts.stream_entity_counts(docs.select("text"), labels=None)
    sinks_of = ("first", "second")
    started = [
        stream_counts.table_writer(counts, f"{path}/{s}", f"{path}/{s}-checkpoint").trigger(availableNow=True).start()
        for s in sinks_of
    ]
    stream_counts.await_first(started)
    for running in started:
        running.awaitTermination()
    both = [stream_counts.latest_counts(spark, f"{path}/{s}").withColumn("sink", F.lit(s)) for s in sinks_of]
    return both[0].unionByName(both[1])


def written_in_files(docs: DataFrame, path: str, batches: int, key: str) -> int:
    """Append ``docs`` to the folder in ``batches`` times as many files as keep each at ``FILE_BYTES`` or less; that number.

    It is the number of files of a micro-batch: one for small tables, more where a file would be more than a task should hold.
    """
    text = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    files = max(1, -(-text // (batches * FILE_BYTES)))
    docs.repartition(batches * files, key).write.mode("append").parquet(path)
    return files


@query
def stream_in_batches(spark, sf_dir):
    """The same stream from a folder of several files, stopped and started again.

    A micro-batch is one file; of a large table, whose files would be more than a task should read, it is several.
    """
    path = scratch_path(spark, "batches")
    docs = tables.documents(spark, sf_dir).select("doc_id", F.lit("a").alias("source"), "text", F.lit("en").alias("lang"))
    for batches in (3, 2):
        files = written_in_files(docs, f"{path}/documents", batches, "doc_id")
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", files)
        counts = streamed_counts(spark, stream.parquet(f"{path}/documents"), path)
    return counts


def sent_messages(docs: DataFrame) -> DataFrame:
    """Documents as messages of the same hour."""
    seconds = (F.lit(1.7e9) + F.col("doc_id") % 600).alias("created_utc")
    return docs.select(F.col("doc_id").cast("string").alias("id"), seconds, "text")


def sent_twice(spark, sf_dir) -> str:
    """The log of a stream in which every message is delivered twice; each batch is in both sinks once."""
    path = scratch_path(spark, "deltas")
    sent = sent_messages(tables.documents(spark, sf_dir))
    for _ in range(2):
        files = written_in_files(sent, f"{path}/messages", 2, "id")
        stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/messages")
        once = stream_counts.without_repeats(stream)
        stream_counts.run_available(stream_counts.delta_writer(once, f"{path}/log", f"{path}/checkpoint", labels=None))
    stream_counts.fold_deltas(spark, f"{path}/log", upto=1)
    return f"{path}/log"


@query
def stream_counts_once(spark, sf_dir):
    totals = stream_counts.window_totals(spark, sent_twice(spark, sf_dir))
    return totals.groupBy("entity").agg(F.sum("count").alias("count"))


@query
def stream_accepted_ids(spark, sf_dir):
    log = stream_counts.BatchLog(spark, sent_twice(spark, sf_dir))
    return log.read(stream_counts.ACCEPTED, stream_counts.ACCEPTED_SCHEMA).select("id", F.unix_timestamp("event_time").alias("seconds"))


# --- folders ----------------------------------------------------------------------------------------


@query
def labelled_folders(spark, sf_dir):
    """Documents written as a file each, in a folder per language, and read back with their labels."""
    path = scratch_path(spark, "folders")
    docs = tables.table(spark, sf_dir, "documents").select("lang", "text")
    sinks.write_file_each(docs, path, "lang")
    found = directories.read_labelled_directory(spark, path, charset="UTF-8")
    return found.select("label", F.md5("text").alias("text"))


@query
def labelled_two_folders(spark, sf_dir):
    """Documents with an odd and an even number in a root of their own each, read as one collection."""
    path = scratch_path(spark, "roots")
    docs = tables.table(spark, sf_dir, "documents")
    for root, odd in (("train", 1), ("test", 0)):
        part = docs.filter(F.col("doc_id") % 2 == odd).select("lang", "text")
        sinks.write_file_each(part, f"{path}/{root}", "lang")
    found = directories.read_labelled_directory(spark, [f"{path}/train", f"{path}/test"], charset="UTF-8")
    root = F.regexp_extract("path", "/(train|test)/lang=[^/]*/[^/]+$", 1)
    return found.select(root.alias("root"), "label", F.md5("text").alias("text"))
