"""The operators as named queries over whole tables, with production parameters, and SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import (
    conversations, decontamination, language, line_rules, mixing, sharding, simhash, sites, substrings, token_counts,
    token_files, toxicity, whitening,
)
from weftline.llm.oracle import ORACLE  # noqa: F401  the SQL beside the queries
from weftline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
END_ID = 2


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    """The public byte-level tokenizer, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_line_rules(spark, sf_dir):
    found = line_rules.line_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", *line_rules.COUNTS, "n_common_words", "base_failed", "kept")


@query
def op2_token_counts(spark, sf_dir):
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), byte_bpe())
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op3_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, byte_bpe(), END_ID)
    return token_files.read_digests(spark, path)


@query
def op4_toxicity(spark, sf_dir):
    """The chain goes from low quality to toxicity, the two categories that are labelled."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.fit_chain(docs, labels, ["low_quality", "toxic"])
    found = toxicity.predict(docs, chain, carry=["doc_id"])
    p = F.col("probabilities")
    return found.select(
        "row.doc_id", F.round(p[0], 6).alias("p_low_quality"), F.round(p[1], 6).alias("p_toxic"),
        (p[1] >= 0.5).alias("toxic"),
    )


@query
def op5_simhash_near_duplicates(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_site_quality(spark, sf_dir):
    """The source is the host, its language sections are the paths below it."""
    found = sites.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return found.select(
        "row.doc_id", *[F.round(c, 6).alias(c) for c in ("doc_probability", "host_posterior", "path_posterior", "quality")],
        (F.col("quality") >= 0.5).alias("kept"),
    )


@query
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit_documents(docs)
    found = language.identify(docs, model, carry=["doc_id"])
    doc_id = F.col("row.doc_id")
    return found.select(doc_id, language.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


@query
def op8_repeated_passages(spark, sf_dir):
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op10_benchmark_matches(spark, sf_dir):
    """One row for each document and benchmark item that it covers."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.match_documents(docs, benchmark, carry=["doc_id"], short_items=True)
    found = found.select("row.doc_id", F.explode("matches").alias("m"))
    return found.select(
        "doc_id", "m.item_id", "m.coverage", "m.n_words", F.size("m.tiles").alias("n_tiles"),
        F.lit(True).alias("contaminated"),
    )


@query
def op11_conversation_repair(spark, sf_dir):
    return conversations.repair_digests(conversations.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_embedding_whitening(spark, sf_dir):
    found = whitening.whitened_components(table(spark, sf_dir, "embeddings"), "embedding", carry=["vec_id"])
    return found.select("row.vec_id", *[c for c in found.columns if c != "row"])


@query
def op13_uniform_shards(spark, sf_dir):
    """Only ids, sizes and hashes are shuffled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", *sharding.sizes_and_hashes("text"))
    found = sharding.shuffle_into_shards(docs)
    return found.select(
        "row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
