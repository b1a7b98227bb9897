"""A training corpus from raw documents: language, near-duplicates, benchmark, mix, token files.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  Its result is written as Parquet and read again
as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import decontamination, language, mixing, simhash, token_files
from weftline.llm.queries import END_ID, byte_bpe, table
from weftline.session import drop_stored, freed_afterwards, scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or no language that the words agree on."""
    return language.in_a_language(docs, language.fit_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group whose fingerprints link at two bits or fewer."""
    return simhash.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that cover an item of the benchmark."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row for each copy of a document that it takes, a part where it takes a part."""
    return mixing.mixed_documents(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns (doc_id, start, n_tokens, ids_crc32) from them."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, byte_bpe(), END_ID)
    return token_files.read_digests(spark, path)


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", tokenised),
]

#: The stages fit a model, hash with XXH64 and run a tokenizer, which SQL cannot.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with freed_afterwards(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        if before:
            drop_stored(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
