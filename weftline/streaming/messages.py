"""JSON messages in and out; the functions take batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import trimmed

# The fields of a text message and the constants of the headline feed.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("subreddit", T.StringType()),
    ]
)
HEADLINE_FEED = "newsapi"
MIN_HEADLINE_CHARS = 10
INDEX_NAMES = {"entity": "entity_name", "count": "entity_count"}


def decode_messages(raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, value: str = "value") -> DataFrame:
    """One column per field of the JSON in ``value`` (binary or string); malformed messages give NULLs."""
    return raw.select(F.from_json(F.col(value).cast("string"), schema).alias("j")).select("j.*")


def judged_messages(raw: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, value: str = "value") -> DataFrame:
    """``raw`` with the fields of ``schema`` and ``reason``: why a message is rejected, NULL for one that is accepted.

    A message is rejected when it is missing, is no JSON, is no object, or has a value of a field that is none of the
    field's type.  Fields that are not there are NULL, fields beyond the schema do no harm.  Every message is one row.
    """
    text = F.col(value).cast("string")
    parsed = raw.withColumn("__json", F.try_parse_json(text))
    fields = {f.name: F.try_variant_get("__json", f"$.{f.name}", f.dataType.simpleString()) for f in schema.fields}
    reason = (
        F.when(text.isNull(), "missing")
        .when(F.col("__json").isNull(), "no JSON")
        .when(~F.startswith(F.schema_of_variant("__json"), F.lit("OBJECT")), "no object")
    )
    for name, found in fields.items():
        given = F.try_variant_get("__json", f"$.{name}", "variant")
        reason = reason.when(found.isNull() & given.isNotNull() & ~F.is_variant_null(given), f"type of {name}")
    return parsed.select(*raw.columns, *[found.alias(name) for name, found in fields.items()], reason.alias("reason"))


def accepted_messages(judged: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """The fields of the accepted ones of ``judged_messages``."""
    return judged.filter("reason is null").select(*schema.names)


def rejected_messages(judged: DataFrame, value: str = "value") -> DataFrame:
    """(value, reason) of the rejected ones of ``judged_messages``."""
    return judged.filter("reason is not null").select(F.col(value).cast("string").alias("value"), "reason")


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """``value``: each row as JSON; ``key`` names a column to send as the message key."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def count_messages(counts: DataFrame, ts: Column | None = None, key: str | None = None) -> DataFrame:
    """(entity, count) -> JSON messages with the processing time as ``ts``."""
    stamp = F.current_timestamp() if ts is None else ts
    return encode_messages(counts.select("entity", "count", stamp.alias("ts")), key)


def normalise_headlines(articles: DataFrame, created_utc: Column | None = None) -> DataFrame:
    """``articles(url, title, description, source)`` -> text messages.

    ``source`` is a struct with a ``name``.  The text is title and description; shorter ones than
    ``MIN_HEADLINE_CHARS`` are dropped.
    """
    title = F.coalesce("title", F.lit(""))
    description = F.coalesce("description", F.lit(""))
    now = F.unix_timestamp(F.current_timestamp()).cast("double") if created_utc is None else created_utc
    return articles.select(
        F.col("url").alias("id"),
        F.col("source.name").alias("author"),
        now.alias("created_utc"),
        trimmed(F.concat(title, F.lit(". "), description)).alias("text"),
        F.lit(HEADLINE_FEED).alias("subreddit"),
    ).filter(F.length("text") >= MIN_HEADLINE_CHARS)


def rename_for_index(df: DataFrame) -> DataFrame:
    """Field names of the search index: entity_name, entity_count; others stay."""
    return df.withColumnsRenamed(INDEX_NAMES)


def index_records(messages: DataFrame) -> DataFrame:
    """JSON count messages -> records of the search index."""
    schema = T.StructType(
        [
            T.StructField("entity", T.StringType()),
            T.StructField("count", T.LongType()),
            T.StructField("ts", T.TimestampType()),
        ]
    )
    return rename_for_index(decode_messages(messages, schema))
