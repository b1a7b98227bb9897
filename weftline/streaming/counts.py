"""Running entity counts over a stream of text messages.

The state is one row per entity, has no window and grows with the number of distinct entities.  Update
mode sends the new total of each entity that changed, so a reader keeps the last total per entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from weftline.functions.text import trimmed
from weftline.functions.wordlists import STREAM_ENTITY_LABELS
from weftline.operators.entities import Extractor, capitalised_words, count_entities, entity_mentions
from weftline.streaming.batch_log import BatchLog

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS, DELTAS, ACCEPTED = "counts", "deltas", "accepted"
COUNT_SCHEMA = "entity string, count bigint"
DELTA_SCHEMA = "window_start timestamp, entity string, count bigint"
ACCEPTED_SCHEMA = "id string, event_time timestamp"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state on local disk with changelog checkpoints instead of on the JVM heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def stream_entity_counts(
    messages: DataFrame,
    extractor: Extractor = capitalised_words,
    labels: Sequence[str] | None = STREAM_ENTITY_LABELS,
) -> DataFrame:
    """(entity, count) of ``messages(text)``, a batch or a stream.  Repeated messages count again."""
    return count_entities(entity_mentions(messages, extractor, labels))


def console_writer(counts: DataFrame, every: str = "30 seconds") -> DataStreamWriter:
    """Debug output of the changed counts."""
    return counts.writeStream.format("console").outputMode("update").trigger(processingTime=every)


def table_writer(counts: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer that logs the changed counts of every micro-batch; a restart leaves no doubles."""
    log = BatchLog(counts.sparkSession, path)
    write = log.writer(lambda batch: {COUNTS: batch.select("entity", "count")})
    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """(entity, count): the last total of each entity in a count log; nothing before the first batch."""
    return _last_totals(BatchLog(spark, path).read(COUNTS, COUNT_SCHEMA))


def _last_totals(log: DataFrame) -> DataFrame:
    return log.groupBy("entity").agg(F.max_by("count", "batch_id").alias("count"))


def fold_counts(spark: SparkSession, path: str, upto: int) -> None:
    """Keep the totals as of batch ``upto`` in place of the batches up to it; run it at intervals.

    Only batches that the stream has committed may be folded.  Readers find the same counts before, during and after it.
    """
    BatchLog(spark, path).fold(upto, {COUNTS: (COUNT_SCHEMA, _last_totals)})


def without_repeats(messages: DataFrame, late: str = "1 hour", key: str = "id", time: str = "created_utc") -> DataFrame:
    """The messages of a stream, each ``key`` once: one that is delivered again within ``late`` is dropped.

    ``time`` is in seconds since 1970.  The state holds the keys of the last ``late`` of event time and no others.
    """
    stamped = messages.withColumn("event_time", F.timestamp_seconds(time))
    return stamped.withWatermark("event_time", late).dropDuplicatesWithinWatermark([key])


def delta_writer(
    messages: DataFrame, path: str, checkpoint: str, extractor: Extractor = capitalised_words,
    labels: Sequence[str] | None = STREAM_ENTITY_LABELS, width: str = "1 hour",
) -> DataStreamWriter:
    """Writer of two sinks for messages with ``event_time``: what each batch adds to the count of an entity in each window
    of ``width``, and the accepted message ids.  Counts live in the log and not in the state of the stream."""
    log = BatchLog(messages.sparkSession, path)

    def tables(batch: DataFrame) -> dict[str, DataFrame]:
        found = batch.select("event_time", F.explode_outer(extractor(F.col("text"))).alias("mention"))
        named = found.select(
            F.window("event_time", width).getField("start").alias("window_start"),
            trimmed("mention.text").alias("entity"), F.col("mention.label").alias("label"),
        ).filter("entity <> ''")
        named = named if labels is None else named.filter(F.col("label").isin(list(labels)))
        deltas = named.groupBy("window_start", "entity").agg(F.count("*").alias("count"))
        return {DELTAS: deltas, ACCEPTED: batch.select("id", "event_time")}

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(log.writer(tables))


def window_totals(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, entity, count) over all committed batches of a delta log."""
    return _sum_deltas(BatchLog(spark, path).read(DELTAS, DELTA_SCHEMA))


def _sum_deltas(log: DataFrame) -> DataFrame:
    return log.groupBy("window_start", "entity").agg(F.sum("count").alias("count"))


def fold_deltas(spark: SparkSession, path: str, upto: int) -> None:
    """Keep the sums of the batches up to ``upto`` in their place, and the accepted ids as they are."""
    ids = (ACCEPTED_SCHEMA, lambda log: log.select("id", "event_time"))
    BatchLog(spark, path).fold(upto, {DELTAS: (DELTA_SCHEMA, _sum_deltas), ACCEPTED: ids})


def start_all(writers: Sequence[DataStreamWriter], every: str | None = None) -> list[StreamingQuery]:
    """Start several queries; ``await_first`` then waits for the first to end."""
    return [(writer.trigger(processingTime=every) if every else writer).start() for writer in writers]


def await_first(queries: Sequence[StreamingQuery], poll_seconds: float = 0.5) -> StreamingQuery:
    """Wait until one of the queries ends, and raise its error if it has failed."""
    while True:
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
                return query
        queries[0].awaitTermination(poll_seconds)


def run_available(writer: DataStreamWriter) -> None:
    """Process what the source holds now and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
