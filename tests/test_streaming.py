import json
import os

import pytest
from pyspark.sql import functions as F

from weftline.operators.entities import capitalised_words, entity_counts, entity_mentions, model_extractor
from weftline.streaming import counts as C
from weftline.streaming.batch_log import BatchLog
from weftline.streaming import messages as M


def put(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.txt").write_text("\n".join(texts) + "\n")


def message(text, **fields):
    return json.dumps({"id": "1", "author": "a", "text": text, **fields})


def run(spark, source, out):
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    counts = C.stream_entity_counts(M.decode_messages(raw), labels=None)
    C.run_available(C.table_writer(counts, str(out / "counts"), str(out / "checkpoint")))
    return {row.entity: row["count"] for row in C.latest_counts(spark, str(out / "counts")).collect()}


def test_running_counts_over_batches_and_a_restart(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1", message("Paris and Rome"), message("Paris and Rome"), "{not json")
    put(source, "2", message("Rome again"), message(None), message("nothing here"))
    assert run(spark, source, tmp_path) == {"Paris": 2, "Rome": 3}
    put(source, "3", message("Oslo Paris"))
    assert run(spark, source, tmp_path) == {"Paris": 3, "Rome": 3, "Oslo": 1}
    batch = C.stream_entity_counts(M.decode_messages(spark.read.text(str(source))), labels=None)
    assert {row.entity: row["count"] for row in batch.collect()} == {"Paris": 3, "Rome": 3, "Oslo": 1}


def test_update_mode_sends_changed_totals_only(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1", message("Paris Rome"))
    run(spark, source, tmp_path)
    put(source, "2", message("Rome"))
    run(spark, source, tmp_path)
    log = BatchLog(spark, str(tmp_path / "counts")).read("counts", C.COUNT_SCHEMA)
    assert sorted(map(tuple, log.collect())) == [("Paris", 1, 0), ("Rome", 1, 0), ("Rome", 2, 1)]


def test_two_queries_on_rocksdb_state(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    C.use_rocksdb_state(spark)
    try:
        source = tmp_path / "in"
        put(source, "1", message("Paris Rome"))
        counts = C.stream_entity_counts(M.decode_messages(spark.readStream.text(str(source))), labels=None)
        outputs = [tmp_path / "a", tmp_path / "b"]
        started = C.start_all([C.table_writer(counts, str(o / "counts"), str(o / "checkpoint")) for o in outputs])
        for query, out in zip(started, outputs):
            query.processAllAvailable()
            query.stop()
            assert C.latest_counts(spark, str(out / "counts")).count() == 2
    finally:
        spark.conf.set(provider, before)


def test_message_round_trip_and_malformed_json(spark, lines):
    raw = lines(message("x", created_utc=1.5, subreddit="s"), "oops").select(F.col("value").cast("binary"))
    assert sorted(map(tuple, M.decode_messages(raw).collect()), key=repr) == [
        ("1", "a", 1.5, "x", "s"), (None,) * 5
    ]


def test_count_messages_and_index_names(spark):
    counts = spark.createDataFrame([("Rome", 3)], "entity string, count bigint")
    sent = M.count_messages(counts, F.lit("2024-01-02 03:04:05").cast("timestamp"), key="entity")
    row = sent.first()
    assert row.key == "Rome" and json.loads(row.value)["count"] == 3
    record = M.index_records(sent).first()
    assert record.asDict()["entity_name"] == "Rome" and record.entity_count == 3 and record.ts.year == 2024
    assert M.rename_for_index(counts).columns == ["entity_name", "entity_count"]
    assert set(json.loads(M.count_messages(counts).first().value)) == {"entity", "count", "ts"}


def test_headlines(spark):
    rows = [
        ("u1", "Title", "More", ("paper",)), ("u2", None, "Description", None), ("u3", "Headline", None, ("p",)),
        ("u4", None, None, None), ("u5", "1234567", "", None), ("u6", "12345678", "", None), ("u7", "123456789", "", None),
    ]
    articles = spark.createDataFrame(rows, "url string, title string, description string, source struct<name:string>")
    got = {r.id: (r.author, r.text, r.subreddit) for r in M.normalise_headlines(articles).collect()}
    assert got == {
        "u1": ("paper", "Title. More", "newsapi"),
        "u2": (None, ". Description", "newsapi"),
        "u7": (None, "123456789.", "newsapi"),
    }
    assert M.normalise_headlines(articles).first().created_utc > 1.6e9


TEXTS = ["Elizabeth met Mr Darcy", "darcy DARCY Darcy9 É Élan Darcy", None, ""]


def texts_frame(spark):
    return spark.createDataFrame([(text,) for text in TEXTS], "text string")


def test_rule_entities(spark):
    rows = entity_counts(texts_frame(spark), labels=None, k=2).collect()
    assert [tuple(row) for row in rows] == [("Darcy", 2), ("Elizabeth", 1)]
    assert entity_mentions(texts_frame(spark), capitalised_words).count() == 4


def test_model_entities(spark):
    def load_model():
        return lambda texts: [
            [(f" {w} ", "PERSON" if w[:1].isupper() else "DATE") for w in text.split(" ")] for text in texts
        ]

    extractor = model_extractor(load_model)
    rows = entity_counts(texts_frame(spark), extractor, ("PERSON",)).collect()
    assert {row.entity: row["count"] for row in rows} == {
        "Elizabeth": 1, "Mr": 1, "Darcy": 2, "DARCY": 1, "Darcy9": 1, "É": 1, "Élan": 1
    }


def test_blank_entities_are_kept_on_request(spark):
    extractor = model_extractor(lambda: lambda texts: [[("  ", "ORG")] for _ in texts])
    assert entity_mentions(texts_frame(spark), extractor, keep_blank=True).count() == 3
    assert entity_mentions(texts_frame(spark), extractor).count() == 0


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load_model():
        import os
        import uuid

        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: [[(text, "ORG")] for text in texts]

    extractor = model_extractor(load_model)
    texts = spark.range(320).select(F.col("id").cast("string").alias("text")).repartition(32)
    assert entity_mentions(texts, extractor).count() == 320
    loads = [name.split("-")[0] for name in os.listdir(folder)]
    assert len(loads) == len(set(loads)) <= 32


def test_a_log_without_batches_is_empty_and_a_folded_one_the_same(spark, tmp_path):
    path = str(tmp_path / "log")
    assert C.latest_counts(spark, path).collect() == []
    log = BatchLog(spark, path)
    for i, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 1), ("b", 3)], [("a", 7)]]):
        assert log.write(i, {"counts": spark.createDataFrame(rows, "entity string, count bigint")})
    before = sorted(C.latest_counts(spark, path).collect())
    early = C.latest_counts(spark, path)  # a reader that has looked before the fold
    C.fold_counts(spark, path, upto=2)
    assert sorted(C.latest_counts(spark, path).collect()) == sorted(early.collect()) == before
    log.vacuum()
    assert sorted(os.listdir(f"{path}/counts/batch")) == ["3"] and os.listdir(f"{path}/counts/base") == ["2"]
    assert sorted(C.latest_counts(spark, path).collect()) == before
    C.fold_counts(spark, path, upto=3)
    C.fold_counts(spark, path, upto=1)  # covered already
    assert sorted(C.latest_counts(spark, path).collect()) == before


def test_a_fold_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    log = BatchLog(spark, path)
    for i in range(3):
        log.write(i, {"counts": spark.createDataFrame([("a", i)], "entity string, count bigint")})
    monkeypatch.setattr("weftline.streaming.batch_log.make_folder", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        C.fold_counts(spark, path, upto=1)
    assert log.base() == -1 and C.latest_counts(spark, path).collect() == [("a", 2)]


SENT = "id string, created_utc double, text string"


def sent_stream(spark, folder, batches):
    """Messages in one file per batch, taken one file at a time in order of time."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SENT).coalesce(1).write.mode("append").parquet(f"{folder}/{i:03}")
    return spark.readStream.schema(SENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_repeated_messages_count_once_and_state_stays_bounded(spark, tmp_path):
    start = 1_700_000_000.0
    batches = []
    for i in range(10):  # each batch sends the one before again
        rows = [(f"{i}-{j}", start + 3600 * i + j, "Anna met Ben") for j in range(20)]
        batches.append(rows + (batches[-1][:20] if batches else []))
    stream = sent_stream(spark, str(tmp_path / "in"), batches)
    once = C.without_repeats(stream, late="2 hours")
    query = C.delta_writer(once, str(tmp_path / "log"), str(tmp_path / "c"), labels=None).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(rows) >= 10 and max(rows) <= 100 < 200
    totals = C.window_totals(spark, str(tmp_path / "log")).groupBy("entity").agg(F.sum("count").alias("n"))
    assert {tuple(r) for r in totals.collect()} == {("Anna", 200), ("Ben", 200)}
    log = BatchLog(spark, str(tmp_path / "log"))
    assert log.read("accepted", C.ACCEPTED_SCHEMA).count() == 200
    C.fold_deltas(spark, str(tmp_path / "log"), upto=log.committed()[5])
    log.vacuum()
    assert log.read("accepted", C.ACCEPTED_SCHEMA).select("id").distinct().count() == 200
    again = C.window_totals(spark, str(tmp_path / "log"))
    assert again.agg(F.sum("count")).first()[0] == 400 and again.count() == 20


def test_a_failure_between_two_sinks_leaves_no_doubles(spark, tmp_path, monkeypatch):
    batches = [[(f"{i}-{j}", 1.7e9 + i, "Anna met Ben") for j in range(5)] for i in range(3)]
    stream = sent_stream(spark, str(tmp_path / "in"), batches)
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "c")

    def run():
        C.run_available(C.delta_writer(C.without_repeats(stream), path, checkpoint, labels=None))

    real = BatchLog.write

    def breaks(self, batch_id, tables):
        if batch_id == 1:
            tables["deltas"].write.parquet(f"{self.path}/deltas/batch/1")
            raise OSError("disk full")
        return real(self, batch_id, tables)

    monkeypatch.setattr(BatchLog, "write", breaks)
    with pytest.raises(Exception, match="disk full"):
        run()
    log = BatchLog(spark, path)
    assert log.committed() == [0] and C.window_totals(spark, path).agg(F.sum("count")).first()[0] == 10
    monkeypatch.setattr(BatchLog, "write", real)
    run()
    assert C.window_totals(spark, path).agg(F.sum("count")).first()[0] == 30
    assert sorted(r.id for r in log.read("accepted", C.ACCEPTED_SCHEMA).collect()) == sorted(r[0] for b in batches for r in b)
    assert not log.write(1, {"deltas": None, "accepted": None})  # delivered again after its commit


def test_await_first_raises_the_error_of_a_failed_query(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.range(3).write.parquet(str(tmp_path / "in" / "x"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in" / "x"))

    def fail(batch, batch_id):
        raise ValueError("broken sink")

    writers = [stream.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "c"))]
    with pytest.raises(Exception, match="broken sink"):
        C.await_first(C.start_all(writers))


def test_files_of_a_stream_grow_in_number_and_not_in_size(spark, tmp_path, monkeypatch):
    from weftline.plans import catalog

    docs = spark.createDataFrame([(str(i), "x" * 100) for i in range(200)] + [("0", None)], "id string, text string")
    assert catalog.written_in_files(docs, f"{tmp_path}/one", 2, "id") == 1
    monkeypatch.setattr(catalog, "FILE_BYTES", 2000)
    assert catalog.written_in_files(docs, f"{tmp_path}/many", 2, "id") == 5
    for folder, files in (("one", 2), ("many", 10)):
        assert len(list((tmp_path / folder).glob("part-*"))) == files
        assert spark.read.parquet(f"{tmp_path}/{folder}").count() == 201
