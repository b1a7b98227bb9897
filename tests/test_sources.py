import pytest
from pyspark.sql import functions as F

from weftline.plans.catalog import QUERIES
from weftline.sources import lines as L
from weftline.sources import directories, sinks
from weftline.sources.directories import read_labelled_directory


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_id_text_splits_at_the_first_tab(lines):
    parsed = L.parse_id_text(lines("1\tone", "no tab", "2\ttwo\tparts", "3\t", "1\tagain"))
    assert rows(parsed) == [("1", "again"), ("1", "one"), ("2", "two\tparts"), ("3", "")]


def test_titles_drop_short_lines(lines):
    assert rows(L.parse_titles(lines("1\tx\tOne\tmore", "2\tx", "3\tx\t"))) == [("1", "One"), ("3", "")]


def test_adjacency(lines):
    parsed = L.parse_adjacency(lines("1\t2,3,", "2\t", " 3 \t 4 , ,5\t9", "4", "\t7", "5\t,", "6\t7,7", ""))
    assert rows(parsed) == [("1", ["2", "3"]), ("3", ["4", "5"]), ("6", ["7", "7"])]


def test_edges(lines):
    parsed = L.parse_edges(lines("# c", "", "1\t2", "1   2 9", "3", "  4 5", "6 6"))
    assert rows(parsed) == [("", "4"), ("1", "2"), ("1", "2"), ("6", "6")]


def test_queries_are_trimmed_and_not_blank(lines):
    asked = L.parse_queries(lines(" war ", "", "\t", "a b", "war"))
    assert [row.text for row in asked.orderBy("query_id").collect()] == ["war", "a b", "war"]


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2\n3 4\n")
    (tmp_path / "b.txt").write_text("5 6\n")
    both = [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]
    assert rows(L.parse_edges(L.read_lines(spark, both))) == [("1", "2"), ("3", "4"), ("5", "6")]


def test_labelled_directory(spark, tmp_path):
    train, test = tmp_path / "train", tmp_path / "test"
    for place in (train / "autos", train / "deep" / "space", test / "autos", train / "train"):
        place.mkdir(parents=True)
    (train / "autos" / "1").write_bytes(b"caf\xe9\r\nline\rend" + b"x" * 50)
    (train / "autos" / "2").write_bytes(b"y" * 50)
    (train / "deep" / "space" / "3").write_bytes(b"z" * 51)
    (train / "root.txt").write_bytes(b"r" * 99)
    (train / "train" / "4").write_bytes(b"t" * 60)
    (test / "autos" / "5").write_bytes(b"u" * 70)
    got = read_labelled_directory(spark, [str(train), f"file://{test}"]).select("label", "text")
    assert rows(got) == [
        ("autos", "café\nline\nend" + "x" * 50), ("autos", "u" * 70), ("space", "z" * 51), ("train", "t" * 60)
    ]


def test_csv_replaces_and_has_no_header(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (3, 2):
        sinks.write_csv(spark.range(n).select("id", (F.col("id") * 2).alias("twice")), path)
    assert rows(spark.read.csv(path)) == [("0", "0"), ("1", "2")]


def test_recommendation_lines(spark, tmp_path):
    lists = spark.createDataFrame([("7", ["1", "2"]), ("8", ["9"])], "user string, candidates array<string>")
    path = str(tmp_path / "lines")
    sinks.write_lines(sinks.recommendation_lines(lists), path)
    assert rows(L.read_lines(spark, path)) == [("7\t1,2",), ("8\t9",)]


def test_kafka_needs_the_connector(spark):
    from pyspark.errors import AnalysisException

    from weftline.streaming.kafka import read_topic

    with pytest.raises(AnalysisException, match="kafka"):
        read_topic(spark, "localhost:9092", "topic")


def test_a_file_for_each_row_is_written_by_all_cores_and_read_in_few_tasks(spark, tmp_path, monkeypatch):
    rows = [("en" if i % 3 else None, f"text number {i} " + "x" * 60) for i in range(300)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    sinks.write_file_each(docs, f"{tmp_path}/each", "lang")
    files = [path.name for path in (tmp_path / "each").rglob("*") if path.is_file() and path.name != "_SUCCESS"]
    assert len(files) == 300 and not [name for name in files if name.endswith(".crc")]
    assert len({name.split("-")[1] for name in files}) > 1
    found = directories.read_labelled_directory(spark, f"{tmp_path}/each", charset="UTF-8")
    assert sorted(row.text.rstrip("\f") for row in found.collect()) == sorted(text for _, text in rows)
    monkeypatch.setattr(directories, "PARTS_PER_TASK", 10_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4100000")  # one file a part
    try:
        found = directories.read_labelled_directory(spark, f"{tmp_path}/each", charset="UTF-8")
        assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def files_below(root):
    return sorted((path.parent.name, path.read_bytes()) for path in root.rglob("*") if path.is_file() and path.name != "_SUCCESS")


def test_local_files_are_written_by_the_tasks_as_spark_writes_them(spark, tmp_path, monkeypatch):
    rows = [("en", "one"), (None, "two"), ("", "three"), ("a/b=c %'{^", "four"), ("ü ", "fünf\n"), ("en", None), ("en", ""), ("en", "one")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    each = docs.write.options(**sinks.SMALL_FILES).option("maxRecordsPerFile", 1).option("lineSep", "\f")
    each.partitionBy("lang").text(f"{tmp_path}/spark")
    monkeypatch.setattr(sinks, "SMALL_FILES", {"fs.file.impl": "no.such.FileSystem"})
    sinks.write_file_each(docs, f"{tmp_path}/tasks", "lang")
    assert files_below(tmp_path / "tasks") == files_below(tmp_path / "spark") and len(files_below(tmp_path / "tasks")) == 8
    with pytest.raises(Exception):
        sinks.write_file_each(docs, f"{tmp_path}/tasks", "lang")


def test_local_folders_are_listed_by_the_tasks_as_spark_lists_them(spark, tmp_path, monkeypatch):
    root = tmp_path / "root"
    for place in ("en", "_a=1", "deep/space", ".hidden", "_hidden"):
        (root / place).mkdir(parents=True)
        for name in ("1", ".2", "_3", "_4=4", "5._COPYING_"):
            (root / place / name).write_bytes(f"{place} {name} caf\xe9\r\n".encode("latin-1"))
        (root / place / "empty").touch()
    (root / "en" / "nowhere").symlink_to(root / "missing")
    (root / "en" / "link").symlink_to(root / "en" / "1")
    found = read_labelled_directory(spark, [str(root), f"file://{root}/en", str(root)], 0)
    assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()
    got = rows(found)
    monkeypatch.setattr(directories, "local_folder", lambda spark, path: None)
    assert got == rows(read_labelled_directory(spark, [str(root), f"file://{root}/en", str(root)], 0)) and len(got) == 4


def test_a_local_file_that_cannot_be_read_is_an_error_or_skipped(spark, tmp_path):
    for name in ("1", "2"):
        (tmp_path / "en").mkdir(exist_ok=True)
        (tmp_path / "en" / name).write_text(name * 60)
    found = [read_labelled_directory(spark, str(tmp_path), skip_unreadable=skip) for skip in (False, True)]
    (tmp_path / "en" / "1").unlink()
    with pytest.raises(Exception, match="No such file"):
        found[0].collect()
    assert [row.text for row in found[1].collect()] == ["2" * 60]


def test_two_roots_of_local_files_need_no_file_of_sparks_writer(spark, tmp_path, monkeypatch):
    texts = [(i, "en" if i % 3 else None, f"text number {i} " + "x" * 60) for i in range(20)]
    spark.createDataFrame(texts, "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(sinks, "SMALL_FILES", {"fs.file.impl": "no.such.FileSystem"})
    found = QUERIES["labelled_two_folders"](spark, str(tmp_path))
    assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()
    folders = {(i % 2, lang): 0 for i, lang, _ in texts}
    for row in found.collect():
        folders[int(row.root == "train"), None if "DEFAULT" in row.label else row.label.removeprefix("lang=")] += 1
    assert folders == {key: sum((i % 2, lang) == key for i, lang, _ in texts) for key in folders}
