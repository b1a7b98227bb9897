import math
import random
import re
from collections import Counter

import pytest

from weftline.operators import search
from weftline.session import drop_stored

DOCS = [
    ("1", "vampire war vampire"), ("2", "war comedy"), ("3", "common comedy drama"), ("4", ""), ("5", "war"),
    ("6", "romantic comedy drama"), ("6", "drama"),
]


def brute_force(docs, queries, k):
    """{query: [(doc, score)]} straight from the definitions."""
    tf = Counter((doc, term) for doc, text in docs for term in text.split())
    df = Counter(term for _, term in tf)
    idf = {term: math.log(len(docs) / n) for term, n in df.items()}
    vectors = {}
    for (doc, term), n in tf.items():
        vectors.setdefault(doc, {})[term] = n * idf[term]
    found = {}
    for query, text in queries:
        terms = text.split()
        if len(terms) == 1:
            scores = {doc: v[terms[0]] for doc, v in vectors.items() if terms[0] in v}
        else:
            weights = {t: n * idf[t] for t, n in Counter(terms).items() if t in idf}
            length = math.sqrt(sum(w * w for w in weights.values()))
            scores = {}
            for doc, v in vectors.items():
                norm = math.sqrt(sum(w * w for w in v.values()))
                dot = sum(w * v.get(t, 0.0) for t, w in weights.items())
                if dot > 0 and length > 0 and norm > 0:
                    scores[doc] = dot / length / norm
        best = sorted(scores.items(), key=lambda item: (-round(item[1], 9), item[0]))[:k]
        if best:
            found[query] = best
    return found


def run(spark, docs, queries, k=10, **options):
    index = search.build_index(
        spark.createDataFrame(docs, "doc_id string, text string"), stop_words=(), **options
    )
    asked = spark.createDataFrame(queries, "query_id string, text string")
    found = {}
    for row in search.search(asked, index, k, stop_words=()).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.doc_id, row.score))
    return found


def same(got, want):
    assert {q: [doc for doc, _ in rows] for q, rows in got.items()} == {
        q: [doc for doc, _ in rows] for q, rows in want.items()
    }
    for q, rows in want.items():
        assert [score for _, score in got[q]] == pytest.approx([score for _, score in rows])


QUERIES = [
    ("one", "vampire"), ("two", "comedy drama"), ("unknown", "nothing"), ("some", "war nothing"), ("none", ""),
    ("twice", "war war comedy"), ("all", "nothing here"),
]


@pytest.mark.parametrize("options", [{}, {"min_hot_rows": 1}])
def test_search_against_brute_force(spark, options):
    same(run(spark, DOCS, QUERIES, **options), brute_force(DOCS, QUERIES, 10))


def test_random_corpora(spark):
    rng = random.Random(7)
    words = ["w" + chr(97 + i) for i in range(12)]
    docs = [(f"{i:03}", " ".join(rng.choices(words, range(12, 0, -1), k=rng.randint(0, 15)))) for i in range(60)]
    queries = [(f"q{i}", " ".join(rng.choices(words, k=rng.randint(1, 4)))) for i in range(25)]
    same(run(spark, docs, queries, k=4, min_hot_rows=3), brute_force(docs, queries, 4))


def test_term_of_every_document_scores_zero_but_is_listed(spark):
    docs = [("1", "all x"), ("2", "all y")]
    assert run(spark, docs, [("q", "all"), ("p", "all all")]) == {"q": [("1", 0.0), ("2", 0.0)]}


def test_stop_words_decide_which_search_is_used(spark):
    index = search.build_index(spark.createDataFrame(DOCS, "doc_id string, text string"))
    asked = spark.createDataFrame([("q", "the war"), ("s", "the of")], "query_id string, text string")
    rows = search.search(asked, index).collect()
    assert {row.query_id for row in rows} == {"q"}
    assert max(row.score for row in rows) == pytest.approx(math.log(7 / 3))


def test_titles(spark):
    results = spark.createDataFrame([("q", "1", 1.0, 1), ("q", "2", 0.5, 2)], "query_id string, doc_id string, score double, rank int")
    titles = spark.createDataFrame([("1", "One"), ("1", "One"), ("9", "Nine")], "doc_id string, title string")
    rows = search.with_titles(results, titles).orderBy("rank").collect()
    assert [(row.doc_id, row.title) for row in rows] == [("1", "One"), ("2", "Unknown")]


def test_saved_index_gives_the_same_results(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string")
    asked = spark.createDataFrame(QUERIES, "query_id string, text string")
    index = search.build_index(docs)
    index.save(str(tmp_path))
    loaded = search.SearchIndex.load(spark, str(tmp_path))
    assert sorted(search.search(asked, loaded).collect()) == sorted(search.search(asked, index).collect())


def test_doc_vectors(spark):
    postings = search.build_index(spark.createDataFrame(DOCS, "doc_id string, text string")).postings
    vectors = {row.doc_id: row.vector for row in search.doc_vectors(postings).collect()}
    assert set(vectors) == {"1", "2", "3", "5", "6"}
    assert vectors["6"] == pytest.approx({"romantic": math.log(7), "comedy": math.log(7 / 3), "drama": 2 * math.log(7 / 2)})



def test_equal_looking_cosines_are_ranked_by_the_cosine(spark):
    """Frequent terms have a tiny idf; the ranking must not round before the query's norm is divided out."""
    docs = [("1", "alpha " * 1001 + "beta " * 1000), ("2", "alpha beta")]
    docs += [(str(i), f"alpha beta gamma gamma") for i in range(3, 2000)] + [("2000", "none")]
    index = search.build_index(spark.createDataFrame(docs, "doc_id string, text string"), stop_words=())
    asked = spark.createDataFrame([("q", "alpha beta")], "query_id string, text string")
    rows = search.search_cosine(asked, index, 2, stop_words=()).orderBy("rank").collect()
    assert [row.doc_id for row in rows] == ["2", "1"]
    assert rows[0].score == pytest.approx(1.0, abs=1e-12) and 0.9999998 < rows[1].score < 0.9999999


@pytest.mark.parametrize("buckets", [None, 1, 64, 256])
def test_a_saved_index_knows_its_buckets(spark, tmp_path, buckets):
    index = search.build_index(spark.createDataFrame(DOCS, "doc_id string, text string"))
    index.save(str(tmp_path), buckets=buckets)
    loaded = search.SearchIndex.load(spark, str(tmp_path))
    assert loaded.buckets == (buckets or 1)
    asked = spark.createDataFrame([("q", "war comedy"), ("p", "romantic vampire war"), ("s", "war")], "query_id string, text string")
    assert sorted(search.search(asked, loaded).collect()) == sorted(search.search(asked, index).collect())


def scanned(df, metric):
    """A metric of the first scan of a query that has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return next(
        leaves.apply(i).metrics().apply(metric).value() for i in range(leaves.size()) if "bucket" in leaves.apply(i).toString()
    )


def test_a_search_reads_the_files_of_its_terms(spark, tmp_path):
    docs = [(str(i), " ".join(f"w{chr(97 + (i * j) % 26)}{chr(97 + j)}" for j in range(26))) for i in range(60)]
    index = search.build_index(spark.createDataFrame(docs, "doc_id string, text string"), stop_words=())
    index.save(str(tmp_path), buckets=32)
    loaded = search.SearchIndex.load(spark, str(tmp_path))
    of = lambda *terms: loaded.of_terms(spark.createDataFrame([(t,) for t in terms], "term string"))
    one, many = of("wab"), of(*[f"w{chr(97 + i)}b" for i in range(26)])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "EqualTo(term,wab)" in plan[plan.index("PushedFilters: ["):]
    assert scanned(one, "numFiles") == 1 < 5 < scanned(many, "numFiles")
    assert one.count() > 0


def test_buckets_follow_the_size():
    assert [search.buckets_for(n) for n in (0, 1, 1_000_000, 1_000_001, 5_000_000, 10**13)] == [1, 1, 1, 2, 8, 4096]


def test_the_last_title_of_an_id_wins(spark):
    results = spark.createDataFrame([("q", "1", 1.0, 1)], "query_id string, doc_id string, score double, rank int")
    titles = spark.createDataFrame([("1", "Zebra", 1), ("1", "Ant", 2)], "doc_id string, title string, line int")
    assert search.with_titles(results, titles, line="line").first().title == "Ant"
    assert search.with_titles(results, titles).first().title == "Zebra"


def test_texts_are_split_once_for_an_index(spark, tmp_path):
    """The counts are stored: neither saving nor searching needs the texts again."""
    texts = str(tmp_path / "texts")
    spark.createDataFrame(DOCS, "doc_id string, text string").write.parquet(texts)
    index = search.build_index(spark.read.schema("doc_id string, text string").parquet(texts))
    drop_stored(spark, texts)
    index.save(str(tmp_path / "index"))
    asked = spark.createDataFrame(QUERIES, "query_id string, text string")
    same(found_by(search.search(asked, search.SearchIndex.load(spark, str(tmp_path / "index")))), brute_force(DOCS, QUERIES, 10))


def found_by(results):
    found = {}
    for row in results.orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.doc_id, row.score))
    return found


@pytest.mark.parametrize("small", [True, False])
def test_scores_are_summed_where_the_postings_are_dealt(spark, monkeypatch, small):
    """Few query terms: one shuffle of postings by document, none of scores by query and document."""
    monkeypatch.setattr(search, "fits_broadcast", lambda df: small)
    index = search.build_index(spark.createDataFrame(DOCS, "doc_id string, text string")).checkpointed()
    results = search.search_cosine(spark.createDataFrame(QUERIES, "query_id string, text string"), index)
    several = [q for q in QUERIES if len(q[1].split()) > 1]
    same(found_by(results), brute_force(DOCS, several, 10))
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert bool(re.search(r"hashpartitioning\(query_id#\d+, doc_id#", plan)) != small
