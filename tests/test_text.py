import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.functions.scalars import id_order, numeric_id
from weftline.functions.wordlists import NEWS_STOP_WORDS, SEARCH_STOP_WORDS
from weftline.operators.classify import clean_news_text

ALPHABET = "ab @\n\t.zéß0_Aw:/htp  \x1c-"


def apply(spark, column, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", column.alias("out"))
    return [row.out for row in sorted(rows.collect())]


def plain_news_tokens(text):
    """The cleaning steps one by one, in Python's own regular expressions."""
    rows = text.split("\n")
    blank = [i for i, row in enumerate(rows) if i > 5 and not row.strip()]
    body = "\n".join(rows[blank[0]:]) if blank else text
    for pattern in (r"\S+@\S+", r"http\S+|www\.\S+"):
        body = re.sub(pattern, "", body)
    letters = re.sub(r"[^a-z\s]", " ", body.lower())
    return [word for word in letters.split() if len(word) >= 3 and word not in NEWS_STOP_WORDS]


def news_tokens(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = clean_news_text(docs, min_tokens=0).collect()
    return [row.tokens for row in sorted(rows, key=lambda row: row.doc_id)]


def test_search_tokens(spark):
    texts = ["café don't abc1 foo_bar naïve ok", "The Vampire, the VAMPIRE!", "", "x"]
    assert apply(spark, T.search_tokens("text", ()), texts) == [
        ["don", "t", "ok"], ["the", "vampire", "the", "vampire"], [], ["x"]
    ]
    assert apply(spark, T.search_tokens("text"), texts) == [["ok"], ["vampire", "vampire"], [], ["x"]]


def test_search_tokens_of_null(spark):
    assert apply(spark, T.search_tokens("text"), [None]) == [None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=20))
def test_search_tokens_like_word_boundaries(spark, texts):
    plain = [re.findall(r"\b[a-zA-Z]+\b", text.lower()) for text in texts]
    assert apply(spark, T.search_tokens("text", ()), texts) == plain


def test_stop_word_lists():
    assert len(SEARCH_STOP_WORDS) == len(set(SEARCH_STOP_WORDS)) and "the" in SEARCH_STOP_WORDS
    assert len(NEWS_STOP_WORDS) == len(set(NEWS_STOP_WORDS))


def test_header_needs_a_blank_line_after_the_sixth(spark):
    head = [f"h{i}" for i in range(5)]
    fifth = "\n".join([*head, "", "body", "more"])
    sixth = "\n".join([*head, "h5", " \t", "body", "", "more"])
    none = "\n".join([*head, "h5", "h6"])
    assert apply(spark, T.strip_message_header("text"), [fifth, sixth, none, "a", ""]) == [
        fifth, "\nbody\n\nmore", none, "a", ""
    ]
    assert apply(spark, T.strip_message_header("text"), ["\n" * 6 + "x", "\n" * 6, "\n" * 5]) == [
        "\n" * 6 + "x", "", "\n" * 5
    ]


def test_mail_addresses_and_urls(spark):
    texts = ["to a@b.c now", "@start x@ @@b a@@ @a@b", "see http://x.y/z, www.q or xhttps://w"]
    assert apply(spark, T.drop_mail_addresses("text"), texts[:2]) == ["to  now", "@start x@   "]
    assert apply(spark, T.drop_urls("text"), texts[2:]) == ["see   or x"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=80), min_size=1, max_size=20))
def test_cleaning_like_the_steps_in_plain_python(spark, texts):
    assert news_tokens(spark, texts) == [plain_news_tokens(text) for text in texts]


def test_cleaning_a_long_text(spark):
    text = "\n".join(f"line{i} word someone@example.org http://x" for i in range(30000)) + " " + "y" * 200000
    assert news_tokens(spark, [text]) == [plain_news_tokens(text)]


def test_five_tokens_are_too_few(spark):
    docs = spark.createDataFrame([(5, "aaa bbb ccc ddd eee the"), (6, "aaa bbb ccc ddd eee fff"), (0, None)], "doc_id int, text string")
    assert [row.doc_id for row in clean_news_text(docs).collect()] == [6]


def test_trimmed(spark):
    assert apply(spark, T.trimmed("text"), [" \t a b \n", " ", "x"]) == ["a b", "", "x"]


def test_id_order_puts_numbers_first(spark):
    ids = ["10", "9", "x", "-5", "007", "12345678901234567890123"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert [row.id for row in df.orderBy(*id_order("id")).collect()] == [
        "007", "9", "10", "12345678901234567890123", "-5", "x"
    ]
    assert df.filter(numeric_id("id").isNull()).count() == 2


def test_cosine_of_a_zero_vector(spark):
    from weftline.functions.scalars import cosine

    df = spark.createDataFrame([(2.0, 2.0, 4.0), (0.0, 0.0, 4.0)], "dot double, a double, b double")
    assert [row[0] for row in df.select(cosine(F.col("dot"), F.col("a"), F.col("b"))).collect()] == [0.25, 0.0]
