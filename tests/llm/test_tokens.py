"""Token counts and token files next to the tokenizers library, and an exact round trip of the codes."""

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weftline.llm import token_files
from weftline.llm.pretokens import encode_keys, keys_of, special_strings
from weftline.llm.token_counts import count_tokens
from weftline.llm.token_files import Encoder, decode_levels, encode_levels, ids_at, read_digests, read_tokens, write_token_files
from weftline.session import scratch_path

FILE = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = special_strings(FILE)
LIBRARY = Tokenizer.from_file(FILE)
PIECES = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x00", " ", " ", "　", "᠎", "a", "The", "the",
    "cat's", "we'll", "12", "ü", "ß", "日本", "!?", "...", "<|endoftext|>", "\U0001f600", "é", "-", "x1", "\x85",
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_pre_tokens_add_up(text):
    assert sum(encode_keys(FILE, keys_of(text, SPECIAL)), []) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_pre_tokens_of_any_text_add_up(text):
    assert sum(encode_keys(FILE, keys_of(text, SPECIAL)), []) == ids_of(text)


ENCODER = Encoder(FILE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), st.text(max_size=20)), max_size=5))
def test_encoder_equals_the_library(texts):
    found = ENCODER([text.encode() for text in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(text) for text in texts]


def test_encoder_forgets_and_stands_broken_bytes(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_KEYS", 3)
    encoder = Encoder(FILE)
    texts = ["one two three", "two four", "one two", "five  six", "", "one"] * 3
    for group in (texts[:2], texts[2:5], texts, texts):
        found = encoder([text.encode() for text in group])
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(text) for text in group]
    assert encoder([b"a \xff b"]) == [np.array(ids_of("a \ufffd b"), "<u4").tobytes()]


def test_a_word_is_encoded_once_whatever_signs_follow_it(monkeypatch):
    asked, encode = [], token_files.encode_pieces

    def encode_pieces(path, pieces):
        asked.extend(pieces.to_pylist())
        return encode(path, pieces)

    monkeypatch.setattr(token_files, "encode_pieces", encode_pieces)
    encoder = Encoder(FILE)
    groups = [["a word, a word. a word", "a word\nword... Größe, word!?"], ["a word; Größe\nword,\nGröße word"]]
    for texts in groups:
        found = encoder([text.encode() for text in texts])
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(text) for text in texts]
    assert len(asked) == len(set(asked))
    assert [piece for piece in asked if "word" in piece] == ["word", "\x00word"]
    assert sorted(piece for piece in asked if "Größe" in piece) == ["\x00Größe", "Größe"]


WORDS = ["the", "Über", "naïve", "x1", "can't", "dogs'", "e\u0301", "×", "_a", "(b", "日本", "²", "42", "don't"]

GAPS = st.sampled_from([" ", "\n", "\n\n", " ", "\n", "\n\n", "\n\n\n", "  ", "\t", "\n "])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(WORDS), st.text("'.,!_$%<|>²é", max_size=3), GAPS), max_size=12))
def test_words_with_signs_equal_the_library(words):
    text = "".join(word + signs + gap for word, signs, gap in words)[:-1]
    assert np.frombuffer(ENCODER([text.encode()])[0], "<u4").tolist() == ids_of(text)


def test_texts_with_empty_lines_are_cut_by_arrow(monkeypatch):
    texts = ["A title\n\nfirst words.\n\nlast, 12\n\n(words)\nend", "a\n\nb", "a\n\n\nb", "a \n\nb", "a\n\n b"]
    slow, keys = [], token_files.keys_of
    monkeypatch.setattr(token_files, "keys_of", lambda text, special: slow.append(text) or keys(text, special))
    found = Encoder(FILE)([text.encode() for text in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(text) for text in texts]
    assert slow == texts[2:]


def test_special_strings_of_letters_and_signs_are_not_cut(tmp_path):
    own = Tokenizer.from_file(FILE)
    own.add_special_tokens(["word!", "b."])
    own.save(path := str(tmp_path / "own.json"))
    texts = ["aword!", "a word!", "ab... b", " ab.?", "a b", "word!?\nb.."]
    found = Encoder(path)([text.encode() for text in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_remembers_no_more_than_its_limits(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_KEYS", 50)
    monkeypatch.setattr(token_files, "MEMO_BYTES", 5_000)
    encoder = Encoder(FILE)
    for i in range(30):
        texts = [f"the long{'x' * 3_000}{i} and", *(f"the {chr(97 + i % 26) * k} word" for k in range(1, 30)), "\x1c" * 200 + str(i)]
        found = encoder([text.encode() for text in texts])
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [ids_of(text) for text in texts]
        assert len(encoder.pieces) <= 2 * 50 + 40
        assert encoder.pieces.nbytes <= 5_000 + 10_000
        assert len(encoder.sizes) == len(encoder.starts) == len(encoder.used) == len(encoder.pieces)
        assert encoder.sizes.sum() == len(encoder.ids)
    assert "the" in encoder.pieces.to_pylist()


def test_runs_take_little_more_room_than_they_give():
    rng = np.random.default_rng(1)
    pool, starts, sizes = np.arange(1_000, dtype=np.uint32), rng.integers(0, 900, 400_000), rng.integers(0, 9, 400_000)
    tracemalloc.start()
    found = token_files._runs(pool, starts, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == [i for a, n in zip(starts.tolist(), sizes.tolist(), strict=True) for i in range(a, a + n)]
    assert peak < 2 * found.nbytes
    assert not len(token_files._runs(pool, starts[:0], sizes[:0]))


def test_lookup_finds_pieces_that_come_twice_or_are_new():
    encoder = Encoder(FILE)
    encoder([b"one two three two"])
    pieces = ["two", "new", "two", "\x00one", "newer"]
    for _ in range(2):
        at = encoder.lookup(token_files.pa.array(pieces))
        assert encoder.pieces.take(token_files.pa.array(at)).to_pylist() == pieces
        assert len(set(encoder.pieces.to_pylist())) == len(encoder.pieces)


def test_documents_reach_python_in_small_batches(spark, documents, monkeypatch):
    key, segments = "spark.sql.execution.arrow.maxBytesPerBatch", token_files._segments
    before, most = spark.conf.get(key), 2 * token_files.BATCH_BYTES

    def spied(*settings):
        write = segments(*settings)

        def small(batches):
            for batch in batches:
                if batch.nbytes > most:
                    raise ValueError(f"{batch.nbytes} bytes at once")
                yield batch

        return lambda batches: write(small(batches))

    monkeypatch.setattr(token_files, "_segments", spied)
    rows = [(i, f"document {i} " + "word " * 4_000) for i in range(900)]
    path = scratch_path(spark, "test-files")
    write_token_files(documents(rows).coalesce(1), path, FILE, 2)
    assert spark.conf.get(key) == before
    assert read_digests(spark, path).count() == 900


def random_rows(n):
    rng = random.Random(3)
    return [(i * 7 % n, "".join(rng.choices(PIECES, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize(("block_bytes", "one_in"), [(200, 1), (200, 40), (10_000_000, 30), (10_000_000, 1_000_000)])
def test_counts_equal_the_library(documents, block_bytes, one_in):
    rows = random_rows(150)
    found = count_tokens(documents(rows), FILE, block_bytes, one_in).collect()
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in found}
    assert found == {i: (len(t.encode()), len(ids_of(t))) for i, t in rows}


def test_counts_of_awkward_rows(awkward, no_documents):
    found = sorted((tuple(r) for r in count_tokens(awkward, FILE).collect()), key=repr)
    rows = [(r.doc_id, r.text or "") for r in awkward.collect()]
    assert found == sorted(((i, len(t.encode()), len(ids_of(t))) for i, t in rows), key=repr)
    assert count_tokens(no_documents, FILE).count() == 0


def digests(rows, end_id=2):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*ids_of(text), end_id]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_ids", [64, 1 << 18])
def test_files_come_back(spark, documents, segment_ids):
    rows = random_rows(150)
    path = scratch_path(spark, "test-files")
    write_token_files(documents(rows).repartition(5), path, FILE, 2, segment_ids)
    found = sorted(tuple(r) for r in read_digests(spark, path).collect())
    assert found == digests(sorted(rows))
    wanted = [(i, k) for i, _ in rows for k in (0, 3, 40, -1)]
    got = read_tokens(spark, path, spark.createDataFrame(wanted, "doc_id bigint, k int")).collect()
    ids = {i: [*ids_of(t), 2] for i, t in rows}
    assert {(r.doc_id, r.k): r.id for r in got} == {(i, k): ids[i][k] for i, k in wanted if 0 <= k < len(ids[i])}


def test_files_of_awkward_rows(spark, awkward, no_documents):
    path = scratch_path(spark, "test-files")
    write_token_files(awkward, path, FILE, 2)
    found = sorted((tuple(r) for r in read_digests(spark, path).collect()), key=lambda r: r[1])
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert [r[0] for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    assert [r[1] for r in found] == np.cumsum([0, *(r[2] for r in found[:-1])]).tolist()
    assert sorted((r[0], r[2], r[3]) for r in found if r[0]) == sorted((d[0], d[2], d[3]) for d in digests(rows) if d[0])
    write_token_files(no_documents, path := scratch_path(spark, "test-files"), FILE, 2)
    assert read_digests(spark, path).count() == 0


@pytest.mark.parametrize("top", [1, 256, 50_257, 1 << 20, 1 << 32])
def test_codes_are_directly_addressable(top):
    ids = np.random.default_rng(top).integers(0, top, 5_000).astype(np.uint32)
    ids[::7] //= 300
    levels = encode_levels(ids)
    assert (decode_levels(levels) == ids).all()
    places = np.random.default_rng(0).integers(0, len(ids), 700)
    assert (ids_at(levels, places) == ids[places]).all()
