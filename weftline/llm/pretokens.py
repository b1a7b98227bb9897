"""Pre-tokens: pieces of a text that a byte-level BPE tokenizer encodes one by one.

The tokenizer cuts a text into runs of letters, digits, signs or spaces and never joins two of them.  A
pre-token here is a run of characters without a space, with the single space in front of it, or a run of
spaces: the tokenizer cuts further inside, but at both ends it cuts as well, so that ids and counts of the
pre-tokens add up to those of the text.

A pre-token is written as a *key*: the run itself where one space or nothing but a line feed, which is kept,
comes before it; else NUL and the text as it is.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Sequence
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from weftline.llm.common import ASCII_PUNCTUATION

# Python counts these as spaces, the tokenizer does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")


def keys_of(text: str, special: Sequence[str] = ()) -> list[str]:
    """The pre-tokens of a text in order.  A text that holds a ``special`` string, which the tokenizer takes out
    before anything else, stays whole."""
    if any(string in text for string in special):
        return ["\x00" + text]
    words = text.split()
    if words and "\x00" not in text and " ".join(words) == text.replace("\n", " "):
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = "\x00" + keys[0]
        return keys
    if not text:
        return []
    if _SEPARATORS.search(text):
        return ["\x00" + text]
    return ["\x00" + run for run in _RUNS.findall(text)]


def written(key: str) -> str:
    """The text that a key stands for."""
    if key[0] == "\x00":
        return key[1:]
    return key if key[0] == "\n" else " " + key


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, loaded once per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def special_strings(path: str) -> tuple[str, ...]:
    """The strings of the added tokens of a tokenizer."""
    return tuple(token.content for token in tokenizer(path).get_added_tokens_decoder().values())


def _byte_letters() -> dict[int, str]:
    """Byte-level models write a byte as a visible character: itself where it is one, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(256 + i) for i, byte in enumerate(hidden)}


_LETTERS = _byte_letters()
_PLAIN = re.compile(r"([\x00\n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
_LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_WORD = rf"[\x00\n]?{_LATIN}"
# NUL and the space, which stand before and between words, stay as they are.
_LETTER_TABLE = "".join(chr(b) if b in (0, 32) else _LETTERS.get(b, chr(b)) for b in range(256))
_MODEL_WORDS = 10_000
_BYTE_LEVEL: dict[str, bool] = {}


def is_byte_level(path: str) -> bool:
    """Whether the tokenizer is nothing but a byte-level model behind the usual cut into words."""
    if path not in _BYTE_LEVEL:
        parts = json.loads(tokenizer(path).to_str())
        cut = parts["pre_tokenizer"] or {}
        _BYTE_LEVEL[path] = parts["normalizer"] is None and (
            cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")
        ) == ("ByteLevel", True, False)
    return _BYTE_LEVEL[path]


def encode_keys(path: str, keys: list[str]) -> list[list[int]]:
    """The ids of each key.

    A word of Latin letters, also with a line feed before or a full stop or comma after it, is cut by the
    byte-level rules into just these; it goes to the tokenizer's model directly, which takes half the time.
    """
    own = tokenizer(path)
    out: list[list[int]] = [[]] * len(keys)
    rest = []
    model = own.model if is_byte_level(path) else None
    signs = {s: [token.id for token in model.tokenize(s.translate(_LETTERS))] for s in ("\n", ".", ",")} if model else {}
    signs[""] = signs["\x00"] = []
    space = _LETTERS[32]
    for i, key in enumerate(keys):
        plain = _PLAIN.fullmatch(key) if model else None
        if plain is None:
            rest.append(i)
            continue
        before, word, after = plain.groups()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_LETTERS)
        ids = [token.id for token in model.tokenize(word if before else space + word)]
        out[i] = signs[before] + ids + signs[after] if before or after else ids
    if rest:
        texts = [written(keys[i]) for i in rest]
        for i, found in zip(rest, own.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[i] = found.ids
    return out


def cut_keys(path: str, keys: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces, places): the keys cut further, and for each key the places of its line feed, word and signs in ``pieces``.

    The byte-level rules cut a word of Latin letters from a line feed before it and from the ASCII signs that follow
    to the end of the key.  Pieces are keys again.  A place is -1 where there is no such piece; any other key, or
    one with a special string, is one piece.
    """
    places = np.full((len(keys), 3), -1, np.int64)
    places[:, 1] = np.arange(len(keys))
    if not is_byte_level(path):
        return keys, places
    bare = pc.ascii_rtrim(keys, ASCII_PUNCTUATION.decode())
    word = pc.match_substring_regex(bare, rf"\A{_WORD}\z")
    for string in special_strings(path):
        word = pc.and_not(word, pc.match_substring(keys, string))
    feed = pc.and_(word, pc.starts_with(bare, "\n"))
    signs = pc.and_(word, pc.less(pc.binary_length(bare), pc.binary_length(keys)))
    words = pc.if_else(word, bare, keys)
    words = pc.replace_with_mask(words, feed, pc.replace_substring(words.filter(feed), "\n", "\x00"))
    tails = pc.replace_substring_regex(keys.filter(signs), rf"\A{_WORD}", "\x00")
    places[signs.to_numpy(zero_copy_only=False), 2] = len(keys) + np.arange(len(tails))
    places[feed.to_numpy(zero_copy_only=False), 0] = len(keys) + len(tails)
    return pa.concat_arrays([words, tails, pa.array(["\x00\n"])]), places


def encode_pieces(path: str, pieces: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces, sizes, ids): the pieces in another order, how many ids each has, and the ids one piece after the other.

    Words of Latin letters go to the tokenizer's model directly, without an object in Python for each.
    """
    word = pc.match_substring_regex(pieces, rf"\A\x00?{_LATIN}\z")
    word = pc.and_(word, is_byte_level(path))
    words, rest = pieces.filter(word), pieces.filter(pc.invert(word))
    found = [np.array(ids, np.uint32) for ids in encode_keys(path, rest.to_pylist())]
    sizes, ids = _word_ids(path, words)
    sizes = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found))])
    return pa.concat_arrays([words, rest]), sizes, np.concatenate([ids, *found])


def _word_ids(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), " ")[0].as_py().encode()
    letters, space = codecs.charmap_decode(joined, "strict", _LETTER_TABLE)[0], _LETTERS[32]
    names = (space + letters.replace(" ", " " + space)).replace(space + "\x00", "").split(" ")
    model, sizes, ids = tokenizer(path).model, [], []
    for i in range(0, len(names), _MODEL_WORDS):
        found = list(map(model.tokenize, names[i : i + _MODEL_WORDS]))
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        ids.append(np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), np.uint32, sizes[-1].sum()))
    return np.concatenate(sizes), np.concatenate(ids)
