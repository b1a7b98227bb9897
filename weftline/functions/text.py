"""Tokenizers and cleaning steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.wordlists import NEWS_STOP_WORDS, SEARCH_STOP_WORDS

# White space as Unicode has it, and the four separators U+001C to U+001F.  ``(?U)`` makes ``\s`` Unicode;
# it also tests faster than a class that lists the ranges.
UNICODE = "(?U)"
WHITE = r"\s\x{1c}-\x{1f}"
WHITE_CHARS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NOT_WORD = r"[^\p{L}\p{N}_]+"
ASCII_WORD = r"^[a-z]+$"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters, digits and ``_``; a run at either end of the text may be empty."""
    return F.split(F.lower(as_column(text)), NOT_WORD)


def is_search_term(word: Column, stop_words: Sequence[str] = SEARCH_STOP_WORDS) -> Column:
    """Whole words of ASCII letters that are not stop words: ``abc1`` and ``café`` are no terms."""
    keep = word.rlike(ASCII_WORD)
    return keep & ~word.isin(list(stop_words)) if stop_words else keep


def search_tokens(text: Column | str, stop_words: Sequence[str] = SEARCH_STOP_WORDS) -> Column:
    """The search terms of a text, in order, as an array."""
    return F.filter(words(text), lambda word: is_search_term(word, stop_words))


def strip_message_header(text: Column | str) -> Column:
    """Text after the first blank line that is seventh or later; without one the text stays whole."""
    text = as_column(text)
    after_sixth = F.substring(text, F.length(F.substring_index(text, "\n", 6)) + 1, F.length(text))
    parts = F.split(after_sixth, rf"{UNICODE}\n[{WHITE}&&[^\n]]*+(?=\n|\z)", 2)
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(1))).otherwise(text)


def drop_mail_addresses(text: Column | str) -> Column:
    """Remove every run of non-blanks with an ``@`` inside.

    A run either has an ``@`` after its first and before its last character or it has none that counts,
    so looking for the first one is enough and the cost stays linear in the length of the run.
    """
    text = as_column(text)
    address = rf"{UNICODE}(?<![^{WHITE}])[^{WHITE}][^{WHITE}@]*+@[^{WHITE}]+"
    return F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, address, "")).otherwise(text)


def drop_urls(text: Column | str) -> Column:
    text = as_column(text)
    url = rf"{UNICODE}http[^{WHITE}]+|www\.[^{WHITE}]+"
    candidate = F.contains(text, F.lit("http")) | F.contains(text, F.lit("www."))
    return F.when(candidate, F.regexp_replace(text, url, "")).otherwise(text)


def letter_runs(text: Column | str, stop_words: Sequence[str] = NEWS_STOP_WORDS, min_length: int = 3) -> Column:
    """Lower-case runs of at least ``min_length`` letters ``a-z`` that are not stop words, in order.

    This equals replacing non-letters by blanks, splitting on blanks and dropping short tokens.
    """
    tokens = F.regexp_extract_all(F.lower(as_column(text)), F.lit(rf"[a-z]{{{min_length},}}"), F.lit(0))
    return F.filter(tokens, lambda token: ~token.isin(list(stop_words))) if stop_words else tokens


def trimmed(text: Column | str) -> Column:
    """Trim Unicode white space, tabs and line ends included, on both sides."""
    return F.btrim(as_column(text), F.lit(WHITE_CHARS))
