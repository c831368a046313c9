"""Text expressions: cleaning, tokens, keyword tests."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning strips, what parts tokens, and the least length of a token.
NOT_LETTERS = r"[^\p{Alpha}\s]+"
BETWEEN_TOKENS = r"[^\p{L}\p{N}_]+"
MIN_TOKEN = 2


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Letters and white space only, lower case; null when no letter is left."""
    c = _column(c)
    return F.when(has_letter(c), F.lower(F.regexp_replace(c, NOT_LETTERS, "")))


def has_letter(c: Column | str) -> Column:
    """The text is not blank after cleaning; stops at the first letter."""
    return _column(c).rlike("[A-Za-z]")


def words(c: Column | str) -> Column:
    """Lower-case word parts of a text, single characters and empty edges included.

    Splitting is linear in the text; extracting all matches copies the text once per match.
    """
    return F.split(F.lower(_column(c)), BETWEEN_TOKENS)


def token_array(c: Column | str) -> Column:
    """Lower-case tokens of a text, in order."""
    return F.filter(words(c), lambda word: F.length(word) >= MIN_TOKEN)


def text_id(c: Column | str) -> Column:
    """Narrow key of a text, so that long texts need not travel as join or group keys."""
    return F.sha2(_column(c), 256)


def contains_all(c: Column | str, words: Iterable[str]) -> Column:
    """Every word occurs as a substring."""
    c = _column(c)
    return reduce(lambda a, b: a & b, [c.contains(w) for w in words], F.lit(True))


def contains_none(c: Column | str, words: Iterable[str]) -> Column:
    """No word occurs as a substring."""
    c = _column(c)
    return reduce(lambda a, b: a & b, [~c.contains(w) for w in words], F.lit(True))
