"""Tokenisers. Every one is a Column expression, so a tokeniser is just ``Column -> Column``."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Byte whitespace, ASCII punctuation.
WHITESPACE = " \t\n\r\f\x0b"
PUNCTUATION = string.punctuation

# A run of letters and digits, or one other visible character.
WORD_PATTERN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def no_tokens() -> Column:
    return F.array().cast("array<string>")


def trim_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def trim_punct(text: Column) -> Column:
    """Strip punctuation, but not blanks, from both ends."""
    return F.btrim(text, F.lit(PUNCTUATION))


def ws_tokens(text: Column) -> Column:
    """Split on runs of byte whitespace; blank text gives no tokens."""
    clean = trim_ws(text)
    return F.when(clean == "", no_tokens()).otherwise(F.split(clean, r"\s+"))


def unicode_tokens(text: Column) -> Column:
    """Split on runs of Unicode whitespace; blank text gives no tokens."""
    clean = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.when(clean == "", no_tokens()).otherwise(F.split(clean, r"(?U)\s+"))


def word_tokens(text: Column) -> Column:
    """Linguistic tokens: words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def chars(text: Column) -> Column:
    """One element per character."""
    return F.when(text == "", no_tokens()).otherwise(F.split(text, ""))


def strip_punct(tokens: Column) -> Column:
    """Strip punctuation from both ends of each token; tokens left empty are kept."""
    return F.transform(tokens, lambda t: trim_punct(t))
