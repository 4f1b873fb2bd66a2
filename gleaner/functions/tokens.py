"""Word and symbol tokens as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scripts written without spaces between words: each of their letters is a token.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
_UNSPACED = "".join(rf"\p{{Is{name}}}" for name in UNSPACED)
# Else a run of letters and digits, or one other visible character. Blank characters are spelled out
# because regex engines disagree on what \s covers. Naming the ASCII ranges first and never giving
# back part of a run only makes the search faster.
TOKEN_PATTERN = (
    rf"[a-zA-Z0-9[\p{{L}}\p{{N}}&&[^{_UNSPACED}]]]++|[{_UNSPACED}&&[\p{{L}}\p{{N}}]]|"
    r"[^\p{L}\p{N}\t\n\x0B\f\r ]"
)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0))


def count_tokens(text: Column) -> Column:
    return F.size(tokens(text))


def message_tokens(messages: Column) -> Column:
    """Token count of every message, in message order."""
    return F.transform(messages, lambda m: count_tokens(m["content"]))


def within_budget(token_array: Column, used: Column, budget: int) -> Column:
    """The tokens that still fit after ``used`` others; none when the budget is already spent."""
    return F.slice(token_array, 1, F.greatest(F.lit(budget) - used, F.lit(0)))
