"""Column functions over text. All are built-in expressions, no Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes both engines read the same way.
TOKEN_PATTERN = r"[\p{L}0-9]+"
PLAIN_TOKEN_PATTERN = r"[a-z0-9#]+"
NUMBER_PATTERN = r"[0-9]+(?:\.[0-9]+)?"
SENTENCE_END = r"([.!?])\s+"
SENTENCE_MARK = "\u0001"

# Words that carry no topic, and the suffixes of the light stemmer.
STOPWORDS = [
    "why", "was", "the", "by", "in", "of", "a", "on", "for", "at", "to", "and", "what", "were", "is",
]
STEM_SUFFIXES = ["ing", "ed", "es", "s"]


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and hand it to `body`, which may use it
    inside lambdas; a plain expression there would be evaluated per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def distinct_tokens(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def numbers(text: Column) -> Column:
    """Distinct numbers of a text, thousands separators removed."""
    return F.array_distinct(F.regexp_extract_all(F.replace(text, F.lit(","), F.lit("")), F.lit(NUMBER_PATTERN), F.lit(0)))


def sentences(text: Column) -> Column:
    marked = F.regexp_replace(F.trim(text), SENTENCE_END, "$1" + SENTENCE_MARK)
    return F.split(marked, SENTENCE_MARK)


def stem(word: Column) -> Column:
    """Drop the first matching suffix if more than two letters stay."""
    out = word
    for suffix in reversed(STEM_SUFFIXES):
        fits = word.endswith(suffix) & (F.length(word) > len(suffix) + 2)
        out = F.when(fits, F.substring(word, F.lit(1), F.length(word) - len(suffix))).otherwise(out)
    return out


def terms(text: Column) -> Column:
    """Distinct stemmed content words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(PLAIN_TOKEN_PATTERN), F.lit(0))
    return F.array_distinct(F.transform(F.filter(words, lambda w: ~w.isin(*STOPWORDS)), stem))


def count_in(words: Column, vocabulary: list[str]) -> Column:
    """How many words (with repeats) belong to a small fixed vocabulary."""
    return F.size(F.filter(words, lambda w: w.isin(*vocabulary)))


def weighted_sum(words: Column, weights: dict[str, float]) -> Column:
    """Sum of the weights of the words, as one term per distinct weight."""
    by_weight: dict[float, list[str]] = {}
    for word, weight in weights.items():
        by_weight.setdefault(weight, []).append(word)
    total = F.lit(0.0)
    for weight, vocabulary in sorted(by_weight.items()):
        total = total + F.lit(weight) * count_in(words, vocabulary)
    return total


def snippet(text: Column, n: int) -> Column:
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"[^\s]+"), F.lit(0)))
