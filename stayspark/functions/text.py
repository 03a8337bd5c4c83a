"""Text analysis in native expressions.

Two analysers: English (lower-case words, stop words, a light plural stemmer) and one for scripts
written without spaces (character pairs inside each run of letters).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual English stop-word list.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they",
    "this", "to", "was", "will", "with",
)

SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits, in order."""
    pieces = F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(pieces, lambda w: w != "")


def is_stop_word(word: Column) -> Column:
    return word.isin(*STOP_WORDS)


def stem(word: Column) -> Column:
    """Harman's S-stemmer: -ies -> -y, -es -> -e, -s -> nothing, with its exceptions."""
    size = F.length(word)
    ies = word.endswith("ies") & ~word.endswith("eies") & ~word.endswith("aies")
    es = word.endswith("es") & ~(word.endswith("aes") | word.endswith("ees") | word.endswith("oes"))
    s = word.endswith("s") & ~(word.endswith("us") | word.endswith("ss"))
    return (
        F.when(ies, F.concat(F.left(word, size - 3), F.lit("y")))
        .when(es, F.left(word, size - 1))
        .when(s, F.left(word, size - 1))
        .otherwise(word)
    )


def stem_of(word: str) -> str:
    """``stem`` of one word inside a task."""
    if word.endswith("ies") and not word.endswith(("eies", "aies")):
        return word[:-3] + "y"
    if word.endswith("es") and not word.endswith(("aes", "ees", "oes")):
        return word[:-1]
    return word[:-1] if word.endswith("s") and not word.endswith(("us", "ss")) else word


def pairs_of(word: str) -> list[str]:
    """``pairs`` of one word inside a task."""
    return [word[i : i + 2] for i in range(len(word) - 1)] or [word]


def pairs(word: Column) -> Column:
    """Overlapping character pairs of one word; a one-letter word stands for itself."""
    size = F.length(word)
    slices = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.substring(word, i, F.lit(2)))
    return F.when(size > 1, slices).otherwise(F.array(word))


def shingles(tokens: Column, n: int) -> Column:
    """n adjacent words joined by a blank; empty when there are fewer than n."""
    if n == 1:
        return tokens
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    return F.when(F.size(tokens) >= n, joined).otherwise(F.array().cast("array<string>"))


def prefixes(term: Column) -> Column:
    """All non-empty prefixes of a term."""
    return F.transform(F.sequence(F.lit(1), F.length(term)), lambda i: F.substring(term, F.lit(1), i))
