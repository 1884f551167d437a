"""Text helpers: failing-row messages, LIKE escaping and word trigrams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a failing row is printed: 'a = 1, b = null'.
KEY_VALUE_SEPARATOR = " = "
PAIR_SEPARATOR = ", "
NULL_TEXT = "null"
# Trigram padding of a word: two blanks before, one after.
WORD_PAD_BEFORE = "  "
WORD_PAD_AFTER = " "


def row_text(columns: list[str]) -> Column:
    """``k = v, k = v`` for one row; NULL values print as ``null``."""
    parts = [
        F.concat(F.lit(c + KEY_VALUE_SEPARATOR), F.coalesce(F.col("`" + c.replace("`", "``") + "`").cast("string"), F.lit(NULL_TEXT)))
        for c in columns
    ]
    return F.concat_ws(PAIR_SEPARATOR, *parts)


def like_escape(text: str) -> str:
    """Escape LIKE wildcards so ``text`` matches literally."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def trigrams(text: Column) -> Column:
    """Distinct word trigrams of a text, the way trigram similarity counts them.

    The text is lower-cased and cut into words at every run of characters that
    are not letters or digits. Each word is padded with two blanks in front and
    one behind, and every three-character window of the padded word is a
    trigram. Returns ``array<string>`` without duplicates.
    """
    words = F.filter(
        F.split(F.lower(text), r"[^\p{L}\p{N}]+"),
        lambda w: F.length(w) > 0,
    )
    grams = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.substring(F.concat(F.lit(WORD_PAD_BEFORE), w, F.lit(WORD_PAD_AFTER)), i, 3),
        ),
    )
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(grams_a: Column, grams_b: Column) -> Column:
    """Shared trigrams over the union of both sets (0 when both are empty)."""
    shared = F.size(F.array_intersect(grams_a, grams_b))
    union = F.size(grams_a) + F.size(grams_b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))
