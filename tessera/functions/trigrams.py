"""Trigram similarity of strings, by array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(value: Column) -> Column:
    """Distinct trigrams of each alphanumeric word, lower-cased, with two spaces before and one behind."""
    words = F.filter(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    each = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(each))


def similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams."""
    x, y = trigrams(a), trigrams(b)
    both = F.size(F.array_intersect(x, y))
    return F.coalesce(both / F.nullif(F.size(F.array_union(x, y)), F.lit(0)), F.when(a.isNotNull() & b.isNotNull(), F.lit(0.0)))


def word_similarity(a: Column, b: Column) -> Column:
    """The greatest similarity of a's trigrams and any run of b's, which are few: both are short."""
    x, y = trigrams(a), trigrams(b)

    def against(i: Column) -> Column:
        ends = F.sequence(i, F.size(y))
        alike = lambda j: F.size(F.array_intersect(x, F.slice(y, i, j - i + 1))) / F.size(F.array_union(x, F.slice(y, i, j - i + 1)))
        return F.array_max(F.transform(ends, alike))

    found = F.array_max(F.transform(F.sequence(F.lit(1), F.size(y)), against))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.when(a.isNotNull() & b.isNotNull(), F.lit(0.0))).otherwise(found)


FUNCTIONS = {"trigram_similarity": similarity, "trigram_word_similarity": word_similarity}
