"""Column functions of the full-text search: tokens and the BM25 term score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The signs words end at.
DELIMITERS = "[，。、；：！？（）【】《》\"'「」『』\\[\\]\\t-\\r\\x20\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]+"
#: Saturation and length normalisation of BM25.
K1, B = 1.5, 0.75


def words(c: Column) -> Column:
    """Words between delimiters, of two signs at least; empty for null."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), DELIMITERS), lambda w: F.length(w) >= 2)


def tokens(c: Column, bigrams: bool) -> Column:
    """Words, each followed by its bigrams if asked for; a word of two signs then stands twice."""
    w = words(c)
    if not bigrams:
        return w
    return F.flatten(F.transform(w, lambda x: F.concat(F.array(x), F.transform(F.sequence(F.lit(1), F.length(x) - 1), lambda i: F.substring(x, i, F.lit(2))))))


def bm25(freq: Column, length: Column, average: Column, n: Column, df: Column) -> Column:
    """Score of one term in one document."""
    idf = F.ln((n - df + 0.5) / (df + 0.5) + 1)
    norm = freq + K1 * (1 - B + B * (length / F.when(average > 0, average).otherwise(F.greatest(length, F.lit(1)))))
    return F.when((freq > 0) & (df > 0) & (n > 0), idf * ((K1 + 1) * freq / norm)).otherwise(0.0)
