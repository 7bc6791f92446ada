"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawweave.session import table


def clauses(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The clauses table with the named columns; rows of one clause_id hold the same title and text."""
    return table(spark, sf_dir, "clauses", *columns)


def char_class(test, last: int = sys.maxunicode) -> str:
    """The body of a regex character class with all code points up to ``last`` for which ``test(char)`` holds."""
    out, start = [], None
    for o in range(last + 2):
        hit = o <= last and not 0xD800 <= o <= 0xDFFF and test(chr(o))
        if hit and start is None:
            start = o
        elif not hit and start is not None:
            out.append(re.escape(chr(start)) + ("-" + re.escape(chr(o - 1)) if o - 1 > start else ""))
            start = None
    return "".join(out)


@lru_cache(maxsize=None)
def category_class(prefix: str, basic: bool = False) -> str:
    """Character class of a Unicode category, e.g. ``L`` or ``N``; ``basic``: only its signs of the basic plane."""
    return char_class(lambda c: unicodedata.category(c).startswith(prefix), 0xFFFF if basic else sys.maxunicode)


def tokenizer_dir(path: str | None = None) -> str:
    """Folder of the public tokenizers' files: the argument, ``LAWWEAVE_TOKENIZERS``, or the installed package."""
    if path or os.environ.get("LAWWEAVE_TOKENIZERS"):
        return path or os.environ["LAWWEAVE_TOKENIZERS"]
    try:
        import public_tokenizers

        return os.path.dirname(public_tokenizers.__file__)
    except ImportError:
        return "/opt/tokenizers"


def bounded_sample(df: DataFrame, id: str, bound: int, *columns: str) -> list:
    """At most ``bound`` rows with the smallest hashes of the id: the same rows on every run and any partitioning."""
    return hash_sample(df, id, bound, df.count(), *columns)


def hash_sample(df: DataFrame, id: str, bound: int, n: int, *columns: str) -> list:
    """The same where the number of rows ``n`` is known.  A filter on the hash keeps each task to its share of the sample."""
    if not n:
        return []
    h = F.pmod(F.xxhash64(id, F.lit(7)), F.lit(1 << 30))
    keep = min(1.0, 1.2 * (bound + 50) / n)
    return df.where(h <= int(keep * (1 << 30))).select(id, *columns).orderBy(F.xxhash64(id, F.lit(7)), id, *columns).limit(bound).collect()
