"""The inverted index as tables: term frequencies, document frequencies, corpus statistics, facets.

Postings are rows (term, id, freq, length), never lists: a frequent term's rows spread over the
partitions like any others, and counts are reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawweave.functions.search import tokens


def postings(df: DataFrame, id: str, text: Column, bigrams: bool, only: list[str] | None = None) -> DataFrame:
    """(term, id, freq, length) of every document; ``only`` keeps the given terms before anything is shuffled.

    Length is that of the indexed text in signs; a null text has length 0 and no terms.
    """
    t = F.coalesce(text, F.lit(""))
    terms = tokens(t, bigrams)
    if only is not None:
        wanted = F.array(*map(F.lit, only)) if only else F.array().cast("array<string>")
        terms = F.filter(terms, lambda x: F.array_contains(wanted, x))
    rows = df.select(F.col(id), F.length(t).alias("length"), F.explode(terms).alias("term"))
    return rows.groupBy("term", id).agg(F.count("*").alias("freq"), F.max("length").alias("length"))


def document_frequency(postings: DataFrame) -> DataFrame:
    """(term, df, cf): documents with the term, and its occurrences."""
    return postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("freq").alias("cf"))


def corpus_statistics(df: DataFrame, text: Column) -> DataFrame:
    """One row (n, avgdl): documents and average length in signs; 0 for an empty table."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.avg(F.length(F.coalesce(text, F.lit("")))), F.lit(0.0)).alias("avgdl"))


def capped_postings(df: DataFrame, id: str, words: Column, cap: int) -> DataFrame:
    """(word, id, rank): per word its first ``cap`` documents by id; a word counts once per document."""
    rows = df.select(F.col(id), F.explode(F.array_distinct(words)).alias("word")).distinct()
    rank = F.row_number().over(Window.partitionBy("word").orderBy(id))
    return rows.withColumn("rank", rank).where(F.col("rank") <= cap)


def facets(df: DataFrame, id: str, single: list[str], multi: list[str]) -> DataFrame:
    """(facet, value, n): distinct ids per value; array columns count once per element; missing values as ``unknown``."""
    pairs = [F.struct(F.lit(c).alias("facet"), F.coalesce(F.col(c), F.lit("unknown")).alias("value")) for c in single]

    def elements(c: str) -> Column:
        return F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda v: F.struct(F.lit(c).alias("facet"), v.alias("value")))

    many = [elements(c) for c in multi]
    rows = df.select(F.col(id), F.explode(F.concat(F.array(*pairs), *many)).alias("p")).select(id, "p.*").distinct()
    return rows.groupBy("facet", "value").agg(F.count("*").alias("n"))
