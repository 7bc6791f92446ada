"""Segmentation of texts into articles or chunks, and the clause rows built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawweave.functions.text import NUMERALS, WS, article_no, clean_text, let, strip

# Where an article begins, and what a heading is.
MARKER = f"第[{NUMERALS}]+条"
HEADING = rf"^(第[{NUMERALS}]+[章节编]|附[件录]|[一二三四五六七八九十]+、).{{0,80}}$"


def split_articles(c: Column, marker: str = MARKER, least: int = 20, repeat_marker: bool = False) -> Column:
    """The articles of a text, each from its marker to the next; longer than ``least`` signs.

    What stands before the first marker is left out.  A text with a single marker and nothing before it has
    no articles (fewer than four parts count as unsegmented).  ``repeat_marker`` writes each marker twice, as
    a splitter with a captured look-ahead does.  Null texts give null.
    """

    def parts(cut: Column) -> Column:
        rest = F.transform(F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0))), strip)
        lead = (strip(F.get(cut, 0)) != "").cast("int")
        whole = F.transform(rest, lambda x: F.concat(F.regexp_extract(x, f"^({marker})", 1), x)) if repeat_marker else rest
        return F.when(lead + 2 * (F.size(cut) - 1) >= 4, F.filter(whole, lambda x: F.length(x) > least)).otherwise(F.array().cast("array<string>"))

    return let(F.split(F.regexp_replace(c, f"({marker})", "\u0001$1"), "\u0001"), lambda cut: F.when(cut.isNotNull(), parts(cut)))


def chunk_by_size(c: Column, most: int = 1200, overlap: int = 160) -> Column:
    """Paragraphs packed greedily into chunks of at most ``most`` signs; a longer paragraph in slices that overlap.

    A fold over the paragraphs; two more signs count for the blank line between them.  Null texts give null.
    """
    paras = F.filter(F.transform(F.split(c, "\n{2,}"), strip), lambda p: p != "")  # null for a null text, and so is the fold
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def slices(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.length(p) - 1, F.lit(most - overlap)), lambda i: F.substring(p, i + 1, F.lit(most)))

    def step(acc: Column, p: Column) -> Column:
        fits = F.length(acc["open"]) + F.length(p) + 2 <= most
        closed = F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        joined = F.when(acc["open"] != "", F.concat(acc["open"], F.lit("\n\n"), p)).otherwise(p)
        return F.when(fits, F.struct(acc["done"].alias("done"), joined.alias("open"))).when(F.length(p) <= most, F.struct(closed.alias("done"), p.alias("open"))).otherwise(F.struct(F.concat(closed, slices(p)).alias("done"), F.lit("").alias("open")))

    return F.aggregate(paras, start, step, lambda acc: F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]))


def long_slices(c: Column, most: int = 1200, overlap: int = 160) -> Column:
    """(offset, slice) of a text longer than ``most``; a shorter one is its only slice; null or empty: none."""
    n = F.length(c)
    at = F.when(n > most, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(most - overlap))).otherwise(F.array(F.lit(0)))
    return F.when(n > 0, F.transform(at, lambda i: F.struct(i.alias("offset"), F.substring(c, i + 1, F.lit(most)).alias("slice"))))


def heading_path(c: Column, lines: int = 20, last: int = 3) -> Column:
    """The last headings among the first lines; empty if there are none."""
    h = F.filter(F.transform(F.slice(F.split(c, r"\r\n|\r|\n"), 1, lines), strip), lambda x: x.rlike(HEADING))
    return F.when(c.isNotNull(), F.slice(h, F.greatest(F.lit(1), F.size(h) - last + 1), last))


def clause_rows(docs: DataFrame, id: str, text: str, *carried: str, most: int = 1200, overlap: int = 160) -> DataFrame:
    """One row per article of each document, or per chunk where it has none: id, number, the carried columns and a citation.

    Null and empty texts give no rows; repeated ids give their rows again.
    """
    t = clean_text(F.col(text))
    parts = let(split_articles(F.col("_t")), lambda articles: F.when(F.size(articles) > 0, articles).otherwise(chunk_by_size(F.col("_t"), most, overlap)))
    d = docs.select(F.col(id).alias("doc_id"), t.alias("_t"), *(F.col(c) for c in carried)).where(F.col("_t") != "")
    rows = d.select("doc_id", *carried, heading_path(F.col("_t")).alias("heading_path"), F.posexplode(parts).alias("pos", "text"))
    cite = F.struct(*(F.col(c) for c in carried)) if carried else F.lit(None)
    return rows.select(F.format_string("%s_c%04d", F.col("doc_id").cast("string"), F.col("pos") + 1).alias("clause_id"), "doc_id", *carried, article_no(F.col("text")).alias("article_no"), "heading_path", "text", cite.alias("citation"))


__all__ = ["HEADING", "MARKER", "WS", "chunk_by_size", "clause_rows", "heading_path", "long_slices", "split_articles"]
