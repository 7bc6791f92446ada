"""The relational core of a crawl: links of fetched pages, candidates of a download, pages of a listing, duplicates across lists.

Fetching itself is left to a job that lands pages and answers in tables; what to fetch, what to keep and when to
stop is decided here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawweave.functions.html import absolute, links, looks_like_document
from lawweave.functions.text import domain_allowed


def page_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``pages`` without the page, one row per link: its place on the page, absolute target and anchor.  Null pages have none."""
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(*keep, F.posexplode(links(F.col(html))).alias("place", "_l"))
    return rows.select(*keep, "place", absolute(F.col(url), F.col("_l.href")).alias("target"), F.col("_l.anchor").alias("anchor")).where("target is not null")


def seed_harvest(pages: DataFrame, source: str, url: str, html: str, registry: DataFrame, most: int) -> DataFrame:
    """(source, target, anchor, place): the documents to fetch from the sources' seed pages, at most ``most`` per source.

    Targets have to be on a domain of their source and look like a document.  A target found several times counts
    where it stands first, by page and place.  Spark limits each source's rows before the shuffle.
    ``registry`` has one row per source (allowed_domains, include_keywords).
    """
    found = page_links(pages.select(source, url, html), url, html).join(registry.select(source, "allowed_domains", "include_keywords"), source)
    good = found.where(domain_allowed(F.col("target"), F.col("allowed_domains")) & looks_like_document(F.col("target"), F.col("anchor"), F.col("include_keywords")))
    first = good.groupBy(source, "target").agg(F.min(F.struct(F.col(url), "place", "anchor")).alias("_f"))
    w = Window.partitionBy(source).orderBy(F.col("_f")[url], F.col("_f")["place"], "target")
    return first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select(source, "target", F.col("_f.anchor").alias("anchor"), "rank")


def first_answer(tries: DataFrame, key: Sequence[str], order: str, ok: str, url: str, reason: str) -> DataFrame:
    """(key, chosen, reasons): per key the first successful try by order, or all reasons joined by `` | ``, null where one succeeded.

    A key has as many tries as candidates, so its list is short.
    """
    best = F.min(F.when(F.col(ok), F.struct(F.col(order), F.col(url)))).alias("_b")
    failed = F.sort_array(F.collect_list(F.when(~F.coalesce(F.col(ok), F.lit(False)), F.struct(F.col(order), F.concat_ws(": ", url, F.coalesce(reason, F.lit(""))).alias("why"))))).alias("_f")
    rows = tries.groupBy(*key).agg(best, failed)
    return rows.select(*key, F.col(f"_b.{url}").alias("chosen"), F.when(F.col("_b").isNull(), F.array_join(F.transform("_f", lambda x: x["why"]), " | ")).alias("reasons"))


def pages_until_empty(pages: DataFrame, listing: str, page: str, rows: str, empties: int = 1, total: str | None = None) -> DataFrame:
    """The pages of each listing up to where a crawl stops: after ``empties`` empty pages in a row, or at the reported ``total`` of pages.

    The last page is the one that makes the crawl stop.  Null counts of rows are empty.
    """
    w = Window.partitionBy(listing).orderBy(page)
    empty = (F.coalesce(F.col(rows), F.lit(0)) <= 0).cast("int")
    in_row = F.sum(empty).over(w.rowsBetween(1 - empties, 0))
    stop = in_row == empties
    if total:
        stop = stop | (F.col(page) >= F.col(total))
    before = F.max(F.col("_stop").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return pages.withColumn("_stop", F.coalesce(stop, F.lit(False))).withColumn("_done", F.coalesce(before, F.lit(0))).where("_done = 0").drop("_stop", "_done")


def first_by_any_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The first row, by order, of each value of the first key that a row has (neither null nor empty); rows without any count as one."""
    key = F.coalesce(*(F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys), F.lit(""))
    w = Window.partitionBy("_key").orderBy(*order)
    return df.withColumn("_key", key).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_key", "_n")


def or_else(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df``, or ``other`` where it has no rows; one row is read to decide."""
    return other if df.isEmpty() else df


def usable_file(path: Column, suffixes: Sequence[str] = (".docx", ".pdf")) -> Column:
    """Whether a file is to be imported: no temporary file, no template, a known suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return ~name.startswith("~$") & ~name.startswith("00_") & F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)).isin(*suffixes)


def usable_text(text: Column, least: int = 300, placeholder: str = "请从这里开始粘贴官方正文") -> Column:
    """Whether an imported text is long enough and not the unfilled form; false for null."""
    return F.coalesce((F.length(text) >= least) & ~F.contains(text, F.lit(placeholder)), F.lit(False))
