"""Column functions on HTML: text, title and links, by regular expressions; exact URL joining by an Arrow UDF."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from lawweave.functions.text import clean_space, first_line, strip, unescape

# Elements that are dropped with their contents, and elements that begin or end a line.
SKIPPED = ("script", "style", "noscript")
BLOCKS = ("p", "div", "li", "tr", "br", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "table", "ul", "ol")


def html_text(c: Column, skipped: Sequence[str] = SKIPPED, blocks: Sequence[str] = BLOCKS) -> Column:
    """The text of a page: skipped elements and comments gone, a line end at each block, tags stripped, entities resolved last."""
    for tag in skipped:
        c = F.regexp_replace(c, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, rf"(?i)</?(?:{'|'.join(blocks)})\b[^>]*>", "\n")
    return clean_space(F.regexp_replace(c, r"(?s)<[^>]*>", ""))


def html_title(c: Column) -> Column:
    """The title element's text, else the first line of the page's text, cut to 120 signs."""
    t = strip(unescape(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1)))
    return F.coalesce(F.nullif(t, F.lit("")), first_line(html_text(c), limit=120))


@pandas_udf(StringType())
def absolute(base: pd.Series, href: pd.Series) -> pd.Series:
    """``href`` resolved against ``base``; null if either is null or malformed."""

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def links(c: Column) -> Column:
    """Array of (href, anchor) of a page's links, without empty, script, mail and fragment targets."""
    p = r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(p), 1).alias("href"), F.regexp_extract_all(c, F.lit(p), 2).alias("anchor"))
    clean = F.transform(pairs, lambda x: F.struct(strip(unescape(x["href"])).alias("href"), clean_space(F.regexp_replace(x["anchor"], r"(?s)<[^>]*>", "")).alias("anchor")))
    return F.filter(clean, lambda x: (x["href"] != "") & ~F.lower(x["href"]).rlike("^(javascript:|mailto:|#)"))


def is_attachment(x: Column) -> Column:
    """Whether a link's anchor or target names an attachment."""
    return F.contains(x["anchor"], F.lit("附件")) | F.lower(x["href"]).rlike(r"\.(pdf|docx?|xlsx?|zip|rar|wps)([?#]|$)")


# URLs of articles.
ARTICLE_URL = r"(?i)(content\.shtml|/content_[0-9]+|/t[0-9]{8}_[0-9]+|\.html?$)"
SUFFIXES = (".pdf", ".doc", ".docx", ".xls", ".xlsx")


def looks_like_document(url: Column, anchor: Column, keywords: Column, pattern: str = ARTICLE_URL) -> Column:
    """PDF targets; any keyword in anchor or URL; without keywords an article's URL."""
    none = F.coalesce(F.size(keywords) <= 0, F.lit(True))
    both = F.concat_ws(" ", anchor, url)
    return F.coalesce(F.lower(url).endswith(".pdf") | F.exists(keywords, lambda k: (k != "") & F.contains(both, k)) | (none & url.rlike(pattern)), F.lit(False))


def attachment_links(c: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """Array of (ordinal, href, anchor) of a page's links to files, numbered from 1 among all its links."""
    numbered = F.transform(links(c), lambda x, i: F.struct((i + 1).alias("ordinal"), x["href"].alias("href"), x["anchor"].alias("anchor")))
    return F.filter(numbered, lambda x: F.lower(x["href"]).rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"))


def label_pairs(c: Column) -> Column:
    """Map of ``<em>label</em> value``; of a label that stands twice the last value counts."""
    p = r"(?s)<em>(.*?)</em>\s*([^<]+)"
    pairs = F.arrays_zip(F.transform(F.regexp_extract_all(c, F.lit(p), 1), lambda x: clean_space(x)).alias("label"), F.transform(F.regexp_extract_all(c, F.lit(p), 2), lambda x: clean_space(x)).alias("value"))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["label"] == x["label"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["label"], x["value"])))


def script_links(c: Column) -> Column:
    """Array of (name, link) of the ``name: '…', link: '…'`` pairs of a script; of a link that stands twice the first counts."""
    p = r"name:\s*'([^']+)'\s*,\s*\n\s*link:\s*'([^']+)'"
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(p), 1).alias("name"), F.regexp_extract_all(c, F.lit(p), 2).alias("link"))
    return F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, 1, i), lambda y: y["link"] == x["link"]))


def delimited_records(c: Column, record: str = "@doc@", field: str = "@memo@", least: int = 4) -> Column:
    """Array of field arrays of a delimited listing: blank fields dropped, short records dropped."""
    rows = F.transform(F.split(c, record), lambda r: F.filter(F.transform(F.split(r, field), strip), lambda x: x != ""))
    return F.filter(rows, lambda r: F.size(r) >= least)
