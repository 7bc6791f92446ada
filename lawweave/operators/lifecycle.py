"""Attachments, their documents and gaps kept in step: three tables rebuilt from one status per attachment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawweave.operators.merge import insert_absent

# What is written about an attachment that came as an error page.
ERROR = "Downloaded HTML error page instead of attachment"
GAP_KEYS = ["source_id", "doc_id", "url", "gap_type"]


def without_gaps(gaps: DataFrame, done: DataFrame, gap_type: str, source: str = "source_id", id: str = "attachment_id", url: str = "url") -> DataFrame:
    """``gaps`` without those of ``gap_type`` whose source, document and URL are an attachment's in ``done``; null equals null."""
    d = done.select(F.col(source).alias("_s"), F.col(id).alias("_i"), F.col(url).alias("_u")).distinct()
    same = reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(b)) for a, b in (("source_id", "_s"), ("doc_id", "_i"), ("url", "_u"))))
    return gaps.join(d, (F.col("gap_type") == gap_type) & same, "left_anti")


def drop_error_pages(attachments: DataFrame, documents: DataFrame, gaps: DataFrame, is_error: Column, prefix: str = "attachment_") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(attachments, documents, gaps) after all attachments that are error pages were taken back.

    Such an attachment counts as not downloaded and loses its place; the document made of it goes; its extraction gap
    goes and a download gap comes, once per key.
    """
    marked = attachments.withColumn("_bad", F.coalesce(is_error, F.lit(False)))
    bad = marked.where("_bad")
    reset = {"downloaded": F.lit(False), "download_error": F.lit(ERROR), "local_path": F.lit(None).cast("string")}
    kept = marked.select(*(F.when(F.col("_bad"), reset[c]).otherwise(F.col(c)).alias(c) if c in reset else F.col(c) for c in attachments.columns))
    gone = bad.select(F.concat(F.lit(prefix), "attachment_id").alias("doc_id")).distinct()
    new = bad.select("source_id", F.col("attachment_id").alias("doc_id"), "url", F.lit("attachment_download_html_error").alias("gap_type"), F.lit(ERROR).alias("reason"), F.lit(False).alias("body_read"))
    return kept, documents.join(gone, "doc_id", "left_anti"), insert_absent(without_gaps(gaps, bad, "attachment_extract_failed"), new, GAP_KEYS)
