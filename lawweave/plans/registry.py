"""The registered queries of the core; ``sql`` has the DuckDB SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawweave.functions import search as fs
from lawweave.functions import text as ft
from lawweave.operators import index, merge, report, segment
from lawweave.operators import search as srch
from lawweave.operators.stored import StoredIndex
from lawweave.plans.sql import SQL
from lawweave.session import small, table
from lawweave.streaming.incremental import ingest, shared_folder

#: The query the search queries answer, and the terms of the keyword search.
QUERY = "场外期权 备案"
TERMS = ["场外期权", "OTC"]
#: Most rows of the registry that are broadcast.
REGISTRY_ROWS = 100_000
# Titles that say nothing, and beginnings of lines that are no titles.
GENERIC = ("", "目录页", "首页")
BAD_PREFIXES = ("|", "English", "移动端", "微博", "微信", "无障碍")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _clauses(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """One row per clause: its last retrieval."""
    return merge.last_per_key(table(spark, d, "clauses", "clause_id", "retrieved_at", *columns), ["clause_id"], ["retrieved_at"])


def _docs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return merge.last_per_key(table(spark, d, "regulatory_documents", "doc_id", "retrieved_at", *columns), ["doc_id"], ["retrieved_at"])


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "evidence_ledger").dropDuplicates(["evidence_id"])


# --- scans, projections, scalar functions -------------------------------------------------------------------------


@query
def scan_project_hit(spark, d):
    c = table(spark, d, "clauses", "clause_id", "title", "url", "published_at", "article_no", "text")
    return c.select("clause_id", *(F.coalesce(x, F.lit("")).alias(x) for x in ("title", "url", "published_at", "article_no")), F.substring(F.coalesce("text", F.lit("")), 1, 300).alias("excerpt"))


@query
def clean_text(spark, d):
    t = ft.clean_text(F.col("text"))
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.length(t).alias("chars"), F.md5(t).alias("digest"))


@query
def clean_space(spark, d):
    t = ft.clean_space(F.col("text"))
    return table(spark, d, "clauses", "clause_id", "text").select("clause_id", F.length(t).alias("chars"), F.md5(t).alias("digest"))


@query
def title_infer(spark, d):
    t = table(spark, d, "documents", "doc_id", "title", "text")
    generic = F.coalesce(ft.strip(F.col("title")), F.lit("")).isin(*GENERIC)
    line = ft.first_line(F.col("text"), BAD_PREFIXES)
    inferred = generic & ~F.coalesce(line, F.lit("")).isin(*GENERIC)  # a generic title stays where the text has no better one
    return t.select("doc_id", F.when(inferred, line).otherwise(F.col("title")).alias("title"), inferred.alias("title_inferred"))


@query
def id_hash(spark, d):
    r = table(spark, d, "regulatory_documents", "source_id", "url", "title")
    return r.select("url", ft.short_id(F.coalesce("source_id", F.lit("none")), F.col("url")).alias("made_id"), F.sha2(F.coalesce("title", F.lit("")), 256).alias("title_sha"))


@query
def date_normalise(spark, d):
    r = table(spark, d, "regulatory_documents", "doc_id", "published_at", "effective_at")
    day = ft.valid_date(F.col("published_at"))
    return r.select("doc_id", ft.extract_date(F.col("published_at")).alias("published_on"), ft.parse_date(F.col("effective_at")).alias("effective_on"), F.date_format(day, "yyyyMMdd").alias("published_day"))


@query
def url_host_allow(spark, d):
    r = table(spark, d, "regulatory_documents", "doc_id", "source_id", "url")
    s = table(spark, d, "sources", "source_id", "allowed_domains")
    return r.join(small(s, REGISTRY_ROWS), "source_id").select("doc_id", ft.host(F.col("url")).alias("host"), ft.domain_allowed(F.col("url"), F.col("allowed_domains")).alias("allowed")).distinct()


@query
def keyword_filter(spark, d):
    r = table(spark, d, "regulatory_documents", "doc_id", "source_id", "title")
    s = table(spark, d, "sources", "source_id", "include_keywords")
    return r.join(small(s, REGISTRY_ROWS), "source_id").where(ft.any_keyword(F.col("title"), F.col("include_keywords"))).select("doc_id").distinct()


@query
def attachment_suffix(spark, d):
    a = table(spark, d, "attachments", "attachment_id", "attachment_name", "attachment_path")
    s = F.coalesce(F.nullif(ft.suffix(F.col("attachment_path")), F.lit("")), F.nullif(ft.suffix(F.col("attachment_name")), F.lit("")), F.lit(".bin"))
    return a.select("attachment_id", s.alias("suffix")).distinct()


@query
def body_gate(spark, d):
    t = table(spark, d, "documents", "doc_id", "source", "text")
    return t.select("doc_id", F.coalesce(F.length("text") >= 120, F.lit(False)).alias("body_read"))


@query
def json_props(spark, d):
    e = table(spark, d, "events", "event_id", "props")
    j = F.from_json(ft.json_object(F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))), "k long, kk long")
    return e.select("event_id", F.coalesce(j["k"], j["kk"], F.lit(-1).cast("long")).alias("k"))


@query
def epoch_date(spark, d):
    e = table(spark, d, "events", "event_id", "ts")
    return e.select("event_id", F.date_format(ft.millis_to_date(F.unix_millis(F.to_timestamp("ts"))), "yyyy-MM-dd").alias("day"))


# --- segmentation ----------------------------------------------------------------------------------------------------


def _articles(spark, d, **how):
    t = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(segment.split_articles(ft.clean_text(F.col("text")), **how)).alias("pos", "text"))
    return t.select("doc_id", "pos", ft.article_no(F.col("text")).alias("article_no"), F.length("text").alias("chars"), F.md5("text").alias("digest"))


@query
def article_split(spark, d):
    return _articles(spark, d)


@query
def article_split_repeated(spark, d):
    """With each marker written twice, as a splitter with a captured look-ahead does."""
    return _articles(spark, d, repeat_marker=True)


@query
def size_chunk(spark, d):
    t = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(segment.chunk_by_size(ft.clean_text(F.col("text")))).alias("pos", "chunk"))
    return t.select("doc_id", "pos", F.length("chunk").alias("chars"), F.md5("chunk").alias("digest"))


@query
def long_slices(spark, d):
    t = table(spark, d, "documents", "doc_id", "text").select("doc_id", F.explode(segment.long_slices(F.col("text"))).alias("s"))
    return t.select("doc_id", F.col("s.offset").cast("int").alias("start_at"), F.length("s.slice").alias("chars"), F.md5("s.slice").alias("digest"))


@query
def heading_path(spark, d):
    t = table(spark, d, "documents", "doc_id", "text")
    return t.select("doc_id", F.array_join(segment.heading_path(F.col("text")), " / ").alias("path"))


@query
def clause_rows(spark, d):
    t = table(spark, d, "documents", "doc_id", "text", "title", "source")
    c = segment.clause_rows(t, "doc_id", "text", "title", "source")
    return c.select("clause_id", "doc_id", "article_no", F.col("citation.title").alias("cited_title"), F.length("text").alias("chars"))


# --- index -----------------------------------------------------------------------------------------------------------


@query
def tokenize_titles(spark, d):
    r = _docs(spark, d, "title")
    return r.select("doc_id", F.array_join(fs.tokens(F.col("title"), True), "¦").alias("tokens"))


@query
def term_freq(spark, d):
    r = _docs(spark, d, "title")
    return index.postings(r, "doc_id", F.col("title"), True)


@query
def doc_freq(spark, d):
    c = _clauses(spark, d, "title", "text")
    p = index.postings(c, "clause_id", srch.full_text(), False)
    return index.document_frequency(p)


@query
def corpus_stats(spark, d):
    c = _clauses(spark, d, "title", "text")
    return index.corpus_statistics(c, srch.full_text()).select("n", F.round("avgdl", 6).alias("avgdl"))


@query
def posting_cap(spark, d):
    r = _docs(spark, d, "title")
    return index.capped_postings(r, "doc_id", fs.words(F.col("title")), 200)


@query
def facets(spark, d):
    c = _clauses(spark, d, "authority_level", "source_id", "product_types", "asset_classes")
    return index.facets(c, "clause_id", ["authority_level", "source_id"], ["product_types", "asset_classes"])


# --- search ----------------------------------------------------------------------------------------------------------


def _registry(spark, d):
    return table(spark, d, "sources", "source_id", "include_keywords", "product_types")


@query
def query_expand(spark, d):
    s = _registry(spark, d).select(F.explode("include_keywords").alias("key"), "include_keywords")
    pairs = s.select("key", F.explode("include_keywords").alias("expansion")).where("key <> expansion").distinct()
    return srch.expand_column(F.col("title"), pairs, _evidence(spark, d), "evidence_id")


@query
def bm25_evidence(spark, d):
    terms, _ = srch.expand(QUERY, *srch.dictionaries(_registry(spark, d)))
    s = srch.scores(_evidence(spark, d), "evidence_id", srch.evidence_text(), terms, True)
    return s.select("evidence_id", F.round("bm25", 6).alias("bm25"))


@query
def bm25_title(spark, d):
    terms, _ = srch.expand(QUERY, *srch.dictionaries(_registry(spark, d)))
    s = srch.scores(_clauses(spark, d, "title", "heading_path"), "clause_id", srch.title_text(), terms, True)
    return s.select("clause_id", F.round("bm25", 6).alias("bm25"))


def _searched(spark, d):
    return _evidence(spark, d), _clauses(spark, d, "title", "text", "heading_path", "authority_level", "product_types", "asset_classes")


_indexes: dict[tuple[str, str], StoredIndex] = {}


@query
def search_full(spark, d):
    """The three-stage search on a stored index of the tables, which is built once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _indexes:
        _indexes[key] = StoredIndex.build(*_searched(spark, d), shared_folder(spark))
    expansions, taxonomy = srch.dictionaries(_registry(spark, d))
    return _indexes[key].search(QUERY, expansions=expansions, taxonomy=taxonomy)


@query
def search_scan(spark, d):
    """The same search without an index: all texts are read and taken apart."""
    expansions, taxonomy = srch.dictionaries(_registry(spark, d))
    return srch.search(*_searched(spark, d), QUERY, expansions=expansions, taxonomy=taxonomy)


@query
def keyword_search(spark, d):
    return srch.keyword_search(_clauses(spark, d, "title", "text"), "clause_id", srch.full_text(), TERMS, 8)


@query
def kwic_preview(spark, d):
    t = table(spark, d, "documents", "doc_id", "text")
    return t.select("doc_id", ft.preview(F.col("text"), TERMS, 240).alias("preview"))


@query
def taxonomy_overlap(spark, d):
    r = _docs(spark, d, "source_id", "asset_classes", "product_types")
    s = table(spark, d, "sources", "source_id", F.col("asset_classes").alias("s_assets"), F.col("product_types").alias("s_products"))
    j = r.join(small(s, REGISTRY_ROWS), "source_id")
    return j.select("doc_id", F.arrays_overlap("asset_classes", "s_assets").alias("assets"), F.arrays_overlap("product_types", "s_products").alias("products"))


@query
def first_match_title(spark, d):
    e = table(spark, d, "evidence_ledger", "title").where("title is not null")
    c = _clauses(spark, d, "title", "article_no").where("article_no <> ''")
    m = srch.first_match(e, "title", c, "clause_id", "title", "article_no")
    return m.select("key", F.col("id").alias("clause_id"), ft.bare_article_no(F.col("article_no")).alias("article"))


@query
def choose_best(spark, d):
    r = _docs(spark, d, "source_id", "title", "published_at", "status", "authority_level").where("source_id is not null")
    return srch.best_candidate(r, "source_id", F.col("title"), "published_at", "doc_id", "场外期权", F.col("status") == "effective", F.col("authority_level") == "law")


@query
def dedupe_title_excerpt(spark, d):
    c = _clauses(spark, d, "title", "text")
    hits = c.select(F.lit("clause").alias("source"), F.lit(2).alias("stage"), F.col("clause_id").alias("id"), F.coalesce("title", F.lit("")).alias("title"), F.substring(F.coalesce("text", F.lit("")), 1, 300).alias("excerpt"), F.length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))
    return srch.first_by_excerpt(hits).select("id", "score")


# --- merges and the lifecycle of gaps --------------------------------------------------------------------------------


@query
def latest_by_key(spark, d):
    return _clauses(spark, d, "title").select("clause_id", "retrieved_at", "title")


@query
def incremental_upsert(spark, d):
    t = ingest(spark, f"{d}/regulatory_documents.parquet", ["doc_id"], ["retrieved_at"])
    return t.select("doc_id", "retrieved_at", "title", "status")


@query
def upsert_documents(spark, d):
    r = _docs(spark, d, "title", "status")
    g = table(spark, d, "resolved_gaps", "doc_id", "resolved_at").where("doc_id is not null").groupBy("doc_id").agg(F.max("resolved_at").alias("retrieved_at"))
    new = g.select("doc_id", "retrieved_at", F.lit("manual").alias("status"))
    return merge.upsert(r, new, ["doc_id"]).select("doc_id", "retrieved_at", "title", "status")


@query
def field_merge(spark, d):
    r = _docs(spark, d, "source_id", "publisher", "authority_level", "asset_classes")
    s = table(spark, d, "sources", "source_id", "publisher", "authority_level", "asset_classes")
    m = merge.merge_fields(r, s, ["source_id"], {"publisher": "left", "authority_level": "right", "asset_classes": "left"})
    return m.select("doc_id", "publisher", "authority_level", F.array_join("asset_classes", ",").alias("assets"))


@query
def registry_lookup(spark, d):
    r = _docs(spark, d, "source_id", "authority_level")
    s = table(spark, d, "sources", "source_id", F.col("authority_level").alias("registered"))
    return r.join(small(s, REGISTRY_ROWS), "source_id", "left").select("doc_id", "authority_level", "registered", (~F.col("authority_level").eqNullSafe(F.col("registered"))).alias("deviates"))


@query
def gap_dedupe(spark, d):
    g = table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type")
    return g.dropDuplicates(["source_id", "doc_id", "url", "gap_type"])


@query
def gap_new_anti(spark, d):
    g = table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type", "resolved_by")
    keys = ["source_id", "doc_id", "url", "gap_type"]
    old, new = g.where("resolved_by = 'retry_job'"), g.where("coalesce(resolved_by, '') <> 'retry_job'")
    return merge.absent(new.select(*keys), old, keys)


@query
def gap_join(spark, d):
    g = table(spark, d, "resolved_gaps", "doc_id").where("doc_id is not null").distinct()
    return _docs(spark, d, "title", "body_read").join(g, "doc_id").select("doc_id", "title", "body_read")


@query
def gap_resolve_split(spark, d):
    g = table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type").distinct()
    a = table(spark, d, "attachments", F.col("content_id").alias("doc_id"), "source_id", "downloaded").where("downloaded").distinct()
    f = merge.flag_resolved(g, a, "doc_id", "source_id", ["mzce", "lzse"])
    still, done = merge.split_resolved(f)
    return still.withColumn("state", F.lit("open")).unionByName(done.withColumn("state", F.lit("resolved")))


@query
def gap_replace(spark, d):
    g = table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type")
    retried = g.where("gap_type = 'pdf_text_too_short'").select("source_id", "doc_id").distinct()
    new = retried.where("doc_id is not null").select("source_id", "doc_id", F.lit("").alias("url"), F.lit("retried").alias("gap_type"))
    return merge.replace_for(g.distinct(), retried, new, ["source_id", "doc_id"], ["source_id", "doc_id", "url", "gap_type"])


@query
def evidence_urls(spark, d):
    e = report.distinct_urls(table(spark, d, "evidence_ledger", "url"), "url")
    r = _docs(spark, d, "url")
    return r.join(e.withColumn("hit", F.lit(True)), "url", "left").select("doc_id", F.coalesce("hit", F.lit(False)).alias("has_evidence"))


@query
def seen_set_anti(spark, d):
    a = table(spark, d, "attachments", "content_id")
    g = table(spark, d, "resolved_gaps", "doc_id").where("doc_id is not null")
    return merge.seen_anti(a, "content_id", g, "doc_id")


@query
def attachment_merge(spark, d):
    a = merge.last_per_key(table(spark, d, "attachments", "attachment_path", "attachment_id", "retrieved_at", "downloaded", "download_error"), ["attachment_path"], ["retrieved_at"])
    return a.select("attachment_path", "attachment_id", F.when(F.col("downloaded"), "ok").otherwise(ft.truthy(F.col("download_error"), F.lit("missing"))).alias("state"))


@query
def attachment_retry(spark, d):
    a = table(spark, d, "attachments", "attachment_id", "source_id", "downloaded", "download_error", "download_url")
    due = (~F.coalesce("downloaded", F.lit(False))) & (F.coalesce("download_url", F.lit("")) != "")
    return a.where(due).select("attachment_id", "source_id", "download_error").distinct()


@query
def union_sources(spark, d):
    r = _docs(spark, d, "source_id", "title", "content_type")
    a = table(spark, d, "attachments", "attachment_id", "source_id", "attachment_name", "parent_title").distinct()
    docs = a.select(F.concat(F.lit("attachment_"), "attachment_id").alias("doc_id"), "source_id", F.col("attachment_name").alias("title"), "parent_title")
    return merge.union_sources(r.drop("retrieved_at"), docs)


# --- reports ---------------------------------------------------------------------------------------------------------


@query
def report_by_source(spark, d):
    r = _docs(spark, d, "source_id", "body_read", "effective_at")
    return report.counts_by(r, "source_id", read=F.col("body_read"), dated=F.coalesce("effective_at", F.lit("")) != "")


@query
def crawl_counters(spark, d):
    a = table(spark, d, "attachments", "attachment_id", "source_id", "downloaded").distinct()
    return report.counts_by(a, "source_id", saved=F.col("downloaded"), gaps=~F.col("downloaded"))


@query
def quota_per_source(spark, d):
    r = _docs(spark, d, "source_id", "title", "published_at").where("source_id is not null")
    return report.newest(r, "source_id", "published_at", "title", "doc_id", 5).select("source_id", "doc_id", "place")


@query
def last_gaps(spark, d):
    g = table(spark, d, "resolved_gaps", "source_id", "url", "gap_type", "resolved_at").distinct()
    return report.last_n(g, 50, "resolved_at", "url", "gap_type", "source_id")


@query
def ui_filter_sort(spark, d):
    r = _docs(spark, d, "title", "publisher", "authority_level")
    return r.where(report.matches("otc", "title", "publisher")).select("doc_id", report.ranked_levels(F.col("authority_level"), list(srch.AUTHORITY)).alias("level_rank"))


@query
def score_band(spark, d):
    t = table(spark, d, "documents", "doc_id", "n_chars")
    return t.select("doc_id", report.band(F.coalesce(F.col("n_chars") / 2000.0, F.lit(0.0)), {"high": 0.7, "medium": 0.4}, "low").alias("band"))


@query
def markdown_rows(spark, d):
    r = _docs(spark, d, "source_id", "title", "url", "published_at").where("source_id is not null")
    cells = [report.md_link(F.substring("title", 1, 120), F.col("url")), F.col("published_at")]
    return report.md_table(r, "source_id", cells, F.desc(F.coalesce("published_at", F.lit(""))), F.desc(F.coalesce("title", F.lit(""))), F.col("doc_id"))
