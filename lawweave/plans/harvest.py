"""Registered queries of pages, payloads, files, attachments' lifecycles and reports, each with its DuckDB SQL.

Where no given table holds pages or payloads, a query writes them from the columns of one and reads them again, so
its work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawweave.functions import html as fh
from lawweave.functions import nested
from lawweave.functions import text as ft
from lawweave.operators import harvest, lifecycle, merge, report
from lawweave.plans.sql import _R, clean, space, strip
from lawweave.session import small, table
from lawweave.sources import files
from lawweave.streaming.incremental import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def _docs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return merge.last_per_key(table(spark, d, "regulatory_documents", "doc_id", "retrieved_at", *columns), ["doc_id"], ["retrieved_at"])


def _attachments(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "attachments", "attachment_id", *columns).distinct()


def _html(title, *body):
    return F.concat(F.lit("<html><head><title>"), F.coalesce(title, F.lit("")), F.lit("</title><script>var a = '<p>';</script><!-- <p>x</p> --></head><body>"), *body, F.lit("</body></html>"))


# --- pages -----------------------------------------------------------------------------------------------------------


@query(f"""with r as (select doc_id, coalesce(title, '') as t, coalesce(publisher, '') as p, coalesce(published_at, '') as d from {_R} q),
x as (select doc_id, {space("t || chr(10) || p || chr(10) || chr(10) || '发布：' || d || chr(10)")} as body, {strip('t')} as t, {strip('p')} as p, d from r)
select doc_id, case when t <> '' then t when {space('p')} <> '' then substring({space('p')}, 1, 120) else substring('发布：' || d, 1, 120) end as title, length(body) as chars, md5(body) as digest from x""")
def html_pages(spark, d):
    page = _html(F.col("title"), F.lit("<p>"), F.coalesce("publisher", F.lit("")), F.lit("</p><DIV class='x'>发布：<b>"), F.coalesce("published_at", F.lit("")), F.lit("</b></DIV>"))
    r = _docs(spark, d, "title", "publisher", "published_at").select("doc_id", page.alias("page"))
    t = fh.html_text(F.col("page"))
    return r.select("doc_id", fh.html_title(F.col("page")).alias("title"), F.length(t).alias("chars"), F.md5(t).alias("digest"))


def _pages(spark, d):
    """One page per attachment: a link to the file, one to the document, and two that are no targets."""
    link = lambda href, anchor: F.concat(F.lit('<a class="l" href="'), href, F.lit('">'), anchor, F.lit("</a> "))
    a = _attachments(spark, d, "source_id", "attachment_name", "attachment_path", "download_url", "url").where("url is not null")
    page = _html(F.lit("附件"), link(F.lit("javascript:void(0)"), F.lit("关闭")), link(F.col("download_url"), F.concat(F.lit("附件：<b>"), F.col("attachment_name"), F.lit("</b>"))), link(F.lit("#top"), F.lit("顶部")), link(F.concat(F.col("attachment_path"), F.lit(".pdf")), F.lit("PDF")))
    return a.select("attachment_id", "source_id", "url", page.alias("page"))


_FILE_URL = "regexp_extract(url, '^([a-z]+://[^/]+)', 1) || attachment_path || '.pdf'"


@query(f"""with a as (select distinct attachment_id, source_id, url, download_url, attachment_name, attachment_path from attachments where url is not null)
select attachment_id, cast(0 as integer) as place, download_url as target, '附件：' || attachment_name as anchor, true as is_attachment, cast(null as integer) as file_no from a
union all select attachment_id, 1, {_FILE_URL}, 'PDF', true, 2 from a""")
def page_links(spark, d):
    p = _pages(spark, d).withColumn("files", fh.attachment_links(F.col("page")))
    rows = harvest.page_links(p, "url", "page")
    number = F.get(F.transform(F.filter("files", lambda x: F.endswith(F.col("target"), x["href"])), lambda x: x["ordinal"]), F.lit(0))
    return rows.select("attachment_id", "place", "target", "anchor", fh.is_attachment(F.struct(F.col("anchor").alias("anchor"), F.col("target").alias("href"))).alias("is_attachment"), number.alias("file_no"))


@query(f"""with a as (select distinct attachment_id, source_id, url, download_url, attachment_name, attachment_path from attachments where url is not null),
l as (select source_id, url, 0 as place, download_url as target, '附件：' || attachment_name as anchor from a union all select source_id, url, 1, {_FILE_URL}, 'PDF' from a),
g as (select l.*, lower(regexp_extract(target, '^[a-z]+://([^/?#:]+)', 1)) as h, s.allowed_domains, coalesce(s.include_keywords, []) as k from l join sources s using (source_id)),
o as (select * from g where len(list_filter(allowed_domains, lambda x: h = lower(x) or ends_with(h, '.' || lower(x)))) > 0 and (ends_with(lower(target), '.pdf') or len(list_filter(k, lambda x: x <> '' and contains(anchor || ' ' || target, x))) > 0 or (len(k) = 0 and regexp_matches(target, '(?i)(content\\.shtml|/content_[0-9]+|/t[0-9]{{8}}_[0-9]+|\\.html?$)')))),
f as (select source_id, target, url, place, anchor, row_number() over (partition by source_id, target order by url, place, anchor) as n from o)
select source_id, target, anchor, cast(rank as integer) as rank from (select *, row_number() over (partition by source_id order by url, place, target) as rank from f where n = 1) where rank <= 20""")
def seed_harvest(spark, d):
    s = small(table(spark, d, "sources", "source_id", "allowed_domains", "include_keywords"), 100_000)
    return harvest.seed_harvest(_pages(spark, d), "source_id", "url", "page", s, 20)


@query(f"""with r as (select doc_id, coalesce(publisher, '') as p, coalesce(status, '') as s from {_R} q)
select doc_id, '机构' as label, {space('p')} as value from r where p <> '' union all select doc_id, '状态', {space('s')} from r where s <> ''""")
def label_pairs(spark, d):
    cell = lambda label, c: F.concat(F.lit(f"<em>{label}</em> "), F.coalesce(c, F.lit("")))
    page = F.concat(F.lit('<div class="article_intro">'), cell("机构", F.col("publisher")), F.lit("<i></i>"), cell("状态", F.lit("旧")), F.lit("<i></i>"), cell("状态", F.col("status")), F.lit("</div>"))
    r = _docs(spark, d, "publisher", "status").where("coalesce(publisher, '') <> '' and coalesce(status, '') <> ''")
    return r.select("doc_id", F.explode(fh.label_pairs(page)).alias("label", "value"))


@query("select doc_id, link, name from (select doc_id, url as link, coalesce(publisher, '') as name from regulatory_documents where coalesce(publisher, '') <> '' and not contains(publisher, '''') union select doc_id, '/rules/' || doc_id, status from regulatory_documents where coalesce(publisher, '') <> '' and not contains(publisher, ''''))")
def script_links(spark, d):
    js = F.format_string("[{ name: '%s',\n   link: '%s' }, { name:'%s' , \n link: '/rules/%s' }, { name: '重复',\n link: '%s' }]", "publisher", "url", "status", "doc_id", "url")
    r = table(spark, d, "regulatory_documents", "doc_id", "publisher", "status", "url").where("coalesce(publisher, '') <> '' and not contains(publisher, '''')").distinct()
    return r.select("doc_id", F.explode(fh.script_links(js)).alias("p")).select("doc_id", "p.link", "p.name").distinct()


@query(f"""select doc_id, replace(replace(replace(url_encode('/规则/' || coalesce(title, '')), '%2F', '/'), '%3A', ':'), '%40', '@') as path, replace(replace(replace(replace(replace(replace(replace(replace(replace(url_encode(coalesce(publisher, '')), '%3D', '='), '%26', '&'), '%3A', ':'), '%2F', '/'), '%3F', '?'), '%2B', '+'), '%40', '@'), '%2C', ','), '%3B', ';') as q from {_R} r where not regexp_matches(coalesce(title, ''), '[%?#]')""")
def ascii_urls(spark, d):
    r = _docs(spark, d, "title", "publisher").where(~F.coalesce("title", F.lit("")).rlike("[%?#]"))
    u = ft.url_parts(ft.ascii_url(F.concat(F.lit("https://h.example/规则/"), F.coalesce("title", F.lit("")), F.lit("?"), F.coalesce("publisher", F.lit("")))))
    return r.select("doc_id", u["path"].alias("path"), F.substring(u["query"], 2, 100_000).alias("q"))


@query("""with x as (select distinct attachment_id, download_url as u, downloaded, download_error from attachments), m as (select *, contains(u, '//file.yhse.example/') as two from x)
select attachment_id, case when downloaded then u end as chosen, case when not downloaded then u || ': ' || coalesce(download_error, '') || case when two then ' | ' || replace(u, '//file.yhse.example/', '//file2.yhse.example/') || ': ' || coalesce(download_error, '') else '' end end as reasons from m""")
def download_candidates(spark, d):
    a = _attachments(spark, d, "download_url", "downloaded", "download_error")
    tries = a.select("attachment_id", "downloaded", "download_error", F.posexplode(ft.url_candidates(F.col("download_url"), "file.yhse.example", "file2.yhse.example")).alias("place", "candidate"))
    return harvest.first_answer(tries, ["attachment_id"], "place", "downloaded", "candidate", "download_error")


@query("""with e as (select user_id, event_id // 100 as page, count(*) filter (event_type = 'purchase') as n from events group by 1, 2),
s as (select *, sum(case when n = 0 then 1 else 0 end) over (partition by user_id order by page rows between 2 preceding and current row) = 3 as stop from e),
t as (select *, coalesce(max(cast(stop as integer)) over (partition by user_id order by page rows between unbounded preceding and 1 preceding), 0) as done from s)
select user_id, page, n from t where done = 0""")
def pages_until_empty(spark, d):
    e = table(spark, d, "events", "user_id", "event_id", "event_type").groupBy("user_id", F.floor(F.col("event_id") / 100).alias("page")).agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    return harvest.pages_until_empty(e, "user_id", "page", "n", empties=3)


@query("""select attachment_id, source_id from (select *, row_number() over (partition by coalesce(nullif(content_id, ''), nullif(url, ''), nullif(attachment_name, ''), '') order by attachment_id, source_id) as n from (select distinct attachment_id, source_id, content_id, url, attachment_name from attachments)) where n = 1""")
def first_across_lists(spark, d):
    a = _attachments(spark, d, "source_id", "content_id", "url", "attachment_name")
    return harvest.first_by_any_key(a, ["content_id", "url", "attachment_name"], "attachment_id", "source_id").select("attachment_id", "source_id")


# --- payloads --------------------------------------------------------------------------------------------------------


_CLEAN_LINE = space("regexp_replace(regexp_replace(x, '<[^>]+>', '', 'g'), '(?i)<br\\s*/?>', chr(10), 'g')")


@query(f"""with t as (select doc_id, coalesce(title, '') as title, list_transform(string_split(text, chr(10) || chr(10)), lambda p: string_split(p, chr(10))) as paras from documents where text is not null),
l as (select doc_id, list_concat([title], flatten(list_transform(paras, lambda p: list_concat(['条 ' || p[1]], p[2:])))) as ls from t),
c as (select doc_id, array_to_string(list_filter(list_transform(ls, lambda x: {_CLEAN_LINE}), lambda x: x <> ''), chr(10) || chr(10)) as body from l),
s as (select doc_id, {strip("regexp_replace(regexp_replace(regexp_replace(body, '[\\t\\r\\f\\v]+', ' ', 'g'), '[ 　]+', ' ', 'g'), '\\n[ 　]+', chr(10), 'g')")} as body from c)
select doc_id, length(body) as chars, md5(body) as digest from s""")
def law_text(spark, d):
    paras = F.transform(F.split("text", "\n\n"), lambda p: F.split(p, "\n"))
    entry = F.transform(paras, lambda p: F.struct(F.lit("条").alias("title"), F.get(p, 0).alias("cntnt"), F.transform(F.slice(p, 2, F.size(p)), lambda x: F.struct(x.alias("cntnt"))).alias("itemList")))
    law = F.struct(F.struct(F.struct(F.col("title").alias("bodyAgoCntnt")).alias("law"), entry.alias("lawEntryVOs")).alias("lawlist"))
    t = table(spark, d, "documents", "doc_id", "title", "text").where("text is not null").select("doc_id", F.to_json(law).alias("payload"))
    body = nested.law_text(F.from_json("payload", nested.LAW))
    return t.select("doc_id", F.length(body).alias("chars"), F.md5(body).alias("digest"))


@query(f"""with r as (select doc_id, list_filter(coalesce(asset_classes, []), lambda x: coalesce(x, '') <> '') as a, list_filter(coalesce(product_types, []), lambda x: coalesce(x, '') <> '') as p from {_R} q)
select doc_id, array_to_string(list_filter([array_to_string(a, ' / '), array_to_string(p, ' / ')], lambda x: x <> ''), '; ') as paths from r""")
def item_paths(spark, d):
    level = lambda c: F.struct(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.struct(x.alias("itemName"))).alias("ItemLvs"))
    r = _docs(spark, d, "asset_classes", "product_types")
    j = F.from_json(F.to_json(F.struct(F.array(level(F.col("asset_classes")), level(F.col("product_types"))).alias("listTwoItem"))), "listTwoItem array<struct<ItemLvs: array<struct<itemName: string>>>>")
    return r.select("doc_id", F.array_join(nested.item_paths(j["listTwoItem"]), "; ").alias("paths"))


@query(f"select doc_id, array_to_string(list_concat(list_filter([coalesce(publisher, '')], lambda x: x <> ''), list_filter(['  ' || coalesce(title, '')], lambda x: x <> '  '), ['    ' || status, '  ' || url]), chr(10)) as lines from {_R} r where status <> '' and url <> ''")
def heading_tree(spark, d):
    leaf = lambda c: F.struct(c.alias("title"))
    r = _docs(spark, d, "publisher", "title", "status", "url").where("status <> '' and url <> ''")
    node = F.struct(F.col("publisher").alias("title"), F.array(F.struct(F.col("title"), F.array(leaf(F.col("status"))).alias("children")), F.struct(F.col("url").alias("title"), F.array().cast("array<struct<title: string>>").alias("children"))).alias("children"))
    return r.select("doc_id", nested.heading_tree(F.to_json(node)).alias("lines"))


@query("select event_id, coalesce(cast(nullif(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1), '') as bigint), -1) as k from events")
def script_wrapped(spark, d):
    e = table(spark, d, "events", "event_id", "props")
    j = F.from_json(ft.unwrapped(F.concat(F.lit("callback("), F.col("props"), F.lit(");"))), "k long")
    return e.select("event_id", F.coalesce(j["k"], F.lit(-1).cast("long")).alias("k"))


@query(f"select doc_id, coalesce(title, '') as product, coalesce(publisher, '') as party, coalesce(body_read, false) as flag, coalesce(product_types, []) as points from {_R} r")
def struct_defaults(spark, d):
    """A struct out of JSON in prose, under either spelling of its names, with defaults for what is missing."""
    r = _docs(spark, d, "title", "publisher", "body_read", "product_types")
    j = F.to_json(F.struct(F.col("title").alias("product_type"), F.col("publisher").alias("counterparty"), F.col("body_read").alias("isRead"), F.col("product_types").alias("risk_points")))
    p = F.from_json(ft.json_object(F.concat(F.lit("如下：\n```json\n"), j, F.lit("\n```\n以上"))), "productType string, product_type string, counterparty string, isRead boolean, is_read boolean, riskPoints array<string>, risk_points array<string>")
    none = F.array().cast("array<string>")
    return r.select("doc_id", F.coalesce(p["productType"], p["product_type"], F.lit("")).alias("product"), F.coalesce(p["counterparty"], F.lit("")).alias("party"), F.coalesce(p["isRead"], p["is_read"], F.lit(False)).alias("flag"), F.coalesce(p["riskPoints"], p["risk_points"], none).alias("points"))


@query("select source_id, url, gap_type from (select distinct source_id, doc_id, url, gap_type, reason from resolved_gaps) where coalesce(trim(doc_id), '') <> '' and coalesce(trim(reason), '') <> ''")
def delimited_records(spark, d):
    g = table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type", "reason").distinct()
    line = F.concat_ws("@memo@", "source_id", "url", "gap_type", F.coalesce("doc_id", F.lit(" ")), F.coalesce("reason", F.lit("")))
    rows = g.select(F.explode(fh.delimited_records(F.concat(F.lit("头@doc@"), line, F.lit("@doc@")), least=5)).alias("r"))
    return rows.select(F.get("r", 0).alias("source_id"), F.get("r", 1).alias("url"), F.get("r", 2).alias("gap_type"))


# --- texts and dates -------------------------------------------------------------------------------------------------


@query(f"select doc_id, length({clean(chr(114) + 'eplace(text, chr(160), chr(32))')}) as chars, md5({clean('replace(text, chr(160), chr(32))')}) as digest from documents")
def normal_text(spark, d):
    t = ft.clean_text(F.col("text"), nbsp=True)
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.length(t).alias("chars"), F.md5(t).alias("digest"))


@query(r"""with x as (select doc_id, published_at, effective_at, regexp_extract(published_at, '(20[0-9]{2})\s*(?:年|-|/)\s*([0-9]{1,2})\s*(?:月|-|/)\s*([0-9]{1,2})', ['y', 'm', 'd']) as p, regexp_extract(effective_at, '(20[0-9]{2})\s*(?:年|-|/)\s*([0-9]{1,2})\s*(?:月|-|/)\s*([0-9]{1,2})', ['y', 'm', 'd']) as e, regexp_extract(published_at, '^(20[0-9]{2})[-年./](0?[1-9]|1[0-2])[-月./](3[01]|[12][0-9]|0?[1-9])', ['y', 'm', 'd']) as s, regexp_extract(published_at, '(20[0-9]{2})[-年./](0?[1-9]|1[0-2])[-月./](3[01]|[12][0-9]|0?[1-9])', ['y', 'm', 'd']) as a from """ + _R + r""" r),
y as (select doc_id, published_at, case when p.y <> '' then strftime(try_strptime(p.y || '-' || p.m || '-' || p.d, '%Y-%m-%d'), '%Y-%m-%d') end as pub, case when e.y <> '' then strftime(try_strptime(e.y || '-' || e.m || '-' || e.d, '%Y-%m-%d'), '%Y-%m-%d') end as eff, case when s.y <> '' then s.y || '-' || lpad(s.m, 2, '0') || '-' || lpad(s.d, 2, '0') end as lab, case when a.y <> '' then a.y || '-' || lpad(a.m, 2, '0') || '-' || lpad(a.d, 2, '0') end as any_ from x)
select doc_id, lab as labelled, pub as published, coalesce(eff, pub) as effective, coalesce(any_, nullif(published_at, '')) as raw_date from y""")
def dates_in_text(spark, d):
    r = _docs(spark, d, "published_at", "effective_at")
    text = F.concat(F.lit("【发布日期】 "), F.coalesce("published_at", F.lit("")), F.lit("\n本办法自 "), F.coalesce("effective_at", F.lit("")), F.lit(" 起施行。自发布之日起"))
    i = ft.inferred_dates(text)
    only = F.when(F.col("published_at").isNotNull(), i["published_at"])  # without one, the first date is the other
    eff = F.coalesce(ft.loose_date(F.col("effective_at")), only)
    return r.select("doc_id", ft.labelled_date(text, "发布日期").alias("labelled"), only.alias("published"), F.when(F.col("published_at").isNull() & F.col("effective_at").isNotNull(), i["effective_at"]).otherwise(eff).alias("effective"), ft.date_or_raw(F.col("published_at")).alias("raw_date"))


@query("""with x as (select doc_id, coalesce(source, 'x') as source, coalesce(title, '无题') as name, list_filter(list_transform(string_split_regex(coalesce(text, ''), '\\r\\n|\\r|\\n'), lambda x: """ + strip("x") + """), lambda x: x <> '')[1] as line from documents)
select doc_id, case when length(line) <= 80 and not regexp_matches(line, '^[（(【]') and regexp_matches(line, '(法|办法|规则|细则|指引|指南|规范|风险揭示书)') and not contains(line, '发布') then line else """ + strip("regexp_replace(name, '[_.]', '-', 'g')") + """ end as title, regexp_replace(source, '[_.]', '-', 'g') as source_key from x""")
def titles_of_files(spark, d):
    t = table(spark, d, "documents", "doc_id", "source", "title", "text")
    plain = lambda c, none: F.regexp_replace(F.coalesce(c, F.lit(none)), "[_.]", "-")
    name = F.concat(F.lit("07_"), plain(F.col("source"), "x"), F.lit("_a_"), plain(F.col("title"), "无题"), F.lit(".docx"))
    return t.select("doc_id", ft.numbered_title(name, F.coalesce("text", F.lit(""))).alias("n")).select("doc_id", "n.title", "n.source_key")


@query("select doc_id, printf('%.2f', n_chars / 7.0) as shown from documents where n_chars is not null")
def two_digits(spark, d):
    return table(spark, d, "documents", "doc_id", "n_chars").where("n_chars is not null").select("doc_id", ft.fixed(F.col("n_chars") / 7.0).alias("shown"))


# --- selections ------------------------------------------------------------------------------------------------------


@query(f"select doc_id as secFutrsLawId, title as secFutrsLawName, publisher as lawPubOrgName, status as lawAthrtyStsCde from {_R} r where starts_with(doc_id, 'yhse_') and (contains(title, '期权') or contains(title, '互换')) and not coalesce(body_read, false)")
def hydration_rows(spark, d):
    """Documents to be filled in, under the names the search service uses."""
    r = _docs(spark, d, "title", "publisher", "status", "body_read")
    due = r.where(F.col("doc_id").startswith("yhse_") & ft.contains_any(F.col("title"), ["期权", "互换"]) & ~F.coalesce("body_read", F.lit(False)))
    return due.select(F.col("doc_id").alias("secFutrsLawId"), F.col("title").alias("secFutrsLawName"), F.col("publisher").alias("lawPubOrgName"), F.col("status").alias("lawAthrtyStsCde"))


@query("select distinct attachment_id, coalesce(regexp_matches(attachment_name, '\\.(docx|pdf)$', 'i') and not starts_with(attachment_name, '00_') and not starts_with(attachment_name, '~$'), false) as usable from (select distinct attachment_id, regexp_extract(attachment_name, '([^/]*)$', 1) as attachment_name from attachments)")
def usable_files(spark, d):
    return _attachments(spark, d, "attachment_name").select("attachment_id", F.coalesce(harvest.usable_file(F.col("attachment_name")), F.lit(False)).alias("usable")).distinct()


@query("select doc_id from documents where length(text) >= 300 and not contains(text, '请从这里开始粘贴官方正文')")
def usable_texts(spark, d):
    return table(spark, d, "documents", "doc_id", "text").where(harvest.usable_text(F.col("text"))).select("doc_id")


@query("select doc_id, coalesce(length(text) >= case source when 'yhse' then 50 when 'lzse' then 80 when 'cbank' then 101 when 'fsra' then 121 else 120 end, false) as body_read from documents")
def body_gates(spark, d):
    """Least lengths per source, as a table; a source without one has 120."""
    gates = spark.createDataFrame([("yhse", 50), ("lzse", 80), ("cbank", 101), ("fsra", 121)], "source string, least int")
    t = table(spark, d, "documents", "doc_id", "source", F.length("text").alias("n")).join(F.broadcast(gates), "source", "left")
    return t.select("doc_id", F.coalesce(F.col("n") >= F.coalesce("least", F.lit(120)), F.lit(False)).alias("body_read"))


@query(f"select distinct r.doc_id, r.title from {_R} r where doc_id in (select doc_id from resolved_gaps where gap_type = 'pdf_text_too_short')")
def ocr_targets(spark, d):
    g = table(spark, d, "resolved_gaps", "doc_id", "gap_type").where("gap_type = 'pdf_text_too_short' and doc_id is not null")
    return _docs(spark, d, "title").join(g, "doc_id", "left_semi").select("doc_id", "title")


@query("select distinct attachment_id, download_error from attachments where source_id = 'yhse' and (not coalesce(downloaded, false) or download_error = 'html instead of file') and coalesce(download_url, '') <> ''")
def retry_targets(spark, d):
    a = _attachments(spark, d, "source_id", "downloaded", "download_error", "download_url")
    due = (F.col("source_id") == "yhse") & (~F.coalesce("downloaded", F.lit(False)) | (F.coalesce("download_error", F.lit("")) == "html instead of file")) & (F.coalesce("download_url", F.lit("")) != "")
    return a.where(due).select("attachment_id", "download_error").distinct()


@query("select source_id, base_url, unnest(seed_urls) as seed from sources where source_id in ('yhse', 'lzse', 'fsra')")
def registry_projection(spark, d):
    return table(spark, d, "sources", "source_id", "base_url", "seed_urls").where(F.col("source_id").isin("yhse", "lzse", "fsra")).select("source_id", "base_url", F.explode("seed_urls").alias("seed"))


# --- lifecycles ------------------------------------------------------------------------------------------------------


_GAPS = "(select distinct source_id, attachment_id as doc_id, url, 'attachment_extract_failed' as gap_type from attachments where not downloaded union select distinct source_id, doc_id, url, gap_type from resolved_gaps)"


def _lifecycle(spark, d):
    a = _attachments(spark, d, "source_id", "url", "local_path", "downloaded", "download_error")
    docs = a.select(F.concat(F.lit("attachment_"), "attachment_id").alias("doc_id")).distinct()
    open_ = a.where(~F.col("downloaded")).select("source_id", F.col("attachment_id").alias("doc_id"), "url", F.lit("attachment_extract_failed").alias("gap_type"))
    gaps = open_.unionByName(table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type")).distinct()
    return a, docs, gaps


@query(f"select * from {_GAPS} g where gap_type <> 'attachment_extract_failed' or not exists (select 1 from attachments a where a.download_error = 'timeout' and a.source_id is not distinct from g.source_id and a.attachment_id is not distinct from g.doc_id and a.url is not distinct from g.url)")
def gaps_of_attachments(spark, d):
    a, _, gaps = _lifecycle(spark, d)
    return lifecycle.without_gaps(gaps, a.where("download_error = 'timeout'"), "attachment_extract_failed")


@query(f"""with bad as (select distinct source_id, attachment_id, url from attachments where download_error = 'html instead of file')
select 'attachment' as kind, attachment_id as id, coalesce(case when attachment_id in (select attachment_id from bad) then 'Downloaded HTML error page instead of attachment' else download_error end, '') as detail from (select distinct attachment_id, source_id, url, local_path, downloaded, download_error from attachments)
union all select distinct 'document', 'attachment_' || attachment_id, '' from attachments where attachment_id not in (select attachment_id from bad)
union all select 'gap', coalesce(doc_id, ''), gap_type from {_GAPS} g where gap_type <> 'attachment_extract_failed' or not exists (select 1 from bad where bad.source_id is not distinct from g.source_id and bad.attachment_id is not distinct from g.doc_id and bad.url is not distinct from g.url)
union all select 'gap', attachment_id, 'attachment_download_html_error' from bad""")
def error_pages_taken_back(spark, d):
    a, docs, gaps = lifecycle.drop_error_pages(*_lifecycle(spark, d), F.col("download_error") == "html instead of file")
    rows = a.select(F.lit("attachment").alias("kind"), F.col("attachment_id").alias("id"), F.coalesce("download_error", F.lit("")).alias("detail"))
    return rows.unionByName(docs.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit("").alias("detail"))).unionByName(gaps.select(F.lit("gap").alias("kind"), F.coalesce("doc_id", F.lit("")).alias("id"), F.col("gap_type").alias("detail")))


@query("select source_id, doc_id, url, gap_type, resolved_by from resolved_gaps where resolved_by <> 'retry_job' union all select source_id, doc_id, url, gap_type, 'again' from resolved_gaps where resolved_by = 'retry_job'")
def resolved_appended(spark, d):
    """Newly resolved gaps after the ones resolved before; repeats stay."""
    g = table(spark, d, "resolved_gaps", "source_id", "doc_id", "url", "gap_type", "resolved_by")
    return merge.union_sources(g.where("resolved_by <> 'retry_job'"), g.where("resolved_by = 'retry_job'").withColumn("resolved_by", F.lit("again")))


@query(f"select doc_id, title from {_R} r where authority_level = 'law' union all select doc_id, title from {_R} r where not exists (select 1 from regulatory_documents where authority_level = 'law')")
def laws_or_all(spark, d):
    r = _docs(spark, d, "title", "authority_level")
    return harvest.or_else(r.where("authority_level = 'law'"), r).select("doc_id", "title")


@query("select distinct doc_id, source_id, title, published_at, body_read from regulatory_documents")
def json_lines(spark, d):
    """Written as JSON lines with sorted keys, and read again under a fixed schema that no malformed line passes."""
    folder = shared_folder(spark)
    rows = table(spark, d, "regulatory_documents", "doc_id", "source_id", "title", "published_at", "body_read").distinct()
    files.write_jsonl(rows, folder)
    return files.read_jsonl(spark, folder, "doc_id string, source_id string, title string, published_at string, body_read boolean")


@query("select distinct attachment_id, coalesce(attachment_name, '') as attachment_name, coalesce(parent_title, '') as parent_title, download_url from attachments")
def manifest(spark, d):
    """Written as a quoted CSV with a header, and read again."""
    folder = shared_folder(spark)
    rows = _attachments(spark, d, *(F.coalesce(c, F.lit("")).alias(c) for c in ("attachment_name", "parent_title")), "download_url")
    files.write_manifest(rows, folder)
    return files.read_csv(spark, folder, rows.schema).select(*(F.coalesce(c, F.lit("")).alias(c) for c in rows.columns))


@query("select doc_id, length(text) as chars, md5(text) as digest from documents where text <> ''")
def texts_by_path(spark, d):
    """Texts written as bytes beside their ids, decoded by the charset ladder's first step and joined by id."""
    t = table(spark, d, "documents", "doc_id", "text").where("text <> ''")
    folder = shared_folder(spark)
    t.select("doc_id", F.encode("text", "UTF-8").alias("content")).write.parquet(folder)
    got = spark.read.parquet(folder).select("doc_id", F.decode("content", "UTF-8").alias("t"))
    return table(spark, d, "documents", "doc_id").join(got, "doc_id").select("doc_id", F.length("t").alias("chars"), F.md5("t").alias("digest"))


# --- reports ---------------------------------------------------------------------------------------------------------


_LEVEL = "case authority_level when 'law' then 5 when 'administrative_regulation' then 4 when 'department_rule' then 3 when 'normative_doc' then 2 when 'self_regulatory_rule' then 1 else 0 end"


@query(f"""with h as (select *, {_LEVEL} as lv from {_R} r where contains(lower(title), '期权')), n as (select greatest(count(*) - 20, 0) as more from h)
select 'authority' as sorted_by, doc_id, cast(k as integer) as place, more from (select doc_id, row_number() over (order by lv desc, doc_id) as k from h), n where k <= 20
union all select 'date', doc_id, cast(k as integer), more from (select doc_id, row_number() over (order by coalesce(published_at, '') desc, doc_id) as k from h), n where k <= 20
union all select 'score', doc_id, cast(k as integer), more from (select doc_id, row_number() over (order by length(title) desc, doc_id) as k from h), n where k <= 20""")
def sorted_hits(spark, d):
    hits = _docs(spark, d, "title", "authority_level", "published_at").where(report.matches("期权", "title")).withColumn("score", F.length("title").cast("double"))
    levels = {"law": 5, "administrative_regulation": 4, "department_rule": 3, "normative_doc": 2, "self_regulatory_rule": 1}
    return merge.union_sources(*(report.sorted_hits(hits, by, "doc_id", levels=levels).select(F.lit(by).alias("sorted_by"), "doc_id", "place", "more") for by in ("authority", "date", "score")))


@query("""select '{"summary":[' || string_agg('{"source_id":"' || source_id || '","saved":' || saved || ',"gaps":' || gaps || '}', ',' order by source_id) || ']}' as summary from (select coalesce(source_id, 'unknown') as source_id, count(*) filter (downloaded) as saved, count(*) filter (not downloaded) as gaps from (select distinct attachment_id, source_id, downloaded from attachments) group by 1)""")
def run_summary(spark, d):
    return report.run_summary(_attachments(spark, d, "source_id", "downloaded"), "source_id", saved=F.col("downloaded"), gaps=~F.col("downloaded"))


@query(f"select (select count(*) from {_R} r) as imported, (select count(*) from resolved_gaps) as resolved, (select count(*) from resolved_gaps where resolved_by = 'ocr_pass') as resolved_this_run, (select count(*) from (select distinct attachment_id from attachments where not downloaded)) as skipped")
def import_totals(spark, d):
    g = table(spark, d, "resolved_gaps", "resolved_by").agg(F.count("*").alias("resolved"), F.count_if(F.col("resolved_by") == "ocr_pass").alias("resolved_this_run"))
    imported, skipped = _docs(spark, d).agg(F.count("*").alias("imported")), _attachments(spark, d, "downloaded").where(~F.col("downloaded")).select("attachment_id").distinct().agg(F.count("*").alias("skipped"))
    return imported.join(g).join(skipped).select("imported", "resolved", "resolved_this_run", "skipped")  # one row each


@query("select 'clauses' as name, count(*) as n from (select distinct clause_id from clauses) union all select 'documents', count(*) from (select distinct doc_id from regulatory_documents) union all select 'evidence', count(*) from (select distinct evidence_id from evidence_ledger) union all select 'gaps', count(*) from (select distinct source_id, doc_id, url, gap_type from resolved_gaps)")
def table_counts(spark, d):
    tables = {"clauses": ("clauses", ["clause_id"]), "documents": ("regulatory_documents", ["doc_id"]), "evidence": ("evidence_ledger", ["evidence_id"]), "gaps": ("resolved_gaps", ["source_id", "doc_id", "url", "gap_type"])}
    return merge.union_sources(*(table(spark, d, t, *keys).distinct().agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, (t, keys) in tables.items()))


_MD = "replace(coalesce({0}, ''), '|', '/')"


def _md(*cells: str) -> str:
    return "'| ' || " + " || ' | ' || ".join(_MD.format(c) for c in cells) + " || ' |'"


_LINK = "case when coalesce(url, '') <> '' then '[原文](' || url || ')' else '原文' end"


@query(f"""with e as (select * from (select *, row_number() over (partition by evidence_id order by title, url) as k from evidence_ledger) where k = 1),
r as (select coalesce(source_id, 'unknown') as source_id, row_number() over (partition by coalesce(source_id, 'unknown') order by coalesce(published_at, '') desc, coalesce(title, '') desc, evidence_id) as line_no, {_md("substring(coalesce(title, ''), 1, 120)", "coalesce(published_at, '') || case when coalesce(effective_at, '') <> '' then ' / ' || effective_at else '' end", "verification_status", "array_to_string(tags[1:6], ', ')", _LINK)} as line from e)
select source_id, 2 as part, cast(line_no as integer) as line_no, line from r
union all select null, 0, 0, '# 已核验证据账本' union all select null, 0, 1, ''
union all select source_id, 1, 0, '## ' || source_id from (select distinct source_id from r) union all select source_id, 1, 1, '' from (select distinct source_id from r) union all select source_id, 1, 2, '| 文件 | 发布/生效 | 核验状态 | 关键标签 | 原文 |' from (select distinct source_id from r) union all select source_id, 1, 3, '|---|---|---|---|---|' from (select distinct source_id from r)""")
def evidence_page(spark, d):
    e = merge.last_per_key(table(spark, d, "evidence_ledger", "evidence_id", "source_id", "title", "published_at", "effective_at", "verification_status", "tags", "url"), ["evidence_id"], [])
    e = e.withColumn("source_id", F.coalesce("source_id", F.lit("unknown")))
    date = F.concat(F.coalesce("published_at", F.lit("")), F.when(F.coalesce("effective_at", F.lit("")) != "", F.concat(F.lit(" / "), "effective_at")).otherwise(""))
    cells = [F.substring("title", 1, 120), date, F.col("verification_status"), F.array_join(F.slice("tags", 1, 6), ", "), report.md_link(F.lit("原文"), F.col("url"))]
    rows = report.md_table(e, "source_id", cells, F.desc(F.coalesce("published_at", F.lit(""))), F.desc(F.coalesce("title", F.lit(""))), F.col("evidence_id"))
    return report.md_page(["# 已核验证据账本", ""], ["文件", "发布/生效", "核验状态", "关键标签", "原文"], rows, "source_id")


@query(f"select source_id, {_md('publisher', 'authority_level', chr(97) + 'rray_to_string(asset_classes, chr(44) || chr(32))', 'array_to_string(product_types[1:8], chr(44) || chr(32))', 'crawl_notes')} as line from sources")
def sources_page(spark, d):
    s = table(spark, d, "sources", "source_id", "publisher", "authority_level", "asset_classes", "product_types", "crawl_notes")
    return s.select("source_id", report.md_row(F.col("publisher"), F.col("authority_level"), F.array_join("asset_classes", ", "), F.array_join(F.slice("product_types", 1, 8), ", "), F.col("crawl_notes")).alias("line"))


@query(f"select cast(row_number() over (order by resolved_at desc nulls last, url desc nulls last, gap_type desc nulls last, source_id desc nulls last, reason desc nulls last) as integer) as place, {_md('source_id', 'gap_type', 'substring(reason, 1, 180)', 'resolved_at')} as line from (select distinct source_id, url, gap_type, reason, resolved_at from resolved_gaps) order by place limit 500")
def gaps_page(spark, d):
    g = report.last_n(table(spark, d, "resolved_gaps", "source_id", "url", "gap_type", "reason", "resolved_at").distinct(), 500, "resolved_at", "url", "gap_type", "source_id", "reason")
    line = report.md_row(F.col("source_id"), F.col("gap_type"), F.substring("reason", 1, 180), F.col("resolved_at"))
    return g.withColumn("all", F.lit(0)).transform(lambda x: report.numbered(x, "all", *(F.desc_nulls_last(c) for c in ("resolved_at", "url", "gap_type", "source_id", "reason")))).select(F.col("line_no").alias("place"), line.alias("line"))


@query("""with m as (select user_id, event_id, event_type, row_number() over (partition by user_id order by event_id desc) as k from events where event_type = 'click') select user_id, event_id, cast(k as integer) as place from m where k <= 20""")
def query_history(spark, d):
    return report.history(table(spark, d, "events", "user_id", "event_id", "event_type"), "user_id", "event_id", "event_type", "click").select("user_id", "event_id", "place")


@query(f"""select doc_id, array_to_string(list_filter(['结论: ' || coalesce(status, ''), '── 法规依据 ──' || chr(10) || '1. 《' || coalesce(title, '') || '》' || case when coalesce(authority_level, '') <> '' then ' 第' || authority_level || '条' else '' end || case when coalesce(url, '') <> '' then chr(10) || '   ' || url else '' end, case when len(product_types) > 0 then '── 待补充信息 ──' || chr(10) || array_to_string(list_transform(product_types, lambda x: '- ' || x), chr(10)) end], lambda x: x is not null), chr(10) || chr(10)) as report from {_R} r""")
def plain_report(spark, d):
    r = _docs(spark, d, "status", "title", "authority_level", "url", "product_types")
    basis = F.array(F.struct("title", F.col("authority_level").alias("article"), "url"))
    return r.select("doc_id", report.plain_report(F.concat(F.lit("结论: "), F.coalesce("status", F.lit(""))), basis, F.col("product_types")).alias("report"))
