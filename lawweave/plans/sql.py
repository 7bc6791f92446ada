"""DuckDB SQL of the core queries, written from their definitions and not from their plans."""

from __future__ import annotations

# The weights of the levels of authority, as the definition states them.
AUTHORITY = {"law": 5.0, "administrative_regulation": 4.5, "department_rule": 4.0, "normative_doc": 3.0, "self_regulatory_rule": 2.5, "exchange_rule": 2.0, "business_guideline": 1.5}
QUERY = "场外期权 备案"
_WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_DELIM = r"[，。、；：！？（）【】《》" + "\"'" + r"「」『』\[\]\t-\r\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
_NUM = "一二三四五六七八九十百千万零〇两0-9"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


def clean(x: str) -> str:
    a = f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"
    b = f"regexp_replace({a}, '[ \\t　]+', ' ', 'g')"
    return strip(f"regexp_replace({b}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def space(x: str) -> str:
    for a, b in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&mdash;", "—"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    x = f"regexp_replace({x}, '[\\t\\r\\f\\v]+', ' ', 'g')"
    x = f"regexp_replace({x}, '[ 　]+', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n[ 　]+', chr(10), 'g')"
    return strip(f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def words(x: str) -> str:
    delim = _DELIM.replace("'", "''")
    return f"list_filter(string_split_regex(coalesce({x}, ''), '{delim}'), lambda w: length(w) >= 2)"


def tokens(x: str) -> str:
    return f"flatten(list_transform({words(x)}, lambda w: list_concat([w], list_transform(range(1, length(w)), lambda i: substring(w, i, 2)))))"


def chunks(rows: str, most: int = 1200, overlap: int = 160) -> str:
    """(doc_id, x, pos) of the greedy chunks of ``rows`` (doc_id, t), by recursion over the paragraphs: one step closes or extends the open chunk."""
    room = f"length(open) + length(p) + 2 <= {most}"
    return f"""with recursive para as (select doc_id, list_filter(list_transform(string_split_regex(t, '\\n{{2,}}'), lambda x: {strip('x')}), lambda x: x <> '') as ps from ({rows})),
step(doc_id, i, open, out) as (select doc_id, 1, '', []::varchar[] from para
union all select doc_id, i + 1, case when {room} then case when open <> '' then open || chr(10) || chr(10) || p else p end when length(p) <= {most} then p else '' end,
case when {room} then []::varchar[] when length(p) <= {most} then list_filter([open], lambda x: x <> '') else list_concat(list_filter([open], lambda x: x <> ''), list_transform(range(0, length(p), {most - overlap}), lambda j: substring(p, j + 1, {most}))) end
from (select s.doc_id, s.i, s.open, q.ps[s.i] as p from step s join para q using (doc_id) where s.i <= len(q.ps))),
last as (select s.doc_id, s.i, list_filter([s.open], lambda x: x <> '') as out from step s join para q using (doc_id) where s.i = len(q.ps) + 1),
pieces as (select doc_id, i, out from step union all select doc_id, i + 1, out from last),
u as (select doc_id, i, unnest(out) as x, generate_subscripts(out, 1) as j from pieces)
select doc_id, x, row_number() over (partition by doc_id order by i, j) - 1 as pos from u"""


_C = "(select * from (select *, row_number() over (partition by clause_id order by retrieved_at desc nulls last, coalesce(source_id, '') desc) as rn from clauses where clause_id <> '') where rn = 1)"
_R = "(select * from (select *, row_number() over (partition by doc_id order by retrieved_at desc nulls last) as rn from regulatory_documents where doc_id <> '') where rn = 1)"
_E = "(select * from (select *, row_number() over (partition by evidence_id) as rn from evidence_ledger) where rn = 1)"
_EV_TEXT = "array_to_string(list_filter(list_concat([title, support_scope], coalesce(tags, []), [publisher]), lambda x: coalesce(x, '') <> ''), ' ')"
_TITLE_TEXT = "array_to_string(list_filter([coalesce(title, ''), array_to_string(coalesce(heading_path, []), ' ')], lambda x: x <> ''), ' ')"
_FULL_TEXT = "(coalesce(title, '') || ' ' || coalesce(text, ''))"
# The terms of the query: its own, those of the keywords that share a source with a keyword it holds (or the first two
# signs of which it holds), and those of that source's product types, with and without underscores.
_KEYS = "select distinct s.source_id, s.include_keywords, s.product_types, k.key from sources s, (select distinct unnest(include_keywords) as key from sources) k where list_contains(s.include_keywords, k.key) and k.key <> '' and (contains('{q}', k.key) or contains('{q}', substring(k.key, 1, 2)))"
_TAX_TERMS = f"select distinct unnest(product_types) as x from ({_KEYS.replace('{q}', QUERY)})"
_WIDE = f"select '{QUERY}' as x union select x from (select key, unnest(include_keywords) as x from ({_KEYS.replace('{q}', QUERY)})) where x <> key union select x from ({_TAX_TERMS}) union select replace(x, '_', ' ') from ({_TAX_TERMS})"
_TERM_ROWS = f"select unnest({tokens('x')}) as x from ({_WIDE}) union select x from ({_WIDE}) where length(x) >= 2"


def scored(name: str, rows: str, id: str, text: str, toks: str) -> str:
    """CTEs that end in ``name`` (id, bm25) for the search's query."""
    return f"""
{name}_d as (select {id} as id, {text} as t from {rows} as q),
{name}_p as (select id, term, count(*) as freq, any_value(dl) as dl from (select id, length(t) as dl, unnest({toks}) as term from {name}_d) where term in (select x from ({_TERM_ROWS}) as v(x)) group by id, term),
{name}_f as (select term, count(*) as df from {name}_p group by term),
{name}_s as (select count(*) as n, coalesce(avg(length(t)), 0) as avgdl from {name}_d),
{name} as (select id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * (2.5 * freq / (freq + 1.5 * (0.25 + 0.75 * (dl / avgdl))))) as bm25 from {name}_p join {name}_f using (term), {name}_s group by id)"""


_WEIGHT = "case authority_level " + " ".join(f"when '{k}' then {v}::double" for k, v in AUTHORITY.items()) + " else 1::double end"
_TAXLIST = f"(select coalesce(list(x), []) from ({_TAX_TERMS}))"
_BOOST = f"(case when list_has_any(coalesce(product_types, []), {_TAXLIST}) then 1.3::double else 1::double end * case when list_has_any(coalesce(asset_classes, []), {_TAXLIST}) then 1.15::double else 1::double end)"

SQL: dict[str, str] = {
    "scan_project_hit": "select clause_id, coalesce(title, '') as title, coalesce(url, '') as url, coalesce(published_at, '') as published_at, coalesce(article_no, '') as article_no, substring(coalesce(text, ''), 1, 300) as excerpt from clauses",
    "clean_text": f"select doc_id, length({clean('text')}) as chars, md5({clean('text')}) as digest from documents",
    "clean_space": f"select clause_id, length({space('text')}) as chars, md5({space('text')}) as digest from clauses",
    "title_infer": f"""with g as (select doc_id, title, coalesce({strip('title')}, '') in ('', '目录页', '首页') as generic, substring(list_filter(list_transform(string_split_regex(coalesce(text, ''), '\\r\\n|\\r|\\n'), lambda x: {strip('x')}), lambda x: x <> '' and not (starts_with(x, '|') or starts_with(x, 'English') or starts_with(x, '移动端') or starts_with(x, '微博') or starts_with(x, '微信') or starts_with(x, '无障碍')))[1], 1, 160) as line from documents),
i as (select *, generic and coalesce(line, '') not in ('', '目录页', '首页') as inferred from g)
select doc_id, case when inferred then line else title end as title, inferred as title_inferred from i""",
    "id_hash": "select url, coalesce(source_id, 'none') || '_' || substring(sha1(url), 1, 12) as made_id, sha256(coalesce(title, '')) as title_sha from regulatory_documents",
    "date_normalise": r"""with x as (select doc_id, effective_at, regexp_extract(published_at, '(20[0-9]{2})[-年./](0?[1-9]|1[0-2])[-月./](3[01]|[12][0-9]|0?[1-9])', ['y', 'm', 'd']) as p, regexp_extract(effective_at, '(20[0-9]{2})[-/年.](0?[1-9]|1[0-2])[-/月.](3[01]|[12][0-9]|0?[1-9])', ['y', 'm', 'd']) as e from regulatory_documents),
y as (select doc_id, effective_at, case when p.y <> '' then p.y || '-' || lpad(p.m, 2, '0') || '-' || lpad(p.d, 2, '0') end as a, case when e.y <> '' then e.y || '-' || lpad(e.m, 2, '0') || '-' || lpad(e.d, 2, '0') end as b from x)
select doc_id, a as published_on, coalesce(b, nullif(substring(effective_at, 1, 10), '')) as effective_on, strftime(try_strptime(a, '%Y-%m-%d'), '%Y%m%d') as published_day from y""",
    "url_host_allow": "with x as (select doc_id, allowed_domains, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as h from regulatory_documents join sources using (source_id)) select distinct doc_id, h as host, coalesce(len(list_filter(allowed_domains, lambda d: h = lower(d) or ends_with(h, '.' || lower(d)))) > 0, false) as allowed from x",
    "keyword_filter": "select distinct doc_id from regulatory_documents r join sources s using (source_id) where coalesce(len(include_keywords), 0) = 0 or coalesce(len(list_filter(include_keywords, lambda k: k <> '' and contains(r.title, k))) > 0, false)",
    "attachment_suffix": r"select distinct attachment_id, coalesce(nullif(lower(regexp_extract(attachment_path, '(\.[^./?#]+)(?:[?#].*)?$', 1)), ''), nullif(lower(regexp_extract(attachment_name, '(\.[^./?#]+)(?:[?#].*)?$', 1)), ''), '.bin') as suffix from attachments",
    "body_gate": "select doc_id, coalesce(length(text) >= 120, false) as body_read from documents",
    "json_props": """select event_id, coalesce(cast(nullif(regexp_extract(props, '"k": *(-?[0-9]+)', 1), '') as bigint), -1) as k from events""",
    "epoch_date": "select event_id, strftime(ts + interval 8 hour, '%Y-%m-%d') as day from events",
    "article_split": f"""with t as (select doc_id, {clean('text')} as t from documents where text is not null),
s as (select doc_id, string_split(regexp_replace(t, '(第[{_NUM}]+条)', chr(1) || '\\1', 'g'), chr(1)) as cut from t),
f as (select doc_id, list_filter(list_transform(cut[2:], lambda x: {strip('x')}), lambda x: length(x) > 20) as parts from s where (case when {strip('cut[1]')} <> '' then 1 else 0 end) + 2 * (len(cut) - 1) >= 4),
u as (select doc_id, unnest(parts) as x, generate_subscripts(parts, 1) - 1 as pos from f)
select doc_id, cast(pos as integer) as pos, regexp_extract(x, '^(第[{_NUM}]+条)', 1) as article_no, length(x) as chars, md5(x) as digest from u""",
    "article_split_repeated": f"""with t as (select doc_id, {clean('text')} as t from documents where text is not null),
s as (select doc_id, string_split(regexp_replace(t, '(第[{_NUM}]+条)', chr(1) || '\\1', 'g'), chr(1)) as cut from t),
f as (select doc_id, list_filter(list_transform(cut[2:], lambda x: regexp_extract(x, '^(第[{_NUM}]+条)', 1) || {strip('x')}), lambda x: length(x) > 20) as parts from s where (case when {strip('cut[1]')} <> '' then 1 else 0 end) + 2 * (len(cut) - 1) >= 4),
u as (select doc_id, unnest(parts) as x, generate_subscripts(parts, 1) - 1 as pos from f)
select doc_id, cast(pos as integer) as pos, regexp_extract(x, '^(第[{_NUM}]+条)', 1) as article_no, length(x) as chars, md5(x) as digest from u""",
    "size_chunk": f"select doc_id, cast(pos as integer) as pos, length(x) as chars, md5(x) as digest from ({chunks('select doc_id, ' + clean('text') + ' as t from documents where text is not null')})",
    "long_slices": "with u as (select doc_id, text, unnest(case when length(text) > 1200 then range(0, length(text), 1040) when length(text) > 0 then [0] else [] end) as i from documents where text is not null) select doc_id, cast(i as integer) as start_at, length(substring(text, i + 1, 1200)) as chars, md5(substring(text, i + 1, 1200)) as digest from u",
    "heading_path": f"""select doc_id, array_to_string(list_filter(list_transform(string_split_regex(text, '\\r\\n|\\r|\\n')[1:20], lambda x: {strip('x')}), lambda x: regexp_matches(x, '^(第[{_NUM}]+[章节编]|附[件录]|[一二三四五六七八九十]+、).{{0,80}}$'))[-3:], ' / ') as path from documents""",
    "tokenize_titles": f"select doc_id, array_to_string({tokens('title')}, '¦') as tokens from {_R} r",
    "term_freq": f"select term, doc_id, count(*) as freq, any_value(dl) as length from (select doc_id, length(coalesce(title, '')) as dl, unnest({tokens('title')}) as term from {_R} r) group by term, doc_id",
    "doc_freq": f"select term, count(*) as df, cast(sum(n) as bigint) as cf from (select clause_id, term, count(*) as n from (select clause_id, unnest({words(_FULL_TEXT)}) as term from {_C} c) group by clause_id, term) group by term",
    "corpus_stats": f"select count(*) as n, round(coalesce(avg(length({_FULL_TEXT})), 0), 6) as avgdl from {_C} c",
    "posting_cap": f"select doc_id, word, cast(rank as integer) as rank from (select doc_id, word, row_number() over (partition by word order by doc_id) as rank from (select distinct doc_id, unnest({words('title')}) as word from {_R} r)) where rank <= 200",
    "facets": f"""with c as (select * from {_C} q), p as (select clause_id, 'authority_level' as facet, coalesce(authority_level, 'unknown') as value from c union select clause_id, 'source_id', coalesce(source_id, 'unknown') from c union select clause_id, 'product_types', unnest(product_types) from c union select clause_id, 'asset_classes', unnest(asset_classes) from c) select facet, value, count(*) as n from p group by facet, value""",
    "query_expand": f"with d as (select distinct a.key as k, b.x from (select source_id, unnest(include_keywords) as key from sources) a join (select source_id, unnest(include_keywords) as x from sources) b using (source_id) where a.key <> b.x and a.key <> ''), e as (select * from {_E} q where trim(title) <> '') select distinct evidence_id, x as expansion from e join d on contains(title, k) or contains(title, substring(k, 1, 2)) union select evidence_id, title from e",
    "bm25_evidence": f"with {scored('a', _E, 'evidence_id', _EV_TEXT, tokens('t'))} select id as evidence_id, round(bm25, 6) as bm25 from a",
    "bm25_title": f"with {scored('a', _C, 'clause_id', _TITLE_TEXT, tokens('t'))} select id as clause_id, round(bm25, 6) as bm25 from a",
    "search_full": f"""with {scored('a', _E, 'evidence_id', _EV_TEXT, tokens('t'))}, {scored('b', _C, 'clause_id', _TITLE_TEXT, tokens('t'))}, {scored('c', _C, 'clause_id', _FULL_TEXT, words('t'))},
cl as (select id, bm25, 2 as stage from b union all select id, bm25, 3 from c where id not in (select id from b)),
h as (select 'evidence' as source, 1 as stage, id, coalesce(title, '') as title, substring(coalesce(support_scope, ''), 1, 300) as excerpt, floor(bm25 * 2 * 100 + 0.5) / 100 as score from a join {_E} e on e.evidence_id = a.id
union all select 'clause', stage, id, coalesce(title, ''), substring(coalesce(text, ''), 1, 300), floor(bm25 * {_WEIGHT} * {_BOOST} * 100 + 0.5) / 100 from cl join {_C} q on q.clause_id = cl.id),
u as (select * from (select *, row_number() over (partition by title, substring(excerpt, 1, 80) order by score desc, stage, id) as k from h) where k = 1),
v as (select * from (select *, row_number() over (partition by source order by score desc, stage, id) as j from u) where j <= case source when 'evidence' then 10 else 20 end)
select * from (select cast(row_number() over (order by case source when 'evidence' then 0 else 1 end, score desc, stage, id) as integer) as rank, source, id, title, excerpt, score from v) where rank <= 25""",
    "keyword_search": f"""with c as (select clause_id as id, {_FULL_TEXT} as t from {_C} q), s as (select id, t, (length(t) - length(replace(lower(t), '场外期权', ''))) // 4 * 4 + (length(t) - length(replace(lower(t), 'otc', ''))) // 3 * 3 as score from c), k as (select * from s where score > 0 order by score desc, id limit 8)
select id, cast(score as integer) as score, translate(substring(t, greatest(0, least(case when instr(lower(t), '场外期权') > 0 then instr(lower(t), '场外期权') else 999999999 end, case when instr(lower(t), 'otc') > 0 then instr(lower(t), 'otc') else 999999999 end) - 81) + 1, 240), chr(10), ' ') as preview from k""",
    "kwic_preview": """with p as (select doc_id, text, least(coalesce(nullif(instr(lower(text), '场外期权'), 0), 999999999), coalesce(nullif(instr(lower(text), 'otc'), 0), 999999999)) as pos from documents)
select doc_id, coalesce(translate(substring(text, greatest(0, case when pos = 999999999 then 1 else pos end - 81) + 1, 240), chr(10), ' '), '') as preview from p""",
    "taxonomy_overlap": f"select r.doc_id, list_has_any(r.asset_classes, s.asset_classes) as assets, list_has_any(r.product_types, s.product_types) as products from {_R} r join sources s using (source_id)",
    "first_match_title": f"with k as (select distinct title as key from evidence_ledger where title is not null), c as (select * from {_C} q where article_no <> ''), m as (select key, min_by(article_no, clause_id) as a, min(clause_id) as clause_id from k join c on key <> '' and contains(lower(c.title), lower(key)) group by key) select k.key, m.clause_id, regexp_replace(regexp_replace(m.a, '^第', ''), '条$', '') as article from k left join m using (key)",
    "choose_best": f"with r as (select source_id, doc_id as id, title, coalesce(published_at, '') as date, regexp_replace(coalesce(title, ''), '\\s+', '', 'g') as t, status, authority_level from {_R} q where source_id is not null), s as (select *, contains(t, '场外期权') as holds, cast((case when t = '中华人民共和国场外期权' then 5 else 0 end) + (case when contains(t, '场外期权') then 2 else 0 end) + (case when status = 'effective' then 2 else 0 end) + (case when authority_level = 'law' then 2 else 0 end) as integer) as score from r) select source_id, id, title, date, score from (select *, row_number() over (partition by source_id order by holds desc, score desc, date desc, id) as k from s) where k = 1",
    "dedupe_title_excerpt": f"select id, score from (select clause_id as id, cast(length(coalesce(text, '')) as double) as score, row_number() over (partition by coalesce(title, ''), substring(coalesce(text, ''), 1, 80) order by length(coalesce(text, '')) desc, clause_id) as k from {_C} c) where k = 1",
    "latest_by_key": "select clause_id, max(retrieved_at) as retrieved_at, any_value(title) as title from clauses group by clause_id",
    "incremental_upsert": f"select doc_id, retrieved_at, title, status from {_R} r",
    "upsert_documents": f"with g as (select doc_id, max(resolved_at) as retrieved_at from resolved_gaps where doc_id is not null group by doc_id) select doc_id, retrieved_at, title, status from {_R} r where doc_id not in (select doc_id from g) union all select doc_id, retrieved_at, null, 'manual' from g",
    "field_merge": f"select r.doc_id, coalesce(nullif(r.publisher, ''), nullif(s.publisher, '')) as publisher, coalesce(nullif(s.authority_level, ''), nullif(r.authority_level, '')) as authority_level, array_to_string(case when len(r.asset_classes) > 0 then r.asset_classes when len(s.asset_classes) > 0 then s.asset_classes end, ',') as assets from {_R} r left join sources s using (source_id)",
    "registry_lookup": f"select r.doc_id, r.authority_level, s.authority_level as registered, r.authority_level is distinct from s.authority_level as deviates from {_R} r left join sources s using (source_id)",
    "gap_dedupe": "select distinct source_id, doc_id, url, gap_type from resolved_gaps",
    "gap_new_anti": "select distinct source_id, doc_id, url, gap_type from resolved_gaps g where coalesce(resolved_by, '') <> 'retry_job' and not exists (select 1 from resolved_gaps o where o.resolved_by = 'retry_job' and o.source_id is not distinct from g.source_id and o.doc_id is not distinct from g.doc_id and o.url is not distinct from g.url and o.gap_type is not distinct from g.gap_type)",
    "gap_join": f"select doc_id, title, body_read from {_R} r where doc_id in (select doc_id from resolved_gaps)",
    "gap_resolve_split": "with d as (select content_id, source_id from attachments where downloaded) select distinct source_id, doc_id, url, gap_type, case when coalesce(doc_id in (select content_id from d), false) or (source_id in ('mzce', 'lzse') and source_id in (select source_id from d)) then 'resolved' else 'open' end as state from resolved_gaps",
    "gap_replace": "with g as (select distinct source_id, doc_id, url, gap_type from resolved_gaps), r as (select distinct source_id, doc_id from g where gap_type = 'pdf_text_too_short') select * from g where not exists (select 1 from r where r.source_id is not distinct from g.source_id and r.doc_id is not distinct from g.doc_id) union select source_id, doc_id, '', 'retried' from r where doc_id is not null",
    "evidence_urls": f"select doc_id, coalesce(url in (select url from evidence_ledger where url <> ''), false) as has_evidence from {_R} r",
    "seen_set_anti": "select distinct content_id from attachments where content_id is not null and content_id not in (select doc_id from resolved_gaps where doc_id is not null)",
    "attachment_merge": "select attachment_path, attachment_id, case when downloaded then 'ok' else coalesce(nullif(download_error, ''), 'missing') end as state from (select *, row_number() over (partition by attachment_path order by retrieved_at desc) as k from attachments where attachment_path <> '') where k = 1",
    "attachment_retry": "select distinct attachment_id, source_id, download_error from attachments where not coalesce(downloaded, false) and coalesce(download_url, '') <> ''",
    "union_sources": f"select doc_id, source_id, title, content_type, null as parent_title from {_R} r union all select distinct 'attachment_' || attachment_id, source_id, attachment_name, null, parent_title from attachments",
    "report_by_source": f"select coalesce(source_id, 'unknown') as source_id, count(*) as n, count(*) filter (body_read) as read, count(*) filter (coalesce(effective_at, '') <> '') as dated from {_R} r group by 1",
    "crawl_counters": "select coalesce(source_id, 'unknown') as source_id, count(*) as n, count(*) filter (downloaded) as saved, count(*) filter (not downloaded) as gaps from (select distinct attachment_id, source_id, downloaded from attachments) group by 1",
    "quota_per_source": f"select source_id, doc_id, cast(k as integer) as place from (select source_id, doc_id, row_number() over (partition by source_id order by coalesce(published_at, '') desc, coalesce(title, '') desc, doc_id) as k from {_R} r where source_id is not null) where k <= 5",
    "last_gaps": "select distinct source_id, url, gap_type, resolved_at from resolved_gaps order by resolved_at desc nulls last, url desc nulls last, gap_type desc nulls last, source_id desc nulls last limit 50",
    "ui_filter_sort": f"select doc_id, case authority_level {' '.join(f'when {chr(39)}{k}{chr(39)} then {i}' for i, k in enumerate(AUTHORITY))} else {len(AUTHORITY)} end as level_rank from {_R} r where contains(lower(title), 'otc') or contains(lower(publisher), 'otc')",
    "score_band": "select doc_id, case when coalesce(n_chars / 2000.0, 0) >= 0.7 then 'high' when coalesce(n_chars / 2000.0, 0) >= 0.4 then 'medium' else 'low' end as band from documents",
    "markdown_rows": f"select source_id, cast(row_number() over (partition by source_id order by coalesce(published_at, '') desc, coalesce(title, '') desc, doc_id) as integer) as line_no, '| ' || replace(case when coalesce(url, '') <> '' then '[' || replace(substring(coalesce(title, ''), 1, 120), '|', '/') || '](' || url || ')' else replace(substring(coalesce(title, ''), 1, 120), '|', '/') end, '|', '/') || ' | ' || replace(coalesce(published_at, ''), '|', '/') || ' |' as line from {_R} r where source_id is not null",
}
SQL["search_scan"] = SQL["search_full"]
# A document's articles, or its chunks where it has none.
_CLEAN_DOCS = f"select doc_id, {clean('text')} as t from documents where text is not null"
_HEADS = f"array_to_string(list_filter(list_transform(string_split_regex(t, '\\r\\n|\\r|\\n')[1:20], lambda x: {strip('x')}), lambda x: regexp_matches(x, '^(第[{_NUM}]+[章节编]|附[件录]|[一二三四五六七八九十]+、).{{0,80}}$'))[-3:], ' / ')"
SQL["clause_rows"] = f"""with a as (select doc_id, t, string_split(regexp_replace(t, '(第[{_NUM}]+条)', chr(1) || '\\1', 'g'), chr(1)) as cut from ({_CLEAN_DOCS}) where t <> ''),
f as (select doc_id, case when (case when {strip('cut[1]')} <> '' then 1 else 0 end) + 2 * (len(cut) - 1) >= 4 then list_filter(list_transform(cut[2:], lambda x: {strip('x')}), lambda x: length(x) > 20) else [] end as parts from a),
ch as ({chunks(_CLEAN_DOCS)}),
u as (select doc_id, unnest(parts) as x, generate_subscripts(parts, 1) - 1 as pos from f union all select doc_id, x, pos from ch where doc_id in (select doc_id from f where len(parts) = 0))
select u.doc_id || '_c' || lpad(cast(pos + 1 as varchar), 4, '0') as clause_id, u.doc_id as doc_id, regexp_extract(x, '^(第[{_NUM}]+条)', 1) as article_no, title as cited_title, length(x) as chars from u join documents d on d.doc_id = u.doc_id"""
