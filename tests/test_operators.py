"""Operators: known values and brute force; nulls, empties, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lawweave.operators import harvest, index, lifecycle, merge, report, search, segment, stored

SAMPLE = "前言。\n第一条 为规范交易行为，保护投资者合法权益，制定本办法。\n第二条 证券公司依照第一条规定开展收益互换业务，应当履行备案程序。\n第三条 短。"


def articles(spark, text, **kw):
    return spark.createDataFrame([(text,)], "t string").select(segment.split_articles(F.col("t"), **kw).alias("a")).first().a


def test_articles(spark):
    a, b = "为规范交易行为，保护投资者合法权益，制定本办法。", "规定开展收益互换业务，应当履行备案程序。"
    assert articles(spark, SAMPLE) == [f"第一条 {a}", f"第一条{b}"]
    assert articles(spark, SAMPLE, repeat_marker=True) == [f"第一条第一条 {a}", f"第一条第一条{b}"]
    assert articles(spark, "没有条文") == [] and articles(spark, "") == [] and articles(spark, None) is None


def check_chunks(chunks, paragraphs, most=1200, overlap=160):
    """What greedy packing has to fulfil: all signs in order, no chunk too long, no pair of neighbours that would fit, overlaps of long paragraphs."""
    signs, done = "".join(paragraphs), 0
    long_ = [p for p in paragraphs if len(p) > most]
    for k, c in enumerate(chunks):
        assert 0 < len(c) <= most
        plain = c.replace("\n\n", "")
        if not signs.startswith(plain, done):  # a slice of a long paragraph begins before the end of the one before
            done = signs.find(plain, done - overlap)
            assert done >= 0 and any(plain in p for p in long_)
        elif k and not any(x.endswith(chunks[k - 1]) or x.startswith(c[:most]) for x in long_):
            first = c.split("\n\n", 1)[0]
            assert len(chunks[k - 1]) + len(first) + 2 > most
        done += len(plain)
    assert done >= len(signs)


@pytest.mark.parametrize(("lengths", "want"), [([700, 498, 10, 2500, 1], [1200, 10, 1200, 1200, 420, 1]), ([700, 499], [700, 499]), ([1200], [1200]), ([1201], [1200, 161]), ([], []), ([1, 1, 1], [7])])
def test_chunks_by_size(spark, lengths, want):
    text = "\n\n".join("字" * n for n in lengths)
    got = spark.createDataFrame([(text,)], "t string").select(segment.chunk_by_size(F.col("t")).alias("c")).first().c
    assert [len(c) for c in got] == want


def test_chunks_on_the_documents(spark):
    from lawweave.functions.text import clean_text

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    t = docs.select(clean_text(F.col("text")).alias("t"))
    for r in t.select(F.filter(F.transform(F.split("t", "\n{2,}"), lambda x: F.trim(x)), lambda x: x != "").alias("p"), segment.chunk_by_size(F.col("t")).alias("c")).collect():
        if all("\n" not in p and p == p.strip() for p in r.p):
            check_chunks(r.c, r.p)


def test_headings_and_clause_rows(spark):
    text = "第一章 总则\n一、目的\n" + SAMPLE + "\n附件 清单"
    df = spark.createDataFrame([("d", text, "T"), ("e", None, "T"), ("f", "", None), ("g", "只有一段文字。", None)], "id string, text string, title string")
    rows = segment.clause_rows(df, "id", "text", "title").collect()
    assert [r.clause_id for r in rows if r.doc_id == "d"] == ["d_c0001", "d_c0002"]
    assert {r.doc_id for r in rows} == {"d", "g"}
    assert rows[0].heading_path == ["第一章 总则", "一、目的", "附件 清单"] and rows[0].citation.title == "T"


def test_last_per_key_and_upsert(spark):
    df = spark.createDataFrame([("a", "1", "x", ["p"]), ("a", "2", "y", None), ("a", "2", "y", None), ("b", None, "z", []), (None, "1", "n", []), ("", "1", "n", [])], "k string, at string, v string, l array<string>")
    got = {(r.k, r.at, r.v) for r in merge.last_per_key(df, ["k"], ["at"]).collect()}
    assert got == {("a", "2", "y"), ("b", None, "z")}
    new = spark.createDataFrame([("a", "9")], "k string, v string")
    up = {(r.k, r.v) for r in merge.upsert(merge.last_per_key(df, ["k"], ["at"]), new, ["k"]).collect()}
    assert up == {("a", "9"), ("b", "z")}
    assert merge.last_per_key(df.limit(0), ["k"], ["at"]).count() == 0


def test_null_safe_keys(spark):
    s = "source string, doc string"
    old, new = spark.createDataFrame([("a", None), ("b", "1")], s), spark.createDataFrame([("a", None), ("a", None), ("c", None), ("c", None), ("b", "2")], s)
    got = {tuple(r) for r in merge.absent(new, old, ["source", "doc"]).collect()}
    assert got == {("c", None), ("b", "2")}
    assert merge.insert_absent(old, new, ["source", "doc"]).count() == 4
    kept = merge.replace_for(old, spark.createDataFrame([("a", None)], s), new, ["source", "doc"], ["source", "doc"])
    assert {tuple(r) for r in kept.collect()} == {("b", "1"), ("a", None), ("c", None), ("b", "2")}


def test_resolved(spark):
    g = spark.createDataFrame([("s", "1", "u"), ("s", None, "v"), ("w", "9", "x")], "source string, doc string, url string")
    docs = spark.createDataFrame([("1", "s"), ("7", "w"), (None, None)], "doc string, source string")
    still, done = merge.split_resolved(merge.flag_resolved(g, docs, "doc", "source", ["w"]))
    assert {r.url for r in still.collect()} == {"v"} and {r.url for r in done.collect()} == {"u", "x"}


def test_merge_fields(spark):
    a = spark.createDataFrame([("k", "", ["x"]), ("n", None, [])], "k string, p string, l array<string>")
    b = spark.createDataFrame([("k", "P", ["y"]), ("n", "", ["y"])], "k string, p string, l array<string>")
    got = {r.k: (r.p, r.l) for r in merge.merge_fields(a, b, ["k"], {"p": "left", "l": "right"}).collect()}
    assert got == {"k": ("P", ["y"]), "n": (None, ["y"])}


def test_index(spark):
    df = spark.createDataFrame([("1", "备案，备案管理"), ("2", None), ("3", "")], "id string, t string")
    p = {(r.term, r.id): (r.freq, r["length"]) for r in index.postings(df, "id", F.col("t"), False).collect()}
    assert p == {("备案", "1"): (1, 7), ("备案管理", "1"): (1, 7)}
    s = index.corpus_statistics(df, F.col("t")).first()
    assert (s.n, s.avgdl) == (3, 7 / 3)
    assert index.corpus_statistics(df.limit(0), F.col("t")).first().avgdl == 0
    assert index.capped_postings(df, "id", F.array(F.lit("w"), F.lit("w")), 2).count() == 2


def test_expand_and_blank_query(spark, tmp_path):
    registry = spark.createDataFrame([("s", ["场外期权", "备案", "登记"], ["otc_derivative"]), ("t", [], ["fund"]), ("u", None, None)], "source_id string, include_keywords array<string>, product_types array<string>")
    dictionary = search.dictionaries(registry)
    assert ({k: sorted(v) for k, v in dictionary[0].items()}, dictionary[1]) == ({"备案": sorted(["场外期权", "登记"]), "场外期权": sorted(["备案", "登记"]), "登记": sorted(["场外期权", "备案"])}, {k: ["otc_derivative"] for k in ("备案", "场外期权", "登记")})
    terms, tax = search.expand("场外期权 备案", *dictionary)
    assert "场外" in terms and "登记" in terms and "otc derivative" in terms and tax == ["otc_derivative"] and len(set(terms)) == len(terms)
    with pytest.raises(ValueError, match="more than 3"):
        search.dictionaries(registry, most=3)
    ev = spark.createDataFrame([("e1", "场外期权备案指引", "范围", ["net"], "P")], "evidence_id string, title string, support_scope string, tags array<string>, publisher string")
    schema = "clause_id string, title string, text string, heading_path array<string>, authority_level string, product_types array<string>, asset_classes array<string>"
    cl = spark.createDataFrame([("c1", "场外期权", "备案", [], "law", ["otc_derivative"], None), ("c2", "其他", "应当，备案", None, None, None, None), ("c3", "场外期权", "备案", [], None, None, None), ("c4", None, None, None, None, None, None)], schema)
    hits = search.search(ev, cl, "场外期权 备案", expansions=dictionary[0], taxonomy=dictionary[1]).orderBy("rank").collect()
    assert [h.id for h in hits] == ["e1", "c1", "c2"]  # c3 has the title and excerpt of c1
    assert search.search(ev, cl, " ").count() == 0
    index_ = stored.StoredIndex.build(ev, cl, str(tmp_path))
    found = index_.search("场外期权 备案", expansions=dictionary[0], taxonomy=dictionary[1])
    assert found.orderBy("rank").collect() == hits and index_.search(" ").count() == 0
    plan = index_.scores("text", ["备案", "登记"])._jdf.queryExecution().executedPlan().toString()
    assert "In(term, " in plan and "regexp" not in plan and "split(" not in plan
    assert search.search(ev.limit(0), cl.limit(0), "备案").count() == 0


def test_first_match_is_brute_force(spark):
    r = random.Random(5)
    titles = ["".join(r.choice("甲乙丙丁AB") for _ in range(r.randint(0, 30))) for _ in range(200)] + [None]
    keys = [t[2 : 2 + r.randint(1, 20)] for t in titles if t and len(t) > 4][:60] + ["", None, "zz"]
    rows = spark.createDataFrame([(f"{i:03d}", t, "x") for i, t in enumerate(titles)], "id string, title string, key string")
    got = {r.key: r.id for r in search.first_match(spark.createDataFrame([(k,) for k in keys], "k string"), "k", rows, "id", "title").collect()}
    for k in keys:
        assert got[k] == next((f"{i:03d}" for i, t in enumerate(titles) if k and t and k.lower() in t.lower()), None)


def test_search_limits_rows_before_the_shuffle(spark):
    hits = spark.createDataFrame([("clause", 2, str(i), "t", "x", float(i)) for i in range(50)], "source string, stage int, id string, title string, excerpt string, score double")
    q = search.quota(hits, {"evidence": 1, "clause": 3}, 2)
    assert [r.id for r in q.orderBy("rank").collect()] == ["49", "48"]
    assert "WindowGroupLimit" in q._jdf.queryExecution().executedPlan().toString()


def test_hot_groups_are_numbered_in_parts(spark):
    df = spark.range(500).select(F.when(F.col("id") < 450, "a").when(F.col("id") < 490, "b").alias("g"), (F.col("id") * 7 % 500).alias("v"))
    got = report.numbered(df, "g", F.col("v"), hot=100).collect()
    for g in ("a", "b", None):
        rows = sorted((r.v, r.line_no) for r in got if r.g == g)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))
    assert len(got) == 500


def test_sorted_hits_and_pages(spark):
    hits = spark.createDataFrame([("a", 1.0, "法律", None), ("b", 3.0, None, "2020-01-01"), ("c", None, "部门规章", "2021-01-01")], "id string, score double, authority_level string, published_at string")
    for by, want in (("score", "bac"), ("authority", "acb"), ("date", "cba")):
        rows = report.sorted_hits(hits, by, "id", most=2).orderBy("place").collect()
        assert "".join(r.id for r in rows) == want[:2] and {r.more for r in rows} == {1}
    with pytest.raises(ValueError, match="colour"):
        report.sorted_hits(hits, "colour", "id")
    assert report.sorted_hits(hits.limit(0), "score", "id").count() == 0
    rows = report.md_table(hits, "published_at", [F.col("id"), F.lit("x|y")], F.col("id"))
    page = report.md_page(["# T"], ["甲", "乙"], rows.where("published_at is not null"), "published_at").collect()
    assert ("2020-01-01", 2, 1, "| b | x/y |") in {tuple(r) for r in page} and (None, 0, 0, "# T") in {tuple(r) for r in page}
    text = spark.range(1).select(report.plain_report(F.lit("结论"), F.array(F.struct(F.lit("法").alias("title"), F.lit("3").alias("article"), F.lit("").alias("url"))), F.array().cast("array<string>")).alias("t")).first().t
    assert text == "结论\n\n── 法规依据 ──\n1. 《法》 第3条"


def test_best_candidate_prefers_those_that_hold_the_query(spark):
    df = spark.createDataFrame([("g", "1", "中华人民共和国 证券法", "2019", True, True), ("g", "2", "证券法释义", "2024", True, False), ("g", "3", "其他", "2025", True, True), ("h", "4", "别的", None, None, None), ("h", "5", None, "1", True, True)], "g string, id string, title string, d string, active boolean, law boolean")
    got = {r.g: (r.id, r.score) for r in search.best_candidate(df, "g", F.col("title"), "d", "id", "证券法", F.col("active"), F.col("law")).collect()}
    assert got == {"g": ("1", 11), "h": ("5", 4)}


def test_harvest(spark):
    pages = spark.createDataFrame([("s", "https://a.x/i/", '<a href="b.pdf">B</a><a href="https://evil.y/c.pdf">C</a><a href="/d/t20200101_1.html">D</a><a href="b.pdf">again</a>'), ("s", "https://a.x/j", None), ("s", "https://a.x/k", "")], "source string, url string, html string")
    registry = spark.createDataFrame([("s", ["a.x"], [])], "source string, allowed_domains array<string>, include_keywords array<string>")
    got = harvest.seed_harvest(pages, "source", "url", "html", registry, 5).orderBy("rank").collect()
    assert [(r.target, r.anchor) for r in got] == [("https://a.x/i/b.pdf", "B"), ("https://a.x/d/t20200101_1.html", "D")]
    assert [r.target for r in harvest.seed_harvest(pages, "source", "url", "html", registry, 1).collect()] == ["https://a.x/i/b.pdf"]
    tries = spark.createDataFrame([("k", 0, False, "u0", "404"), ("k", 1, True, "u1", None), ("l", 0, False, "u0", "404"), ("l", 1, None, "u1", None)], "key string, n int, ok boolean, u string, why string")
    assert {r.key: (r.chosen, r.reasons) for r in harvest.first_answer(tries, ["key"], "n", "ok", "u", "why").collect()} == {"k": ("u1", None), "l": (None, "u0: 404 | u1: ")}
    listing = spark.createDataFrame([("a", i, n, 4) for i, n in enumerate([5, 0, 3, 0, 0, None, 9])], "listing string, page int, n int, total int")
    assert [r.page for r in harvest.pages_until_empty(listing, "listing", "page", "n", empties=3).orderBy("page").collect()] == [0, 1, 2, 3, 4, 5]
    assert [r.page for r in harvest.pages_until_empty(listing, "listing", "page", "n", empties=3, total="total").orderBy("page").collect()] == [0, 1, 2, 3, 4]
    rows = spark.createDataFrame([("1", "x", None), ("2", "x", None), ("3", "", "y"), ("4", None, "y"), ("5", None, None), ("6", None, "")], "id string, a string, b string")
    assert {r.id for r in harvest.first_by_any_key(rows, ["a", "b"], "id").collect()} == {"1", "3", "5"}
    assert harvest.or_else(rows.limit(0), rows).count() == 6 and harvest.or_else(rows.limit(1), rows).count() == 1


def test_error_pages_are_taken_back(spark):
    a = spark.createDataFrame([("s", "a1", "u1", True, None, "p"), ("s", "a2", "u2", True, None, "p"), (None, "a3", None, False, "x", None)], "source_id string, attachment_id string, url string, downloaded boolean, download_error string, local_path string")
    docs = spark.createDataFrame([("attachment_a1", "x"), ("attachment_a2", "y"), ("other", "z")], "doc_id string, title string")
    gaps = spark.createDataFrame([("s", "a1", "u1", "attachment_extract_failed", None, True), ("s", "a2", "u2", "attachment_extract_failed", None, True), (None, None, None, "other", None, None)], "source_id string, doc_id string, url string, gap_type string, reason string, body_read boolean")
    a2, d2, g2 = lifecycle.drop_error_pages(a, docs, gaps, F.col("attachment_id") == "a1")
    assert {(r.attachment_id, r.downloaded, r.local_path) for r in a2.collect()} == {("a1", False, None), ("a2", True, "p"), ("a3", False, None)}
    assert {r.doc_id for r in d2.collect()} == {"attachment_a2", "other"}
    assert {(r.doc_id, r.gap_type) for r in g2.collect()} == {("a1", "attachment_download_html_error"), ("a2", "attachment_extract_failed"), (None, "other")}
    assert lifecycle.drop_error_pages(a.limit(0), docs, gaps, F.lit(None).cast("boolean"))[2].count() == 3


def test_reports(spark):
    df = spark.createDataFrame([("a", "2", "x"), ("a", None, "y"), (None, "1", "z|z")], "s string, d string, t string")
    assert {(r.s, r.n, r.dated) for r in report.counts_by(df, "s", dated=F.col("d").isNotNull()).collect()} == {("a", 2, 1), ("unknown", 1, 1)}
    assert [r.t for r in report.newest(df.where("s is not null"), "s", "d", "t", "t", 1).collect()] == ["x"]
    assert [r.t for r in report.last_n(df, 2, "d", "t").collect()] == ["x", "z|z"]
    assert [r.x for r in df.select(report.matches("Z", "t").alias("x")).collect()] == [False, False, True]
    assert [r.b for r in spark.createDataFrame([(0.9,), (0.5,), (-1.0,)], "s double").select(report.band(F.col("s"), {"high": 0.7, "mid": 0.4}, "low").alias("b")).collect()] == ["high", "mid", "low"]
    assert "z/z" in {r.l for r in df.select(report.md_link(F.col("t"), F.lit("")).alias("l")).collect()}
