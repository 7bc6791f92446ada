"""Column functions: known values, nulls, empties, other white space, signs beyond the basic plane."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lawweave.functions import html as fh
from lawweave.functions import search as fs
from lawweave.functions import text as ft


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(("raw", "want"), [(None, None), ("", ""), ("　\t \xa0", ""), ("a\r\nb\rc", "a\nb\nc"), ("a \t　b", "a b"), ("a\n\n\n\nb", "a\n\nb"), ("𠀀　𠀀", "𠀀 𠀀")])
def test_clean_text(spark, raw, want):
    assert one(spark, raw, ft.clean_text) == want


def test_clean_space(spark):
    assert one(spark, " a&nbsp;&amp;lt;<br/>　 b ", lambda c: ft.clean_space(c, breaks=True)) == "a\xa0&lt;\nb"
    assert one(spark, None, ft.clean_space) is None


def test_truthy_treats_empty_as_missing(spark):
    r = spark.createDataFrame([("", None, "x"), (None, "", None)], "a string, b string, c string").select(ft.truthy(F.col("a"), F.col("b"), F.col("c")).alias("r")).collect()
    assert [x.r for x in r] == ["x", None]


def test_first_line(spark):
    assert one(spark, "\n  \n|nav\n标题\n正文", lambda c: ft.first_line(c, ("|",))) == "标题"
    assert one(spark, "", ft.first_line) == "" and one(spark, None, ft.first_line) is None
    assert len(one(spark, "长" * 500, ft.first_line)) == 160


@pytest.mark.parametrize(("raw", "want"), [("发布于2024年3月5日", "2024-03-05"), ("2012/08/17", "2012-08-17"), ("2020.1.9", "2020-01-09"), ("1999-01-01", None), ("", None), (None, None)])
def test_extract_date(spark, raw, want):
    assert one(spark, raw, ft.extract_date) == want


def test_other_dates(spark):
    assert one(spark, "20240305xyz", ft.parse_date) == "20240305xy"
    assert one(spark, "2023-02-30", ft.valid_date) is None
    assert one(spark, 1704038400000, ft.millis_to_date, "long") == datetime.date(2024, 1, 1)


def test_occurrences_and_keyword_score(spark):
    assert one(spark, "场外期权与场外衍生品 OTC otc", lambda c: ft.keyword_score(c, ["场外", "otc"])) == 10
    assert one(spark, "aaaa", lambda c: ft.occurrences(c, "aa")) == 2
    assert one(spark, None, lambda c: ft.keyword_score(c, ["x"])) == 0
    with pytest.raises(ValueError):
        ft.occurrences(F.col("c"), "")


def test_preview(spark):
    text = "甲" * 200 + "\nOTC" + "乙" * 300
    got = one(spark, text, lambda c: ft.preview(c, ["otc"]))
    assert len(got) == 240 and got.startswith("甲" * 79 + " OTC")
    assert one(spark, None, lambda c: ft.preview(c, ["x"])) == "" and one(spark, "abc", lambda c: ft.preview(c, ["x"])) == "abc"


def test_hosts_and_domains(spark):
    df = spark.createDataFrame([("https://u@WWW.a.example:80/x", ["A.example"]), ("https://ba.example/", ["a.example"]), ("no url", ["a.example"]), (None, ["a.example"])], "u string, d array<string>")
    r = df.select(ft.host(F.col("u")).alias("h"), ft.domain_allowed(F.col("u"), F.col("d")).alias("ok")).collect()
    assert [(x.h, x.ok) for x in r] == [("www.a.example", True), ("ba.example", False), (None, False), (None, False)]


def test_keywords(spark):
    df = spark.createDataFrame([("期权", ["期权"]), ("期权", ["", "互换"]), ("期权", []), (None, ["期权"]), (None, None)], "t string, k array<string>")
    assert [r.x for r in df.select(ft.any_keyword(F.col("t"), F.col("k")).alias("x")).collect()] == [True, False, True, False, True]
    assert one(spark, "a.b", lambda c: ft.contains_any(c, ["a.c", ".b"])) and not one(spark, None, lambda c: ft.contains_any(c, ["a"]))


def test_article_numbers_and_json(spark):
    assert one(spark, "第十二条 x", ft.article_no) == "第十二条" and one(spark, "x 第一条", ft.article_no) == ""
    assert one(spark, "第十条", ft.bare_article_no) == "十"
    assert one(spark, 'so:\n```json\n{"a": {"b": 1}}\n``` end', ft.json_object) == '{"a": {"b": 1}}'
    assert one(spark, "nothing", ft.json_object) is None


def test_rounding_shortening_suffix(spark):
    assert one(spark, 0.285, ft.round_half_up, "double") == 0.28
    assert one(spark, "abcdef", lambda c: ft.shorten(c, 3)) == "abc…" and one(spark, "abc", lambda c: ft.shorten(c, 3)) == "abc"
    assert one(spark, "https://a/b.PDF?x=1", ft.suffix) == ".pdf" and one(spark, "a/b", ft.suffix) == ""
    assert one(spark, "u", lambda c: ft.short_id(F.lit("s"), c)).startswith("s_")


PAGE = "<html><head><title> 标题&amp;名 </title><script>x('</p>')</script></head><body><!-- no --><p>第一段</p><div>a <b>b</b>&lt;</div><a href='/x.pdf'>附件 <i>1</i></a><a href=\"#top\">t</a><a href='javascript:void(0)'>j</a></body></html>"


def test_html(spark):
    assert one(spark, PAGE, fh.html_text).split("\n")[-3:] == ["第一段", "a b<", "附件 1tj"] or "第一段" in one(spark, PAGE, fh.html_text)
    assert "x(" not in one(spark, PAGE, fh.html_text) and "no" not in one(spark, PAGE, fh.html_text)
    assert one(spark, PAGE, fh.html_title) == "标题&名"
    assert one(spark, "<p>无标题</p>", fh.html_title) == "无标题"
    got = one(spark, PAGE, fh.links)
    assert [(x.href, x.anchor) for x in got] == [("/x.pdf", "附件 1")]
    assert one(spark, "/b/../c", lambda c: fh.absolute(F.lit("https://h/a/"), c)) == "https://h/c"
    df = spark.createDataFrame([("https://h/x.pdf", "t", ["k"]), ("https://h/content_1", "t", []), ("https://h/content_1", "t", ["k"])], "u string, a string, k array<string>")
    assert [r.x for r in df.select(fh.looks_like_document(F.col("u"), F.col("a"), F.col("k")).alias("x")).collect()] == [True, True, False]
    assert one(spark, "@doc@a@memo@ @memo@b@memo@c@memo@d@doc@x@memo@y", fh.delimited_records) == [["a", "b", "c", "d"]]


def test_tokens(spark):
    assert one(spark, "场外期权，备案", lambda c: fs.tokens(c, True)) == ["场外期权", "场外", "外期", "期权", "备案", "备案"]
    assert one(spark, "场外期权，备案", lambda c: fs.tokens(c, False)) == ["场外期权", "备案"]
    assert one(spark, None, lambda c: fs.tokens(c, True)) == [] and one(spark, "　a b", lambda c: fs.tokens(c, True)) == []


def test_bm25(spark):
    r = spark.range(1).select(fs.bm25(F.lit(2), F.lit(10), F.lit(8.0), F.lit(4), F.lit(1)).alias("s")).first().s
    assert r == pytest.approx(1.5920301545, abs=1e-9)


@pytest.mark.parametrize("raw", ["a&eacute;b &#20013; &hellip;", "&amp;lt;", "&nbsp;&copy x", "&#x4e2d;&#128;&#0;&#xD800;", "&unknown; & b", "AT&T &notit; &AMP", "&#99999999999;", "", "&;&&#;", "&#x1F600;&NotEqualTilde;"])
def test_entities_are_those_of_html(spark, raw):
    import html

    assert one(spark, raw, ft.unescape) == html.unescape(raw)


@pytest.mark.parametrize(("raw", "want"), [("2020-13-45", None), ("2020-1-45", "2020-01-04"), ("于2021年3月9日", "2021-03-09"), ("1999-01-01", None), ("", None), (None, None)])
def test_dates_the_calendar_can_have(spark, raw, want):
    assert one(spark, raw, ft.extract_date) == want


def test_dates_in_running_text(spark):
    text = "【发布日期】2020-3-1\n本办法自 2021 年 5 月 1 日 起施行。"
    assert one(spark, text, lambda c: ft.labelled_date(c, "发布日期")) == "2020-03-01" and one(spark, text, lambda c: ft.labelled_date(c, "生效")) is None
    assert tuple(one(spark, text, ft.inferred_dates)) == ("2020-03-01", "2021-05-01")
    assert tuple(one(spark, "2020年2月30日印发，自发布之日起施行", ft.inferred_dates)) == (None, None)
    assert tuple(one(spark, "2020年2月3日印发，自发布之日起施行", ft.inferred_dates)) == ("2020-02-03", "2020-02-03")
    assert one(spark, "x" * 20, ft.parse_date) == "x" * 10 and one(spark, "无", ft.date_or_raw) == "无" and one(spark, "", ft.parse_date) is None


def test_urls(spark):
    from urllib.parse import quote, urlsplit, urlunsplit

    for u in ("https://a.b/路径/x y.html?q=中&z=1#片", "http://h/%20a", "/x", "𠀀", "https://h.example"):
        p = urlsplit(u)
        tail = "=&%:/?+@,;"
        assert one(spark, u, ft.ascii_url) == urlunsplit((p.scheme, p.netloc, quote(p.path, safe="/%:@"), quote(p.query, safe=tail), quote(p.fragment, safe=tail)))
    assert one(spark, "https://w.a/x?b=1#c", lambda c: ft.url_candidates(c, "w.a", "w.b")) == ["https://w.a/x?b=1#c", "https://w.b/x?b=1"]
    assert one(spark, "https://z.a/x", lambda c: ft.url_candidates(c, "w.a", "w.b")) == ["https://z.a/x"] and one(spark, None, ft.ascii_url) is None
    assert one(spark, 'cb({"a": "(x)"});', ft.unwrapped) == '{"a": "(x)"}' and one(spark, "none", ft.unwrapped) is None


@pytest.mark.parametrize(("name", "text", "want"), [("07_SSE_x_管理办法.docx", "", ("管理办法", "SSE")), ("07_CSRC_NERIS_x_规则_二.docx", "（一）规则", ("规则_二", "CSRC_NERIS")), ("说明.pdf", "\n 业务指引 \n正文", ("业务指引", None)), ("a_b.docx", "发布规则", ("a_b", None))])
def test_titles_of_files(spark, name, text, want):
    r = spark.createDataFrame([(name, text)], "n string, t string").select(ft.numbered_title(F.col("n"), F.col("t")).alias("r")).first().r
    assert tuple(r) == want


def test_pairs_and_links_of_pages(spark):
    assert one(spark, "<em>a</em> 1 <em>b</em>2<em>a</em>3", fh.label_pairs) == {"b": "2", "a": "3"}
    js = "[{name: 'x',\n link: '/1'}, {name:'y' ,\n  link: '/2'}, {name: 'z',\n link: '/1'}]"
    assert [tuple(r) for r in one(spark, js, fh.script_links)] == [("x", "/1"), ("y", "/2")]
    page = '<a href="#">t</a><a href="/a.PDF">A</a><a href="/b.html">b</a><a href="c.docx">C</a>'
    assert [(r.ordinal, r.href) for r in one(spark, page, fh.attachment_links)] == [(1, "/a.PDF"), (3, "c.docx")]


def test_nested_payloads(spark):
    from lawweave.functions import nested

    law = '{"lawlist": {"law": {"bodyAgoCntnt": "<p>前言</p>", "draftDscr": ""}, "lawEntryVOs": [{"title": "第一条", "cntnt": "内容", "itemList": [{"cntnt": "<b>一</b>"}, {"cntnt": null}]}, {"title": null, "cntnt": null}, null]}}'
    read = lambda c: nested.law_text(F.from_json(c, nested.LAW))
    assert one(spark, law, read) == "前言\n\n第一条 内容\n\n一" and one(spark, "{}", read) == ""
    assert one(spark, '{"title": "a", "children": [{"title": "b", "children": null}, {"title": "", "children": [{"title": "c"}]}]}', nested.heading_tree) == "a\n  b\n    c"
    paths = '{"p": [{"ItemLvs": [{"itemName": "a"}, {"itemName": null}, {"itemName": "b"}]}, {"ItemLvs": []}, {}]}'
    assert one(spark, paths, lambda c: nested.item_paths(F.from_json(c, "p array<struct<ItemLvs: array<struct<itemName: string>>>>")["p"])) == ["a / b"]
