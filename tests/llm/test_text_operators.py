"""Operators on text: nulls, empty and long texts, repeats, ties, empty tables, clashing names, and known cases."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lawweave.llm import boilerplate, bpe, mojibake, packing, queries, repeated_lines, residue, scan_noise, sizes, splitting, unify

RULE = "第一条 证券公司开展场外期权业务的，应当在十五个工作日内报送交易明细，保存期限不得少于二十年。"
WORDS = "the fund manager shall report every amendment of contract terms and monitor the risk reserve ledger".split()


def english(n: int, seed: int = 1) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


# --- problem 5 ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("a", "b"), [("ＡＢＣ１２", "ABC12"), ("收益 互换", "收益　互换"), ("风​险", "风险"), ("⼈民", "人民"), ("е", "e"), ("Ångholm", "Ångholm"), ("ｶﾞ", "ガ"), ("a b", "a b"), ("行", "行")])
def test_looks_the_same(a, b):
    assert unify.visible(a) == unify.visible(b)
    assert unify.folded(a) == unify.folded(b)


@pytest.mark.parametrize(("a", "b"), [("第1条", "第2条"), ("ABC", "abc"), ("x²", "x2"), ("①", "1"), ("權", "权"), ("⑴", "(1)")])
def test_looks_different(a, b):
    assert unify.visible(a) != unify.visible(b)


def test_folding_is_idempotent():
    for s in ("Ｓtraße ①", "ΑΒΓ ｶﾞ", "第　一条"):
        assert unify.folded(unify.folded(s)) == unify.folded(s)


def test_look_alike_pairs(spark):
    rows = [("c1", "标题", "收益互换"), ("c2", "标题", "收益​互换"), ("c2", "标题", "收益​互换"), ("c3", "标题", "收益互换"), ("c4", None, "收益互换"), ("c5", "标题", ""), ("c6", "标题", None), ("c7", "标 题", "收益互换")]
    df = spark.createDataFrame(rows, "clause_id string, title string, text string")
    got = {tuple(r) for r in unify.look_alike_pairs(df, "clause_id", "title", "text").collect()}
    assert got == {("c1", "c2"), ("c2", "c3")}
    assert unify.look_alike_pairs(df.limit(0), "clause_id", "title", "text").count() == 0
    out = unify.unify_columns(df, "text").where("clause_id = 'c6' or clause_id = 'c5'").select("text_unified").collect()
    assert {r[0] for r in out} == {None, ""}


def test_copies_of_one_spelling_never_meet(spark):
    rows = [(f"c{i:04}", "标题", "收益互换") for i in range(3000)] + [("d1", "标题", "收益​互换"), ("b1", "标题", "收益　互换"), ("b2", "标题", "收益 互换"), ("b3", "标题", "收益　互换")]
    df = spark.createDataFrame(rows, "clause_id string, title string, text string")
    want = {tuple(sorted((x, "d1"))) for x, *_ in rows if x[0] == "c"} | {("b1", "b2"), ("b2", "b3")}
    for hot in (7, unify.HOT_ROWS):
        pairs = unify.look_alike_pairs(df, "clause_id", "title", "text", hot)
        got = [tuple(r) for r in pairs.collect()]
        assert len(got) == len(set(got)) and set(got) == want
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in x and "NOT (raw" in x for x in plan.split("\n"))


# --- problem 7 ---------------------------------------------------------------------------------------------------


def test_bpe_equals_the_library():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    v = bpe.vocabulary("byte_bpe_50k")
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    r = random.Random(3)
    texts = [RULE * 5, english(200), "<|endoftext|> x", "  \n\n \t a  b　c\r\n", "𠀀𠀁 🏛️", "aaaaaaaaaaaaaaaaaaaaaaaa" * 20, "don't we'll I'M", "".join(chr(r.choice([r.randrange(32, 0x3000), r.randrange(0x4E00, 0x9FFF)])) for _ in range(3000))]
    for t in texts:
        assert v.encode(t) == e.encode_ordinary(t)
        assert v.decode(v.encode(t)) == t


def test_encode_corpus(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "ab ab", 0), (3, "ab ab", 0)], "doc_id long, text string, ids int")
    got = bpe.encode_corpus(df, "doc_id", "text").collect()
    assert sorted((r.doc_id, len(r.ids)) for r in got) == [(1, 0), (2, 0), (3, 2), (3, 2)]
    assert all(r.same for r in bpe.round_trip(df.dropDuplicates(["doc_id"]), "doc_id", "text").collect())
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text").count() == 0


def test_look_alike_classes(spark):
    rows = [("a", "规则", "文本１"), ("b", "规则", "文本1"), ("c", "规则", "文本2"), ("d", None, "文本1"), ("e", "规则", "文本1"), ("e", "规则", "文本1"), ("n", "规则", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id string, title string, text string, class string")
    got = {r.id: (r["class"], r.spelling, r.spellings) for r in unify.look_alike_classes(df, "id", "title", "text").collect()}
    assert set(got) == {"a", "b", "e"} and len({c for c, _, _ in got.values()}) == 1 and got["b"][1] == got["e"][1] != got["a"][1] and got["a"][2] == 2
    assert unify.look_alike_classes(df.limit(0), "id", "title", "text").count() == 0


# --- problem 3 ---------------------------------------------------------------------------------------------------


def test_repeated_lines(spark):
    rows = [(f"a{i}", "a", f"da{i}", f"条文{i}内容甲\n  转载请注明　出处 {i}\n") for i in range(30)]
    rows += [(f"b{i}", "b", f"db{i}", f"另一条{i}\n共同的一行") for i in range(30)] + [("n1", None, "da1", "转载请注明 出处 7"), ("n2", None, "zz", None), ("n3", "a", "da1", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "clause_id string, source_id string, doc_id string, text string, h string")
    known = spark.createDataFrame([("a", "da1"), ("c", None)], "source_id string, doc_id string")
    lines = repeated_lines.repeated_lines(df, "source_id", "doc_id", "text", known, least_docs=4, least_share=0.1)
    assert {(r.source_id, r.line) for r in lines.collect()} >= {("a", "转载请注明 出处 0"), ("b", "共同的一行")}
    clean = {r.clause_id: r.text for r in repeated_lines.remove_lines(df, "clause_id", "source_id", "doc_id", "text", lines, known).collect()}
    assert len(clean) == len(rows) and clean["n2"] is None and clean["n3"] == "" and clean["n1"] == ""
    assert "转载" not in clean["a5"]
    assert repeated_lines.repeated_lines(df.limit(0), "source_id", "doc_id", "text").count() == 0


def test_lines_of_all_sources_are_no_excess(spark):
    """A line that all sources hold alike is rejected by the test, one that a single source repeats is not; the rule lists both."""
    rows = [(s, f"{s}{i}", f"{s}文{'x' * i}\n" + ("各处都有的一行" if i % 4 == 0 else "") + ("\n本站提示" if s == "a" and i % 3 == 0 else "")) for s in "abc" for i in range(60)]
    df = spark.createDataFrame(rows, "source_id string, doc_id string, text string")
    assert {(r.source_id, r.line) for r in repeated_lines.repeated_lines(df, "source_id", "doc_id", "text").collect()} == {("a", "本站提示")}
    ruled = repeated_lines.repeated_lines(df, "source_id", "doc_id", "text", least_docs=4, least_share=0.1).collect()
    assert {(r.source_id, r.line) for r in ruled} == {("a", "本站提示"), *((s, "各处都有的一行") for s in "abc")}
    assert all((r.g2 > 20) == (r.line == "本站提示") for r in ruled)


def test_rule_decides_on_skewed_sources(spark):
    rows = [("a", f"a{i}", f"甲文{i * 'x'}\n" + ("请勿外传" if i < 60 else "")) for i in range(300)] + [("b", f"b{i}", f"乙文{i * 'y'}") for i in range(3)]
    rows += [("c", f"c{i}", "共同页脚" if i < 4 else f"丙文{i * 'z'}") for i in range(40)]
    df = spark.createDataFrame(rows[:303], "source_id string, doc_id string, text string")
    assert [(r.line, r.docs) for r in repeated_lines.repeated_lines(df, "source_id", "doc_id", "text", least_docs=4, least_share=0.1).collect()] == [("请勿外传", 60)]
    assert [r.line for r in repeated_lines.repeated_lines(df, "source_id", "doc_id", "text").collect()] == ["请勿外传"]
    df = spark.createDataFrame(rows, "source_id string, doc_id string, text string")
    got = {(r.source_id, r.line) for r in repeated_lines.repeated_lines(df, "source_id", "doc_id", "text", least_docs=4, least_share=0.1).collect()}
    assert got == {("a", "请勿外传"), ("c", "共同页脚")}
    found = {r.line for r in repeated_lines.repeated_lines(df, "source_id", "doc_id", "text").collect()}  # no line of a single document
    assert found <= {"请勿外传", "共同页脚"} and "请勿外传" in found


def test_the_rule_runs_no_test_it_does_not_use(spark, monkeypatch):
    rows = [(s, f"{s}{i}", f"{s}文{'x' * i}\n" + ("各处都有的一行" if i % 4 == 0 else "") + ("\n本站提示" if s == "a" and i % 3 == 0 else "")) for s in "abc" for i in range(60)] + [(None, "z", "各处都有的一行"), ("d", "d1", None)]
    df = spark.createDataFrame(rows, "source_id string, doc_id string, text string")
    rated = repeated_lines.repeated_lines(df, "source_id", "doc_id", "text", least_docs=4, least_share=0.1)
    found = queries.p3_found(spark, "/root/testdata/sf0.001").collect()
    monkeypatch.setattr(repeated_lines, "_ratio", None)
    monkeypatch.setattr(repeated_lines, "line_statistics", None)
    plain = repeated_lines.repeated_lines(df, "source_id", "doc_id", "text", least_docs=4, least_share=0.1, ratio=False)
    assert sorted(map(tuple, plain.collect())) == sorted(tuple(r)[:4] for r in rated.collect()) and "g2" not in plain.columns
    assert sorted(queries.p3_found(spark, "/root/testdata/sf0.001").collect()) == sorted(found)
    assert queries.p3_cleaned(spark, "/root/testdata/sf0.001").count() > 0


# --- problem 2 ---------------------------------------------------------------------------------------------------


def test_every_pair_is_restored():
    texts = [RULE + str(i) for i in range(300)] + [english(30, i) for i in range(100)] + ["如“Noël”与 Ångholm 所示。"] * 20
    m = mojibake.fit(texts)
    for true, wrong in [("utf-8", "cp1252"), ("utf-8", "gb18030"), ("utf-8", "mac_roman"), ("gb18030", "cp1252"), ("gb18030", "big5"), (mojibake.TWICE, "cp1252")]:
        bad = "证券公司" + mojibake.misread("开展场外期权业务的，应当", true, wrong) + "报送交易明细。"
        (fixed, n), = mojibake.repair(m, [bad])
        assert n == 1, (true, wrong)
        if "�" not in bad:
            assert fixed == "证券公司开展场外期权业务的，应当报送交易明细。", (true, wrong)
    for ok in (RULE, "", None, "不得出现乱码（例如“锟斤拷”等字样）", "including Köstner Brokers"):
        assert mojibake.repair(m, [ok]) == [(ok, 0)]


def test_restore_encoding(spark):
    rows = [(str(i), RULE) for i in range(50)] + [("n", None), ("e", ""), ("g", mojibake.misread(RULE, "utf-8", "cp1252")), ("l", RULE * 2000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, text string, spans int")
    got = {r.id: r for r in mojibake.restore_encoding(df, "id", "text").collect()}
    assert got["g"].text == RULE and got["g"].garbled and not got["l"].garbled and got["n"].text is None and got["e"].text == ""
    assert mojibake.restore_encoding(df.limit(0), "id", "text").count() == 0


def test_signs_of_all_rows_are_usual(spark):
    rows = [(i, RULE) for i in range(400)] + [(1000 + i, "经办人：玲瑞继启倡函。") for i in range(8)] + [(9999, "经办人" + mojibake.misread("玲瑞继启倡函", "utf-8", "cp1252") + "。")]
    df = spark.createDataFrame(rows, "id long, text string")
    model = mojibake.fit_model(df, "id", "text", 1)  # the sample can't hold the signs, the counts do
    assert set("玲瑞继启倡函") <= model.usual
    assert mojibake.repair(model, [rows[-1][1]]) == [("经办人玲瑞继启倡函。", 1)]


def test_pairs_are_fitted_on_every_given_text():
    model = mojibake.fit([RULE] * 2500 + ["玲瑞继启倡函"] * 500)
    at = {int(o): i for i, o in enumerate(model.signs)}
    assert all(ord(c) in at for c in mojibake.misread("玲瑞继启倡函", "utf-8", "gb18030"))


def test_pairs_and_entering_are_fitted_on_all_rows(spark):
    rare = "经办人：玲瑞继启倡函。"
    rows = [(i, f"{RULE}{i}") for i in range(400)] + [(1000 + i, rare) for i in range(8)] + [(2000 + i, "经办人" + mojibake.misread("玲瑞继启倡函", "utf-8", "cp1252") + "。") for i in range(5)]
    df = spark.createDataFrame(rows, "id long, text string")
    one, many = (mojibake.fit_model(df.repartition(n), "id", "text", k) for n, k in ((1, 1), (3, 1000)))
    assert (one.logp == many.logp).all() and (one.signs == many.signs).all() and one.enter == many.enter
    clean = mojibake.fit([t for i, t in rows if i < 2000])
    assert (one.signs == clean.signs).all() and abs(one.logp - clean.logp).max() < 1e-9  # the garbled rows left the counts
    assert one.enter == mojibake.entering(5, sum(len(t) for i, t in rows if i < 2000) + 5 * 4)
    at = {int(o): i for i, o in enumerate(one.signs)}
    for k, pair in enumerate(mojibake.PAIRS, 1):
        assert all(ord(c) in at and one.logp[at[ord(c)], k] > -22 for c in mojibake.misread(rare, *pair) if ord(c) > 127 and c != "�"), pair


# --- problem 6 ---------------------------------------------------------------------------------------------------


def test_residue(spark):
    bad = ["${title}\n${content}", "{{title}}\n{{content}}", "Lorem ipsum dolor sit amet", "You need to enable JavaScript to run this app.", "请启用 JavaScript 后继续浏览本页内容。", "系统繁忙，请于 3 分钟后重试。"] * 6
    good = [RULE.replace("十五", str(i)) for i in range(200)] + [f"报送文件应当按“{{机构代码}}_{i}.csv”的格式命名。" for i in range(20)]
    rows = [(f"b{i}", t) for i, t in enumerate(bad)] + [(f"g{i}", t) for i, t in enumerate(good)] + [("n", None), ("e", ""), ("i", "证券公司应当{{title}}报送交易明细。"), ("l", RULE * 1000)]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "id string, text string, score double")
    found = {r.id for r in residue.score_records(df, "id", "text", only_found=True).collect()}
    assert {f"b{i}" for i in range(len(bad))} <= found and "i" in found
    assert not any(x.startswith("g") for x in found) and not {"n", "e", "l"} & found
    assert residue.exclude_residue(df, "id", "text").count() == len(rows) - len(found)
    assert residue.score_records(df.limit(0), "id", "text").count() == 0


def test_residue_beyond_the_trusted_records():
    """A message and a slot syntax that no trusted record holds are learned from what they share with trusted ones."""
    trusted = ["请启用 JavaScript 后继续浏览本页内容。", "系统繁忙，请于 3 分钟后重试。错误代码：C1", "{{title}}\n{{content}}\n{{date}}", "抱歉，您访问的页面已被删除，5秒后自动返回。"] * 8
    rest = [RULE.replace("十五", str(i)) for i in range(300)] + [f"报送文件应当按“{{机构代码}}_{i}.csv”的格式命名，" + RULE for i in range(20)]
    new = ["抱歉，本页内容暂时无法浏览，请于 5 分钟后重试。"] * 3 + ["#{title}\n#{content}\n#{date}"] * 3
    model = residue.fit(trusted, rest + new)
    assert not any(re.search(residue.TRUSTED, t) for t in new)
    assert all(model.is_residue(t) for t in (*new, "证券公司应当#{content}报送交易明细。" + RULE))
    assert not any(model.is_residue(t) for t in rest)


@pytest.mark.parametrize(("slot", "shape"), [("{{regulatory_document.metadata.effective_date}}", "{{w}}"), ("{{ title | default('一个很长很长的默认标题值') }}", "{{w}}"), ("${" + "regulatory_document_" * 3 + "date}", "${w}"), ("%REGULATORY_DOCUMENT_EFFECTIVE_DATE%", "%w%"), ("{" + "x" * 40 + "}", "{w}"), ("[[" + "x" * 40 + "]]", "[[w]]"), ("<%= title %>", "<%=w%>")])
def test_long_slots_are_passages(slot, shape):
    kind, features = residue.passages(f"证券公司应当{slot}报送交易明细。")[0]
    assert kind == 1 and features[:2] == (f"s:{shape}", "s:inside")


# --- problem 4 ---------------------------------------------------------------------------------------------------


def page(i: int) -> str:
    menu = ["首页", "登录", "注册", "法规制度", "新闻动态"]
    return "\n".join([*menu[: 3 + i % 3], "您所在的位置 > 首页 > 公告", RULE.replace("十五", str(i)), "特此通知。", "相关阅读", "· 关于收益互换的通知（东发〔2020〕", "> 结算业务管理办法", f"版权所有 东陆交易所 备案序号 {i} 号"])


def test_page_lines(spark):
    rows = [(f"p{i}", page(i)) for i in range(60)] + [(f"t{i}", RULE + "\n（一）应当按季度报送。\n特此通知。") for i in range(60)] + [("n", None), ("e", ""), ("p1", page(1))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "id string, text string, line_no int")
    model = boilerplate.fit_model(df, "id", "text")
    got: dict[str, set[int]] = {}
    for r in boilerplate.page_lines(df, "id", "text", model).collect():
        got.setdefault(r.id, set()).add(r.line_no)
    lines = page(2).split("\n")
    want = {i for i, s in enumerate(lines, 1) if RULE[:4] not in s and s != "特此通知。"}
    assert got["p2"] == want
    assert not any(k.startswith("t") or k in "ne" for k in got)
    text = {r.id: r.text for r in boilerplate.main_text(df, "id", "text", model).collect()}
    assert text["p2"].split("\n") == [RULE.replace("十五", "2"), "特此通知。"] and text["n"] is None and text["e"] == ""
    assert boilerplate.page_lines(df.limit(0), "id", "text").count() == 0


# --- problem 1 ---------------------------------------------------------------------------------------------------


KNOWN = scan_noise.Confusions([(seen, right) for right, seen in scan_noise.CONFUSIONS + scan_noise.LATIN])


def test_anagram_difference_leads_to_the_right_word():
    for word, right in (("tlie", "the"), ("contrac†", "contract"), ("核入员", "核人员"), ("无木又在", "无权在")):
        assert scan_noise.anagram(right) in KNOWN.targets(word) and KNOWN.is_reading(word, right)
    assert not KNOWN.is_reading("the", "the") and not KNOWN.is_reading("eht", "the")


def test_differences_are_learned_from_the_corpus(spark):
    """Without any list, the differences that many word pairs share are found, and those that few share are not."""
    words = "the of margin member clear default settle exchange report amend ledger reserve".split()
    counts = [(w, 500) for w in words] + [(w.replace("e", "c", 1), 1) for w in words if "e" in w and len(w) > 3] + [("rescrvc", 1), ("margiq", 1)]
    counts += [(f"{a}应{b}", 300) for a, b in ("司当", "者按", "人在", "商由", "行及")] + [(f"{a}庆{b}", 2) for a, b in ("司当", "者按", "人在", "商由", "行及")]
    counts += [(f"所称{b}", 300) for b in "交净集额款"] + [(f"所列{b}", 2) for b in "交净集额款"]
    df = spark.createDataFrame(counts, "word string, n long")
    learned = {(s, r) for s, r, _ in scan_noise.learn_confusions(df)}
    assert learned == {("c", "e"), ("庆", "应")}
    fixed = {r.word: r.right for r in scan_noise.corrections(df, scan_noise.confusions(df, known=[])).collect()}
    assert fixed["rescrvc"] == "reserve" and fixed["司庆当"] == "司应当" and "margiq" not in fixed


def test_scan_traces(spark):
    clean = english(40)
    broken = "Article 1 The fund man-\nager shall report every amendment of contract terms."
    rows = [(f"k{i}", english(60, i), "t", "p") for i in range(60)]
    rows += [("word", clean.replace(" the ", " tlie ", 1), "t", "p"), ("hyphen", broken, "t", "p"), ("page", f"{clean[:60]}\n第3页 共9页\n{clean[60:]}", "t", "p"), ("head", f"{clean[:60]}\n东陆期货交易所公报 12 期\n{clean[60:]}", "t", "p")]
    rows += [("table", clean + "\n序号\n指标\n限额\n1\n授信额度\n72\n2\n净资本\n44", "t", "p"), ("compound", "on a trade-by-trade basis", "t", "p"), ("n", None, None, None), ("e", "", "t", "p"), ("word", clean.replace(" the ", " tlie ", 1), "t", "p")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id string, text string, title string, publisher string, word string")
    found = {r.id for r in scan_noise.find_traces(df, "id", "text", "title", "publisher").collect()}
    assert found == {"word", "hyphen", "page", "head"}
    fixed = {r.id: r.text for r in scan_noise.repair(df, "id", "text", "title", "publisher").collect()}
    assert fixed["word"] == clean and "manager" in fixed["hyphen"] and "\n" not in fixed["page"] and fixed["n"] is None and fixed["e"] == ""
    assert fixed["table"] == rows[64][1] and fixed["k3"] == english(60, 3)
    assert scan_noise.find_traces(df.limit(0), "id", "text", "title", "publisher").count() == 0


@pytest.mark.parametrize(("word", "right"), [("clearecl", "cleared"), ("clisclose", "disclose"), ("collatcral", "collateral"), ("inclucling", "including"), ("clclivery", "delivery"), ("illumínatíng", "illuminating")])
def test_no_subset_of_places_is_left_out(spark, word, right):
    counts = spark.createDataFrame([(word, 2), (right, 400), ("llllllllll", 500)], "word string, n long")
    assert [(r.word, r.right) for r in scan_noise.corrections(counts).collect()] == [(word, right)]


def test_canonical_form_is_shared_by_all_readings():
    assert all(KNOWN.canonical(a) == KNOWN.canonical(b) for a, b in scan_noise.LATIN)
    r = random.Random(5)
    for _ in range(300):
        word = "".join(r.choice("elihmrnIO0†a1") for _ in range(r.randint(2, 9)))
        right, i = "", 0
        while i < len(word):  # some reading of the word
            options = [(right_, seen) for seen, right_ in KNOWN.pairs if word.startswith(seen, i)] + [(word[i], word[i])]
            x, seen = r.choice(options)
            right, i = right + x, i + len(seen)
        assert KNOWN.canonical(word) == KNOWN.canonical(right) and KNOWN.is_reading(word, right) == (word != right)


def test_short_words_and_other_cases_are_evidence(spark):
    rows = [(f"k{i}", "The ETF and the TAPI of the Irs desk.") for i in range(20)]
    breaks = {"a": ("units of the ET-\nF are listed", "ETF"), "b": ("units of the E-\nTF are listed", "ETF"), "c": ("see the A-\nPI here", None), "d": ("swaps by IR-\nS are", "IRS"), "e": ("the T-\nAPI is", "TAPI")}
    df = spark.createDataFrame([(*r, "t", "p") for r in [*rows, *((k, t) for k, (t, _) in breaks.items())]], "id string, text string, title string, publisher string")
    found = {r.id for r in scan_noise.find_traces(df, "id", "text", "title", "publisher").collect()}
    assert found == {k for k, (_, w) in breaks.items() if w}
    fixed = {r.id: r.text for r in scan_noise.repair(df, "id", "text", "title", "publisher").collect()}
    for k, (t, w) in breaks.items():
        assert fixed[k] == t if w is None else f" {w} " in fixed[k] and "-" not in fixed[k]


# --- problems 8 and 9 --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [1, 7, 100])
def test_histogram_packing(capacity):
    r = random.Random(capacity)
    for _ in range(40):
        hist = {r.randint(1, capacity): r.randint(1, 50) for _ in range(r.randint(1, 12))}
        room: dict[int, int] = {}
        seen = dict.fromkeys(hist, 0)
        for length, lo, n, first, per in packing.pack_histogram(hist, capacity):
            assert lo == seen[length] and n % per == 0
            seen[length] += n
            for c in range(first, first + n // per):
                room[c] = room.get(c, 0) + per * length
        assert seen == hist and max(room.values()) <= capacity and sorted(room) == list(range(len(room)))


def test_shortest_pack_first():
    rows = {r[0]: r for r in packing.pack_histogram({7: 1, 5: 1, 3: 1, 2: 1}, 10)}
    assert rows[3][3] == rows[5][3] != rows[7][3]  # 3 joins the pack with the most room, not the fullest one


def brute_shortest_pack_first(hist, capacity):
    packs = []
    for length in sorted(hist, reverse=True):
        for _ in range(hist[length]):
            k = min(range(len(packs)), key=packs.__getitem__, default=None)
            if k is None or packs[k] + length > capacity:
                packs.append(length)
            else:
                packs[k] += length
    return sorted(packs)


@pytest.mark.parametrize("capacity", [10, 60])
def test_patterns_equal_item_by_item(capacity):
    r = random.Random(capacity)
    for _ in range(60):
        hist = {r.randint(1, capacity): r.randint(1, 30) for _ in range(r.randint(1, 9))}
        fill: dict[int, int] = {}
        for length, _, n, first, per in packing.pack_histogram(hist, capacity):
            for c in range(first, first + n // per):
                fill[c] = fill.get(c, 0) + per * length
        assert sorted(fill.values()) == brute_shortest_pack_first(hist, capacity)


def test_hot_length_is_ranked_in_parts(spark):
    items = spark.range(1000).select("id", F.lit(0).alias("part"), F.lit(0).alias("start"), F.when(F.col("id") < 900, 5).otherwise(6).alias("size"))
    got = packing.ranked(items, "id", {5: 900, 6: 100}, hot=100).collect()
    for size, n in ((5, 900), (6, 100)):
        assert sorted(r["rank"] for r in got if r["size"] == size) == list(range(n))


def limits_df(spark, rows):
    return spark.createDataFrame(rows, "limit_id int, purpose string, tokenizer string, capacity int, overlap int")


def test_pack_documents(spark):
    texts = [None, "", *(english(5 + i % 40, i) for i in range(150)), english(900)] + ["a b c"] * 30
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, container string")
    lim = limits_df(spark, [(1, "container", "byte_bpe_50k", 128, 0), (2, "piece", "byte_bpe_50k", 64, 8)])
    rows = packing.pack_documents(df, "doc_id", "text", lim).collect()
    count = sizes.counter("byte_bpe_50k")
    fill: dict[int, int] = {}
    whole: dict[int, list] = {}
    for r in rows:
        fill[r.container] = fill.get(r.container, 0) + r["size"]
        whole.setdefault(r.doc_id, []).append(r)
    assert max(fill.values()) <= 128 and set(whole) == set(range(len(texts)))
    for i, t in enumerate(texts):
        assert sum(r["size"] for r in whole[i]) == (count(t) if t else 0)
        assert len(whole[i]) == 1 or count(t) > 128
    assert sum(fill.values()) / (128 * len(fill)) > 0.9
    assert packing.pack_documents(df.limit(0), "doc_id", "text", lim).count() == 0


@pytest.mark.parametrize(("tokenizer", "capacity", "overlap"), [("byte_bpe_50k", 64, 8), ("byte_bpe_50k", 200, 0), ("piece_bpe_32k", 50, 0)])
def test_pieces(tokenizer, capacity, overlap):
    texts = [RULE * 20, "\n".join(RULE for _ in range(30)), english(500), "法" * 3000, "a" * 5000, "𠀀" * 500, " \n" * 400 + RULE * 9]
    count = sizes.counter(tokenizer)
    for t in texts:
        got = splitting.split(t, tokenizer, capacity, overlap)
        assert bool(got) == (count(t) > capacity)
        core = 0
        for k, (start, at, end, n) in enumerate(got):
            assert at == core and end > at and n <= capacity and count(t[start:end]) <= capacity
            assert (start == at) == (k == 0 or not overlap)
            core = end
        assert not got or core == len(t)
    cut = splitting.split("\n".join(RULE for _ in range(30)), tokenizer, capacity * 4, overlap)
    text = "\n".join(RULE for _ in range(30))
    assert all(text[end - 1] == "\n" for _, _, end, _ in cut[:-1])


@pytest.mark.parametrize("tokenizer", ["byte_bpe_50k", "piece_bpe_32k"])
def test_long_line_is_cut_at_commas(tokenizer):
    line = ("基金管理人应当按照合同约定及时披露有关信息内容，" * 450)[:10_000] + "。"
    cut = splitting.split(line, tokenizer, 200, 0)
    assert len(cut) > 40 and all(line[end - 1] in "，。" for *_, end, _ in cut)


def test_split_documents(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, RULE * 10, 0), (4, "short", 0)], "doc_id long, text string, piece int")
    lim = limits_df(spark, [(1, "container", "byte_bpe_50k", 128, 0), (2, "piece", "byte_bpe_50k", 64, 8), (3, "piece", "piece_bpe_32k", 64, 0)])
    rows = splitting.split_documents(df, "doc_id", "text", lim).collect()
    assert {(r.limit_id, r.doc_id) for r in rows} == {(2, 3), (3, 3)}
    again = "".join(r.text[r.core_start - r.start :] for r in sorted((r for r in rows if r.limit_id == 2), key=lambda r: r.piece))
    assert again == RULE * 10
    assert splitting.split_documents(df.limit(0), "doc_id", "text", lim).count() == 0
    assert df.where(F.col("doc_id") < 0).count() == 0


def test_sizes_need_no_pass_per_piece(monkeypatch):
    """Pieces not seen before are counted together, overlaps take only a piece's last tokens, short texts are not encoded at all."""
    r = random.Random(3)
    texts = ["".join(r.choice("证券公司开展场外期权业务应当在日内报送ab 1é，。\n😀") for _ in range(n)) for n in (3, 400, 3000)]
    v = bpe.BytePairs.load("byte_bpe_50k")
    whole = [p for t in texts for p in bpe.split_pieces(t)]
    want = [len(v.piece(p)) // 4 for p in whole]
    assert v.count_each(whole).tolist() == want and v.count_each([]).tolist() == []
    for p in whole:
        exact = [len(v.strings[i]) for i in memoryview(v.piece(p)).cast("i")]
        for need in (1, len(exact)):
            assert v.last_tokens(p.encode(), need)[-need:] == exact[-need:]
    monkeypatch.setattr(bpe.BytePairs, "piece", None)
    assert bpe.BytePairs(v.ranks).count_each(whole).tolist() == want
    known = sizes.single_signs("piece_bpe_32k")
    short = "证券公司，" * 100
    assert set(short) <= known and sizes.counter("piece_bpe_32k")(short) <= len(short) + splitting.MARK
    monkeypatch.setattr(splitting, "TokenRuler", None)
    assert splitting.split(short, "piece_bpe_32k", 1024, 0) == []


def test_texts_are_measured_together(monkeypatch):
    """One pass over many texts gives each its own split and sizes; an overlap of long tokens has all the tokens asked for."""
    r = random.Random(5)
    signs = "ab's tremdlv12½é中国证券，。\n\t　\xa0 '’😀_-"
    texts = ["", *("".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(5000)), RULE, "x" * 3000]
    v = bpe.BytePairs.load("byte_bpe_50k")
    for t, (ends, before, stretches, upto) in zip(texts, v.measure(texts), strict=True):
        pieces = bpe.split_pieces(t)
        assert ends.tolist() == np.cumsum([len(p) for p in pieces], dtype=int).tolist()
        assert np.diff(before).tolist() == [len(v.piece(p)) // 4 for p in pieces]
        assert upto[-1] == before[-1] and set(ends.tolist()) <= set(stretches.tolist())
    text = "机构（如Brünnhaus Trust）应当报送。" * 3
    ruler = splitting.BpeRuler(v, text).listed()
    for wanted in range(1, ruler.total):
        place, n = ruler.overlap(len(text), wanted)
        assert n == len(v.encode(text[place:])) and wanted <= n <= wanted + splitting.SLACK
    monkeypatch.setattr(bpe.BytePairs, "encode_packed", None)  # no text is encoded one by one, not even inside a long unit
    assert len(splitting.split("券商" * 2000 + RULE, "byte_bpe_50k", 512, 64)) > 5


def plain_viterbi(m, text):
    """The likeliest states of a whole text, sign by sign."""
    e = [m.logp[m.row[ord(c)]] for c in text]
    stay = np.log1p(-np.exp(mojibake.LEAVE))
    v, back = e[0] + np.append(0.0, np.full(m.logp.shape[1] - 1, m.enter)), []
    for x in e[1:]:
        away = int(v[1:].argmax()) + 1
        come, leave = v[0] + m.enter > v[1:] + stay, v[away] + mojibake.LEAVE > v[0]
        back.append([away if leave else 0, *(0 if c else k for k, c in enumerate(come, 1))])
        v = x + np.append(v[away] + mojibake.LEAVE if leave else v[0], np.where(come, v[0] + m.enter, v[1:] + stay))
    path = [int(v.argmax())]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def test_only_stretches_that_can_be_garbled_are_searched():
    """The labels are those of a search over whole texts, wherever the spans stand; most signs of the texts are not searched."""
    r = random.Random(7)
    m = mojibake.fit([RULE] * 2000 + ["plain text of a rule, 2024; é ü"] * 200)
    texts = ["", "a", "é"]
    for _ in range(150):
        parts = [r.choice([RULE[: r.randint(0, 40)], mojibake.misread(RULE[: r.randint(1, 6)], *r.choice(mojibake.PAIRS)), "text 12", "é", "锟斤拷", "玲"]) for _ in range(r.randint(1, 6))]
        texts.append("".join(parts))
    texts += [t + "。" * 3 for t in texts]
    found = mojibake.label(m, texts)
    assert [p.tolist() for p in found] == [plain_viterbi(m, t) if t else [] for t in texts]
    assert sum(map(np.any, found)) > 100
    long = [RULE * 20 + mojibake.misread(RULE[:5], "utf-8", "cp1252") + RULE * 20] * 3
    assert 0 < sum(b - a for _, a, b in mojibake._windows(m, long)) < sum(map(len, long)) / 20


def test_texts_are_misread_once_for_the_counts(spark, monkeypatch):
    """Where the usual signs change, only rows with a sign that was or is no longer usual are misread again; the model is the same."""
    rare = "经办人：玲瑞继启倡函。"
    rows = [(i, f"{RULE}{i}") for i in range(400)] + [(1000 + i, rare) for i in range(8)] + [(2000 + i, "经办人" + mojibake.misread("玲瑞继启倡函", "utf-8", "cp1252") + "。") for i in range(5)] + [(3000, "å" + RULE)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    asked = []
    count = mojibake.pair_counts
    monkeypatch.setattr(mojibake, "pair_counts", lambda df, *x: asked.append(df) or count(df, *x))
    model = mojibake.fit_model(df, "id", "text")
    assert len(asked) == 2 and asked[0] is df  # all rows, and those found
    first = mojibake.usual_signs(mojibake.without_lost(mojibake.sign_counts(df, "text")))
    assert first != model.usual
    monkeypatch.undo()
    left = df.join(asked[1], "text", "left_anti")
    clean = mojibake.without_lost(mojibake.sign_counts(left, "text"))
    want = mojibake.fit_counts(clean, mojibake.pair_counts(left, "text", mojibake.usual_signs(clean), mojibake.PAIRS))
    assert model.usual == want.usual and np.array_equal(model.signs, want.signs) and np.array_equal(model.logp, want.logp)
