"""Sources, sinks and streaming on small files made here."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lawweave.sources import documents, files, paged
from lawweave.streaming.incremental import KeyedTable, ingest


def test_jsonl(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": "1", "b": ["x"]}\n\n{"a": "2"}\nnot json\n', encoding="utf-8")
    s = "a string, b array<string>"
    assert files.read_jsonl(spark, str(p), s, strict=False).where("a is not null").count() == 2
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.read_jsonl(spark, str(p), s).collect()
    assert files.read_jsonl(spark, str(tmp_path / "none.jsonl"), s).count() == 0
    df = spark.createDataFrame([("规则", None, "1")], "z string, n string, a string")
    files.write_jsonl(df, str(tmp_path / "out"))
    files.write_jsonl(df, str(tmp_path / "out"), mode="append")
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines == ['{"a":"1","n":null,"z":"规则"}'] * 2


def test_registry_and_terms(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text(json.dumps({"at": "t", "sources": [{"id": "a"}, {"id": "b"}], "x": ["1", "2"], "y": ["3"]}, indent=1))
    assert [r.id for r in files.read_json_list(spark, str(p), "sources").collect()] == ["a", "b"]
    assert files.read_terms(spark, str(p), ["x", "y"]).count() == 3
    p.write_text("{not json")
    assert files.read_terms(spark, str(p), ["x", "y"]).count() == 0


def test_manifest_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', "x\ny")], "n string, t string")
    files.write_manifest(df, str(tmp_path / "m"))
    assert files.read_csv(spark, str(tmp_path / "m"), "n string, t string").collect() == df.collect()


def office() -> dict[str, bytes]:
    def packed(parts: dict[str, str]) -> bytes:
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            for k, v in parts.items():
                z.writestr(k, v)
        return b.getvalue()

    w, s = 'xmlns:w="w"', 'xmlns="s"'
    docx = packed({"word/document.xml": f"<w:d {w}><w:p><w:r><w:t>第一</w:t><w:tab/><w:t>条</w:t></w:r></w:p><w:p><w:r><w:t>二</w:t></w:r></w:p></w:d>"})
    xlsx = packed({"xl/workbook.xml": f'<workbook {s}><sheets><sheet name="表"/></sheets></workbook>', "xl/sharedStrings.xml": f"<sst {s}><si><t>甲</t></si></sst>", "xl/worksheets/sheet1.xml": f'<worksheet {s}><row><c t="s"><v>0</v></c><c><v>5</v></c></row></worksheet>'})
    return {"a.docx": docx, "b.xlsx": xlsx, "c.zip": packed({"in.txt": "内文", "skip.bin": "x"}), "d.txt": "文本".encode("gb18030"), "e.docx": b"broken", "f.bin": b"x"}


def test_office_files(spark, tmp_path):
    for k, v in office().items():
        (tmp_path / k).write_bytes(v)
    got = {r.path.rsplit("/", 1)[-1]: r.text for r in documents.extract_texts(files.read_files(spark, str(tmp_path))).collect()}
    assert got == {"a.docx": "第一\t条\n二", "b.xlsx": "# 表\n甲\t5", "c.zip": "# in.txt\n内文", "d.txt": "文本", "e.docx": None, "f.bin": None}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.txt").write_text("整篇\n文字", encoding="utf-8")
    assert [r.text for r in files.read_texts(spark, str(tmp_path / "t")).collect()] == ["整篇\n文字"]


def test_charsets_and_error_pages(spark):
    rows = [("规则".encode("gbk"), "text/html; charset=GBK"), ("规则".encode(), None), (None, None)]
    df = spark.createDataFrame(rows, "b binary, t string")
    assert [r.x for r in df.select(documents.decoded(F.col("b"), F.col("t")).alias("x")).collect()] == ["规则", "规则", None]
    pages = spark.createDataFrame([(b"<html>403 Forbidden",), (b"%PDF",), (b"",), (None,), ("<html>访问错误".encode(),)], "b binary")
    assert [r.x for r in pages.select(files.is_error_page(F.col("b")).alias("x")).collect()] == [True, False, True, True, True]


def test_paged_source(spark, tmp_path):
    for i in range(5):
        body = json.dumps({"records": [{"id": i * 10 + j} for j in range(3)]})
        (tmp_path / f"page{i}.json").write_text(f"cb({body});" if i == 2 else body)
    paged.register(spark)
    df = spark.read.format("paged_json").option("path", str(tmp_path)).option("pages_per_task", "2").load()
    assert df.count() == 15 and df.rdd.getNumPartitions() == 3
    assert sorted(r.record for r in df.where("page = 2").collect()) == ['{"id": 20}', '{"id": 21}', '{"id": 22}']
    assert paged.total_pages(11, 5) == 3 and paged.total_pages(0, 5) == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = [(f"k{i % 7}", f"{(i * 37) % 50:02d}", str(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, at string, v string")
    df.repartition(6).write.parquet(str(tmp_path / "in"))
    from lawweave.operators.merge import last_per_key

    got = {tuple(r) for r in ingest(spark, str(tmp_path / "in"), ["k"], ["at"], files_per_batch=2).collect()}
    assert got == {tuple(r) for r in last_per_key(df, ["k"], ["at"]).collect()}
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"])
    t.merge(df, 0)
    t.merge(df.where("at < '20'"), 1)
    t.merge(df.where("at < '20'"), 1)
    assert {tuple(r) for r in t.current().collect()} == got


def test_archives_of_any_depth():
    data = b"x"
    for level in range(9):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            z.writestr("in.zip" if level else "in.txt", data)
        data = b.getvalue()
    assert documents.file_text("a.zip", data).endswith("# in.txt\nx")


def test_files_to_skip(spark, tmp_path):
    from lawweave.operators.harvest import usable_file

    for n in ("a.docx", "~$a.docx", "00_form.docx", "b.PDF", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    kept = files.read_files(spark, str(tmp_path), keep=usable_file).select(F.regexp_extract("path", "[^/]*$", 0).alias("n")).collect()
    assert {r.n for r in kept} == {"a.docx", "b.PDF"}
