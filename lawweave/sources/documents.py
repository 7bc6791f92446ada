"""Text of office files: one Arrow UDF over file contents, a small parser per format."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from lawweave.functions.text import suffix


def docx_text(data: bytes) -> str:
    """Paragraphs of a word document, one per line, tabs and breaks kept."""
    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
    out = []
    for p in root.iter():
        if p.tag.endswith("}p"):
            parts = [(n.text or "") if n.tag.endswith("}t") else "\t" if n.tag.endswith("}tab") else "\n" if n.tag.endswith("}br") else "" for n in p.iter()]
            out.append("".join(parts))
    return "\n".join(out)


def xlsx_text(data: bytes) -> str:
    """Sheets in order, each with its name as a heading, cells of a row joined by tabs."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    tag = lambda n: n.tag.rpartition("}")[2]
    shared = ["".join(t.text or "" for t in s.iter() if tag(t) == "t") for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    sheets = [s.get("name", "") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if tag(s) == "sheet"] if "xl/workbook.xml" in names else []
    files = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
    out = []
    for i, name in enumerate(files):
        out.append(f"# {sheets[i] if i < len(sheets) else name}")
        for row in (r for r in ElementTree.fromstring(z.read(name)).iter() if tag(r) == "row"):
            cells = []
            for c in row:
                value = "".join(v.text or "" for v in c.iter() if tag(v) in ("v", "t"))
                cells.append(shared[int(value)] if c.get("t") == "s" and value.isdigit() and int(value) < len(shared) else value)
            if any(cells):
                out.append("\t".join(cells))
    return "\n".join(out)


def pdf_text(data: bytes) -> str | None:
    """Pages joined by blank lines, where a PDF reader is installed; else null."""
    try:
        from pypdf import PdfReader
    except ImportError:
        return None
    return "\n\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages)


def plain_text(data: bytes) -> str:
    """UTF-8, else GB 18030, else UTF-8 with substitutes."""
    for e in ("utf-8-sig", "gb18030"):
        try:
            return data.decode(e)
        except UnicodeDecodeError:
            pass
    return data.decode("utf-8", "replace")


def zip_text(data: bytes, above: frozenset[bytes] = frozenset()) -> str:
    """The texts of an archive's members in order of their names, each under its name as a heading; archives inside it are opened as well.

    An archive that lies in itself is not opened again.
    """
    above = above | {hashlib.sha1(data).digest()}
    out = []
    z = zipfile.ZipFile(io.BytesIO(data))
    for n in sorted(z.namelist()):
        t = None if n.endswith("/") else file_text(n, z.read(n), above)
        if t:
            out.append(f"# {n}\n{t}")
    return "\n\n".join(out)


def file_text(path: str, data: bytes | None, above: frozenset[bytes] = frozenset()) -> str | None:
    """The text of a file by its suffix; null for an unknown format, no content, or a damaged file."""
    end = re.search(r"\.[^./]+$", path.lower())
    kinds = {".docx": docx_text, ".xlsx": xlsx_text, ".pdf": pdf_text, ".txt": plain_text, ".csv": plain_text, ".md": plain_text}
    try:
        if data is None:
            return None
        if end and end[0] == ".zip":
            return None if hashlib.sha1(data).digest() in above else zip_text(data, above)
        return kinds[end[0]](data) if end and end[0] in kinds else None
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, OSError):
        return None


@pandas_udf(StringType())
def _text(path: pd.Series, content: pd.Series) -> pd.Series:
    return pd.Series([file_text(p or "", c) for p, c in zip(path, content, strict=True)], dtype=object)


def extract_texts(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, suffix, text, chars) of files; a text that could not be read is null."""
    t = files.select(F.col(path).alias("path"), suffix(F.col(path)).alias("suffix"), _text(F.col(path), F.col(content)).alias("text"))
    return t.withColumn("chars", F.coalesce(F.length("text"), F.lit(0)))


@pandas_udf(StringType())
def _decoded(content: pd.Series, declared: pd.Series) -> pd.Series:
    def one(b: bytes | None, d: str | None) -> str | None:
        if b is None:
            return None
        m = re.search(r"charset=[\"']?([\w-]+)", d or "", re.I)
        for e in [*([m[1]] if m else []), "utf-8", "gb18030"]:
            try:
                return b.decode(e)
            except (UnicodeDecodeError, LookupError):
                pass
        return b.decode("utf-8", "replace")

    return pd.Series([one(b, d) for b, d in zip(content, declared, strict=True)], dtype=object)


def decoded(content: Column, content_type: Column) -> Column:
    """A page's bytes by the declared charset, else UTF-8, else GB 18030, else UTF-8 with substitutes."""
    return _decoded(content, content_type)
