"""Scans and sinks: JSON lines, registries, CSV manifests, text and binary files by reference."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or a glob) has any file, on whatever file system it names."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines under a fixed schema; a missing path is an empty table.

    ``strict``: a malformed line fails the query.  Otherwise malformed lines are dropped.  Blank lines never count.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_json_list(spark: SparkSession, path: str, field: str) -> DataFrame:
    """The objects of a list inside one JSON document, as rows."""
    return spark.read.option("multiLine", True).json(path).select(F.inline(field))


def read_terms(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """(dimension, term) of a JSON document of string lists; a document that can't be parsed has none."""
    doc = spark.read.schema(StructType([StructField(f, ArrayType(StringType())) for f in fields])).option("multiLine", True).json(path)
    return doc.select(F.explode(F.array(*(F.struct(F.lit(f).alias("dimension"), F.col(f).alias("terms")) for f in fields))).alias("d")).select("d.dimension", F.explode("d.terms").alias("term"))


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, text) of whole text files."""
    return spark.read.format("text").option("wholetext", True).option("pathGlobFilter", glob).load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """(path, content) of binary files; ``keep``: which paths count, decided before their bytes are read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    return (found.where(keep(F.col("path"))) if keep else found).select("path", "content")


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV with a header, fields quoted with doubled quotes."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-empty keys of a scan."""
    return df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").select(key).distinct()


def sorted_json(df: DataFrame) -> DataFrame:
    """(value): each row as a JSON object with its keys in order; nulls are written."""
    return df.select(F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns))), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with sorted keys; Spark's commit makes the overwrite or append visible at once.

    A table must not be overwritten while it is read: materialise it first (``session.cut``).
    """
    sorted_json(df).write.mode(mode).text(path)


def write_manifest(df: DataFrame, path: str) -> None:
    """A CSV with header, every field quoted, quotes doubled."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def is_error_page(content: Column, first: int = 4096) -> Column:
    """Whether a downloaded file is an HTML error page: HTML among its first bytes, and a refusal; empty or null counts as one."""
    head = F.lower(F.decode(F.substring(content, 1, first), "ISO-8859-1"))
    refused = head.rlike("403|forbidden|request-id|access denied") | F.contains(F.substring(content, 1, first), F.encode(F.lit("访问错误"), "UTF-8"))
    return F.coalesce(F.length(content) == 0, F.lit(True)) | (head.rlike("<!doctype html|<html|<head|<body") & refused)
