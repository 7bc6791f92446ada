"""Registered queries of the text operators, each over its whole tables, and SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawweave.llm import boilerplate, bpe, mojibake, packing, repeated_lines, residue, scan_noise, splitting, unify
from lawweave.llm.common import clauses
from lawweave.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.find_traces(clauses(spark, d, "clause_id", "text", "title", "publisher"), "clause_id", "text", "title", "publisher")


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every clause's text as continuous paragraphs, without what belongs to the paper page."""
    return scan_noise.repair(clauses(spark, d, "clause_id", "text", "title", "publisher"), "clause_id", "text", "title", "publisher")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    c = clauses(spark, d, "clause_id", "text")
    return mojibake.restore_encoding(c, "clause_id", "text", only_found=True).distinct()


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    """The affected clauses with their wording restored as far as the bytes allow."""
    c = clauses(spark, d, "clause_id", "text")
    return mojibake.restore_encoding(c, "clause_id", "text").where("garbled").dropDuplicates(["clause_id"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    c, g = clauses(spark, d, "source_id", "doc_id", "text"), table(spark, d, "resolved_gaps", "source_id", "doc_id")
    return repeated_lines.repeated_lines(c, "source_id", "doc_id", "text", g, least_docs=4, least_share=0.1, ratio=False).select("source_id", "line")


def p3_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every clause's text without its source's repeated lines."""
    c, g = clauses(spark, d, "clause_id", "source_id", "doc_id", "text"), table(spark, d, "resolved_gaps", "source_id", "doc_id")
    lines = repeated_lines.repeated_lines(c, "source_id", "doc_id", "text", g, least_docs=4, least_share=0.1, ratio=False)
    return repeated_lines.remove_lines(c, "clause_id", "source_id", "doc_id", "text", lines, g)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.page_lines(clauses(spark, d, "clause_id", "text"), "clause_id", "text")


def p4_main_text(spark: SparkSession, d: str) -> DataFrame:
    """Every clause's text without the lines of the page around it; repeated rows stay."""
    return boilerplate.main_text(clauses(spark, d, "clause_id", "text"), "clause_id", "text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.look_alike_pairs(clauses(spark, d, "clause_id", "title", "text"), "clause_id", "title", "text")


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every clause that looks like another one of other characters, with its class and spelling; not expanded into pairs."""
    return unify.look_alike_classes(clauses(spark, d, "clause_id", "title", "text"), "clause_id", "title", "text")


def p5_unified(spark: SparkSession, d: str) -> DataFrame:
    """Titles and texts in the one consistent form; repeated rows stay."""
    c = clauses(spark, d, "clause_id", "title", "text")
    return c.select("clause_id", unify.unify(F.col("title")).alias("title"), unify.unify(F.col("text")).alias("text"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    c = clauses(spark, d, "clause_id", "text")
    return residue.score_records(c, "clause_id", "text", only_found=True).distinct()


def p6_kept(spark: SparkSession, d: str) -> DataFrame:
    """The clauses that remain once residue is left out."""
    c = clauses(spark, d, "clause_id", "doc_id", "text")
    return residue.exclude_residue(c, "clause_id", "text").select("clause_id", "doc_id").distinct()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Whether decoding the ids of each document gives its text again."""
    return bpe.round_trip(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document's (or part's) container, for each container limit."""
    return packing.pack_documents(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", table(spark, d, "size_limits"))


def p8_usage(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and filled share per container limit."""
    return packing.usage(p8_containers(spark, d), table(spark, d, "size_limits"))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of every oversized document, for each piece limit."""
    return splitting.split_documents(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", table(spark, d, "size_limits"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_repaired, p2_found, p2_restored, p3_found, p3_cleaned, p4_found, p4_main_text, p5_found, p5_classes, p5_unified, p6_found, p6_kept, p7_ids, p7_round_trip, p8_containers, p8_usage, p9_pieces)}

_LINES = """
with known as (select doc_id, min(source_id) as s from resolved_gaps where doc_id is not null group by doc_id),
c as (select distinct coalesce(c.source_id, k.s) as source_id, c.doc_id, c.text from clauses c left join known k on c.doc_id = k.doc_id),
n as (select source_id, count(distinct doc_id) as n from c where source_id is not null group by source_id),
l as (select source_id, doc_id, regexp_replace(trim(regexp_replace(unnest(string_split(text, chr(10))), '[ \\t\\r' || chr(160) || chr(12288) || ']+', ' ', 'g')), '[0-9]+', '0', 'g') as line from c)
"""

SQL: dict[str, str] = {
    "p3_found": _LINES + "select l.source_id, l.line from l join n on l.source_id = n.source_id where l.line <> '' group by l.source_id, l.line, n.n having count(distinct l.doc_id) >= 4 and 10 * count(distinct l.doc_id) >= n.n",
    "p7_round_trip": "select doc_id, true as same from documents",
}
