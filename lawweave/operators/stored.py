"""A stored index: postings, statistics and what hits show, written once and read by every query.

Postings are ranged over files by term and id and sorted by term, so a query's terms are found by the files' own
statistics and a frequent term's postings lie in several files.  A query reads its terms' postings and joins what
hits show by id; no text is tokenised again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawweave.operators import search as srch
from lawweave.operators.index import corpus_statistics, postings

#: Stage, its id column, and whether its terms include pairs of signs.
STAGES = {"evidence": ("evidence_id", True), "title": ("clause_id", True), "text": ("clause_id", False)}


class StoredIndex:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def build(cls, evidence: DataFrame, clauses: DataFrame, folder: str) -> StoredIndex:
        """Write the index of one row per evidence id and clause id (see ``merge.last_per_key``)."""
        rows = {"evidence": (evidence, srch.evidence_text()), "title": (clauses, srch.title_text()), "text": (clauses, srch.full_text())}
        for stage, (id, bigrams) in STAGES.items():
            df, text = rows[stage]
            p = postings(df, id, text, bigrams)
            p.repartitionByRange(F.col("term"), F.col(id)).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/postings/{stage}")
            corpus_statistics(df, text).write.mode("overwrite").parquet(f"{folder}/statistics/{stage}")
        srch.shown_evidence(evidence).write.mode("overwrite").parquet(f"{folder}/shown/evidence")
        srch.shown_clauses(clauses).write.mode("overwrite").parquet(f"{folder}/shown/clauses")
        return cls(evidence.sparkSession, folder)

    def read(self, kind: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{kind}/{name}")

    def scores(self, stage: str, terms: Sequence[str]) -> DataFrame:
        """(id, bm25) of one stage; the terms are pushed into the scan."""
        p = self.read("postings", stage).where(F.col("term").isin(*terms) if terms else F.lit(False))
        return srch.scored(p, STAGES[stage][0], self.read("statistics", stage))

    def search(self, query: str, max_evidence: int = 10, max_clauses: int = 20, max_total: int = 25, expansions: Mapping[str, Sequence[str]] | None = None, taxonomy: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
        """The same hits as ``search.search`` over the indexed rows."""
        terms, tax = srch.expand(query, expansions or {}, taxonomy or {}) if query.strip() else ([], [])
        by_stage = tuple(self.scores(s, terms) for s in STAGES)
        return srch.ranked_hits(by_stage, self.read("shown", "evidence"), self.read("shown", "clauses"), tax, max_evidence, max_clauses, max_total)
