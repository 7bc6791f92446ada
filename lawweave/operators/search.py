"""Search: query expansion, BM25 over evidence, titles and texts, deduplication, quotas; keyword search."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawweave.functions.search import DELIMITERS, bm25
from lawweave.functions.text import keyword_score, preview, round_half_up
from lawweave.operators.index import corpus_statistics, document_frequency, postings
from lawweave.session import small

# Weights of the levels of authority.
AUTHORITY: dict[str, float] = {"law": 5.0, "administrative_regulation": 4.5, "department_rule": 4.0, "normative_doc": 3.0, "self_regulatory_rule": 2.5, "exchange_rule": 2.0, "business_guideline": 1.5}


def _tokens(s: str) -> list[str]:
    """Driver-side twin of ``functions.search.tokens`` for the query, which is a parameter."""
    out = []
    for w in re.split(DELIMITERS, s):
        if len(w) >= 2:
            out += [w, *(w[i : i + 2] for i in range(len(w) - 1))]
    return out


Dictionary = Mapping[str, Sequence[str]]


def dictionaries(registry: DataFrame, most: int = 10_000) -> tuple[Dictionary, Dictionary]:
    """(expansions, taxonomy) of a registry: a keyword stands for the other keywords of its sources, and for their product types.

    The registry is a parameter table; more than ``most`` pairs are refused, as the terms of a query are a parameter too.
    """
    k = registry.select(F.explode("include_keywords").alias("key"), "include_keywords", "product_types").where("key <> ''")
    pairs = k.select("key", F.lit(0).alias("kind"), F.explode("include_keywords").alias("term")).where("term <> key").unionByName(k.select("key", F.lit(1).alias("kind"), F.explode("product_types").alias("term"))).distinct()
    rows = pairs.orderBy("kind", "key", "term").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a dictionary of more than {most} pairs")
    out: tuple[dict, dict] = ({}, {})
    for key, kind, term in rows:
        out[kind].setdefault(key, []).append(term)
    return out


def expand(query: str, expansions: Dictionary, taxonomy: Dictionary) -> tuple[list[str], list[str]]:
    """(distinct query terms in order, taxonomy terms): a key fires if the query holds it or its first two signs."""
    fired = [x for k, v in expansions.items() if k in query or k[:2] in query for x in v]
    tax = [x for k, v in taxonomy.items() if k in query or k[:2] in query for x in v]
    wide = dict.fromkeys([query, *fired, *tax, *(t.replace("_", " ") for t in tax)])
    terms = _tokens(query)
    for e in wide:
        terms += [*_tokens(e), *([e] if len(e) >= 2 else [])]
    return list(dict.fromkeys(terms)), list(dict.fromkeys(tax))


def expand_column(query: Column, dictionary: DataFrame, queries: DataFrame, id: str) -> DataFrame:
    """(id, expansion): every expansion whose key, or the key's first two signs, the query holds, and the query itself.

    ``dictionary`` (key, expansion) is a small parameter table; the match is on substrings.
    """
    q = queries.select(F.col(id), query.alias("_q")).where(F.trim(F.col("_q")) != "")
    hit = F.contains(F.col("_q"), F.col("key")) | F.contains(F.col("_q"), F.substring("key", 1, 2))
    found = q.join(small(dictionary.where("key <> ''"), 10_000), hit).select(id, "expansion")
    return found.unionByName(q.select(id, F.col("_q").alias("expansion"))).distinct()


def scores(df: DataFrame, id: str, text: Column, terms: Sequence[str], bigrams: bool) -> DataFrame:
    """(id, bm25): summed BM25 of the query's terms; documents without any term are absent.

    Terms are filtered before the first shuffle, so what moves grows with the matches, not with the corpus.
    """
    return scored(postings(df, id, text, bigrams, list(terms)), id, corpus_statistics(df, text))


def scored(postings: DataFrame, id: str, stats: DataFrame) -> DataFrame:
    """(id, bm25) from the query terms' postings (term, id, freq, length) and the corpus' statistics, which are one row."""
    s = postings.join(document_frequency(postings).select("term", "df"), "term").crossJoin(F.broadcast(stats))
    return s.groupBy(id).agg(F.sum(bm25(F.col("freq"), F.col("length"), F.col("avgdl"), F.col("n"), F.col("df"))).alias("bm25"))


def weight(level: Column, weights: Mapping[str, float] = AUTHORITY) -> Column:
    """The weight of an authority level; 1 for any other."""
    c = F.lit(1.0)
    for k, v in weights.items():
        c = F.when(level == k, F.lit(v)).otherwise(c)
    return c


def taxonomy_boost(products: Column, assets: Column, terms: Sequence[str]) -> Column:
    """1.3 for a shared product type times 1.15 for a shared asset class; 1 without terms."""
    if not terms:
        return F.lit(1.0)
    t = F.array(*map(F.lit, terms))
    return F.when(F.coalesce(F.arrays_overlap(products, t), F.lit(False)), 1.3).otherwise(1.0) * F.when(F.coalesce(F.arrays_overlap(assets, t), F.lit(False)), 1.15).otherwise(1.0)


def evidence_text() -> Column:
    parts = F.filter(F.concat(F.array("title", "support_scope"), F.coalesce(F.col("tags"), F.array().cast("array<string>")), F.array("publisher")), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.array_join(parts, " ")


def title_text() -> Column:
    head = F.array_join(F.coalesce(F.col("heading_path"), F.array().cast("array<string>")), " ")
    return F.array_join(F.filter(F.array(F.coalesce("title", F.lit("")), head), lambda x: x != ""), " ")


def full_text() -> Column:
    return F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))


def search(evidence: DataFrame, clauses: DataFrame, query: str, max_evidence: int = 10, max_clauses: int = 20, max_total: int = 25, expansions: Dictionary | None = None, taxonomy: Dictionary | None = None) -> DataFrame:
    """The hits of a query: (rank, source, id, title, excerpt, score), evidence first.

    Three stages - evidence, clause titles with headings, clause texts - each scored by BM25; a clause found by
    its title is not scored by its text.  Scores are rounded half up to two digits and then ranked; of hits with
    the same title and first 80 signs the best stays, after that each source has its quota.  Ties go by stage and
    id.  One row per clause id and evidence id is assumed (see ``merge.last_per_key``).  A blank query has no hits.
    This reads all texts; ``stored.StoredIndex`` answers many queries from an index instead.
    """
    terms, tax = expand(query, expansions or {}, taxonomy or {}) if query.strip() else ([], [])
    by_stage = (scores(evidence, "evidence_id", evidence_text(), terms, True), scores(clauses, "clause_id", title_text(), terms, True), scores(clauses, "clause_id", full_text(), terms, False))
    return ranked_hits(by_stage, shown_evidence(evidence), shown_clauses(clauses), tax, max_evidence, max_clauses, max_total)


def shown_evidence(evidence: DataFrame) -> DataFrame:
    """What a hit shows of an evidence row."""
    return evidence.select("evidence_id", F.coalesce("title", F.lit("")).alias("title"), F.substring(F.coalesce("support_scope", F.lit("")), 1, 300).alias("excerpt"))


def shown_clauses(clauses: DataFrame) -> DataFrame:
    """What a hit shows of a clause, and what its weight depends on."""
    return clauses.select("clause_id", F.coalesce("title", F.lit("")).alias("title"), F.substring(F.coalesce("text", F.lit("")), 1, 300).alias("excerpt"), "authority_level", "product_types", "asset_classes")


def ranked_hits(by_stage: tuple[DataFrame, DataFrame, DataFrame], evidence: DataFrame, clauses: DataFrame, tax: Sequence[str], max_evidence: int, max_clauses: int, max_total: int) -> DataFrame:
    """The hits from the scores of the three stages; each stage is evaluated once."""
    by_evidence, by_title, by_text = by_stage
    ev = by_evidence.join(evidence, "evidence_id")
    hits_ev = ev.select(F.lit("evidence").alias("source"), F.lit(1).alias("stage"), F.col("evidence_id").alias("id"), "title", "excerpt", (F.col("bm25") * 2).alias("raw"))
    both = by_title.withColumn("stage", F.lit(2)).unionByName(by_text.withColumn("stage", F.lit(3)))
    first = both.groupBy("clause_id").agg(F.min("stage").alias("stage"), F.min_by("bm25", "stage").alias("bm25"))
    raw = F.col("bm25") * weight(F.col("authority_level")) * taxonomy_boost(F.col("product_types"), F.col("asset_classes"), tax)
    hits_cl = first.join(clauses, "clause_id").select(F.lit("clause").alias("source"), "stage", F.col("clause_id").alias("id"), "title", "excerpt", raw.alias("raw"))
    hits = hits_ev.unionByName(hits_cl).select("source", "stage", "id", "title", "excerpt", round_half_up(F.col("raw")).alias("score"))
    return quota(first_by_excerpt(hits), {"evidence": max_evidence, "clause": max_clauses}, max_total)


def first_by_excerpt(hits: DataFrame, signs: int = 80) -> DataFrame:
    """Of hits with the same title and beginning of the excerpt the best one: by score, then stage, then id.

    Spark keeps one hit per task and key before the shuffle, so a title that many hits share is reduced first.
    """
    w = Window.partitionBy("title", F.substring("excerpt", 1, signs)).orderBy(F.desc("score"), "stage", "id")
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def quota(hits: DataFrame, quotas: Mapping[str, int], total: int) -> DataFrame:
    """The best hits of each source up to its quota, sources in the order given, ``total`` at most; with their rank.

    Spark limits each source's rows before the shuffle (a window with a rank filter).
    """
    order = F.lit(len(quotas))
    for i, s in enumerate(quotas):
        order = F.when(F.col("source") == s, i).otherwise(order)
    own = Window.partitionBy("source").orderBy(F.desc("score"), "stage", "id")
    most = max(quotas.values())
    kept = hits.where(F.col("source").isin(*quotas)).withColumn("_k", F.row_number().over(own)).where(F.col("_k") <= most)
    allowed = F.lit(0)
    for s, n in quotas.items():
        allowed = F.when(F.col("source") == s, n).otherwise(allowed)
    kept = kept.where(F.col("_k") <= allowed).withColumn("_o", order)  # at most the sum of the quotas from here on
    return kept.withColumn("rank", F.row_number().over(Window.orderBy("_o", F.desc("score"), "stage", "id"))).where(F.col("rank") <= total).select("rank", "source", "id", "title", "excerpt", "score")


def keyword_search(df: DataFrame, id: str, text: Column, terms: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the highest keyword score above 0, with a preview; ties by id."""
    rows = df.select(F.col(id).alias("id"), text.alias("_t")).select("id", keyword_score(F.col("_t"), terms).alias("score"), "_t").where("score > 0")
    return rows.orderBy(F.desc("score"), "id").limit(k).select("id", "score", preview(F.col("_t"), terms).alias("preview"))


def first_match(keys: DataFrame, key: str, rows: DataFrame, id: str, title: str, *carried: str, gram: int = 12) -> DataFrame:
    """For each key the first row, by id, whose title holds it, without regard to case; keys without a match keep nulls.

    Not a nested loop: titles are taken apart into grams, joined with each key's first gram by equality, and only
    then compared.  Keys shorter than ``gram`` are joined by their whole length.  Null and empty keys match nothing.
    """
    k = keys.select(F.col(key).alias("key")).distinct().withColumn("_low", F.lower("key"))
    usable = k.where(F.length("_low") > 0).withColumn("_n", F.least(F.length("_low"), F.lit(gram))).withColumn("_g", F.substring(F.col("_low"), F.lit(1), F.col("_n")))
    lengths = [r[0] for r in usable.select("_n").distinct().collect()]  # at most ``gram`` values
    r = rows.where(F.col(title).isNotNull()).groupBy(F.lower(F.col(title)).alias("_title")).agg(F.min_by(F.struct(F.col(id).alias("id"), *(F.col(c) for c in carried)), F.col(id)).alias("_r"))
    starts = lambda n: F.transform(F.sequence(F.lit(1), F.length("_title") - n + 1), lambda i: F.substring(F.col("_title"), i, F.lit(n)))
    grams = F.array_distinct(F.flatten(F.array(*(F.when(F.length("_title") >= n, starts(n)).otherwise(F.array().cast("array<string>")) for n in lengths)))) if lengths else F.array().cast("array<string>")
    found = r.select("_title", "_r", F.explode(grams).alias("_g")).join(usable, "_g").where(F.contains(F.col("_title"), F.col("_low")))
    best = found.groupBy(F.col("key").alias("_k")).agg(F.min_by("_r", F.col("_r.id")).alias("_b"))
    return k.select("key").join(best, F.col("key") == F.col("_k"), "left").select("key", F.col("_b.id").alias("id"), *(F.col(f"_b.{c}").alias(c) for c in carried))


def best_candidate(df: DataFrame, group: str, title: Column, date: str, id: str, query: str, active: Column, law: Column, prefix: str = "中华人民共和国") -> DataFrame:
    """Per group the best candidate for a query: the full name of the law 5, title holds the query 2, active 2, a law 2; then the later date, then the id.

    Titles are compared without white space.  The candidates are those whose title holds the query; all where none does.
    """
    q = re.sub(r"\s+", "", query)
    compact = F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", "")
    holds = F.contains(compact, F.lit(q))
    s = F.when(compact == prefix + q, 5).otherwise(0) + F.when(holds, 2).otherwise(0) + F.when(F.coalesce(active, F.lit(False)), 2).otherwise(0) + F.when(F.coalesce(law, F.lit(False)), 2).otherwise(0)
    rows = df.select(group, F.col(id).alias("id"), title.alias("title"), F.coalesce(F.col(date), F.lit("")).alias("date"), s.cast("int").alias("score"), holds.alias("_holds"))
    w = Window.partitionBy(group).orderBy(F.desc("_holds"), F.desc("score"), F.desc("date"), "id")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_holds")
