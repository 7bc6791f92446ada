"""Keyed merges: last row wins, upserts, field-wise merges, null-safe anti joins, and the lifecycle of gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawweave.functions.text import truthy


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest order values (nulls lowest); equal rows count once.

    Spark keeps one row per key and task before the shuffle (a window with a rank filter), so a hot key is reduced
    first and each row moves once.  Rows whose key is null or empty drop out.  Ties are settled by all other columns
    that can be compared, so the result does not depend on arrival.
    """
    comparable = [f.name for f in df.schema if f.name not in {*keys, *order} and f.dataType.typeName() not in ("map", "variant")]
    present = reduce(Column.__and__, (F.col(k).isNotNull() & (F.col(k).cast("string") != "") for k in keys))
    w = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in (*order, *comparable)))
    return df.where(present).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows replaced as a whole by new ones of the same key, other new rows added; null keys are kept as they are.

    ``new`` should have one row per key (see ``last_per_key``); missing columns are null.
    """
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def merge_fields(left: DataFrame, right: DataFrame, keys: Sequence[str], prefer: Mapping[str, str]) -> DataFrame:
    """Left join with one value per shared column: ``prefer[column]`` is ``left`` or ``right``, whose value counts unless null or empty."""
    r = right.select(*keys, *(F.col(c).alias(f"_r_{c}") for c in prefer))
    own, other = (lambda c: F.col(c)), (lambda c: F.col(f"_r_{c}"))
    pick = {c: (own(c), other(c)) if side == "left" else (other(c), own(c)) for c, side in prefer.items()}

    def chosen(c: str) -> Column:
        a, b = pick[c]
        kind = left.schema[c].dataType.typeName()
        if kind == "string":
            return truthy(a, b)
        if kind == "array":
            return F.coalesce(F.when(F.size(a) > 0, a), F.when(F.size(b) > 0, b))
        return F.coalesce(a, b)

    return left.join(r, list(keys), "left").select(*(chosen(c).alias(c) if c in prefer else F.col(c) for c in left.columns))


def absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows, one per key, whose key is not among the existing; null equals null."""
    new = new.dropDuplicates(list(keys))
    e = existing.select(*(F.col(k).alias(f"_e_{k}") for k in keys)).distinct()
    return new.join(e, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys)), "left_anti")


def insert_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The existing rows and the new ones whose key was not there."""
    return existing.unionByName(absent(new, existing, keys), allowMissingColumns=True)


def flag_resolved(gaps: DataFrame, docs: DataFrame, doc: str, source: str, whole_sources: Sequence[str] = ()) -> DataFrame:
    """Gaps with ``resolved``: their document is there now, or their source counts as resolved as a whole once a document of it is."""
    d = docs.where(F.col(doc).isNotNull()).select(F.col(doc).alias("_d")).distinct().withColumn("_hit", F.lit(True))
    out = gaps.join(d, F.col(doc) == F.col("_d"), "left").drop("_d")
    if whole_sources:
        s = docs.where(F.col(source).isin(*whole_sources)).select(F.col(source).alias("_s")).distinct().withColumn("_src", F.lit(True))
        out = out.join(F.broadcast(s), F.col(source) == F.col("_s"), "left").drop("_s")  # at most one row per listed source
        return out.withColumn("resolved", F.coalesce("_hit", "_src", F.lit(False))).drop("_hit", "_src")
    return out.withColumn("resolved", F.coalesce("_hit", F.lit(False))).drop("_hit")


def split_resolved(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open, resolved) gaps."""
    return flagged.where(~F.col("resolved")).drop("resolved"), flagged.where("resolved").drop("resolved")


def replace_for(existing: DataFrame, retried: DataFrame, new: DataFrame, scope: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Every existing row in the scope of a retried one removed, then the new rows added once per key."""
    r = retried.select(*(F.col(k).alias(f"_r_{k}") for k in scope)).distinct()
    kept = existing.join(r, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in scope)), "left_anti")
    return insert_absent(kept, new, keys)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Tables with different columns as one; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def seen_anti(df: DataFrame, key: str, seen: DataFrame, seen_key: str) -> DataFrame:
    """Distinct non-null keys of ``df`` that were not seen before."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().join(seen.select(F.col(seen_key).alias(key)).distinct(), key, "left_anti")
