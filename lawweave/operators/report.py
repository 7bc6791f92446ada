"""Grouped reports: counts, last rows, orders, Markdown lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawweave.session import cut


def counts_by(df: DataFrame, group: str, **flags: Column) -> DataFrame:
    """(group, n, one count per flag); a missing group as ``unknown``."""
    return df.groupBy(F.coalesce(F.col(group), F.lit("unknown")).alias(group)).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in flags.items()))


def last_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The last ``n`` rows of an order that names every row."""
    return df.orderBy(*(F.desc_nulls_last(c) for c in order)).limit(n)


def newest(df: DataFrame, group: str, date: str, title: str, id: str, n: int) -> DataFrame:
    """Per group its ``n`` newest rows: date, then title, both descending with null as empty; ties by id."""
    w = Window.partitionBy(group).orderBy(F.desc(F.coalesce(date, F.lit(""))), F.desc(F.coalesce(title, F.lit(""))), id)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def matches(q: str, *columns: str) -> Column:
    """Whether any of the columns holds ``q``, without regard to case; an empty ``q`` holds everywhere."""
    if not q:
        return F.lit(True)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(q.lower())), F.lit(False))
    return hit


def ranked_levels(level: Column, order: Sequence[str]) -> Column:
    """The position of a level in an order; those not in it come last."""
    c = F.lit(len(order))
    for i, x in enumerate(order):
        c = F.when(level == x, i).otherwise(c)
    return c


def band(score: Column, edges: Mapping[str, float], rest: str) -> Column:
    """The name of the first edge a score, clamped to 0..1, reaches."""
    s = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    c = F.lit(rest)
    for name, edge in sorted(edges.items(), key=lambda x: x[1]):
        c = F.when(s >= edge, F.lit(name)).otherwise(c)
    return c


def md_link(title: Column, url: Column) -> Column:
    """A Markdown link whose text cannot break a table cell; the bare title without a URL."""
    t = F.replace(F.coalesce(title, F.lit("")), F.lit("|"), F.lit("/"))
    return F.when(F.coalesce(url, F.lit("")) != "", F.format_string("[%s](%s)", t, url)).otherwise(t)


def numbered(df: DataFrame, group: str, *order: Column, hot: int = 200_000) -> DataFrame:
    """``df`` with ``line_no``, from 1, in each group by ``order``, which has to name every row.

    A group is one window only up to ``hot`` rows.  The rows of a larger one are dealt over ranges of the order, ranked
    within their range, and a range starts where those before it end, so that no group is sorted in one task.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group).count().where(F.col("count") > hot).collect()}  # at most one row per ``hot`` rows
    own = Window.partitionBy(group).orderBy(*order)
    if not counts:
        return df.withColumn("line_no", F.row_number().over(own))
    large = F.col(group).isin(*counts)
    ranges = df.where(large).repartitionByRange(sum(-(-n // hot) for n in counts.values()), F.col(group), *order).withColumn("_range", F.spark_partition_id())
    ranges = cut(ranges)  # the ranges are drawn from a sample, so they are drawn once
    sizes = ranges.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(group, "_range", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    rest = df.where(~F.coalesce(large, F.lit(False))).withColumn("line_no", F.row_number().over(own))
    ranked = ranges.withColumn("_k", within).join(offsets, [group, "_range"]).withColumn("line_no", (F.col("_before") + F.col("_k")).cast("int"))
    return rest.unionByName(ranked.drop("_range", "_k", "_before"))


def md_row(*cells: Column) -> Column:
    """A row of a Markdown table; null cells are empty and no cell can break the row."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("/")) for c in cells)), F.lit(" |"))


def md_table(df: DataFrame, group: str, cells: Sequence[Column], *order: Column) -> DataFrame:
    """(group, line_no, line): the rows of each group's Markdown table, numbered by the order.

    Rows stay rows: no group's page is built in one task.
    """
    return numbered(df, group, *order).select(group, "line_no", md_row(*cells).alias("line"))


def md_page(heads: Sequence[str], columns: Sequence[str], rows: DataFrame, group: str) -> DataFrame:
    """(group, part, line_no, line) of a page: the title's lines, then per group, in order, its heading, the table's head and its rows."""
    spark = rows.sparkSession
    top = spark.createDataFrame([(None, 0, i, h) for i, h in enumerate(heads)], f"{group} string, part int, line_no int, line string")
    groups = rows.select(group).distinct()
    table_head = ["", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines = F.array(F.struct(F.lit(1).alias("part"), F.lit(0).alias("line_no"), F.concat(F.lit("## "), group).alias("line")), *(F.struct(F.lit(1).alias("part"), F.lit(i).alias("line_no"), F.lit(x).alias("line")) for i, x in enumerate(table_head, 1)))
    return top.unionByName(groups.select(group, F.inline(lines))).unionByName(rows.select(group, F.lit(2).alias("part"), "line_no", "line"))


# The weight of a hit's level in the order by authority.
LEVELS = {"法律": 5, "行政法规": 4, "部门规章": 3, "规范性文件": 2, "行业自律规则": 1}


def sorted_hits(hits: DataFrame, by: str, id: str, most: int = 20, levels: Mapping[str, int] = LEVELS) -> DataFrame:
    """The first ``most`` hits by ``score``, ``authority`` or ``date``, descending, with their ``place``, and how many ``more`` there are.

    Missing values come last; ties by id.  The number of all hits is one row.
    """
    keys = {"score": F.col("score"), "authority": F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in levels.items() for x in kv)), F.col("authority_level")), F.lit(0)), "date": F.coalesce("published_at", F.lit(""))}
    if by not in keys:
        raise ValueError(f"no order by {by!r}")
    top = hits.withColumn("_key", keys[by]).orderBy(F.desc_nulls_last("_key"), id).limit(most)
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("_key"), id))  # ``most`` rows
    total = hits.agg(F.count("*").alias("_all"))
    return top.withColumn("place", place).join(F.broadcast(total)).withColumn("more", F.greatest(F.col("_all") - most, F.lit(0))).drop("_key", "_all")


def run_summary(df: DataFrame, group: str, **counts: Column) -> DataFrame:
    """(summary): one JSON document with the counts of every group, groups in order.  One row per group is collected."""
    per = df.groupBy(F.coalesce(F.col(group), F.lit("unknown")).alias(group)).agg(*(F.count_if(c).alias(k) for k, c in counts.items()))
    return per.agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct(group, *counts))).alias("summary"))).alias("summary"))


def plain_report(title: Column, basis: Column, notes: Column) -> Column:
    """A report as plain text: the title, a numbered basis (title, article, url), the notes as a list; empty parts are left out."""
    cited = F.transform(basis, lambda b, i: F.concat((i + 1).cast("string"), F.lit(". 《"), F.coalesce(b["title"], F.lit("")), F.lit("》"), F.when(F.coalesce(b["article"], F.lit("")) != "", F.concat(F.lit(" 第"), b["article"], F.lit("条"))).otherwise(""), F.when(F.coalesce(b["url"], F.lit("")) != "", F.concat(F.lit("\n   "), b["url"])).otherwise("")))
    listed = F.transform(notes, lambda x: F.concat(F.lit("- "), x))
    parts = F.array(title, F.when(F.size(basis) > 0, F.concat(F.lit("── 法规依据 ──\n"), F.array_join(cited, "\n"))), F.when(F.size(notes) > 0, F.concat(F.lit("── 待补充信息 ──\n"), F.array_join(listed, "\n"))))
    return F.array_join(F.filter(parts, lambda x: x.isNotNull()), "\n\n")


def history(messages: DataFrame, owner: str, order: str, kind: str, wanted: str, most: int = 20) -> DataFrame:
    """Per owner its last ``most`` messages of one kind, the newest first, with their ``place``."""
    w = Window.partitionBy(owner).orderBy(F.desc(order))
    return messages.where(F.col(kind) == wanted).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def distinct_urls(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct non-empty values of several URL columns."""
    return df.select(F.explode(F.array(*columns)).alias("url")).where(F.coalesce("url", F.lit("")) != "").distinct()
