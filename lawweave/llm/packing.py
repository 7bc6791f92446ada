"""Problem 8: items of varying length in containers of a fixed capacity, with little space left unused.

Method: shortest-pack-first over the histogram of lengths.  Lengths are placed longest first, each
item into the shortest pack, that is the open pack with the most room, and into a new one only where
none has room for it.  Equally long items go by packing pattern: a pattern stands for any number of
containers filled alike, so the work depends on the capacity and never on the number of items.
Patterns are then joined back to the items by their rank within their length.

The histogram has at most ``capacity`` rows; the driver sees it and nothing else.  An item larger
than the capacity is cut at token positions into parts: as many full containers as it fills, and a
rest that is packed like any item.  Items of size 0 (null or empty texts) take no room; they are in
container 0.  Ranks are dense per length and do not need one task per length: a length with many items
is dealt over as many salts as its count asks for, and a salt's ranks start where the salts before it
end.  Patterns meet the items by length and by the block of ranks, so that an item only meets the
patterns of its own block.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lawweave.llm.sizes import token_counts
from lawweave.session import cut

#: Most items of one length that are ranked in one task; a length with more is salted.
RANKED_ROWS = 200_000
#: Ranks of one length are joined with the patterns in blocks of so many.
BLOCK = 1_024
#: Most pattern rows that are broadcast; beyond it Spark picks a shuffle join.
BROADCAST_ROWS = 100_000


def pack_histogram(hist: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first: rows (length, first rank, items, first container, items per container).

    Packs are kept by their room.  The packs with the most room take items of the length in step until they have
    less room than the next ones, then these join in, and so on until no pack fits; what remains opens new packs.
    A pattern splits when only a part of its containers takes a further item.
    """
    open_: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)  # room -> [(containers, lengths of the pattern)]
    rooms: list[int] = []  # heap of the rooms, the largest first

    def keep(room: int, n: int, pattern: list[int]) -> None:
        if not open_[room]:
            heapq.heappush(rooms, -room)
        open_[room].append((n, pattern))

    for length in sorted((k for k in hist if 0 < k <= capacity), reverse=True):
        left = hist[length]
        while left:
            while rooms and not open_[-rooms[0]]:
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room < length:  # the shortest pack has no room, so none has
                per = min(capacity // length, left)
                keep(capacity - per * length, left // per, [length] * per)
                if left % per:
                    keep(capacity - left % per * length, 1, [length] * (left % per))
                break
            n, pattern = open_[room].pop()
            if not open_[room]:
                heapq.heappop(rooms)
                while rooms and not open_[-rooms[0]]:
                    heapq.heappop(rooms)
            second = -rooms[0] if rooms else 0
            # Items each of these containers takes before another pack is shorter.
            per = min(room // length, max(1, -((second - room) // length)), max(1, left // n))
            take = min(n, left // per)
            keep(room - per * length, take, pattern + [length] * per)
            if n > take:
                keep(room, n - take, pattern)
            left -= take * per
    rows, container = [], 0
    rank: dict[int, int] = defaultdict(int)
    for n, pattern in sorted(((n, p) for packs in open_.values() for n, p in packs), key=lambda x: (x[1], x[0]), reverse=True):
        for length in dict.fromkeys(pattern):
            per = pattern.count(length)
            rows.append((length, rank[length], n * per, container, per))
            rank[length] += n * per
        container += n
    return rows


def limits(spark_df: DataFrame, purpose: str) -> list[tuple[int, str, int, int]]:
    """(limit_id, tokenizer, capacity, overlap) rows of one purpose; the table is a handful of parameters."""
    return [tuple(r) for r in spark_df.where(F.col("purpose") == purpose).select("limit_id", "tokenizer", "capacity", "overlap").orderBy("limit_id").collect()]


def parts(sizes: DataFrame, id: str, size: str, capacity: int) -> DataFrame:
    """(id, part, start, size): one row per item that fits; the full parts and the rest of one that does not."""
    n = F.col(size)
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(n / capacity).cast("int") - 1))
    return sizes.select(id, n.alias("_n"), F.explode(cuts).alias("part")).select(id, "part", (F.col("part") * capacity).alias("start"), F.least(F.lit(capacity), F.col("_n") - F.col("part") * capacity).alias("size"))


def ranked(items: DataFrame, id: str, hist: dict[int, int], hot: int = RANKED_ROWS) -> DataFrame:
    """Items with a dense rank from 0 within their size, in an order that is the same on every run.

    ``hist``: the number of items per size; a size with more than ``hot`` is dealt over several tasks.
    """
    many = {k: -(-n // hot) for k, n in hist.items() if n > hot}
    salt = F.lit(0)
    if many:  # at most one entry per length, so bounded by the capacity
        salts = F.coalesce(F.create_map(*(F.lit(x) for kv in many.items() for x in kv))[F.col("size")], F.lit(1))
        salt = F.pmod(F.xxhash64(id, "part"), salts).cast("int")
    salted = items.withColumn("salt", salt)
    within = F.row_number().over(Window.partitionBy("size", "salt").orderBy(id, "part")) - 1
    if not many:
        return salted.select(id, "part", "start", "size", within.cast("long").alias("rank"))
    counts = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("size", "salt", F.coalesce(before, F.lit(0)).alias("offset"))
    # The window has partitioned the items by size and salt already, so the join moves only the offsets.
    return salted.withColumn("within", within).join(offsets, ["size", "salt"]).select(id, "part", "start", "size", (F.col("offset") + F.col("within")).alias("rank"))


def pack(sizes: DataFrame, id: str, size: str, capacity: int) -> DataFrame:
    """(id, part, start, size, container) of every item: whole and in one container, unless it exceeds the capacity."""
    spark: SparkSession = sizes.sparkSession
    items = parts(sizes, id, size, capacity)
    hist = {r[0]: r[1] for r in items.groupBy("size").count().collect()}  # at most capacity + 1 rows
    schema = StructType([StructField("size", IntegerType())] + [StructField(c, LongType()) for c in ("lo", "items", "first", "per")])
    rows = pack_histogram(hist, capacity)
    patterns = spark.createDataFrame(rows, schema)
    blocks = F.sequence(F.floor(F.col("lo") / BLOCK), F.floor((F.col("lo") + F.col("items") - 1) / BLOCK))
    patterns = patterns.withColumn("block", F.explode(blocks))
    if len(rows) + sum(hist.values()) // BLOCK <= BROADCAST_ROWS:
        patterns = F.broadcast(patterns)
    full = ranked(items.where(F.col("size") > 0), id, hist).withColumn("block", F.floor(F.col("rank") / BLOCK))
    placed = full.join(patterns, ["size", "block"]).where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("lo") + F.col("items")))
    placed = placed.select(id, "part", "start", "size", (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))).cast("long").alias("container"))
    return placed.unionByName(items.where(F.col("size") == 0).select(id, "part", "start", "size", F.lit(0).cast("long").alias("container")))


def pack_documents(docs: DataFrame, id: str, text: str, size_limits: DataFrame, folder: str | None = None) -> DataFrame:
    """(limit_id, id, part, start, size, container) for every container limit; each tokenizer counts each text once."""
    todo = limits(size_limits, "container")
    names = list(dict.fromkeys(t for _, t, _, _ in todo))
    sizes = cut(token_counts(docs, id, text, names, folder))  # three numbers a document, used several times per limit
    out = None
    for limit, tokenizer, capacity, _ in todo:
        p = pack(sizes, id, tokenizer, capacity).select(F.lit(limit).alias("limit_id"), id, "part", "start", "size", "container")
        out = p if out is None else out.unionByName(p)
    if out is None:
        raise ValueError("size_limits has no container rows")
    return out


def usage(packed: DataFrame, size_limits: DataFrame) -> DataFrame:
    """Per limit: containers, tokens, and the share of the containers' room that is filled."""
    per = packed.groupBy("limit_id").agg(F.countDistinct("container").alias("containers"), F.sum("size").alias("tokens"))
    return per.join(size_limits.select("limit_id", "capacity"), "limit_id").select("limit_id", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("filled"))
