"""Filling containers of a fixed capacity with items of varying length (problem 8).

Method: length-histogram planning. Items are counted by length, best-fit decreasing runs over
the counts (a whole group of equal items goes at once into a whole group of containers with
equal room), and the plan says which ranks of each length go to which containers. Items then
take their slots by joining on their rank within their length. No item travels to the driver:
the histogram has at most `capacity` rows whatever the number of items.

An item larger than a container, and only such an item, is divided into full containers and
one rest, which is packed like any other item.

Ranks come from counts per length and salt, of which there are as many as keep a task's share at
ITEMS_PER_SALT, so a length that a third of all items share is numbered in many tasks. Events are cut
at blocks of BLOCK ranks, so an item meets only the events of its length and block. Defined results: null keys are kept as keys, items of no size take no
container; repeated keys are items of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY = 2048
ITEMS_PER_SALT = 200_000
BLOCK = 4096
#: A plan of so many events at most is broadcast; beyond it Spark joins by shuffling.
BROADCAST_EVENTS = 100_000


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over counts: (events, number of containers).

    An event (length, rank, count, container, offset) puts the items of that length with ranks
    rank .. rank+count-1 into containers container .. container+count-1, each at `offset`.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> [(first container, how many)]
    sizes: list[int] = []  # rooms that have containers, sorted
    events: list[tuple[int, int, int, int, int]] = []
    total = 0

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            if not rooms[room]:
                insort(sizes, room)
            rooms[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                n = -(-left // (capacity // length))
                give(capacity, total, n)
                total += n
                continue
            room = sizes[at]
            first, n = rooms[room].pop()
            if not rooms[room]:
                sizes.pop(at)
            k = min(n, left)
            events.append((length, rank, k, first, capacity - room))
            give(room, first + k, n - k)
            give(room - length, first, k)
            rank, left = rank + k, left - k
    return events, total


def in_blocks(events: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Events cut at blocks of ranks: (length, block, rank, count, container, offset)."""
    out = []
    for length, rank, count, container, offset in events:
        at = rank
        while at < rank + count:
            n = min(rank + count, (at // BLOCK + 1) * BLOCK) - at
            out.append((length, at // BLOCK, at, n, container + at - rank, offset))
            at += n
    return out


def ranked(items: DataFrame, key: str, size: str, salts: int = 64) -> DataFrame:
    """`items` with `rank`: from 0 within equal `size`, numbered by salt so that no length is one task."""
    salted = items.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)))
    counts = salted.groupBy(size, "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(size).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(size, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(size, "salt").orderBy(key)
    numbered = salted.withColumn("i", F.row_number().over(inside) - 1)
    return numbered.join(starts, [size, "salt"]).withColumn("rank", F.col("first") + F.col("i")).drop("salt", "first", "i")


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """(`key`, part_no, from_unit, n_units, container_id, offset) of every item's parts.

    `items` is read twice (for the histogram and for the slots), so it should be cheap to make.
    """
    spark = items.sparkSession
    base = items.select(F.col(key).alias("k"), F.col(size).cast("bigint").alias("s")).where("s > 0")
    histogram = {r["r"]: r["n"] for r in base.select(F.pmod("s", F.lit(capacity)).alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("n")).collect() if r["r"]}
    events, total = plan(histogram, capacity)
    events = in_blocks(events)
    salts = max(64, -(-sum(histogram.values()) // ITEMS_PER_SALT))
    steps = spark.createDataFrame(events or [], "s bigint, block bigint, lo bigint, n bigint, c bigint, offset bigint")
    if len(events) <= BROADCAST_EVENTS:
        steps = F.broadcast(steps)

    rest = base.withColumn("whole", F.floor(F.col("s") / capacity)).withColumn("r", F.pmod("s", F.lit(capacity)))
    items_ = ranked(rest.where("r > 0"), "k", "r", salts).withColumn("block", F.floor(F.col("rank") / BLOCK)).alias("i")
    slots = items_.join(steps.alias("e"), (F.col("i.r") == F.col("e.s")) & (F.col("i.block") == F.col("e.block")) & (F.col("i.rank") >= F.col("e.lo")) & (F.col("i.rank") < F.col("e.lo") + F.col("e.n")))
    placed = slots.select(
        "i.k",
        (F.col("i.whole") + 1).alias("part_no"),
        (F.col("i.whole") * capacity).alias("from_unit"),
        F.col("i.r").alias("n_units"),
        (F.col("e.c") + F.col("i.rank") - F.col("e.lo")).alias("container_id"),
        F.col("e.offset").alias("offset"),
    )
    # Full containers of divided items come behind all planned ones, numbered in the same way.
    large = ranked(rest.where("whole > 0").withColumn("one", F.col("whole")), "k", "one", salts)
    per = large.groupBy("one").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("one")).over(Window.orderBy("one").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    full = large.join(per.select("one", "before"), "one").withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)))
    divided = full.select(
        "k",
        (F.col("i") + 1).alias("part_no"),
        (F.col("i") * capacity).alias("from_unit"),
        F.lit(capacity).cast("bigint").alias("n_units"),
        (F.lit(total) + F.col("before") + F.col("rank") * F.col("whole") + F.col("i")).alias("container_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return placed.unionByName(divided).withColumnRenamed("k", key)
