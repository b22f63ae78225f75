"""Sharding by balanced label propagation: copies stay together, shards stay even.

Documents with equal texts are linked. Every document starts in the shard of its number
modulo the number of shards, so sizes are even. In each round the linked documents that have
no place yet move towards the shard that holds most of their neighbours, of those whose quota
still has room for all of them; a shard takes whom it can in the order of a hash, and who
finds no room turns to the next shard in the next round. Documents that fit into no shard together fill
the one with most room and go on with the rest. Large groups move before small ones,
which find room later too. Rounds end when all linked documents have a place; documents without links
then fill the shards to their quotas, which are at most one document apart.

Each round and each shard that is asked gives at least one group its place or is full
afterwards, so there is no limit on rounds, and none is needed.

Links of a group of copies are those of a clique, so a round needs no more of a group than
its number of documents in each shard: the rounds join and aggregate tables of one row for a
group, however large it is. Which documents of a group
go where is settled once at the end by numbering them inside (group, file part), so that no
window ever holds a whole hot group. All steps are DataFrame functions; each round's table
is written to the shared folder.

Defined results: a null text has size 8, checksum 0 and no links; empty texts are equal
texts; repeated rows are separate documents that are linked; an empty table gives no rows;
only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempspan.runtime import write_shared

BINS = 1024
UNLINKED = b""


@dataclass(frozen=True)
class Part:
    """One range of numbers [low, high) that belongs to a shard."""

    shard: int
    low: int
    high: int


def numbered_rows(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (row, part, doc_id, size, text_crc32, twin): twin is the digest of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(whole) + 8).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(F.col(text), 256)).alias("twin"),
    )
    return write_shared(rows, "rows").withColumn("part", F.shiftright("row", 33))


def _offsets(counts: DataFrame, within: list[str]) -> DataFrame:
    """Add ``first``: the sum of n over earlier parts of the same key."""
    earlier = W.partitionBy(*within).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _asked(waiting: DataFrame, room: list[int], n_round: int) -> DataFrame:
    """Add ``target``, the shard that a group turns to, and ``bin``, its place in the queue.

    ``held`` lists the shards of its documents, that of most of them first. A group takes the
    first of them that has room for all it has left, else any other such shard, else the
    shard with most room.
    """
    rooms = F.array(*(F.lit(r) for r in room))
    roomy = F.filter("held", lambda x: F.get(rooms, x.shard) >= F.col("left"))
    others = F.filter(F.sequence(F.lit(0), F.lit(len(room) - 1)), lambda s: F.get(rooms, s) >= F.col("left"))
    turn = F.pmod(F.xxhash64("twin", F.lit(n_round)), F.greatest(F.size(others), F.lit(1))).cast("int")
    largest = max(range(len(room)), key=room.__getitem__)
    return waiting.withColumns({
        "target": F.coalesce(F.get(roomy, F.lit(0)).shard, F.get(others, turn), F.lit(largest)),
        "bin": F.pmod(F.xxhash64("twin", F.lit(n_round), F.lit("bin")), F.lit(BINS)),
    })


def _answered(asked: DataFrame, room: list[int]) -> DataFrame:
    """Add ``taken``: how many of its documents the target takes. Queues are running sums over
    hashed bins of groups, so that no window holds all groups of a shard."""
    bins = _offsets(
        asked.groupBy("target", F.col("bin").alias("part")).agg(F.sum("left").alias("n")), ["target"]
    ).select("target", F.col("part").alias("bin"), "first")
    before = W.partitionBy("target", "bin").orderBy("twin").rowsBetween(W.unboundedPreceding, -1)
    queued = asked.join(bins, ["target", "bin"])
    start = F.col("first") + F.coalesce(F.sum("left").over(before), F.lit(0))
    here = F.get(F.array(*(F.lit(r) for r in room)), F.col("target"))
    part = F.least(F.col("left"), F.greatest(here - start, F.lit(0)))
    return queued.withColumn(
        "taken", F.when((part == F.col("left")) | (here < F.col("left")), part).otherwise(0)
    ).drop("first", "bin")


def propagate(placed: DataFrame, quotas: list[int]) -> DataFrame:
    """Rounds of moves over (twin, shard, n) until all have a place; shards keep their quotas."""
    groups = write_shared(
        placed.groupBy("twin").agg(
            F.sum("n").alias("left"),
            F.sort_array(
                F.collect_list(F.struct("n", F.xxhash64("twin", "shard").alias("tie"), "shard")), asc=False
            ).alias("held"),
        ), "linked_groups",
    )
    room, settled, n_round = list(quotas), [], 0
    sizes = [None, max(quotas, default=0) // 2, max(quotas, default=0) // 16, 0]
    for high, low in zip(sizes, sizes[1:]):
        waiting = groups.where(F.col("left") > low)
        waiting = waiting if high is None else waiting.where(F.col("left") <= high)
        while not waiting.isEmpty():
            answered = write_shared(_answered(_asked(waiting, room, n_round), room), "answered")
            taken = answered.where("taken > 0").select("twin", F.col("target").alias("shard"), F.col("taken").alias("n"))
            for row in taken.groupBy("shard").agg(F.sum("n").alias("n")).collect():
                room[row.shard] -= row.n
            settled.append(taken)
            waiting = answered.where("left > taken").select("twin", (F.col("left") - F.col("taken")).alias("left"), "held")
            n_round += 1
    if not settled:
        return placed
    moved = reduce(DataFrame.union, settled).groupBy("twin", "shard").agg(F.sum("n").alias("n"))
    return write_shared(moved, "placed")


def _shard_of(number: Column, ranges: list[Part]) -> Column:
    found = F.lit(None).cast("int")
    for part in ranges:
        found = F.when((number >= part.low) & (number < part.high), part.shard).otherwise(found)
    return found


def shard_documents(
    documents: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = numbered_rows(documents, key, text)
    parts = _offsets(rows.groupBy("part").agg(F.count("*").alias("n")), [])
    in_part = F.col("row") - F.shiftleft(F.col("part"), 33)
    total = rows.count()
    quotas = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    groups = rows.where("twin IS NOT NULL").groupBy("twin").agg(F.count("*").alias("n")).where("n > 1")
    groups = write_shared(groups.select("twin"), "groups")
    linked = rows.join(groups, "twin").select("twin", "part", in_part.alias("at"))
    start = linked.join(parts.select("part", "first"), "part").select(
        "twin", F.pmod(F.col("first") + F.col("at"), F.lit(n_shards)).cast("int").alias("shard")
    )
    placed = write_shared(start.groupBy("twin", "shard").agg(F.count("*").alias("n")), "placed")
    placed = propagate(placed, quotas)

    held = {r.shard: r.n for r in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    free, low = [], 0
    for shard, quota in enumerate(quotas):
        high = low + quota - held.get(shard, 0)
        free.append(Part(shard, low, high))
        low = high
    upto = W.partitionBy("twin").orderBy("shard")
    ranges = placed.withColumn("high", F.sum("n").over(upto)).groupBy("twin").agg(
        F.sort_array(F.collect_list(F.struct("high", "shard"))).alias("ranges")
    )
    known = rows.join(ranges, "twin", "left").withColumn(
        "kin", F.when(F.col("ranges").isNull(), F.lit(UNLINKED)).otherwise(F.col("twin"))
    )
    known = write_shared(known.drop("twin"), "known").withColumn("part", F.shiftright("row", 33))
    kin = _offsets(known.groupBy("kin", "part").agg(F.count("*").alias("n")), ["kin"])
    number = F.col("first") + F.row_number().over(W.partitionBy("kin", "part").orderBy("row")) - 1
    numbered = known.join(kin.select("kin", "part", "first"), ["kin", "part"]).withColumn("number", number)
    own = F.get(F.filter("ranges", lambda r: r.high > F.col("number")), F.lit(0)).shard
    sharded = numbered.select(
        "row", "part", "doc_id", "size", "text_crc32",
        F.when(F.col("ranges").isNull(), _shard_of(F.col("number"), free)).otherwise(own).alias("shard"),
    )
    sharded = write_shared(sharded, "sharded")
    firsts = _offsets(sharded.groupBy("shard", "part").agg(F.count("*").alias("n")), ["shard"])
    slot = F.col("first") + F.row_number().over(W.partitionBy("shard", "part").orderBy("row")) - 1
    return sharded.join(firsts.select("shard", "part", "first"), ["shard", "part"]).select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
