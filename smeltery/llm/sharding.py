"""Shards of near equal bytes that keep linked documents together: balanced label propagation.

Documents with equal texts are linked, through a node that stands for the text. Linked documents
start on a shard by hash. In each round every text looks at how many of its bytes lie on each shard
and calls all its documents to the shard with most of them that has room (in the first round, to any);
the calls are joined back to the documents, and each shard admits callers in order of a hash of text
and id as far as its quota goes, to which what leaves the shard adds. Rounds end when nothing moves,
or after ``ROUNDS``. What lies beyond an equal share of all bytes then leaves its shard, and so do the
texts of up to ``SMALL`` of a share that are still split. Those together with the unlinked documents
level the shards: they are counted by size class and hash bucket, a table of fixed size, and these
units go to the lightest shard, largest first. The copies of a text of up to ``SMALL`` move as one, so
such texts always end whole. A text that holds more bytes than a shard is split over several.

Null text has no bytes (size 8, checksum 0). Null ids are placed like others. Repeated rows are
copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F, Window

from smeltery.llm.common import text_key, text_of
from smeltery.session import stage

SHARDS = 24
ROUNDS = 20
SMALL = 0.05                        # of a share: texts that move as one
GROUP_STEPS, ROW_STEPS = 1024, 64   # order of admission: by text, then by document
CLASSES, BUCKETS = 40, 2048         # units for levelling: powers of two of the size, hash buckets
SLOT_PARTS = 1024
TEXT = ["_h1", "_h2", "_len"]


def rows_of(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 8).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), *text_key(text), F.xxhash64("doc_id", text).alias("mark"))


def turn() -> Column:
    """The place of a document in the order of admission; a text's documents stand together, those of a small one at one place."""
    row = F.when(F.col("small"), F.lit(0)).otherwise(F.pmod("mark", F.lit(ROW_STEPS)))
    return (F.pmod(F.xxhash64(*TEXT), F.lit(GROUP_STEPS)) * ROW_STEPS + row).cast("int")


def by_shard(values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_at") + 1)


def loads(rows: DataFrame, column: str = "shard") -> list[int]:
    """Bytes by shard: as many numbers as there are shards."""
    got = [0] * SHARDS
    for shard, size in rows.groupBy(column).agg(F.sum("size")).collect():
        got[shard] = size
    return got


def admitted(rows: DataFrame, column: str, quota: list[float]) -> list[int]:
    """For each shard the last turn up to which the bytes of ``rows`` fit its quota."""
    sums = rows.groupBy(F.col(column).alias("_at"), turn().alias("turn")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("_at").orderBy("turn"))
    # At most GROUP_STEPS * ROW_STEPS rows a shard.
    last = sums.select("_at", "turn", upto.alias("upto")).filter(F.col("upto") <= by_shard(quota)).groupBy("_at").agg(F.max("turn"))
    got = [-1] * SHARDS
    for shard, at in last.collect():
        got[shard] = at
    return got


def propagate(linked: DataFrame, share: float) -> DataFrame:
    """``linked`` with ``shard``."""
    linked = stage(linked.withColumn("shard", F.pmod("mark", F.lit(SHARDS)).cast("int")), "linked")
    for k in range(ROUNDS):
        load = loads(linked)
        room = [max(0.0, share - x) for x in load]
        held = linked.groupBy(*TEXT, "shard").agg(F.sum("size").alias("held"))
        open_ = held if not k else held.withColumn("_at", F.col("shard")).filter((by_shard(room) > 0.01 * share) | (F.col("held") > 0.5 * share))
        # Of equal shards a hash chooses, so that no shard is called to more than others.
        call = open_.groupBy(*TEXT).agg(F.max(F.struct("held", F.xxhash64(*TEXT, "shard").alias("hash"), "shard")).alias("b")).select(
            *TEXT, F.col("b.shard").alias("to"))
        here = held.join(call, TEXT).select(*TEXT, "shard", F.when(F.col("to") != F.col("shard"), F.col("to")).alias("to"))
        # One row for each text and shard on the right; the join of a text that many documents have is split by Spark.
        called = stage(linked.join(here, [*TEXT, "shard"], "left"), "called")
        movers = called.filter("`to` is not null")
        leaving = loads(movers)
        last = admitted(movers, "to", [max(0.0, share - x + y) for x, y in zip(load, leaving)])
        goes = F.coalesce(F.col("to").isNotNull() & (turn() <= by_shard(last)), F.lit(False))
        moved = called.withColumn("_at", F.coalesce("to", F.lit(0))).withColumn("goes", goes)
        moved = stage(moved.select(*[c for c in linked.columns if c != "shard"], "goes",
                                   F.when(F.col("goes"), F.col("to")).otherwise(F.col("shard")).alias("shard")), "linked")
        n = moved.agg(F.count_if("goes")).first()[0]
        linked = moved.drop("goes")
        if not n:
            break
    return linked


def unit() -> list[Column]:
    size_class = F.least(F.length(F.bin("size")), F.lit(CLASSES)).cast("int")
    return [size_class.alias("class"), F.pmod(F.when(F.col("small"), F.xxhash64(F.lit(5), *TEXT)).otherwise(F.xxhash64("mark")), F.lit(BUCKETS)).cast("int").alias("bucket")]


def levelled(loose: DataFrame, load: list[int]) -> DataFrame:
    """``loose`` with ``shard``: every unit on the lightest shard, larger size classes first."""
    spark = loose.sparkSession
    loose = loose.select("*", *unit())
    # At most CLASSES * BUCKETS rows, whatever the input.
    units = loose.groupBy("class", "bucket").agg(F.sum("size").alias("size")).collect()
    heap = [(x, k) for k, x in enumerate(load)]
    heapq.heapify(heap)
    placed = []
    for size_class, bucket, size in sorted(units, key=lambda u: (-u[2], u[0], u[1])):
        x, k = heapq.heappop(heap)
        heapq.heappush(heap, (x + size, k))
        placed.append((size_class, bucket, k))
    table = spark.createDataFrame(placed, "class int, bucket int, shard int")
    return loose.join(F.broadcast(table), ["class", "bucket"]).drop("class", "bucket")


def with_slots(rows: DataFrame) -> DataFrame:
    """A gapless number inside each shard, from two levels of counts."""
    part = F.pmod(F.xxhash64(F.lit(3), F.col("mark")), F.lit(SLOT_PARTS)).cast("int")
    rows = rows.withColumn("part", part)
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("c"))
    ahead = F.sum("c").over(Window.partitionBy("shard").orderBy("part")) - F.col("c")
    # SHARDS * SLOT_PARTS rows at most.
    starts = F.broadcast(counts.select("shard", "part", ahead.alias("ahead")))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("mark", "doc_id")) - 1
    return rows.join(starts, ["shard", "part"]).withColumn("slot", (F.col("ahead") + place).cast("bigint")).drop("part", "ahead")


def shards(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot``, ``grown_shard`` (null)."""
    rows = stage(rows_of(docs), "rows")
    share = (rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]) / SHARDS
    many = rows.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("c"), (F.sum("size") <= SMALL * share).alias("small"))
    split = stage(rows.join(many, TEXT), "copies")
    linked = propagate(split.filter("c > 1").drop("c"), share)
    # Small texts still split leave, and bytes beyond an equal share; they and the unlinked documents level the shards.
    apart = linked.filter("small").groupBy(*TEXT).agg((F.min("shard") != F.max("shard")).alias("apart")).filter("apart")
    whole = stage(linked.join(apart, TEXT, "left"), "whole")
    last = admitted(whole.filter("apart is null"), "shard", [share] * SHARDS)
    linked = whole.withColumn("_at", F.col("shard")).withColumn("stays", F.col("apart").isNull() & (turn() <= by_shard(last))).drop("_at", "apart")
    stay = stage(linked, "settled")
    loose = split.filter("c = 1").drop("c").unionByName(stay.filter("not stays").drop("stays", "shard"))
    stay = stay.filter("stays").drop("stays")
    placed = stay.unionByName(levelled(loose, loads(stay)))
    return with_slots(stage(placed, "placed")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
