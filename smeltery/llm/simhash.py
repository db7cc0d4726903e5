"""Near-duplicate documents by SimHash, compared exactly in tiles.

A fingerprint has the majority bits of the XXH64 values of all word shingles. Distinct fingerprints
fall into tiles by the population counts of their four 16-bit lanes. Two fingerprints within
``RADIUS`` bits have lane counts that differ by no more than that in sum, so a tile meets only the
tiles inside that radius; all others are skipped. A pair of tiles is compared whole with exclusive
or and bit counts in numpy, and gives links enough to keep its parts connected. Components of all
links then get the smallest document id in them.

Exact copies share a fingerprint and are never compared with each other. Null text counts as empty;
a text without words has fingerprint zero. Null ids count for no component's smallest id; a
component of only such has none. Repeated rows are copies. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from smeltery.llm.common import text_of
from smeltery.llm.components import components
from smeltery.session import stage

SHINGLE = 3
SEED = 42
RADIUS = 3
LANES = 4
CHUNK = 4096     # fingerprints of one tile compared at a time
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, size: int = SHINGLE) -> int:
    words = text.encode("utf-8").translate(LOWER).split()
    if not words:
        return 0
    if len(words) < size:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        n = len(words) - size + 1
        shingles = map(b" ".join, zip(*[words[k:] for k in range(size)]))
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    for at in range(0, n, 1 << 15):
        part = np.fromiter(hashes, np.uint64, min(n - at, 1 << 15))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, keep: list) -> DataFrame:
    source = docs.select(*keep, text_of().alias("_text"))
    kept = source.schema.fields[:-1]
    schema = T.StructType([*kept, T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = pa.array((fingerprint(t.as_py()) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + [fps],
                                             names=[f.name for f in kept] + ["fp"])

    return source.mapInArrow(run, schema)


def lanes(fp):
    """One number for the population counts of the lanes, five bits each."""
    width = 64 // LANES
    counts = [F.bit_count(F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit((1 << width) - 1))) for k in range(LANES)]
    return sum((c * (1 << 5 * k) for k, c in enumerate(counts)), F.lit(0)).cast("int")


def steps(radius: int = RADIUS) -> list[int]:
    """Distances from a tile to those it must meet, each pair of tiles once."""
    near = [d for d in product(range(-radius, radius + 1), repeat=LANES) if sum(map(abs, d)) <= radius]
    return [sum(x << 5 * k for k, x in enumerate(d)) for d in near if d >= (0,) * LANES]


def placed_in_tiles(fps: DataFrame) -> DataFrame:
    return fps.select("fp", lanes(F.col("fp")).alias("tile"))


def chunks_of(placed: DataFrame) -> DataFrame:
    """``tile`` and the number of its ``parts``: at most 17 ** LANES rows of two numbers, however many the fingerprints."""
    return placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))


def tiles(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """``tile``, ``chunk``, ``list``: the distinct fingerprints, packed."""
    placed = placed.join(F.broadcast(parts), "tile")
    return (placed.groupBy("tile", F.pmod(F.xxhash64("fp"), F.col("parts")).alias("chunk"))
            .agg(F.collect_list("fp").alias("list")))


def towards(packed: DataFrame, parts: DataFrame, moves: list[int]) -> DataFrame:
    """Each chunk once for every chunk of the tiles at ``moves`` from its own: ``tile``, ``chunk``, ``list``, ``to``, ``part``."""
    met = packed.select("*", F.explode(F.array(*[F.lit(m) for m in moves])).alias("move"))
    met = met.select("tile", "chunk", "list", (F.col("tile") + F.col("move")).alias("to"))
    met = met.join(F.broadcast(parts.select(F.col("tile").alias("to"), "parts")), "to")
    return met.select("tile", "chunk", "list", "to", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two lists; if they are many, as many as keep the same parts connected."""
    xs, ys = [], []
    for at in range(0, len(a), 256):
        x, y = np.nonzero(np.bitwise_count(a[at:at + 256, None] ^ b[None, :]) <= radius)
        xs.append(x + at)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    different = a[x] != b[y]
    x, y = x[different], y[different]
    if len(x) <= 2 * (len(a) + len(b)):
        return a[x], b[y]
    values, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ids[:len(a)][x], ids[len(a):][y]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    inner = np.flatnonzero(label != np.arange(len(values)))
    return values[inner], values[label[inner]]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``x``, ``y``: pairs of distinct fingerprints within ``radius`` bits (see ``near_pairs``).

    Two chunks meet under a key of their own, so the chunks of a hot tile share no task.
    """
    placed = stage(placed_in_tiles(fps), "placed")
    parts = stage(chunks_of(placed), "tile-parts")
    packed = stage(tiles(placed, parts), "tiles")
    moves = steps(radius)
    left = towards(packed, parts, moves).select(
        F.col("tile").alias("t1"), F.col("chunk").alias("c1"), F.col("to").alias("t2"), F.col("part").alias("c2"), F.col("list").alias("a"))
    right = towards(packed, parts, [-m for m in moves]).select(
        F.col("to").alias("t1"), F.col("part").alias("c1"), F.col("tile").alias("t2"), F.col("chunk").alias("c2"), F.col("list").alias("b"))
    once = (F.col("t1") != F.col("t2")) | (F.col("c1") <= F.col("c2"))
    # Both sides are many times the size of the table that they come from, which Spark doesn't see when it plans.
    met = left.filter(once).join(right.filter(once).hint("merge"), ["t1", "c1", "t2", "c2"])

    def run(batches):
        for batch in batches:
            xs, ys = [], []
            for a, b in zip(batch.column(0), batch.column(1)):
                x, y = near_pairs(a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64), radius)
                xs.append(x)
                ys.append(y)
            if xs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v).view(np.int64)) for v in (xs, ys)], names=["x", "y"])

    return met.select("a", "b").mapInArrow(run, "x bigint, y bigint")


def classes(prints: DataFrame) -> DataFrame:
    """``fp``, ``root``: the component of every distinct fingerprint of ``prints``."""
    fps = stage(prints.select("fp").distinct(), "fps")
    roots = components(links(fps))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every document."""
    prints = stage(with_fingerprint(docs, [F.col("doc_id")]), "prints")
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    of = stage(classes(prints).join(lowest, "fp"), "classes")
    ids = of.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = of.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of every component, with the columns it came with.

    Among rows of equal id (or only null ids, which come last) any one stays.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = stage(with_fingerprint(docs, [F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), whole]), "near")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    best = rows.groupBy("fp").agg(first.alias("best"))
    kept = (classes(rows).join(best, "fp").groupBy("root").agg(F.min("best").alias("best"))
            .select(F.col("best.row").alias("_row")))
    return rows.join(kept, "_row", "left_semi").select("_doc.*")
