"""A Merkle manifest of a table: every row a leaf, a subroot for each language, one root over all.

The rows of a language stand in order of id. Runs of ``fan`` consecutive nodes become one node, level by
level, until one is left. Positions come from one range shuffle of narrow rows: a row's place is its
place in its sorted partition plus the rows of the language in earlier ones, so no language is gathered in
a task. Levels are then climbed ``fan ** LEVELS`` rows at a time: such a block is aligned to runs of all its
levels, so it's one window partition, however large its language. A node lives on the row of its first leaf.
At each level lag and lead columns at fixed offsets, masked by the node's slot and by the length of its run,
are its siblings; the row of the first child hashes the parent. Going down again, a child takes the siblings
of its ancestors from the first child's row by lag. The blocks' nodes are the leaves of the next round, and
the subroots those of the last tree.

A null field counts as ``-``, apart from empty text. Ids may be null (they come first) or equal (ordered
by leaf; rows with equal leaves are interchangeable, so results don't depend on their order). An empty table
gives an empty result. Only the leaf's fields are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from smeltery.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")   # fixed values: what a leaf covers, in order
FAN = 2
LEVELS = 10     # climbed in one window partition
TAMPERED = 7    # rows whose checksum this divides are tampered with


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """The value behind its length in bytes; null differs from every value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    return digest(*[field(changed.get(name, F.col(f"`{name}`"))) for name in FIELDS])


def numbered(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos``, the place in the group from 0 without gaps, and ``n``, the group's rows."""
    tie = F.xxhash64(F.monotonically_increasing_id())   # splits equal rows over partitions; any order of them is right
    columns = [F.col(group), *[F.col(c) for c in order]]
    spread = rows.withColumn("_tie", tie).repartitionByRange(*columns, "_tie").sortWithinPartitions(*columns, "_tie").drop("_tie")
    kept = stage(spread.withColumn("_at", F.monotonically_increasing_id()), label)
    # The upper bits of these numbers are the partition's. A row for each group and partition:
    part = F.shiftright("_at", 33)
    parts = kept.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    inside = Window.partitionBy(group)
    before = F.sum("_rows").over(inside.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.select(F.col(group).alias("_group"), F.col("_part"), F.sum("_rows").over(inside).alias("n"),
                          (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    same = kept[group].eqNullSafe(shifts["_group"]) & (part == shifts["_part"])
    return kept.join(shifts, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "n")


def climbed(nodes: DataFrame, group: str, fan: int, levels: int) -> DataFrame:
    """``nodes`` with ``block``, ``steps`` (each level's siblings left and right) and, on its first row, the block's ``top``."""
    size = fan ** levels
    df = nodes.withColumns({"block": F.floor(F.col("pos") / size), "_node0": F.col("hash")})
    window = Window.partitionBy(group, "block").orderBy("pos")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    none = F.lit("")

    def slot(unit: int) -> Column:
        return F.pmod(F.floor(F.col("pos") / unit), F.lit(fan))

    for level in range(levels):
        unit = fan ** level
        node = F.col(f"_node{level}")
        left = [F.when(slot(unit) >= k, F.lag(node, k * unit).over(window)).otherwise(none) for k in range(fan - 1, 0, -1)]
        right = [F.when((slot(unit) + k < fan) & (F.col("pos") + k * unit < F.col("n")), F.lead(node, k * unit).over(window)).otherwise(none)
                 for k in range(1, fan)]
        df = df.withColumns({"_left": F.concat(*left), "_right": F.concat(*right)})
        several = F.col("n") > unit      # else one node is left and the tree ends below
        siblings = F.struct(F.col("_left").alias("left"), F.col("_right").alias("right"))
        df = df.withColumn(f"_step{level}", F.when((F.col("pos") % unit == 0) & several, F.array(siblings)).otherwise(nothing))
        parent = F.when(several, digest(node, F.col("_right"))).otherwise(node)
        df = df.withColumn(f"_node{level + 1}", F.when(F.col("pos") % (unit * fan) == 0, parent)).drop("_left", "_right")
    df = df.withColumn("_path", nothing)
    for level in reversed(range(levels)):
        unit = fan ** level
        above = F.col("_path")
        for k in range(1, fan):
            above = F.when(slot(unit) == k, F.lag("_path", k * unit).over(window)).otherwise(above)
        path = F.when(F.col("pos") % unit == 0, F.concat(F.col(f"_step{level}"), above))
        df = df.withColumn("_path", path)
    return df.select(*nodes.columns, "block", F.col("_path").alias("steps"), F.col(f"_node{levels}").alias("top"))


def tree(nodes: DataFrame, group: str, fan: int = FAN, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (``hash``, ``pos``, ``n`` and a group) with the ``top`` of their group and the ``steps`` up to it;
    and a row for each group with its top as ``hash``.

    One round for each ``levels`` levels of the largest group; a round's nodes are that power of ``fan`` fewer.
    """
    size = fan ** levels
    rows = stage(climbed(nodes, group, fan, levels), "merkle-climbed")
    first = rows.where(F.col("top").isNotNull()).select(
        group, F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("hash"))
    if (rows.agg(F.max("n")).first()[0] or 0) <= size:
        tops = first.select(group, "hash")
        lifted = first.select(F.col(group).alias("_group"), F.col("pos").alias("_block"), F.col("hash").alias("_top"))
        steps = F.col("steps")
    else:
        above, tops = tree(stage(first, "merkle-blocks"), group, fan, levels)
        lifted = above.select(F.col(group).alias("_group"), F.col("pos").alias("_block"), F.col("top").alias("_top"), F.col("steps").alias("_more"))
        steps = F.concat("steps", "_more").alias("steps")
    same = rows[group].eqNullSafe(lifted["_group"]) & (rows["block"] == lifted["_block"])
    return rows.drop("top").join(lifted, same).select(*nodes.columns, F.col("_top").alias("top"), steps), tops


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, start, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(docs: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf``, ``bent`` (the leaf of a tampered row), ``subroot``, ``root`` and the ``steps`` to it."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    leaves = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf().alias("hash"),
        F.when(chosen, leaf(n_chars=F.col("n_chars") + 1)).alias("bent"))
    rows, subroots = tree(numbered(leaves, "lang", ["doc_id", "hash"], "merkle-leaves"), "lang", fan, levels)
    last = numbered(subroots.withColumn("all", F.lit(0)), "all", ["lang"], "merkle-subroots")
    roots, _ = tree(last, "all", fan, levels)
    # A row for each language; Spark broadcasts it while it's small.
    ends = stage(roots.select(F.col("lang").alias("_lang"), F.col("top").alias("root"), F.col("steps").alias("_more")), "merkle-roots")
    return rows.join(ends, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "doc_id", "lang", F.col("hash").alias("leaf"), "bent", F.col("top").alias("subroot"), "root", F.concat("steps", "_more").alias("steps"))


def proofs(docs: DataFrame) -> DataFrame:
    """Of every document its leaf, roots, the digest of its proof, and whether the proof still leads to the root."""
    rows = manifest(docs)
    folded = rows.withColumn("folded_root", fold(F.coalesce("bent", "leaf"), F.col("steps")))
    siblings = F.transform("steps", lambda s: F.concat(s["left"], s["right"]))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
