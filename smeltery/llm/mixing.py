"""Mixing sources to target token counts by entropy balancing.

A source's target is its share of all tokens by weight, but at most ``MOST`` times what it has; the
excess goes to the others by weight. Among all rates with that many expected tokens, those closest
to one copy each (in relative entropy) are ``exp(tilt * size)``, held at ``MOST`` copies; the tilt
solves a convex dual of one variable a source. Newton steps find all tilts together: a step is one
aggregate over (source, size) cells, kept inside a bracket that every step narrows.

Rates become whole copies by systematic rounding along the sizes of a source: the rounded count of
any run of sizes is within one of the expected one. Then corrections add or take copies of one size in each
round, as many as bring a source nearer to its target, until it is close or no size helps. Newton steps that end
before all sources are within the tolerance say so in the log. Which documents of a cell get the copy more
follows from a hash of id and text, so reruns agree. Cells and sources are partial aggregates; no
group of rows is gathered.

Null text has size zero. Null source is a source of its own, last in order. A document without
words takes part in no sum and gets one copy. Repeated rows count each. An empty table gives an
empty result.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F, Window

from smeltery.llm.common import text_of, words_of
from smeltery.operators.numbering import numbered, placed
from smeltery.session import stage

WEIGHTS = (1, 2, 3)
MOST = 3
TOLERANCE = 1e-9
STEPS = 60
CLOSE = 0.001        # a source as near as this to its target is left alone
BUCKETS = 1024
SAME = lambda *names: " and ".join(f"l.{n} <=> r.{n}" for n in names)


def joined(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """A join on names whose nulls are equal; the right side's are left out."""
    out = left.alias("l").join(right.alias("r"), F.expr(SAME(*names)), how)
    return out.select("l.*", *[F.col(f"r.`{c}`") for c in right.columns if c not in names])


def targets(cells: DataFrame) -> DataFrame:
    """``source``, ``source_size``, ``target``: one row for each source."""
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    sizes = numbered(stage(placed(sizes, F.col("source").isNull(), F.col("source")), "ranked"), "rank")
    place = F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (place + 1).cast("int"))
    sizes = stage(sizes.withColumn("weight", w).drop("rank"), "sources")
    cap = MOST * F.col("source_size").cast("double")
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = float("-inf")
    while True:  # the level only rises, and each time another source is full
        full = cap <= F.col("weight") * level
        held, open_ = sizes.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
                                F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        risen = (total - held) / open_ if open_ else level
        if not risen > level:
            break
        level = risen
    return sizes.select("source", "source_size", "docs", F.least(cap, F.col("weight") * level).alias("target"))


def rate(tilt: Column, scaled: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(tilt * scaled, F.lit(50.0))))


def tilts(cells: DataFrame, aims: DataFrame) -> DataFrame:
    """``aims`` with ``mean`` and ``tilt``: the dual solution of every source that is neither empty nor full."""
    have, aim = F.col("source_size").cast("double"), F.col("target")
    mean = have / F.greatest(F.col("docs"), F.lit(1))
    free = (aim > 0) & (aim < MOST * have)
    # exp(tilt / mean) bounds the rate of the shortest text, so these tilts lie on either side.
    low = F.when(free & (aim < have), F.log(aim / have) * mean).otherwise(0.0)
    high = F.when(free & (aim > have), F.log(F.lit(float(MOST))) * mean).otherwise(0.0)
    state = aims.select("*", mean.alias("mean"), free.alias("free"), low.alias("low"), high.alias("high"), F.lit(0.0).alias("tilt"))
    state = stage(state, "tilts")
    for _ in range(STEPS):
        seen = joined(cells.filter("size > 0"), state.filter("free").select("source", "mean", "tilt"), "source")
        scaled = F.col("size") / F.col("mean")
        r, mass = rate(F.col("tilt"), scaled), F.col("size") * F.col("n")
        sums = seen.groupBy("source").agg(F.sum(mass * r).alias("f"), F.sum(F.when(r < MOST, mass * r * scaled).otherwise(0.0)).alias("slope"))
        now = joined(state, sums, "source", how="left")
        off = F.log(F.col("f") / F.col("target"))
        low, high = F.when(off < 0, F.col("tilt")).otherwise(F.col("low")), F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - off * F.try_divide("f", "slope")
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        step = F.when(off == 0, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2)
        moved = F.col("free") & F.coalesce(F.abs(off) > TOLERANCE, F.lit(False))
        pick = lambda new, old: F.when(moved, new).otherwise(F.col(old)).alias(old)
        state = stage(now.select("source", "source_size", "docs", "target", "mean", "free", pick(low, "low"), pick(high, "high"),
                                 pick(step, "tilt"), moved.alias("moved")), "tilts")
        going = state.agg(F.count_if("moved")).first()[0]
        state = state.drop("moved")
        if not going:
            break
    else:
        logging.getLogger(__name__).warning("%d sources are not within %g of their targets after %d steps", going, TOLERANCE, STEPS)
    return state


def rounded(cells: DataFrame, state: DataFrame) -> DataFrame:
    """``source``, ``size``, ``n``, ``base`` and ``extra``: all of a cell's documents get ``base`` copies, ``extra`` of them one more."""
    full = F.col("target") >= MOST * F.col("source_size")
    r = (F.when(F.col("size") == 0, 1.0).when(F.col("target") <= 0, 0.0).when(full, float(MOST))
         .otherwise(rate(F.col("tilt"), F.col("size") / F.col("mean"))))
    priced = joined(cells, state, "source").select("source", "size", "n", "target", r.alias("rate"))
    base = F.floor("rate").cast("bigint")
    line = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.col("n") * (F.col("rate") - base)).over(line)
    at = F.floor(upto + 0.5).cast("bigint")
    cut = priced.select("*", base.alias("base"), at.alias("at"))
    before = F.coalesce(F.lag("at").over(Window.partitionBy("source").orderBy("size")), F.lit(0))
    extra = F.least(F.greatest(F.col("at") - before, F.lit(0)), F.when(F.col("base") >= MOST, 0).otherwise(F.col("n")))
    out = stage(cut.select("source", "size", "n", "target", "rate", "base", extra.cast("bigint").alias("extra")), "cells")
    while True:  # every round brings each open source nearer to its target
        taken = F.sum(F.col("size") * (F.col("n") * F.col("base") + F.col("extra")))
        off = out.groupBy("source").agg((F.max("target") - taken).alias("left"), F.max("target").alias("aim"))
        open_ = joined(out, off.filter(F.abs("left") > CLOSE * F.col("aim")).drop("aim"), "source")
        given = F.col("n") * F.col("base") + F.col("extra")
        room = F.when(F.col("left") > 0, MOST * F.col("n") - given).otherwise(given)
        fits = F.floor(F.abs("left") / F.col("size")).cast("bigint")
        moved = F.greatest(F.least(room, fits), F.lit(1))
        tried = (open_.filter("size > 0").filter(room > 0)
                 .select("source", "size", "left", (moved * F.signum("left").cast("bigint")).alias("d")))
        tried = tried.select("*", F.abs(F.col("left") - F.col("size") * F.col("d")).alias("then"))
        best = (tried.filter(F.col("then") < F.abs(F.col("left"))).groupBy("source")
                .agg(F.min(F.struct("then", "size", "d")).alias("b")).select("source", F.col("b.size").alias("size"), F.col("b.d").alias("d")))
        best = stage(best, "moves")
        if best.isEmpty():
            break
        now = given + F.coalesce("d", F.lit(0))
        out = stage(joined(out, best, "source", "size", how="left").select(
            "source", "size", "n", "target", "rate", F.floor(now / F.col("n")).cast("bigint").alias("base"),
            F.pmod(now, F.col("n")).alias("extra")), "cells")
    return out


def copies(sized: DataFrame) -> DataFrame:
    """``sized(source, size, mark, ...)`` with ``source_size``, ``target``, ``rate`` and ``copies``."""
    cells = stage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    state = tilts(cells, targets(cells))
    whole = rounded(cells, state)
    # Which rows of a cell get one copy more: ranks by hash, found bucket by bucket.
    bucket = F.pmod(F.col("mark"), F.lit(BUCKETS)).alias("bucket")
    marked = sized.select("*", bucket)
    held = marked.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("c"))
    ahead = F.sum("c").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("c")
    held = joined(held.select("source", "size", "bucket", ahead.alias("ahead")), whole.drop("n"), "source", "size")
    held = joined(held, state.select("source", "source_size"), "source")
    ranked = joined(marked, held, "source", "size", "bucket")
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("mark", "doc_id")) + F.col("ahead")
    return ranked.select("*", (F.col("base") + (rank <= F.col("extra")).cast("bigint")).alias("copies"))


def sized(docs: DataFrame, keep: list[Column]) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.size(words_of(text)).cast("bigint").alias("size"), F.xxhash64("doc_id", text).alias("mark"), *keep)


def mix(docs: DataFrame) -> DataFrame:
    """For every document its size, its source's size and target, and the words that the mix takes of it."""
    rows = stage(sized(docs, []), "sized")
    return copies(rows).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                               "copies", "rate")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix: a row for each copy, with the columns they came with."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = stage(sized(docs, [F.monotonically_increasing_id().alias("_row"), whole]), "sized")
    times = copies(rows.drop("_doc")).select("_row", "copies").filter("copies > 0")
    many = rows.select("_row", "_doc").join(times, "_row").select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return many.select("_doc.*")
