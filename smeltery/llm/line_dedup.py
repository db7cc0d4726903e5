"""Line dedup: later lines within one word edit of an earlier line go. DataFrame functions only.

A line is a ``\\n``-split part of a text; its words are runs of non-blanks. Documents are in order of
id (null last, equal ids by text hash), lines in order of place. A line goes if the same line stands
earlier, or if it has at least ``MIN_WORDS`` words and an earlier, different line that has them too lies
within an edit distance of one word (one word replaced, added or left out). Lines without words always stay.

Distinct lines are found by partial aggregates. Their deletion neighbourhood (the line, and the line
without its i-th word) is emitted as hashed keys. Before that, lines that can't have a partner are
left out without loss: two lines one edit apart agree in their first or their last half. Equal keys
are joined through the earliest line of each key, never pair by pair: all lines that leave out a word
at the same place to give the same rest are one edit apart from each other, so if any of them is
earlier than a line, the earliest of them is. What the keys propose is verified on the words.

Rows of equal id and text count as one document, each with the same result. Null text stays null and
has no lines. An empty table gives an empty result.
"""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, functions as F, Window

from smeltery.llm.common import BLANKS, let, words_of
from smeltery.session import stage

MIN_WORDS = 8
ID = ["none", "id", "h1", "h2"]
PART, REST, WHOLE = 0, 1, 2
BROADCAST_ROWS = 1_000_000   # of two hashes


def free_shuffles(df: DataFrame) -> None:
    """Finished steps leave shuffle files until the driver's collector drops their handles; do it now."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def identity(text: Column) -> list[Column]:
    doc = F.col("doc_id").cast("bigint")
    return [doc.isNull().alias("none"), doc.alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def occurrences(docs: DataFrame) -> DataFrame:
    """Every line with words: its document, place and hashes."""
    text = F.col("text").cast("string")
    lines = docs.filter(text.isNotNull()).select(*identity(text), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return lines.filter(F.btrim("line", F.lit(BLANKS)) != "").select(
        "*", F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(7), F.col("line")).alias("l2"))


def halves(words: Column) -> Column:
    """Keys of the first and last half of a line, as cut for a partner of equal length or one word more;
    none for lines too short to have one."""
    n = F.size(words)
    at = lambda h: [F.xxhash64(F.lit(0), F.slice(words, 1, h)), F.xxhash64(F.lit(1), F.slice(words, n - h + 1, h))]
    short, long = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n < MIN_WORDS, F.array().cast("array<bigint>")).when(n % 2 == 1, F.array(*at(short))).otherwise(
        F.array(*at(short), *at(long)))


def with_partner(lines: DataFrame) -> DataFrame:
    """``l1``, ``l2`` of the distinct lines that share a half with another one."""
    keys = lines.select("l1", "l2", F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    return keys.join(shared, "key").select("l1", "l2").distinct()


def texts_of(found: DataFrame, seen: DataFrame) -> DataFrame:
    """``seq``, ``l1``, ``l2``, ``line`` of the lines found, in the order in which they first stand.

    Up to ``BROADCAST_ROWS`` pairs of hashes go to every task; beyond that all lines are shuffled.
    """
    few = found.count() <= BROADCAST_ROWS
    own = seen.join(F.broadcast(found) if few else found, ["l1", "l2"])
    first = own.groupBy("l1", "l2").agg(F.min(F.struct(*ID, "pos", "line")).alias("f"))
    # Ranges of the order, sorted inside: the numbers given to the rows follow it.
    ranged = first.repartitionByRange(*[F.col(f"f.{k}") for k in (*ID, "pos")]).sortWithinPartitions("f")
    return ranged.select(F.monotonically_increasing_id().alias("seq"), "l1", "l2", "f.line")


def neighbourhood(lines: DataFrame) -> DataFrame:
    """``seq``, ``key``, ``kind`` of each line and of each line less one word.

    A key is the exclusive or of word hashes salted with their places, hashed with its size and, for
    ``PART``, the place left out. ``REST`` (a line less a word) meets ``WHOLE`` (a line as it is).
    """
    each = lines.select("seq", words_of(F.col("line")).alias("words")).repartition("seq")
    each = each.select("seq", F.size("words").alias("n"), F.posexplode("words").alias("j", "w"))
    each = each.select("seq", "n", "j", F.xxhash64("w", "j").alias("a"), F.xxhash64("w", F.col("j") - 1).alias("b"))
    line = Window.partitionBy("seq")
    run = line.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    less = each.select("*", F.bit_xor("a").over(run).alias("ra"), F.bit_xor("b").over(run).alias("rb"),
                       F.bit_xor("a").over(line).alias("ta"), F.bit_xor("b").over(line).alias("tb"))
    without = F.col("ra").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("rb")).bitwiseXOR(F.col("tb"))
    n, j = F.col("n"), F.col("j")
    entry = lambda key, size, place, kind: F.struct(F.xxhash64(key, size, place).alias("key"), F.lit(kind).cast("tinyint").alias("kind"))
    keys = F.array(entry(without, n, j, PART), entry(without, n - 1, F.lit(-1), REST))
    keys = F.when(j == 0, F.concat(keys, F.array(entry(F.col("ta"), n, F.lit(-1), WHOLE)))).otherwise(keys)
    return less.select("seq", F.explode(keys).alias("k")).select("seq", "k.*")


def proposed(keys: DataFrame) -> DataFrame:
    """``seq``, ``other``: each line with the earliest line of a key that it shares, where that is earlier."""
    of = lambda *kinds: F.min(F.when(F.col("kind").isin(*kinds), F.col("seq")))
    first = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), of(WHOLE).alias("w"), of(PART, REST).alias("p")).filter("c > 1")
    # Lines that leave out the same place match each other; beside that, a whole line matches rests and rests a whole.
    rivals = F.when(F.col("kind") == PART, F.array("p")).when(F.col("kind") == WHOLE, F.array("w", "p")).otherwise(F.array("w"))
    return (keys.join(first.drop("c"), "key").select("seq", F.explode(rivals).alias("other"))
            .filter(F.col("other") < F.col("seq")).distinct())


def within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one edit apart: common start and end cover all but one word."""
    def common(x: Column, y: Column) -> Column:
        same = F.concat(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), F.array(F.lit(False)))
        return F.array_position(same, F.lit(False)) - 1
    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longest - 1)


def near_lines(lines: DataFrame, seen: DataFrame) -> DataFrame:
    """``l1``, ``l2`` of the distinct lines that have an earlier line one edit away."""
    found = stage(with_partner(lines), "line-partners")
    free_shuffles(found)
    some = stage(texts_of(found, seen), "line-texts")
    free_shuffles(some)
    pairs = stage(proposed(neighbourhood(some)), "line-pairs")
    free_shuffles(pairs)
    both = pairs.join(some, "seq").join(some.select(F.col("seq").alias("other"), F.col("line").alias("earlier")), "other")
    verified = let(words_of(F.col("line")), lambda a: let(words_of(F.col("earlier")), lambda b: within_one(a, b)))
    return both.filter(verified).select("l1", "l2").distinct()


def order() -> Column:
    return F.struct(*ID, "pos")


def dropped(docs: DataFrame) -> DataFrame:
    """``none``, ``id``, ``h1``, ``h2`` and the places of lines that go: ``gone`` all, ``near`` among them."""
    seen = occurrences(docs)
    each = seen.select("l1", "l2", order().alias("o"), let(words_of(F.col("line")), halves).alias("halves"))
    first = each.groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("o", "halves")).alias("f"))
    lines = stage(first.select("l1", "l2", "c", "f.o", "f.halves"), "lines")
    free_shuffles(lines)
    near = stage(near_lines(lines, seen), "near-lines")
    free_shuffles(near)
    near = near.withColumn("near", F.lit(True))
    classes = (lines.select("l1", "l2", "c", "o").join(near, ["l1", "l2"], "left")
               .filter((F.col("c") > 1) | F.col("near")).select("l1", "l2", "o", F.coalesce("near", F.lit(False)).alias("near")))
    hit = seen.drop("line").join(classes, ["l1", "l2"]).filter(F.col("near") | (order() != F.col("o")))
    return hit.groupBy(*ID).agg(F.collect_set("pos").alias("gone"), F.count_if((F.col("near")) & (order() == F.col("o"))).alias("n_near"))


def dedup(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep``, ``text`` without the lines that go, ``n_lines``, ``n_kept`` and ``n_near``."""
    gone = stage(dropped(docs), "gone")
    free_shuffles(gone)
    text = F.col("text").cast("string")
    rows = docs.select(*keep, *identity(F.coalesce(text, F.lit(""))), text.alias("_text"), text.isNotNull().alias("_is"))
    rows = rows.alias("d").join(gone.alias("g"), F.expr("d.none = g.none and d.id <=> g.id and d.h1 = g.h1 and d.h2 = g.h2 and d._is"), "left")
    lines = F.split("_text", "\n")

    def rest(parts: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("g.gone"))
        return F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")

    made = F.when(F.col("g.gone").isNull(), F.col("_text")).otherwise(let(lines, rest))
    n = F.when(F.col("_is"), F.size(lines)).otherwise(0).cast("bigint")
    return rows.select("d.*", made.alias("_made"), n.alias("n_lines"), (n - F.coalesce(F.size("g.gone"), F.lit(0))).alias("n_kept"),
                       F.coalesce("g.n_near", F.lit(0)).cast("bigint").alias("n_near")).drop(*ID, "_text", "_is")


def line_counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of lines and a digest of the text that is left."""
    return dedup(docs, [F.col("doc_id")]).select(
        "doc_id", "n_lines", "n_kept", "n_near", F.sha2(F.coalesce("_made", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents with their columns; ``text`` (and ``n_chars``, where there is one) follows what is left."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    made = dedup(docs, [whole])
    fresh = {"text": F.col("_made"), "n_chars": F.length("_made")}
    return made.select(*[(fresh[c].cast(docs.schema[c].dataType) if c in fresh else F.col(f"_doc.`{c}`")).alias(c)
                         for c in docs.columns])
