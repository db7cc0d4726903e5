"""Quality rules whose cutoffs follow each language and source.

Every document gets a few counts (``features``). Documents that fail the base rule go at once.
For the others each rate is put in a log-linear bucket that keeps the leading seven bits, and
buckets are counted by language and source. Such counts are a quantile sketch: its relative error
is below 1/64, two sketches merge by adding counts, and its size doesn't grow with the rows. The
quartiles of a source are blended with those of its language's merged sketch, which counts as
``WEIGHT`` documents, and a language's in the same way with those of all documents: few documents
of its own leave a source near its language, many near itself, and one more never switches. The
cutoff of a rate lies ``REACH`` times the distance from median to upper quartile (and a stated
slack) above that quartile, so it moves with what is usual there.

Null text has no words and fails the base rule. Null language or source is a group of its own.
Repeated rows count and return as often as they come. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from smeltery.llm.common import let, text_of, words_of
from smeltery.session import stage

WINDOW = 8          # words that count as a repeated passage
MIN_WORDS = 20
MAX_REPEAT = 30     # percent of the words
# Rate, slack above the fence: per 1000 characters, per 1000 characters, 1/100 characters, per 1000 lines.
RATES = {"symbol_rate": 30, "upper_rate": 150, "word_size": 300, "line_rate": 500}
REACH = 4
WEIGHT = 50         # documents of its own with which a source counts as much as its language
BROADCAST_ROWS = 50_000


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text.

    A window is known by its 64-bit hash, built from word hashes in three doublings.
    """
    def joined(h: Column, k: int) -> Column:
        """Hashes of runs of 2k words from those of k words: one is rotated, then both are mixed."""
        turned = lambda x: F.shiftleft(x, k).bitwiseOR(F.shiftrightunsigned(x, 64 - k))
        return let(h, lambda a: F.zip_with(
            F.slice(a, 1, F.greatest(F.size(a) - k, F.lit(0))), F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0))),
            lambda x, y: turned(x).bitwiseXOR(y)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for k in (1, 2, 4):
        hashes = joined(hashes, k)

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    def found(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda p, k: F.coalesce(F.get(pairs, k - 1)["h"] == p["h"], F.lit(False))
                         | F.coalesce(F.get(pairs, k + 1)["h"] == p["h"], F.lit(False)))
        return let(F.array_sort(F.transform(twice, lambda p: p["i"])), covered)

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(pairs, found))

    return let(hashes, count)


def features(text: Column) -> Column:
    """A struct of the counts of one text."""
    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(" \t\n\x0b\x0c\r")) != "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.size(F.split(text, "\n")).cast("long").alias("n_lines"))
    return let(words_of(text), of)


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT * f["n_words"])


def rates(f: Column) -> dict[str, Column]:
    """Whole numbers, rounded down; a text without words has rate zero."""
    def per(part: Column, whole: Column, unit: int) -> Column:
        return F.when(whole > 0, F.floor((unit * part).cast("decimal(38,0)") / whole)).otherwise(0).cast("long")
    return {"symbol_rate": per(f["n_symbols"], f["word_chars"], 1000),
            "upper_rate": per(f["n_upper"], f["word_chars"], 1000),
            "word_size": per(f["word_chars"], f["n_words"], 100),
            "line_rate": per(f["n_dup_lines"], f["n_lines"], 1000)}


def bucket(value: Column) -> Column:
    """The value with all but its seven leading bits cleared."""
    drop = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame) -> DataFrame:
    """Bucket counts by language, source and rate. Partial counts come before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(k).alias("rate"), bucket(F.col(k)).alias("bucket")) for k in RATES])
    return (measured.select("lang", "source", F.explode(pairs).alias("p"))
            .groupBy("lang", "source", "p.rate", "p.bucket").agg(F.count(F.lit(1)).alias("n")))


def quantiles(cells: DataFrame, by: list[str]) -> DataFrame:
    """Median and upper quartile of each sketch, and its number of documents."""
    merged = cells.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "rate")
    seen = merged.select("*", F.sum("n").over(w.orderBy("bucket")).alias("upto"), F.sum("n").over(w).alias("rows"))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("rows") * q, F.col("bucket")))
    return seen.groupBy(*by, "rate").agg(F.first("rows").alias("rows"), at(50).alias("mid"), at(75).alias("high"))


def fences(cells: DataFrame) -> DataFrame:
    """One row for each language and source: the cutoff of every rate."""
    fine, by_lang, whole = (quantiles(cells, by) for by in (["lang", "source"], ["lang"], []))
    a, b, c = fine.alias("a"), by_lang.alias("b"), whole.alias("c")
    joined = (a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang")) & (F.col("a.rate") == F.col("b.rate")))
              .join(c, F.col("a.rate") == F.col("c.rate")))

    def blend(own: str, rows: str, other: Column) -> Column:
        """Whole numbers, rounded down."""
        n = F.col(rows).cast("decimal(38,0)")
        return F.call_function("div", n * F.col(own) + WEIGHT * other, n + WEIGHT)

    def pick(name: str) -> Column:
        return blend(f"a.{name}", "a.rows", blend(f"b.{name}", "b.rows", F.col(f"c.{name}")))

    cut = joined.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("a.rate").alias("rate"),
                        pick("high").alias("high"), pick("mid").alias("mid"))
    cut = cut.select("lang", "source", "rate", (F.col("high") + REACH * (F.col("high") - F.col("mid"))).alias("cut"))
    return cut.groupBy("lang", "source").agg(*[
        (F.max(F.when(F.col("rate") == k, F.col("cut"))) + slack).alias(f"max_{k}") for k, slack in RATES.items()])


def judge(docs: DataFrame, carry: list[Column]) -> DataFrame:
    """``carry`` columns, the counts, ``base_failed``, ``kept`` and the cutoffs that applied.

    The counts are computed once and written to the shared folder with what is carried; the
    sketches read the narrow columns of that table, the verdict reads all of them.
    """
    f = F.col("_f")
    once = docs.select(*carry, F.col("lang").cast("string").alias("_lang"), F.col("source").cast("string").alias("_source"),
                       features(text_of()).alias("_f"))
    once = stage(once.select("*", base_failed(f).alias("base_failed")), "quality")
    measured = once.filter(~F.col("base_failed")).select(F.col("_lang").alias("lang"), F.col("_source").alias("source"),
                                                         *[c.alias(k) for k, c in rates(f).items()])
    cut = stage(fences(sketches(measured)), "quality-cuts")
    n_groups = cut.count()
    cut = cut.withColumnsRenamed({"lang": "_l", "source": "_s"})
    # A few numbers for each language and source; beyond the bound Spark shuffles and splits hot keys.
    cut = F.broadcast(cut) if n_groups <= BROADCAST_ROWS else cut
    judged = once.join(cut, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
    fine = F.lit(True)
    for k, c in rates(f).items():
        fine = fine & F.coalesce(c <= F.col(f"max_{k}"), F.lit(True))
    return judged.select("*", (~F.col("base_failed") & fine).alias("kept")).drop("_l", "_s")


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` for every document."""
    judged = judge(docs, [F.col("doc_id")])
    return judged.select("doc_id", *[F.col(f"_f.{k}").alias(k) for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")],
        "base_failed", "kept", *[f"max_{k}" for k in RATES])


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return judge(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")]).filter("kept").select("_doc.*")
