"""A corpus from raw documents: quality rules, line dedup, near-duplicates, mixing, token ids."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from smeltery.llm.bpe import encode
from smeltery.llm.common import reach_package
from smeltery.llm.line_dedup import without_repeated_lines
from smeltery.llm.mixing import mixed
from smeltery.llm.quality import keep_good
from smeltery.llm.queries import vocabulary
from smeltery.llm.simhash import one_of_each
from smeltery.session import collected, drop_staged, stage

# Folders that the stage called last has staged; its output still reads them.
_LEFT: list[str] = []


def step(work):
    """A stage that first deletes what the one before it staged, as that one's output is written by now."""
    @wraps(work)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_staged(spark, _LEFT)
        with collected() as paths:
            out = work(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return out
    return run_step


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


@step
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go."""
    return keep_good(docs)


@step
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or nearly so, go; no document does."""
    return without_repeated_lines(docs)


@step
def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within three bits stays."""
    reach_package(spark)
    return one_of_each(docs)


@step
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights; a document has a row for each copy."""
    return mixed(docs)


@step
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and digests of them and of the text that they decode to."""
    reach_package(spark)
    return encode(docs, vocabulary("word_bpe_49k.json"), ["doc_id", "lang", "source"], ["n_tokens", "ids_sha256", "decoded_sha256", "ids"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash", simhash), ("mixing", mixing), ("bpe", token_ids),
]
# The fingerprints' hash and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is written to the shared folder and read again by the next.

    Functions of ``STAGES`` called one by one are to be used likewise: write a stage's output before
    calling the next.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
