"""The registered queries of the text operators: one for each, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smeltery.llm import sql
from smeltery.llm.alignment import alignment
from smeltery.llm.bpe import encode
from smeltery.llm.classifier import quality_scores
from smeltery.llm.common import documents, reach_package
from smeltery.llm.line_dedup import line_counts
from smeltery.llm.manifest import proofs
from smeltery.llm.mixing import mix
from smeltery.llm.nearest import neighbours_of_sample
from smeltery.llm.pii import personal_data
from smeltery.llm.quality import quality
from smeltery.llm.sharding import shards
from smeltery.llm.simhash import near_duplicates
from smeltery.llm.token_counts import token_counts
from smeltery.llm.token_files import digests


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; every node has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_counts(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), ["doc_id"],
                  ["n_tokens", "ids_sha256", "decoded_sha256"])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach_package(spark)
    return neighbours_of_sample(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_bpe, op3_quality_rules, op4_token_counts, op5_token_files, op6_personal_data, op7_nearest, op8_simhash, op9_sharding, op10_mixing,
                                   op11_quality_classifier, op12_alignment, op13_manifest)}
ORACLE = {"op1_line_dedup": sql.LINE_DEDUP, "op3_quality_rules": sql.QUALITY, "op13_manifest": sql.MANIFEST}
