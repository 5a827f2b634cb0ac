"""The subpackage's queries; each applies an operator, as in production, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, bytebpe, classlm, counts, mtree, neardup, oracles, packing, quality, secrets, spelling, suffixes, toxicity, whitening

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op3_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.class_lm_scores(table(spark, sf_dir, "documents"), modulus=7, remainder=2)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_digests(table(spark, sf_dir, "documents"), span=50)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations past a long are null."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8).withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bytebpe.byte_bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_dedup": oracles.NEAR_DUPLICATES, "op3_mtree_top_k": oracles.TOP_K, "op6_secret_scan": oracles.secret_scan(), "op13_spelling_variants": oracles.SPELLING}
