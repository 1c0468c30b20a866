"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, importance, licenses, minhash, mixing, oracles, packing, permutation_index, quality, secret_scan, sentence_pieces, token_counts, token_files,
    vector_dedup,
)
from tidemark.llm.common import read
from tidemark.session import new_path


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read(spark, folder, "documents"))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(read(spark, folder, "documents"))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A cache of its own, so that every run encodes the distinct texts of the whole table."""
    cache = new_path(spark, "token-counts")
    return token_counts.token_counts(read(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"), cache)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_files(read(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"), 2, path)
    return token_files.read_files(spark, path)


def op6_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces.digests(read(spark, folder, "documents"), _tokenizer("piece_bpe_32k.model"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(read(spark, folder, "documents"))


def op8_minhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.groups(read(spark, folder, "documents"), n=3, threshold=85)


def op9_vector_groups(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.groups(read(spark, folder, "embeddings"))


def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.nearest(read(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digests(read(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"), 1)


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    tokenizers = _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model")
    return alignment.link_scores(read(spark, folder, "documents"), *tokenizers, [digest])


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_source_mix, op3_quality, op4_token_counts, op5_token_files, op6_sentence_pieces, op7_secret_scan, op8_minhash_groups,
        op9_vector_groups, op10_nearest, op11_packing, op12_importance, op13_alignment,
    )
}
#: The others use random permutations, trained models, tokenizers, digests of them, or iteration; tests compare them
#: with brute force.
ORACLES: dict[str, str] = oracles.ORACLES
