"""The corpus pipeline: five operators, one after another, over the table of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, mixing, quality, secret_scan, sentence_pieces
from tidemark.llm.common import read, ship
from tidemark.session import stage

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it is trained on the documents themselves."""
    ship(spark)
    return quality.filtered(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words to a shingle, similarity of 0.8 or more."""
    ship(spark)
    return minhash.deduplicated(docs, n=5, threshold=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come once for each epoch that reads them, with the words that the slots of the mix read."""
    ship(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document of the mix."""
    ship(spark)
    return sentence_pieces.encoded(docs, MODEL).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]
#: The trained scorer, the pseudorandom mix and the encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written before the next stage reads it."""
    docs = read(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
