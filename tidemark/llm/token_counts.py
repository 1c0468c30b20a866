"""Token counts with a digest cache.

The cache is a table (content, version, n_tokens) that grows by appending. A count is looked up by
the digest of a document's normalised content and the digest of the tokenizer's version; only
distinct contents that the cache lacks are encoded, and their counts are appended.

Defined results: a null text counts as the empty one; repeated rows give a row each; an empty table
gives an empty result; other columns are not read. A content appended twice, by two runs at a time,
has the same count twice and is read once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokenizing import WordCounter, once, version_digest
from tidemark.session import stage

CACHE = "content string, version string, n_tokens long"
LIMIT = 2048


def normalised(text: Column) -> Column:
    """One space for every run of spaces and line ends: they part words and do nothing else.

    Letters' case stays, since special strings are only found in their own case.
    """
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \n]+", " "))


def read_cache(docs: DataFrame, cache: str) -> DataFrame:
    """The cache's rows; a cache that does not exist yet is empty."""
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(cache)


def encode_misses(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text)."""

    def count(batches):
        counter = once(("counter", tokenizer), lambda: WordCounter(tokenizer))
        for batch in batches:
            counts = pa.array([counter(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["content", "n_tokens"])

    return texts.mapInArrow(count, "content string, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of `docs`.

    One document stands for each content: texts are dealt by content and id, so many copies of one
    text do not meet in one task, and only rows that stand for a missing content go on.
    """
    version = version_digest(tokenizer)
    body = docs.select(
        "doc_id", F.sha2(normalised(F.col("text")), 256).alias("content"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    seen = stage(body, "digests")
    known = read_cache(docs, cache).filter(F.col("version") == version)
    missing = seen.join(known, "content", "left_anti").groupBy("content").agg(F.min(F.coalesce("doc_id", F.lit(-1))).alias("_id"))
    texts = docs.select(
        F.sha2(normalised(F.col("text")), 256).alias("content"), F.coalesce("doc_id", F.lit(-1)).alias("_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    texts = texts.join(missing.hint("shuffle_hash"), ["content", "_id"], "left_semi").select("content", "text")
    new = encode_misses(texts, tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # repeated rows have one count
    new.select("content", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    counts = read_cache(docs, cache).filter(F.col("version") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return seen.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
