"""Importance resampling towards a target distribution, over hashed word features.

A feature is a run of words; its bucket is the CRC of its bytes. Features that a task has not met
before are hashed together: those of equal length lie in one matrix of bytes, a row each, and all
their CRCs are updated column by column; the results are scattered back to the features. Buckets of
known features stay in a bounded table of the worker.

The corpus and the target each give one count for each bucket. A bucket's gain is the scaled log of
how much more frequent it is in the target (smoothed by one), a document's weight the floored mean
of its features' gains, and the draw takes the documents with the largest weight plus Gumbel noise,
which comes from a digest of the id, so reruns agree.

All documents are counted, weighed and ranked. The driver sees one count for each bucket and one for
each score: gains are bounded by the logarithm of the corpus size and the noise by its 32 bits, so
there are some ten thousand scores, however many documents there are.

Defined results: a null text has no words; a document without features has weight 0; a null id draws
noise from the empty id and comes after all others of its score; repeated rows are documents of their
own; an empty target or corpus counts 0 everywhere; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.ordering import numbered
from tidemark.llm.tokenizing import once
from tidemark.session import stage

BUCKETS = 10_000
KNOWN = 400_000
LONG = 512
SEED = 2024
_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table


_TABLE = _crc_table()


def crc32_of(features: list[bytes]) -> np.ndarray:
    """CRC of every feature, as unsigned 32-bit numbers.

    Features longer than `LONG` bytes, of which hardly any two have the same length, are hashed one by one.
    """
    size = np.fromiter(map(len, features), np.int64, len(features))
    out = np.empty(len(features), np.uint32)
    order = np.argsort(size, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
        length = int(size[at[0]])
        if length > LONG:
            out[at] = [zlib.crc32(features[k]) for k in at]
            continue
        rows = np.frombuffer(b"".join([features[k] for k in at]), np.uint8).reshape(len(at), length)
        crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
        for column in np.ascontiguousarray(rows.T):
            crc = _TABLE[(crc ^ column) & 0xFF] ^ crc >> np.uint32(8)
        out[at] = ~crc
    return out


#: Every byte as part of a word, in lower case, or as a space.
_AS_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words, A-Z in lower case: runs of ASCII letters, digits and signs beyond ASCII."""
    return (text or "").encode().translate(_AS_WORDS).split()


class Buckets:
    """Bucket numbers of the features of many texts, with a table of features met before."""

    def __init__(self, runs: int, buckets: int):
        self.runs, self.buckets, self.known = runs, buckets, {}
        self.dtype = np.uint16 if buckets <= 1 << 16 else np.uint32

    def features(self, words: list[bytes]) -> list[bytes]:
        return words + [b" ".join(words[k : k + n]) for n in range(2, self.runs + 1) for k in range(len(words) - n + 1)]

    def __call__(self, texts: list[str | None]) -> tuple[list[int], list[np.ndarray]]:
        """Number of words and the features' buckets of each text."""
        words = list(map(words_of, texts))
        found = [self.features(w) for w in words] if self.runs > 1 else words
        every = set().union(*found)
        if len(self.known) + len(every) > KNOWN:
            self.known.clear()
        new = list(every.difference(self.known))
        self.known.update(zip(new, (crc32_of(new) % np.uint32(self.buckets)).tolist(), strict=True))
        return list(map(len, words)), [np.fromiter(map(self.known.__getitem__, f), self.dtype, len(f)) for f in found]


def hashed(docs: DataFrame, id_column: str = "doc_id", runs: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): numbers of words and features, and every feature's bucket, as bytes.

    Features are all runs of 1 to `runs` words, repeats included.
    """
    ship(docs.sparkSession)

    def count(batches):
        table = once(("buckets", runs, buckets), lambda: Buckets(runs, buckets))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                n_words, held = table(part.column(1).to_pylist())
                n = list(map(len, held))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()), pa.array([h.tobytes() for h in held], pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of the whole table in each bucket; tasks send a count for each bucket they met."""
    dtype = Buckets(1, buckets).dtype

    def tally(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(held, dtype), minlength=buckets) if len(held) > buckets else 0
            short = b"".join(h for h in batch.column(0).to_pylist() if len(h) <= buckets)
            total += np.bincount(np.frombuffer(short, dtype), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in features.select("buckets").mapInArrow(tally, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much more frequent each bucket is in the target, smoothed by one."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (s_all + b)) / float((s + 1) * (t_all + b))))
        for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(features: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of hashed documents."""
    dtype = Buckets(1, len(gain)).dtype

    def weigh(batches):
        for batch in batches:
            weights = []
            for held in batch.column(3).to_pylist():
                mine = gain[np.frombuffer(held, dtype)]
                weights.append(int(mine.sum()) // len(mine) if len(mine) else 0)
            scores = [w + noise(i, seed) for w, i in zip(weights, batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return features.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, runs: int = 1, buckets: int = BUCKETS, per_cent: int = 10, least_words: int = 20, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per row of `docs`; rank is null for those not drawn.

    Of the documents with `least_words` words or more, `per_cent` in a hundred are drawn (floored), by
    score, ties to the smaller id.
    """
    features = stage(hashed(docs, "doc_id", runs, buckets), "features")
    goal = hashed(target.select(F.lit(0).alias("_id"), "text"), "_id", runs, buckets)
    scored = stage(weighed(features, gains(bucket_counts(features, buckets), bucket_counts(goal, buckets)), seed), "scores")

    fit = F.col("n_words") >= least_words
    n_of = {r["score"]: r["n"] for r in scored.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = per_cent * sum(n_of.values()) // 100
    least, above = None, 0
    for score in sorted(n_of, reverse=True):
        if above >= wanted:
            break
        least, above = score, above + n_of[score]
    out = ["doc_id", "n_features", "weight", "score"]
    if least is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    near = fit & (F.col("score") >= least)  # all that are drawn, and those that tie with the last
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("weight"), F.col("n_features"), F.col("_row")]
    drawn = numbered(scored.filter(near).select(*out, F.monotonically_increasing_id().alias("_row")), order, "_number")
    drawn = drawn.select(*out, F.when(F.col("_number") <= wanted, F.col("_number")).alias("rank"))
    return drawn.unionByName(scored.filter(~near).select(*out, F.lit(None).cast("long").alias("rank")))
