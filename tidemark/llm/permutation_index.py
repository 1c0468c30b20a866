"""Nearest neighbours by a permutation index.

A vector is represented by its `PREFIX` nearest pivots, in order. Each chunk of the index keeps, per
pivot, the vectors that have the pivot in their prefix and at which place: the pivot's inverted
file. A query goes through the files of its own `ASKED` nearest pivots only and adds up, for each
vector met, how far the places differ (Spearman's footrule over those pivots, with the place just past
the prefix for a vector that lacks one). The `RERANK` part of a chunk with the smallest footrule is
ranked by true distance, and with it all that tie with its last.

Pivots come from a bounded sample, the `SAMPLE * PIVOTS` vectors with the smallest hash of their number:
farthest first, in the distance of the queries, so a direction that all vectors share makes no
difference and a crowd of near copies takes no place from others. There are `PIVOTS` of them unless
the sample has fewer distinct vectors. Everything else covers all rows: every vector is in the index,
and every query meets every chunk. So work grows with queries times vectors, as an exact search's
does, but a query adds ASKED * PREFIX / PIVOTS small integers for a vector, and compares true
components for the part that is ranked again. Queries meet chunks in blocks of `QUERIES`, and the index
is copied once for each block.

Defined results: vectors that are null, zero or hold null or non-finite components, have a null id or
another number of components than most take no part; repeated rows are one vector; different vectors of
one id are vectors of their own, each a query if its id is asked for, and candidates of each other; a
query with fewer candidates than asked for gets them all; equal distances are ordered by id;
distances beyond the range of squares are still right; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.vectors import checked, distances, distinct_vectors, matrix, of_one_size
from tidemark.session import stage

PIVOTS = 256
PREFIX = 128
ASKED = 32
SAMPLE = 8
RERANK = 0.06
LEAST = 400
CHUNK = 8192
QUERIES = 8192


def _scale(vectors: np.ndarray) -> float:
    """What to divide by so that squares of all components stay in the range of doubles."""
    largest = np.abs(vectors).max(initial=0.0)
    return 1.0 if 1e-100 < largest < 1e100 or largest == 0 else float(largest)


def fit_pivots(vectors: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """At most n pivots; a sample of n * SAMPLE vectors passes the driver."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(n * SAMPLE).select("vector").collect()
    held = np.array([r.vector for r in rows], dtype=np.float64)
    scaled = held / _scale(held)
    chosen, away = [0], ((scaled - scaled[0]) ** 2).sum(axis=1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((scaled - scaled[chosen[-1]]) ** 2).sum(axis=1))
    return held[chosen]


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    scale = _scale(pivots)
    near = pivots / scale
    away = (near * near).sum(axis=1) - 2 * ((vectors / scale) @ near.T)
    return np.argsort(away, axis=1, kind="stable")[:, :prefix].astype(np.uint16)


class InvertedFiles:
    """The inverted files of one chunk: for each pivot the rows that hold it and its place there."""

    def __init__(self, orders: np.ndarray, n_pivots: int):
        self.n, self.prefix = orders.shape
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[by_pivot], np.arange(1, n_pivots))
        rows, places = by_pivot // self.prefix, (by_pivot % self.prefix).astype(np.int32)
        self.files = list(zip(np.split(rows, ends), np.split(places, ends), strict=True))

    def footrule(self, asked: np.ndarray) -> np.ndarray:
        """Footrule distance of all vectors of the chunk to a query, over the query's nearest pivots in order."""
        total = np.full(self.n, int((self.prefix - np.arange(len(asked))).sum()), np.int32)
        for own, pivot in enumerate(asked):
            rows, at = self.files[pivot]
            total[rows] += np.abs(at - own) - (self.prefix - own)
        return total


def _represented(vectors: DataFrame, size: int, pivots: np.ndarray, prefix: int) -> DataFrame:
    """(row, id, vector, pivots): the permutation prefix as bytes."""

    def represent(batches):
        for batch in batches:
            if batch.num_rows:
                seen = nearest_pivots(matrix(batch.column(2), size), pivots, prefix)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([p.tobytes() for p in seen], pa.binary())], ["row", "id", "vector", "pivots"]
                )

    return vectors.select("row", "id", "vector").mapInArrow(represent, "row long, id long, vector array<double>, pivots binary")


def nearest(table: DataFrame, is_query: Column, k: int = 10, rerank: float = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row where `is_query` holds.

    score is the Euclidean distance of the original vectors in double precision; a query is no
    candidate of its own. `is_query` is a condition on the column id.
    """
    spark = table.sparkSession
    ship(spark)
    vectors, size = of_one_size(distinct_vectors(checked(table, labelled=False)))
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = fit_pivots(vectors.select(F.col("row").alias("id"), "vector"))
    prefix = min(PREFIX, len(pivots))
    index = stage(_represented(vectors, size, pivots, prefix), "index")
    asked = index.filter(is_query)
    chunks, blocks = math.ceil(index.count() / CHUNK), max(1, math.ceil(asked.count() / QUERIES))
    held = index.select(
        F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("long").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "row", "id", "vector", "pivots",
    )
    asked = asked.select(
        F.explode(F.expr(f"sequence(0L, {chunks - 1}L)")).alias("chunk"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "row", "id", "vector", "pivots",
    )

    def search(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            files = InvertedFiles(np.stack([np.frombuffer(p, np.uint16) for p in rows["pivots"]]), len(pivots))
            mine, ids, at = np.stack(rows["vector"].to_numpy()), rows["id"].to_numpy(), rows["row"].to_numpy()
            depth = min(len(ids), max(LEAST, math.ceil(rerank * len(ids))))
            for query, own, vector, order in zip(queries["id"], queries["row"], queries["vector"], queries["pivots"], strict=True):
                rule = files.footrule(np.frombuffer(order, np.uint16)[:ASKED])
                near = np.flatnonzero(rule <= np.partition(rule, depth - 1)[depth - 1])
                near = near[at[near] != own]
                away = distances(mine[near], np.asarray(vector))
                best = np.lexsort((ids[near], away))[:k]
                out.append((np.full(len(best), own), np.full(len(best), query), ids[near][best], away[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]
        return pd.DataFrame(dict(zip(("row", "query_id", "vec_id", "score"), columns, strict=True)))

    found = asked.groupBy("chunk", "block").cogroup(held.groupBy("chunk", "block")).applyInPandas(
        search, "row long, query_id long, vec_id long, score double"
    )
    best = Window.partitionBy("row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
