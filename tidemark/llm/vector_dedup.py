"""Near-duplicate vectors by sorted projection passes.

1. Every pass hashes a vector by `BITS` random hyperplanes of its own, and vectors of one label are
   sorted by the concatenated bits, first bit first, then id. In that order each vector is
   compared with the `WINDOW` vectors after it. Close vectors often agree in the leading bits, and
   passes are independent: their number follows from the size of the largest label, so that a pair
   at the threshold agrees in `leading_bits` of no pass with probability `MISS` at most.
2. Vectors that agree in so many bits are a cell. A cell that fits the window has been compared. In
   a larger one, as a crowd of vectors just below the threshold makes, all pairs that are not in one
   component yet are compared, in blocks. So that probability is the miss rate whatever the cells hold.
   Verified pairs of all passes and cells are united: connected components.
3. A component may be larger than any window. So all pairs inside a component are compared, block
   against block of at most `BLOCK` members, which finds every link between its members.

Sorting is distributed: rows are dealt by ranges of (label, bits, id), and the last rows of each
range are given to the following ranges as well, as far as the window reaches.

Links are between vectors of one label with a cosine of `threshold` or more in double precision; vectors
are scaled to length one first, whatever their size. Defined results: vectors that are null, zero or hold
null or non-finite components, those with a null label or id and those with another number of components
than most link with nothing and are groups of their own; repeated rows are one vector and have its links;
different vectors of one id have each their own links, also with each other, and share the group; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.components import connected_components
from tidemark.llm.minhash import _forest
from tidemark.llm.open_pairs import compared, open_pairs
from tidemark.llm.vectors import checked, distinct_vectors, matrix, of_one_size, units
from tidemark.session import stage

BITS = 62
WINDOW = 128
MISS = 1e-5
BLOCK = 128
CHUNK = 1024
SEED = 99


def leading_bits(largest: int, window: int = WINDOW) -> int:
    """Bits that part a label of so many vectors into cells of half a window, if all were alike in size."""
    return min(BITS, math.ceil(max(0.0, math.log2(max(largest, 1) / window))) + 1)


def n_passes(largest: int, threshold: float, window: int = WINDOW) -> int:
    """Passes for a label of so many vectors: two of them must agree in the leading bits of one pass.

    They agree in each bit with probability 1 - angle / pi.
    """
    bits = leading_bits(largest, window)
    found = (1 - math.acos(threshold) / math.pi) ** bits
    return max(2, math.ceil(math.log(MISS) / math.log(1 - min(found, 1 - 1e-9))))


def _ordered(vectors: DataFrame, size: int, number: int) -> DataFrame:
    """(pass, label, key, id, vector) for every pass."""

    def hashes(batches):
        planes = [np.random.default_rng([SEED, p]).standard_normal((size, BITS)) for p in range(number)]
        weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                held = matrix(batch.column(0), size)
                keys = np.stack([((held @ p) > 0) @ weights for p in planes], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), batch.column(2), batch.column(0), pa.array(list(keys), pa.list_(pa.int64()))],
                    ["id", "label", "vector", "keys"],
                )

    kind = vectors.schema["label"].dataType.simpleString()
    keyed = vectors.select("vector", "id", "label").mapInArrow(hashes, f"id long, label {kind}, vector array<double>, keys array<long>")
    return keyed.select("id", "label", "vector", F.posexplode("keys").alias("pass", "key"))


def _unit_vectors(rows: DataFrame, size: int) -> DataFrame:
    """(id, label, vector): the row's number as id, the vector scaled to length one."""

    def scale(batches):
        for batch in batches:
            if batch.num_rows:
                held = units(matrix(batch.column(2), size))
                ends = pa.array(np.arange(0, held.size + 1, size), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(held.ravel()))], ["id", "label", "vector"]
                )

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("row", "label", "vector").mapInArrow(scale, f"id long, label {kind}, vector array<double>")


def _pass_links(keyed: DataFrame, threshold: float, window: int) -> DataFrame:
    """(a, b): verified pairs from the windows of all passes, a spanning forest per chunk.

    Rows get their place in the order of (pass, label, key, id): range and place inside the range.
    A chunk is `CHUNK` places, and also holds the `window` places before it.
    """

    def place(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(np.arange(at, at + batch.num_rows))],
                ["pass", "label", "id", "part", "place"],
            )
            at += batch.num_rows

    kind = keyed.schema["label"].dataType.simpleString()
    order = ["pass", "label", "key", "id"]
    placed = stage(
        keyed.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).select("pass", "label", "id")
        .mapInArrow(place, f"pass int, label {kind}, id long, part long, place long"), "places",
    )
    parts = placed.groupBy("part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = placed.join(parts, "part").select("pass", "id", (F.col("place") + F.col("_before")).alias("at"))
    vectors_at = placed.join(keyed.select("pass", "id", "label", "vector"), ["pass", "id"])
    chunks = F.sequence(F.expr(f"at div {CHUNK}"), F.expr(f"(at + {window}) div {CHUNK}"))
    dealt = vectors_at.select("pass", "label", "id", "at", "vector", F.explode(chunks).alias("chunk"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        held = np.stack(pdf["vector"].to_numpy())
        at, ids = pdf["at"].to_numpy(), pdf["id"].to_numpy()
        label, which = pd.factorize(pdf["label"])[0], pdf["pass"].to_numpy()
        # a pair belongs to the chunk of its later member
        x, y = np.nonzero(np.triu(held @ held.T >= threshold, 1))
        good = (at[y] - at[x] <= window) & (at[y] // CHUNK == pdf["chunk"].iloc[0]) & (label[x] == label[y]) & (which[x] == which[y])
        kept = _forest(len(ids), np.stack([x[good], y[good]], axis=1))
        return pd.DataFrame({"a": ids[[k[0] for k in kept]], "b": ids[[k[1] for k in kept]]}, dtype=np.int64)

    return dealt.groupBy("chunk").applyInPandas(compare, "a long, b long")


def _cell_links(keyed: DataFrame, vectors: DataFrame, found: DataFrame, bits: int, threshold: float, window: int) -> DataFrame:
    """(a, b): verified pairs of the cells that are wider than the window, across the components found so far."""

    def close(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
        held = [np.stack(s["vector"].to_numpy()) for s in (left, right)]
        return (held[0] @ held[1].T >= threshold) & (left["label"].to_numpy()[:, None] == right["label"].to_numpy()[None, :])

    cell = ["pass", "label", "cell"]
    rows = keyed.select("pass", "label", F.shiftright("key", BITS - bits).alias("cell"), "id")
    wide = rows.groupBy(*cell).count().filter(F.col("count") > window + 1).drop("count")
    rows = rows.join(wide, cell).join(found.withColumnRenamed("node", "id"), "id", "left")
    rows = rows.select(*cell, F.col("id").alias("node"), F.coalesce("component_id", "id").alias("component"))
    known = vectors.select(F.col("id").alias("node"), "label", "vector")
    return compared(open_pairs(rows, cell).join(known, "node"), close)


def _link_counts(vectors: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """(id, n_links): links of every vector with the members of its component."""
    members = vectors.select("id", "label", "vector").join(found.withColumnRenamed("node", "id"), "id")
    blocks = found.groupBy("component_id").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    placed = members.join(blocks, "component_id").withColumn("_at", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    met = placed.select(
        "component_id", "label", "id", "vector", "_at",
        F.explode(F.expr("transform(sequence(0, _blocks - 1), o -> struct(least(o, _at) as i, greatest(o, _at) as j))")).alias("_pair"),
    ).select("component_id", "label", "_pair.i", "_pair.j", "id", "vector", "_at")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        parts = [pdf[pdf["_at"] == k] for k in ((i,) if i == j else (i, j))]
        held = [np.stack(p["vector"].to_numpy()) if len(p) else np.zeros((0, 1)) for p in parts]
        if not (len(held[0]) and len(held[-1])):
            return pd.DataFrame({"id": [], "n": []}, dtype=np.int64)
        linked = held[0] @ held[-1].T >= threshold
        if i == j:
            np.fill_diagonal(linked, False)
            return pd.DataFrame({"id": parts[0]["id"], "n": linked.sum(axis=1)})
        return pd.DataFrame({
            "id": np.concatenate([p["id"] for p in parts]), "n": np.concatenate([linked.sum(axis=1), linked.sum(axis=0)]),
        })

    each = met.groupBy("component_id", "label", "i", "j").applyInPandas(count, "id long, n long")
    return each.groupBy("id").agg(F.sum("n").alias("n_links"))


def _by_id(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(vec_id, component_id): the smallest id of the component that the vectors of an id are in."""
    known = found.join(rows.select(F.col("row").alias("node"), "id"), "node")
    roots = known.groupBy("component_id").agg(F.min("id").alias("_root"))
    return known.join(roots, "component_id").groupBy(F.col("id").alias("vec_id")).agg(F.min("_root").alias("component_id"))


def groups(table: DataFrame, threshold: float = 0.98, window: int = WINDOW) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `table`."""
    ship(table.sparkSession)
    rows = checked(table)
    good, size = of_one_size(distinct_vectors(rows))
    if size:
        vectors = stage(_unit_vectors(good, size), "units")
        largest = vectors.groupBy("label").count().agg(F.max("count")).first()[0]
        keyed = stage(_ordered(vectors, size, n_passes(largest, threshold, window)), "keys")
        # vectors of one id belong together, linked or not
        first = good.groupBy("id").agg(F.min("row").alias("a"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        tied = good.select("id", F.col("row").alias("b")).join(first, "id").select("a", "b")
        found = connected_components(_pass_links(keyed, threshold, window).unionByName(tied))
        more = _cell_links(keyed, vectors, found, leading_bits(largest, window), threshold, window)
        joined = found.select(F.col("node").alias("a"), F.col("component_id").alias("b"))
        found = connected_components(joined.unionByName(more))
        counts = _link_counts(vectors, found, threshold).withColumnRenamed("id", "row")
        counts = good.join(counts, "row").select("id", "label", "vector", "n_links")
        named = _by_id(good, found)
    else:
        named = table.sparkSession.createDataFrame([], "vec_id long, component_id long")
        counts = good.withColumn("n_links", F.lit(0)).drop("row")
    everyone = rows.join(counts, ["id", "label", "vector"], "left").withColumnRenamed("id", "vec_id")
    return everyone.join(named, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )
