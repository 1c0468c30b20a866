"""Near-duplicate documents by MinHash, with every link confirmed on full shingle sets.

1. A task turns each text into its set of distinct word shingles (as 64-bit hashes), `BANDS * ROWS`
   universal hash minima, one key per band of minima, and a sketch of one byte per minimum.
2. Documents with equal sets form a class; one document stands for it from here on.
3. Classes with an equal band key are a bucket. Each is paired with the bucket's smallest and
   largest member, and pairs whose sketches agree too little go. Where that leaves a bucket's other
   members in several components, all their pairs across components are compared by sketches too,
   in blocks, so no pair of a bucket is left undecided. Components of all pairs that agree are
   clusters: wider than the groups looked for.
4. Inside a cluster all pairs are compared on full sets, in blocks of at most `BLOCK` members, by one
   product of incidence matrices per pair of blocks. A block returns a spanning forest of its links.
5. Components of the links, by alternating large-star and small-star, are the groups.

A pair at the threshold misses all bands with probability below 1e-5 (3e-6 at 0.8, 7e-9 at 0.85).

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. Defined results: a text with fewer words than
a shingle has its whole sequence as the only one; a null text and one without words has the empty
set and is linked with nothing; rows with equal ids are one document, which has the links of all of
them; a row with a null id is linked with nothing; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts
from tidemark.llm.components import connected_components
from tidemark.llm.open_pairs import compared, open_pairs
from tidemark.session import stage

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: How far below the threshold a sketch may estimate a pair that only serves to find clusters.
SLACK = 0.25
BLOCK = 128
BLOCK_SHINGLES = 1_000_000
PART = 1 << 22
#: Classes that a task puts into one file.
FILE_ROWS = 20_000

_rng = np.random.default_rng(20240607)
_U = np.uint64
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * _U(2) + _U(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_POWERS["up"]) < n:
        have = len(_POWERS["up"])
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            old = _POWERS[name]
            _POWERS[name] = np.concatenate([old, old * _U(pow(base, have, 1 << 64))])
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word: differences of prefix sums of byte values times powers.

    Very long texts are worked on in parts that end at white space.
    """
    if len(text) > PART:
        cut = max(text.rfind(c, 0, PART) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut <= 0:  # one word longer than a part: it ends at the next white space
            found = [k for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (k := text.find(c, PART)) > 0]
            cut = min(found, default=len(text))
        if cut < len(text):
            parts = [text[:cut]]
            while cut < len(text):
                end = min(len(text), cut + PART)
                while end < len(text) and not _IS_SPACE[text[end]]:
                    end += 1
                parts.append(text[cut:end])
                cut = end
            return np.concatenate([_word_hashes(p) for p in parts])
    return _word_hashes(text)


def _word_hashes(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of n words."""
    with np.errstate(over="ignore"):
        words = word_hashes((text or "").encode())
        if not len(words):
            return np.empty(0, np.uint64)
        k = min(n, len(words))
        total = np.full(len(words) - k + 1, k, np.uint64)
        for j in range(k):
            total += words[j : len(words) - k + 1 + j] * _PLACE[j]
        return np.unique(_mix(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash a * x + b over a set, as 32 bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(shingles), 1024):
            np.minimum(least, (shingles[k : k + 1024, None] * _A + _B).min(axis=0), out=least)
    return least >> _U(32)


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, content, bands, sketch); content is null for the empty set."""

    def sketch(batches):
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("content", pa.binary()),
            ("bands", pa.list_(pa.int64())), ("sketch", pa.binary()),
        ])
        with np.errstate(over="ignore"):
            for batch in parts(batches):
                sizes, contents, bands, bytes_ = [], [], [], []
                for text in batch.column(1).to_pylist():
                    shingles = shingle_set(text, n)
                    sizes.append(len(shingles))
                    if not len(shingles):
                        contents.append(None), bands.append(None), bytes_.append(None)
                        continue
                    least = minima(shingles)
                    contents.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    keys = (least.reshape(BANDS, ROWS) * _PLACE[:ROWS]).sum(axis=1) + np.arange(BANDS, dtype=np.uint64) * _PLACE[ROWS]
                    bands.append(_mix(keys).view(np.int64))
                    bytes_.append((least & _U(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(contents, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())], schema=schema,
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sketch, "doc_id long, n_shingles long, content binary, bands array<long>, sketch binary"
    )


def _clusters(classes: DataFrame, threshold: int) -> DataFrame:
    """(node, component_id): classes that may be linked, directly or through others."""
    least = (threshold / 100 - SLACK) * HASHES
    rows = classes.select("node", F.explode("bands").alias("key"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).filter("_low < _high")
    pairs = rows.join(hubs, "key").select("node", F.explode(F.array("_low", "_high")).alias("hub")).filter("node <> hub")
    pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    known = classes.select("node", "sketch")
    pairs = pairs.join(known.toDF("a", "_one"), "a").join(known.toDF("b", "_two"), "b")

    def agree(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in (2, 3))
            close = pa.array((one == two).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(close) for c in (0, 1)], ["a", "b"])

    found = connected_components(pairs.select("a", "b", "_one", "_two").mapInArrow(agree, "a long, b long"))

    def close(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
        one, two = (np.ascontiguousarray(np.frombuffer(b"".join(s["sketch"]), np.uint8).reshape(-1, HASHES).T) for s in (left, right))
        same = np.zeros((len(left), len(right)), np.uint8)
        for x, y in zip(one, two, strict=True):
            same += x[:, None] == y[None, :]
        return same >= least

    # a hub has met its whole bucket
    others = rows.join(hubs, "key").filter("node <> _low AND node <> _high").select("key", "node")
    others = others.join(found, "node", "left").select("key", "node", F.coalesce("component_id", "node").alias("component"))
    more = compared(open_pairs(others, ["key"]).join(known, "node"), close)
    joined = found.select(F.col("node").alias("a"), F.col("component_id").alias("b"))
    return connected_components(joined.unionByName(more))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right."""
    values = np.concatenate([*left, *right])
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    often = times[column] > 1  # what only one set has is in no intersection
    new = np.cumsum(times > 1) - 1
    row, column = row[often], new[column[often]]
    out = np.zeros((len(left), len(right)), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (start, start + width))
        held = np.zeros((len(left) + len(right), width), np.float32)
        held[row[lo:hi], column[lo:hi] - start] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out.astype(np.int64)


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of links between 0..n-1."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for x, y in pairs:
        a, b = find(int(x)), find(int(y))
        if a != b:
            root[a] = b
            kept.append((int(x), int(y)))
    return kept


def _links(docs: DataFrame, clusters: DataFrame, n: int, threshold: int) -> DataFrame:
    """(a, b): spanning links, confirmed on full sets, inside each cluster."""

    def sets(batches):
        for batch in parts(batches):
            found = [shingle_set(t, n) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
                ["cluster", "node", "n", "shingles"],
            )

    # the same plan at every size: texts are dealt by id, and each task keeps the ids of its members
    members = clusters.select(F.col("component_id").alias("cluster"), "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(members.hint("shuffle_hash"), "node")
    sized = stage(texts.select("cluster", "node", "text").mapInArrow(sets, "cluster long, node long, n long, shingles binary"), "sets")
    blocks = sized.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("_blocks")
    )
    placed = sized.join(blocks, "cluster").withColumn("_at", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    met = placed.select(
        "cluster", "node", "shingles", "_at",
        F.explode(F.expr("transform(sequence(0, _blocks - 1), o -> struct(least(o, _at) as i, greatest(o, _at) as j))")).alias("_pair"),
    ).select("cluster", "_pair.i", "_pair.j", "node", "_at", "shingles")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        parts = [pdf[pdf["_at"] == k] for k in ((i,) if i == j else (i, j))]
        nodes = [p["node"].to_numpy() for p in parts]
        held = [[np.frombuffer(s, np.uint64) for s in p["shingles"]] for p in parts]
        shared = shared_counts(held[0], held[-1])
        size = [np.array([len(s) for s in h], np.int64) for h in held]
        either = size[0][:, None] + size[-1][None, :] - shared
        x, y = np.nonzero((100 * shared >= threshold * either) & (either > 0))
        kept = _forest(sum(map(len, nodes)), np.stack([x, y + (len(nodes[0]) if i != j else 0)], axis=1))
        every = np.concatenate(nodes)
        return pd.DataFrame({"a": every[[k[0] for k in kept]], "b": every[[k[1] for k in kept]]}, dtype=np.int64)

    return met.groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long")


def groups(docs: DataFrame, n: int = 5, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs`.

    component_id is the smallest id reachable by links of similarity `threshold` per cent or more.
    """
    seen = stage(sketches(docs, n), "sketches")
    classes = stage(
        seen.filter("content IS NOT NULL AND doc_id IS NOT NULL").groupBy("content").agg(
            F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ).coalesce(max(1, math.ceil(seen.count() / FILE_ROWS))), "classes",
    )
    clusters = _clusters(classes, threshold)
    # equal sets with other ids of the same documents: a document of several rows joins its classes
    same = seen.filter("content IS NOT NULL AND doc_id IS NOT NULL").select("content", "doc_id").distinct()
    twice = same.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    tied = same.join(twice, "doc_id").join(classes.select("content", "node"), "content").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = connected_components(_links(docs, clusters, n, threshold).unionByName(tied))
    named = classes.select("content", "node").join(found, "node", "left").select(
        "content", F.coalesce("component_id", "node").alias("_component")
    )
    return seen.join(named, "content", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
        (F.col("doc_id") == F.coalesce("_component", "doc_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, n: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id; all columns of `docs` stay.

    Of rows with equal id and text one stays, the one with the smallest other columns; rows with equal
    id and different texts are one document and stay or go together; rows with a null id all stay.
    """
    kept = groups(docs, n, threshold).filter("kept").select("doc_id").distinct()
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # copies merge inside the tasks, before the shuffle
    first = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(
        F.min(F.struct(F.lit(0).alias("_none"), *[F.col(c).alias(f"_{k}") for k, c in enumerate(rest)])).alias("_first")
    )
    columns = {c: F.col("_first")[f"_{k}"] for k, c in enumerate(rest)}
    first = first.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])
    return first.unionByName(docs.filter("doc_id IS NULL"))
