"""Mix sources to target weights in fixed-length blocks of words.

1. `packed`: the words of each document and where they lie in the packed words of their source.
2. `targets`: the words that each source shall give, by water-filling under a cap on repeats.
3. `shard_counts`: every output shard draws how many slots each source gets (a multinomial draw);
   draws beyond a source's target go to sources that are short of theirs.
4. `slots`: slot k of a source reads the block that a keyed permutation of the block numbers
   gives for k; all blocks are used once before any is used again.
5. `taken`: blocks and documents are joined by block number; `mixed_documents` cuts the same word
   ranges out of the texts.

Words are `[^\\x20\\x09-\\x0D]+`. Defined results: a null text has no words; null and empty
documents are taken 0 words; a null source is a source of its own, the last in order; rows with
equal ids are mixed each on their own; an empty table gives an empty result; only doc_id, text and
source are read, so any further columns may be there.

Tables with one row per source, or per source and shard, are taken as small; the bounds of the
sources' shares (two numbers per source) pass through the driver.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

BLOCK = 256
SHARD_SLOTS = 4096
SEED = 17
REPEATS = 3
WEIGHTS = (1, 2, 3)
FEISTEL_ROUNDS = 4
CHUNK_ROWS = 2_000
#: Two hashes of a whole row, by which `mixed_documents` finds it again.
ROW = ("_mix_row", "_mix_also")
#: Running sums are cut into stretches of so many numbers.
STRETCH = 1_024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def summed_before(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """`df` with _before: the sum of `value` over the rows of `by` that are earlier in the numbers `order`.

    Stretches of numbers are summed first, so a source with most rows is sorted in many tasks.
    """
    cut = df.withColumn("_stretch", F.expr(f"{order} div {STRETCH}"))
    line = Window.partitionBy(by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(by, "_stretch").agg(F.sum(value).alias("_all"))
    sums = sums.select(by, "_stretch", F.coalesce(F.sum("_all").over(line), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy(by, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, [by, "_stretch"])
    return cut.withColumn("_before", F.col("_earlier") + F.col("_inside")).drop("_stretch", "_earlier", "_inside")


def _named(docs: DataFrame) -> list[str]:
    return [c for c in ROW if c in docs.columns]


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, chunk), staged: documents with sizes, each source cut into hash chunks.

    The columns `ROW` of `docs`, if there, stay.
    """
    sized = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *_named(docs)), "sizes")
    chunks = max(1, math.ceil(sized.count() / CHUNK_ROWS))
    return sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)))


def targets(own: DataFrame) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size).

    A target is min(REPEATS * size, level * weight), where one level for all sources makes the sum
    equal to all words; sharing the excess again and again ends at the same numbers. Sources in
    the order in which they would reach their cap: the first one that does not reach it shows the
    level.
    """
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    own = own.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    own = own.withColumn("_weight", F.element_at(weights, F.col("rank") % len(WEIGHTS) + 1))
    own = own.withColumn("_cap", F.col("source_size") * float(REPEATS))
    order, everything = Window.orderBy(F.col("_cap") / F.col("_weight"), "rank"), Window.partitionBy()
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0))
    sharing = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0))
    own = own.withColumn("_level", left / sharing).withColumn("_at", F.row_number().over(order))
    free = F.when(F.col("_cap") >= F.col("_level") * F.col("_weight"), F.struct("_at", "_level"))
    own = own.withColumn("_level", F.min(free).over(everything)["_level"])
    return own.select("source", "rank", "source_size", F.least("_cap", F.col("_level") * F.col("_weight")).alias("target"))


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index, n, key, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0..n-1 at `index`, or its inverse; element by element.

    Feistel rounds over the smallest even number of bits that holds n, walked on while the value
    is not below n.
    """
    index, n, key = (np.asarray(x).astype(np.uint64) for x in (index, n, key))
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)

    def once(x, half, key):
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        for r in range(FEISTEL_ROUNDS):
            turn = np.uint64(FEISTEL_ROUNDS - r if inverse else r + 1)
            if inverse:
                left, right = right ^ (_mix64(left + key + turn) & mask), left
            else:
                left, right = right, left ^ (_mix64(right + key + turn) & mask)
        return (left << half) | right

    with np.errstate(over="ignore"):
        key = _mix64(key)
        out = once(index, half, key)
        while (far := out >= n).any():
            out[far] = once(out[far], half[far], key[far])
    return out.astype(np.int64)


def _key(rank: pd.Series, epoch: pd.Series, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return rank.to_numpy().astype(np.uint64) * np.uint64(1_000_003) + epoch.to_numpy().astype(np.uint64) + np.uint64(seed)


def quotas(goal: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Add what follows from the targets: blocks, whole epochs, slots.

    A source of n words has ceil(n / block) blocks, the last maybe short. Its target is a number of
    whole epochs and a rest. The rest is read from one more epoch until it is used up, the last
    slot cut; `short_at` is the slot of that epoch where the short block comes.
    """

    @F.pandas_udf("long")
    def short_at(n: pd.Series, rank: pd.Series, epoch: pd.Series) -> pd.Series:
        return pd.Series(permuted(n - 1, n, _key(rank, epoch, seed), inverse=True))

    return (
        goal.filter("source_size > 0")
        .withColumn("n_blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
        .withColumn("epochs", F.expr("floor(target) div source_size"))
        .withColumn("rest", F.expr("floor(target) % source_size"))
        .withColumn("n_slots", F.expr(f"epochs * n_blocks + if(rest = 0, 0, least(n_blocks, rest div {block} + 2))"))
        .withColumn("short_at", short_at("n_blocks", "rank", "epochs"))
    )


def shard_counts(quota: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, rank, first, n): slots first .. first + n - 1 of a source go to the shard.

    Each slot of a shard draws a source by the targets' shares, so the counts of a shard are a
    multinomial draw. Over all shards a source may be drawn too often or too rarely: draws beyond
    its slots are numbered, open slots of other sources likewise, and equal numbers meet.
    """
    spark = quota.sparkSession
    shares = quota.select("rank", "n_slots").orderBy("rank").collect()
    ends = np.cumsum([r.n_slots for r in shares], dtype=np.float64)
    ranks = np.array([r["rank"] for r in shares])
    total = int(ends[-1]) if shares else 0

    def draw(batches):
        for pdf in batches:
            ids = pdf["id"].to_numpy()
            with np.errstate(over="ignore"):
                u = _mix64(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) >> np.uint64(11)
            at = np.searchsorted(ends, u / float(1 << 53) * total, side="right").clip(max=len(ends) - 1)
            out = pd.DataFrame({"shard": ids // shard_slots, "rank": ranks[at]})
            yield out.groupby(["shard", "rank"], as_index=False).size().rename(columns={"size": "n"})

    drawn = spark.range(total).mapInPandas(draw, "shard long, rank int, n long").groupBy("shard", "rank").agg(F.sum("n").alias("n"))
    drawn = stage(drawn, "draws")
    placed = summed_before(drawn, "rank", "shard", "n").withColumnRenamed("_before", "first").join(quota.select("rank", "n_slots"), "rank").withColumn(
        "_kept", F.greatest(F.lit(0), F.least("n", F.col("n_slots") - F.col("first")))
    )

    def numbered(df: DataFrame, order: list[str], *keep: Column) -> DataFrame:
        line = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        until = df.filter("_n > 0").withColumn("_until", F.sum("_n").over(line))
        return until.select(*keep, F.posexplode(F.expr("sequence(_until - _n, _until - 1)")).alias("_k", "_number"))

    over = numbered(
        placed.groupBy("shard").agg(F.sum(F.col("n") - F.col("_kept")).alias("_n")), ["shard"], F.col("shard")
    )
    had = drawn.groupBy("rank").agg(F.sum("n").alias("_had"))
    vacant = quota.join(had, "rank", "left").fillna(0, ["_had"]).withColumn("_n", F.col("n_slots") - F.col("_had"))
    vacant = numbered(vacant, ["rank"], F.col("rank"), F.col("_had"))
    moved = over.select("shard", "_number").join(vacant, "_number").select(
        "shard", "rank", (F.col("_had") + F.col("_k")).alias("first"), F.lit(1).cast("long").alias("n")
    )
    return placed.filter("_kept > 0").select("shard", "rank", "first", F.col("_kept").alias("n")).unionByName(moved)


def slots(quota: DataFrame, counts: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(shard, rank, slot, epoch, block, words): each output slot reads the first `words` words of a block.

    `words` may be 0 in the last slot of a source, where its rest was used up one slot early.
    """

    @F.pandas_udf("long")
    def block_at(index: pd.Series, n: pd.Series, rank: pd.Series, epoch: pd.Series) -> pd.Series:
        return pd.Series(permuted(index, n, _key(rank, epoch, seed)))

    shape = quota.select("rank", "source_size", "n_blocks", "epochs", "rest", "short_at")
    each = counts.join(shape, "rank").select(
        "shard", *shape.columns, F.explode(F.expr("sequence(first, first + n - 1)")).alias("slot")
    )
    each = each.withColumn("_epoch", F.expr("slot div n_blocks")).withColumn("_index", F.expr("slot % n_blocks"))
    each = each.withColumn("block", block_at("_index", "n_blocks", "rank", "_epoch"))
    length = F.expr(f"if(block = n_blocks - 1, source_size - (n_blocks - 1) * {block}, {block}L)")
    gone = F.expr(f"_index * {block} - if(_index > short_at, n_blocks * {block} - source_size, 0)")
    words = F.when(F.col("_epoch") < F.col("epochs"), length).otherwise(
        F.greatest(F.lit(0), F.least(length, F.col("rest") - gone))
    )
    return each.select("shard", "rank", "slot", F.col("_epoch").alias("epoch"), "block", words.cast("long").alias("words"))


def plan(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Placed documents (doc_id, size, start, rank, source_size, target) and the slots of the mix."""
    pack = packed(docs)
    sums = pack.groupBy("source", "chunk").agg(F.sum("size").alias("_sum"))
    goal = stage(targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size"))), "targets")
    sums = sums.withColumnsRenamed({"source": "_s", "chunk": "_c"}).join(goal, F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    sums = summed_before(sums, "rank", "_c", "_sum")
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "size", *_named(pack)).rowsBetween(Window.unboundedPreceding, -1)
    pack = pack.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = pack.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("chunk") == F.col("_c"))).select(
        "doc_id", "size", (F.col("_before") + F.col("_inside")).alias("start"), "rank", "source_size", "target", *_named(pack)
    )
    quota = stage(quotas(goal, block, seed), "quotas")
    return placed, slots(quota, shard_counts(quota, shard_slots, seed), block, seed)


def _met(placed: DataFrame, slot: DataFrame, block: int, how: str) -> DataFrame:
    """Documents that have words, with the slots that read a block they lie in.

    _from and _to are the words of the document, counted in it, that the slot reads.
    """
    pieces = placed.filter("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})"))
    )
    cuts = slot.filter("words > 0").select("rank", "epoch", "block", "words")
    first = F.greatest(F.col("start"), F.col("block") * block) - F.col("start")
    last = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words")) - F.col("start")
    return pieces.join(cuts, ["rank", "block"], how).withColumns({"_from": first, "_to": last})


def taken(placed: DataFrame, slot: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_word): words the mix takes of each document.

    A document meets the slots of every block it lies in; both sides are spread by source and
    block, so a hot source makes many small groups. A block is read by REPEATS slots at most.
    """
    own = ["doc_id", "size", "start", "rank", "source_size", "target"]
    got = F.greatest(F.lit(0), F.col("_to") - F.col("_from"))
    summed = _met(placed, slot, block, "left").groupBy(*own).agg(
        F.coalesce(F.sum(F.when(F.col("words").isNotNull(), got)), F.lit(0)).alias("taken")
    )
    return summed.unionByName(placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))).drop("start", "rank")


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """What the mix takes of each document, one row per row of `docs`."""
    return taken(*plan(docs, block, shard_slots, seed), block)


def word_ranges(text: str, ranges: list[tuple[int, int]]) -> str:
    """The words first .. last - 1 of each range, in order; what two ranges leave out is one line end.

    Inside a range the text stays as it is; ranges that touch are one.
    """
    out, todo, first, end = [], iter(ranges), None, 0
    start, stop = next(todo)
    for k, word in enumerate(re.finditer(r"[^\x20\x09-\x0D]+", text)):
        while k >= stop:
            if (after := next(todo, None)) is None:
                out.append(text[first:end])
                return "\n".join(out)
            if after[0] > stop:
                out.append(text[first:end])
                first = None
            start, stop = after
        if k >= start:
            first, end = word.start() if first is None else first, word.end()
    return "\n".join([*out, text[first:end]])


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The words that the slots of the mix read, as rows of `docs` with the columns of `docs`.

    A document comes once for each epoch of its source in which slots read some of its words: the
    whole row if they read all of it, else with the text of the words they read (and its number of
    characters, where there is a column n_chars). Documents of which nothing is read go, among them
    empty ones. Rows are told apart by all their columns; rows alike in all of them are one row that
    comes as often as all of them do.
    """
    every = [docs[c] for c in docs.columns] + [docs[c].isNull() for c in docs.columns]
    held = docs.select(  # one column, so no column of theirs meets one of ours
        F.struct(*docs.columns).alias("_row"), F.xxhash64(*every).alias(ROW[0]), F.xxhash64(F.lit(seed), *every).alias(ROW[1])
    )
    told = held.select("_row.doc_id", "_row.source", "_row.text", *ROW)
    placed, slot = plan(told, block, seed=seed)
    one = Window.partitionBy(*ROW).orderBy(F.lit(0))
    held = held.withColumn("_alike", F.row_number().over(one)).filter("_alike = 1").drop("_alike")
    read = _met(placed, slot, block, "inner").filter("_to > _from").groupBy(*ROW, "rank", "start", "size", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_to"))).alias("_ranges"), F.sum(F.col("_to") - F.col("_from")).alias("_words")
    )
    read = read.select(*ROW, F.when(F.col("_words") < F.col("size"), F.col("_ranges")).alias("_ranges"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series(
            [None if r is None else word_ranges(t, [(x["_from"], x["_to"]) for x in r]) for t, r in zip(text, ranges, strict=True)],
            dtype=object,
        )

    # whole texts do not pass through Python
    part = F.col("_ranges").isNotNull()
    rows = held.join(read, list(ROW)).withColumn("_cut", cut(F.when(part, F.col("_row")["text"]), F.col("_ranges")))
    columns = {c: F.col("_row")[c].alias(c) for c in docs.columns}
    columns["text"] = F.when(part, F.col("_cut")).otherwise(F.col("_row")["text"]).alias("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(part, F.length("_cut").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("_row")["n_chars"]
        ).alias("n_chars")
    return rows.select(*columns.values())
