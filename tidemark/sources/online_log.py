"""The online table as a log of small writes, merged when it is read.

Rows lie in buckets by a hash of their entity. A write adds one folder with the buckets it touches and
nothing else; a delete adds tombstones. The manifest, a small file per write, names the folders that
count for each bucket, oldest first. Reading takes the newest manifest and merges buckets that have
several folders: per key the newest event time wins, then the newest write, among rows written after
the entity's last tombstone. A bucket with more than `FOLDERS` folders is written anew as one.

A write is visible when its manifest is renamed into place, which happens as a whole; of two writers that
start from one manifest the first wins and the other gets an error, with nothing of it visible. A
writer that repeats a numbered batch finds its number in the manifest and writes nothing. The last
`KEEP` manifests and their folders stay, for readers that started from them; older ones are dropped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.operators.online import ONLINE_COLUMNS, newest
from tidemark.schemas import ONLINE_FEATURES
from tidemark.sources.tables import delete_path, list_names, read_text, rename_new, write_text

BUCKETS = 64
FOLDERS = 8
KEEP = 3
ROWS = f"{ONLINE_FEATURES}, deleted boolean, commit string, bucket int"


def _manifest_path(root: str, number: int) -> str:
    return f"{root}/_manifest/{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in list_names(spark, f"{root}/_manifest") if n.endswith(".json"))


def manifest(spark: SparkSession, root: str) -> dict:
    """The newest manifest: its number, the folders of each bucket, folders with tombstones, batch numbers by source."""
    numbers = _numbers(spark, root)
    if not numbers:
        return {"number": -1, "buckets": BUCKETS, "live": {}, "tombstones": [], "batches": {}}
    return json.loads(read_text(spark, _manifest_path(root, numbers[-1])))


def _scan(spark: SparkSession, root: str, live: dict[str, list[str]]) -> DataFrame:
    paths = [f"{root}/data/commit={folder}/bucket={bucket}" for bucket, folders in live.items() for folder in folders]
    return spark.read.schema(ROWS).option("basePath", f"{root}/data").parquet(*paths)


def _merged(rows: DataFrame, tombstones: bool) -> DataFrame:
    if tombstones:
        gone = F.max(F.when(F.col("deleted"), F.col("commit"))).over(Window.partitionBy("entity_id"))
        rows = rows.withColumn("_gone", gone).where(~F.col("deleted") & (F.col("_gone").isNull() | (F.col("commit") > F.col("_gone"))))
    return newest(rows.select(*ONLINE_COLUMNS, "bucket"))


def _read(spark: SparkSession, root: str, state: dict) -> DataFrame:
    """Rows of the table with their bucket; buckets with one folder are scanned as they are."""
    dead = set(state["tombstones"])
    single = {b: f for b, f in state["live"].items() if len(f) == 1 and f[0] not in dead}
    several = {b: f for b, f in state["live"].items() if b not in single}
    parts = []
    if single:
        parts.append(_scan(spark, root, single).select(*ONLINE_COLUMNS, "bucket"))
    if several:
        parts.append(_merged(_scan(spark, root, several), any(f in dead for folders in several.values() for f in folders)))
    if not parts:
        return spark.createDataFrame([], f"{ONLINE_FEATURES}, bucket int").select(*ONLINE_COLUMNS, "bucket")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_online(spark: SparkSession, root: str) -> DataFrame:
    """The table as the newest manifest has it; a missing table reads as empty, so that lookups degrade to misses."""
    return _read(spark, root, manifest(spark, root)).select(*ONLINE_COLUMNS)


def _write_folder(rows: DataFrame, root: str, folder: str) -> list[str]:
    """Write rows (with their bucket) as one folder; gives the buckets it has."""
    path = f"{root}/data/commit={folder}"
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    return [n.split("=")[1] for n in list_names(rows.sparkSession, path) if n.startswith("bucket=")]


def _commit(spark: SparkSession, root: str, rows: DataFrame, tombstones: bool, batch: tuple[str, int] | None, folders: int) -> int:
    state = manifest(spark, root)
    if batch and state["batches"].get(batch[0], -1) >= batch[1]:
        return state["number"]
    number = state["number"] + 1
    folder = f"{number:012d}-{uuid.uuid4().hex[:8]}"
    bucket = F.pmod(F.xxhash64("entity_id"), F.lit(state["buckets"])).cast("int")
    for name in _write_folder(rows.withColumn("bucket", bucket), root, folder):
        state["live"].setdefault(name, []).append(folder)
    state["tombstones"] += [folder] * tombstones
    state["batches"] |= dict([batch]) if batch else {}

    full = {b: f for b, f in state["live"].items() if len(f) > folders}
    if full:
        whole = _merged(_scan(spark, root, full), any(f in state["tombstones"] for held in full.values() for f in held))
        compacted = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        kept = _write_folder(whole.withColumn("deleted", F.lit(False)), root, compacted)
        for name in full:
            state["live"][name] = [compacted]
            if name not in kept:  # every entity of the bucket was deleted
                del state["live"][name]
    used = {f for held in state["live"].values() for f in held}
    state["tombstones"] = [f for f in state["tombstones"] if f in used]
    state["number"] = number
    draft = f"{root}/_manifest/.{folder}"
    write_text(spark, draft, json.dumps(state))
    rename_new(spark, draft, _manifest_path(root, number))
    _drop_old(spark, root)
    return number


def _drop_old(spark: SparkSession, root: str) -> None:
    """Drop manifests before the last `KEEP`, and the buckets that none of those names."""
    numbers = _numbers(spark, root)
    kept = numbers[-KEEP:]
    used = {
        (folder, bucket) for n in kept for bucket, folders in json.loads(read_text(spark, _manifest_path(root, n)))["live"].items() for folder in folders
    }
    for n in numbers[:-KEEP]:
        delete_path(spark, _manifest_path(root, n))
    for name in list_names(spark, f"{root}/data"):
        folder = name.removeprefix("commit=")
        if int(folder.split("-")[0]) > kept[0]:  # may belong to a write under way
            continue
        buckets = [b.removeprefix("bucket=") for b in list_names(spark, f"{root}/data/{name}") if b.startswith("bucket=")]
        held = [b for b in buckets if (folder, b) in used]
        for b in set(buckets) - set(held) if held else ():
            delete_path(spark, f"{root}/data/{name}/bucket={b}")
        if not held:
            delete_path(spark, f"{root}/data/{name}")


def write_online(
    spark: SparkSession, root: str, rows: DataFrame, unique: bool = False, batch: tuple[str, int] | None = None, folders: int = FOLDERS
) -> int:
    """Merge rows into the table; gives the number of the write.

    `unique` says that no key comes twice. `batch` is a source and a number that grows: writing a batch
    again changes nothing. Errors are raised: a run that stores nothing must not look like a success.
    """
    rows = rows.select(*ONLINE_COLUMNS)
    rows = (rows if unique else newest(rows)).withColumn("deleted", F.lit(False))
    return _commit(spark, root, rows, False, batch, folders)


def delete_online(spark: SparkSession, root: str, ids: DataFrame, folders: int = FOLDERS) -> int:
    """Delete the entities of a one-column frame of ids, in every version; later writes may bring them back."""
    gone = ids.select(F.col(ids.columns[0]).cast("long").alias("entity_id")).where("entity_id IS NOT NULL").distinct()
    empty = spark.createDataFrame([], ONLINE_FEATURES).select(*ONLINE_COLUMNS).where("false")
    rows = empty.unionByName(gone, allowMissingColumns=True).withColumn("deleted", F.lit(True))
    return _commit(spark, root, rows, True, None, folders)
