"""Stored tables as Parquet folders: scans that may find nothing yet, appends and replacements."""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import moment, snapshot_id, snapshot_name
from tidemark.schemas import FEATURE_HISTORY, FEATURES, HISTORY_KEY, TABLES, VERSION

HISTORY_FOLDERS = ["feature_version", "snapshot_id"]
# How long a writer waits for another one that adds to the same snapshot.
LOCK_TRIES, LOCK_WAIT = 120, 5.0


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at `path`, or an empty one with its schema when nothing was written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read(spark, f"{root}/{name}", TABLES[name])


def raw_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(read_table(spark, root, n) for n in ("raw_users", "raw_transactions", "raw_support_tickets"))


def load_raw(root: str, **frames: DataFrame) -> DataFrame:
    """Replace raw tables by the given frames and return the row count of each."""
    counts = None
    for name, frame in frames.items():
        path = f"{root}/{name}"
        frame.write.mode("overwrite").parquet(path)
        stored = read(frame.sparkSession, path, frame.schema)
        one = stored.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def scan_history(
    history: DataFrame, version: str = VERSION, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """History of a version between two times, both included.

    Where the history has its snapshot folders as a column, their names prune the scan.
    """
    found = history.where(F.col("feature_version") == version)
    in_folders = "snapshot_id" in history.columns
    if since is not None:
        found = found.where(F.col("event_time") >= moment(since))
        if in_folders:
            found = found.where(F.col("snapshot_id") >= snapshot_name(since))
    if until is not None:
        found = found.where(F.col("event_time") <= moment(until))
        if in_folders:
            found = found.where(F.col("snapshot_id") <= snapshot_name(until))
    return found


def only_latest_snapshots(history: DataFrame, as_of: datetime, version: str = VERSION) -> DataFrame:
    """Stored history without the snapshots that are nobody's newest one at `as_of`.

    Finding them reads two columns. The names of the folders that count, one row each, then prune
    the scan of the wide rows while it runs.
    """
    known = scan_history(history, version, until=as_of)
    newest = known.groupBy("entity_id").agg(F.max("event_time").alias("event_time"))
    folders = newest.select(snapshot_id("event_time").alias("snapshot_id")).distinct()
    kept = scan_history(history, version, until=as_of).join(F.broadcast(folders), "snapshot_id", "left_semi")
    return kept.select(*history.columns)


def append_history(
    path: str,
    features: DataFrame,
    computed_at: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    unique: bool = False,
) -> None:
    """Append rows whose key is not stored yet: the first write of a key stays, also of two at a time.

    `since` and `until` bound the snapshots in `features`; only stored folders between them are
    read for the comparison, which is left out when there are none. `unique` says that no key
    occurs twice in `features`, and saves the shuffle that chooses the copy with the largest values.
    Rows are gathered by folder before the write, and Spark splits large folders into several files.

    Rows are written to a folder of the run, which readers do not see, and each snapshot's folder is
    then renamed into place, as a whole. Where another writer, or an earlier run, has the snapshot
    already, the rows it lacks are found anew while a lock on the snapshot keeps others from adding to it.
    """
    spark = features.sparkSession
    if not unique:
        rest = [c for c in features.columns if c not in HISTORY_KEY]
        newest = features.groupBy(*HISTORY_KEY).agg(F.max(F.struct(*rest)).alias("_row"))
        features = newest.select(*HISTORY_KEY, "_row.*")
    fresh = features.withColumns({"computed_at": moment(computed_at), "snapshot_id": snapshot_id("event_time")})
    stored = read(spark, path, FEATURE_HISTORY)
    if since is not None:
        stored = stored.where(F.col("snapshot_id") >= snapshot_name(since))
    if until is not None:
        stored = stored.where(F.col("snapshot_id") <= snapshot_name(until))
    if not stored.isEmpty():
        fresh = fresh.join(stored.select(*HISTORY_KEY), HISTORY_KEY, "left_anti")
    run = f"{path}/_runs/{uuid.uuid4().hex}"
    try:
        _write_snapshots(fresh, run)
        late = [folder for folder in _snapshot_folders(spark, run) if not _moved(spark, f"{run}/{folder}", f"{path}/{folder}")]
        for folder in late:
            _add_to_snapshot(spark, path, run, folder)
    finally:
        delete_path(spark, run)


def _write_snapshots(rows: DataFrame, path: str) -> None:
    columns = ["entity_id", "entity_type", "event_time", *FEATURES, "computed_at", *HISTORY_FOLDERS]
    rows.select(*columns).hint("rebalance", *HISTORY_FOLDERS).write.partitionBy(*HISTORY_FOLDERS).parquet(path)


def _snapshot_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of single snapshots below `path`, as version/snapshot."""
    versions = [n for n in list_names(spark, path) if n.startswith("feature_version=")]
    return sorted(f"{v}/{s}" for v in versions for s in list_names(spark, f"{path}/{v}") if s.startswith("snapshot_id="))


def _moved(spark: SparkSession, source: str, target: str) -> bool:
    """Rename `source` to `target` unless there is one already; whether it was done."""
    make_folder(spark, target.rsplit("/", 1)[0])
    try:
        rename_new(spark, source, target)
    except Exception:
        if not exists(spark, target):
            raise
        return False
    return True


def _add_to_snapshot(spark: SparkSession, path: str, run: str, folder: str) -> None:
    """Add the rows of a run to a snapshot that is stored already, those with keys that it lacks."""
    lock = f"{path}/_locks/{folder.replace('/', '-')}"
    draft = f"{run}/_lock"
    write_text(spark, draft, run)
    for _ in range(LOCK_TRIES):
        if _moved(spark, draft, lock):
            break
        time.sleep(LOCK_WAIT)
    else:
        raise RuntimeError(f"another writer holds {lock}; remove it if that writer is gone")
    try:
        mine = spark.read.schema(FEATURE_HISTORY).option("basePath", run).parquet(f"{run}/{folder}")
        stored = spark.read.schema(FEATURE_HISTORY).option("basePath", path).parquet(f"{path}/{folder}")
        added = f"{run}/_added"
        _write_snapshots(mine.join(stored.select(*HISTORY_KEY), HISTORY_KEY, "left_anti"), added)
        for name in list_names(spark, f"{added}/{folder}"):
            if name.endswith(".parquet"):
                rename_new(spark, f"{added}/{folder}/{name}", f"{path}/{folder}/{name}")
        delete_path(spark, added)
    finally:
        delete_path(spark, lock)


def snapshot_row_count(history: DataFrame, snapshot: datetime, version: str = VERSION) -> DataFrame:
    return scan_history(history, version, snapshot, snapshot).agg(F.count(F.lit(1)).alias("n_rows"))


def replace_version(path: str, rows: DataFrame) -> None:
    """Replace the rows of the versions at hand and leave other versions alone."""
    (
        rows.repartition("feature_version")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("feature_version")
        .parquet(path)
    )


def append(path: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none if there is no folder."""
    hadoop_path, fs = _filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _filesystem(spark, path)
    fs.mkdirs(hadoop_path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text, from any store that Spark reaches."""
    hadoop_path, fs = _filesystem(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    hadoop_path, fs = _filesystem(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that nothing has yet; raises if another writer took it first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(hadoop.Path(target).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    context.rename(hadoop.Path(source), hadoop.Path(target), none)
