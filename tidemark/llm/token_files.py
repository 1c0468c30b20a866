"""Token ids in files: frequency-ranked ids, variable-length bytes, separate control bytes.

Format: Parquet rows in ascending order of doc_id, one row per document, in files that hold ranges
of documents. Ids are replaced by their rank by frequency over the whole corpus (equal frequencies
by id), so frequent ids take one byte. `control` has two bits for each id, its number of bytes less
one, four ids to a byte from the low bits up; `data` has the bytes of the ranks, low byte first.
`part` and `offset` tell the place of a row: the ids before it inside its part. The ranking, one row
per vocabulary id, lies beside the rows.

Defined results: a null text holds only the end id; rows with equal doc_id come in the order of a hash
of their token ids, copies side by side; null ids come first; an empty table gives empty files; other
columns are not read; a vocabulary whose ids need more than 16 bits is refused with an error.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.tokenizing import ByteLevelEncoder, once
from tidemark.session import new_path

#: Bytes of text that are encoded together.
SLICE_BYTES = 1 << 23
#: Lengths of the four ranks of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(ranks: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of ranks below 2**32, and where those of each document end in both.

    `n` is the number of ranks of each document, one document by default; each begins a control byte of its own.
    """
    n = np.array([len(ranks)]) if n is None else n
    size = 1 + (ranks > 0xFF).astype(np.int64) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    control_ends = np.cumsum((n + 3) // 4)
    # a rank's place among the padded codes: its own place plus the padding of the documents before
    padding = 4 * (control_ends - (n + 3) // 4) - (np.cumsum(n) - n)
    codes = np.zeros(4 * int(control_ends[-1]) if len(n) else 0, np.uint8)
    codes[np.arange(len(ranks)) + np.repeat(padding, n)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    ends = np.cumsum(size)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - size
    data[starts] = ranks & 0xFF
    for k in range(1, int(size.max(initial=1))):
        longer = np.flatnonzero(size > k)
        data[starts[longer] + k] = ranks[longer] >> 8 * k & 0xFF
    data_ends = np.concatenate([[0], ends])[np.cumsum(n)]
    return control, data, control_ends, data_ends


def unpack(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ranks of documents of n ranks each: control bytes give lengths by table, lengths give places, places give bytes."""
    size = LENGTHS[control].reshape(-1)
    if len(n) > 1 or len(size) != int(n.sum()):  # codes that fill up a document's last control byte stand for nothing
        padded = (n + 3) // 4 * 4
        first = np.cumsum(padded) - padded
        size = size[np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)]
    starts = np.cumsum(size) - size
    ranks = data[starts].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        longer = np.flatnonzero(size > k)
        ranks[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def _bytes_of(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column without nulls, one value after another."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _slices(batches, rows: int = 1000):
    return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


def _sized(batches, size: int = SLICE_BYTES):
    """Slices of whole texts, `size` bytes and one text long at most."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, ids) of every document as the scan meets it, and a row (counts) for every task."""
    ship(docs.sparkSession)

    def encode(batches):
        encoder = once(("bytes", tokenizer), lambda: ByteLevelEncoder(tokenizer))
        end = np.array([end_id], encoder.dtype).tobytes()
        counts = np.zeros(1 << 16, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
        for batch in _sized(batches):
            ids = encoder(batch.column(1), end)
            counts += np.bincount(_bytes_of(ids).view(encoder.dtype), minlength=1 << 16)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.nulls(len(ids), pa.binary())], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids binary, counts binary")


def ranking(staged: DataFrame) -> DataFrame:
    """(id, n, rank): every id that occurs, the most frequent first. It is as long as the vocabulary at most."""

    def spread(batches):
        for batch in batches:
            for one in batch.column(0).to_pylist():
                n = np.frombuffer(one, np.int64)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["id", "n"])

    counts = staged.filter("counts IS NOT NULL").select("counts").mapInArrow(spread, "id long, n long")
    summed = counts.groupBy("id").agg(F.sum("n").alias("n"))
    return summed.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)


def write_files(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Encode, rank and write; `path` gets the folders `tokens` and `ranking`."""
    spark = docs.sparkSession
    work = new_path(spark, "ids")
    encoded(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(work)
    staged = spark.read.schema("doc_id long, ids binary, counts binary").parquet(work)
    ranking(staged).write.parquet(f"{path}/ranking")
    rank_of = np.zeros(1 << 16, np.uint32)
    for row in spark.read.parquet(f"{path}/ranking").collect():
        rank_of[row.id] = row["rank"]

    def to_bytes(batches):
        part, offset = TaskContext.get().partitionId(), 0
        for batch in _slices(batches):
            ids = _bytes_of(batch.column(1)).view(ByteLevelEncoder.dtype)
            n = np.asarray(pc.binary_length(batch.column(1)), np.int64) // ids.itemsize
            control, data, control_ends, data_ends = pack(rank_of[ids], n)
            starts = offset + np.cumsum(n) - n
            offset += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n.astype(np.int32)),
                 _binary(control, control_ends), _binary(data, data_ends)],
                ["doc_id", "part", "offset", "n_tokens", "control", "data"],
            )

    # the only shuffle: ids, dealt by ranges; a hash and the row's place part rows of one id, copies too
    order = ["doc_id", "_hash", "_row"]
    ordered = staged.filter("ids IS NOT NULL").select(
        "doc_id", "ids", F.xxhash64("ids").alias("_hash"), F.monotonically_increasing_id().alias("_row")
    )
    parts = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    parts.mapInArrow(to_bytes, "doc_id long, part int, offset long, n_tokens int, control binary, data binary").write.parquet(f"{path}/tokens")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from written files."""
    tokens = spark.read.parquet(f"{path}/tokens")
    ids_of = np.zeros(1 << 16, np.uint32)
    for row in spark.read.parquet(f"{path}/ranking").collect():
        ids_of[row["rank"]] = row.id

    def check(batches):
        for batch in _slices(batches):
            n = np.asarray(batch.column(3), np.int64)
            ids = ids_of[unpack(_bytes_of(batch.column(4)), _bytes_of(batch.column(5)), n)].astype("<u4")
            ends = np.cumsum(n)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crcs, pa.int64())], ["doc_id", "part", "offset", "n_tokens", "ids_crc32"])

    parts = tokens.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return tokens.mapInArrow(check, "doc_id long, part int, offset long, n_tokens int, ids_crc32 long").join(parts, "part").select(
        "doc_id", (F.col("_before") + F.col("offset")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32"
    )
