"""Pack documents into sequences of a fixed number of tokens.

How a document is packed depends on its length alone, and there are no more lengths than a sequence
has tokens. So the corpus shrinks to a table of lengths and their counts, as long as `capacity` at
most, and the packing is worked out on that table, for all pieces of one length at a time:

1. Martello-Toth reduction. For a length w, some sets of at most three pieces that hold one of w
   dominate every other set that holds it: whatever else shares a sequence with it could give its
   place to the set's members without loss. Such sets are fixed for good, as often as their pieces
   last; that leaves a smaller instance with the same optimum beside them. Passes over all lengths
   go on until none fixes anything.
2. Best fit, longest first, for the rest: a piece goes where the least room is left that holds it.

Both give patterns (lengths and how often a sequence holds each) with a number of sequences. Pieces
of one length are numbered over the whole corpus, by the tasks that encoded them and inside each,
and a piece's number finds its pattern, sequence and offset by bisection.

Defined results: a null text holds the end id only; a document longer than a sequence is cut into
full pieces, of which the last may be shorter; repeated rows and null ids are documents of their own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import struct
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.tokenizing import UNITS, WORDS, PieceTable, byte_signs, load, once, signs_and_letters
from tidemark.session import stage

CAPACITY = 4096
DTYPE = "<u4"
PIECES = "part long, doc_id long, piece int, start long, length int, number long, ids binary"


class WordEncoder:
    """Ids, as bytes, for a tokenizer that drops white space before it looks for tokens.

    Words between spaces and line ends are encoded on their own: no token and no special string
    holds one. Most words are letters with signs around them; letters and signs are units of their own,
    so the library's model gets the letters without its splitting. Words, letters and kinds of signs are
    remembered, up to bounds that change speed only.
    """

    def __init__(self, path: str):
        tokenizer = load(path)
        encode, of_model, signs = tokenizer.encode, tokenizer.model.tokenize, byte_signs()
        whole = lambda word: np.array(encode(word, add_special_tokens=False).ids, DTYPE).tobytes()
        around = PieceTable(whole)

        def unit(letters: str) -> bytes:
            ids = [t.id for t in of_model(letters if letters.isascii() else letters.encode().decode("latin-1").translate(signs))]
            return struct.pack(f"<{len(ids)}I", *ids)

        units = PieceTable(unit, UNITS)

        plain = all(
            around[a] + units[w.lower()] + around[b] == whole(a + w + b) for w in ("The", "Élève", "ŵordLess") for a in ("", "(", "**") for b in ("", ".", ",***")
        )

        def value(word: str) -> bytes:
            if plain and (parts := signs_and_letters(word)):
                before, letters, after = parts
                return around[before] + units[letters.lower()] + around[after]
            return whole(word)

        self.table = PieceTable(value, WORDS)

    def __call__(self, text: str | None) -> bytes:
        return b"".join(map(self.table.__getitem__, (text or "").replace("\n", " ").split(" ")))


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: (part, doc_id, piece, start, length, number, ids).

    `number` counts the pieces of one length inside one task, `part`; write the result before use.
    """
    ship(docs.sparkSession)
    names = [f.split()[0] for f in PIECES.split(", ")]

    def cut(batches):
        encoder = once(("words", tokenizer), lambda: WordEncoder(tokenizer))
        width, end = np.dtype(DTYPE).itemsize, np.array([end_id], DTYPE).tobytes()
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder(text) + end
                for piece, at in enumerate(range(0, len(ids), capacity * width)):
                    held = ids[at : at + capacity * width]
                    length = len(held) // width
                    rows.append((part, doc_id, piece, at // width, length, seen[length], held))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


@dataclass
class Instance:
    """How many pieces of each length are left, and the patterns found so far."""

    counts: np.ndarray
    capacity: int
    patterns: list[tuple[tuple[tuple[int, int], ...], int]] = field(default_factory=list)

    def at_most(self) -> np.ndarray:
        """For each length, the longest one present that does not exceed it; 0 if there is none."""
        lengths = np.arange(len(self.counts))
        return np.maximum.accumulate(np.where(self.counts > 0, lengths, 0))

    def smallest(self, n: int) -> list[int]:
        """The n smallest pieces; an absent one counts as longer than a sequence."""
        out: list[int] = []
        for length in np.flatnonzero(self.counts)[:n]:
            out += [int(length)] * int(min(self.counts[length], n - len(out)))
            if len(out) == n:
                return out
        return out + [self.capacity + 1] * (n - len(out))

    def dominating_set(self, w: int) -> tuple[int, ...] | None:
        """A set that holds one piece of length w and dominates every other such set, if one is known.

        With `best` the longest other piece that fits beside w:
        w alone, if nothing fits; w and best, if best fills the sequence, if no two pieces fit beside
        w, or if two that fit are never longer together than best; w, best and the longest piece that
        still fits, if no three fit beside w and no pair that fits has a longer second piece.
        """
        room = self.capacity - w
        self.counts[w] -= 1
        try:
            least = self.smallest(3)
            if least[0] > room:
                return (w,)
            below = self.at_most()
            best = int(below[room])
            if best == room or least[0] + least[1] > room:
                return (w, best)
            if sum(least) <= room:
                return None
            second = np.flatnonzero(self.counts[: room // 2 + 1])
            first = below[room - second]
            paired = (first > second) | (self.counts[second] > 1)
            second, first = second[paired], first[paired]
            if best >= int((first + second).max()):
                return (w, best)
            self.counts[best] -= 1
            third = int(self.at_most()[room - best])
            self.counts[best] += 1
            return (w, best, third) if third and third >= int(second.max()) else None
        finally:
            self.counts[w] += 1

    def reduce(self) -> None:
        """Fix dominating sets until a pass finds none; each is taken as often as its pieces last."""
        changed = True
        while changed:
            changed = False
            for w in range(self.capacity, 0, -1):
                while self.counts[w] and (members := self.dominating_set(w)):
                    held = tuple(Counter(members).items())
                    times = min(int(self.counts[length]) // k for length, k in held)
                    for length, k in held:
                        self.counts[length] -= k * times
                    self.patterns.append((held, times))
                    changed = True

    def best_fit(self) -> None:
        """Best fit, longest first; sequences with equal room and contents are handled together."""
        room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
        present = np.zeros(self.capacity + 1, bool)  # rooms that some open sequence has

        def put(left: int, held: tuple, times: int) -> None:
            room.setdefault(left, []).append((held, times))
            present[left] = True

        for w in map(int, np.flatnonzero(self.counts)[::-1]):
            n = int(self.counts[w])
            while n:
                fits = np.flatnonzero(present[w:])
                if not len(fits):
                    break
                left = w + int(fits[0])
                held, times = room[left].pop()
                if not room[left]:
                    present[left] = False
                each = left // w
                full = min(times, n // each)
                if full:
                    put(left - each * w, (*held, (w, each)), full)
                    n, times = n - full * each, times - full
                if times and n < each:
                    if n:
                        put(left - n * w, (*held, (w, n)), 1)
                        times, n = times - 1, 0
                    if times:
                        put(left, held, times)
            if n:
                each = self.capacity // w
                if n // each:
                    put(self.capacity - each * w, ((w, each),), n // each)
                if n % each:
                    put(self.capacity - (n % each) * w, ((w, n % each),), 1)
            self.counts[w] = 0
        self.patterns += [(held, times) for group in room.values() for held, times in group]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, how often), ...) with their numbers of sequences, for pieces of given lengths."""
    start = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        start[length] = n
    instance = Instance(start, capacity)
    instance.reduce()
    instance.best_fit()
    return instance.patterns


@dataclass
class Plan:
    """Where the pieces of each length go, as runs of pieces sorted by (length, first number)."""

    keys: np.ndarray
    first: np.ndarray
    base: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    SPAN = 1 << 48

    @classmethod
    def of(cls, patterns: list) -> Plan:
        rows, sequence, used = [], 0, Counter()
        for held, times in patterns:
            at = 0
            for length, each in held:
                rows.append((length * cls.SPAN + used[length], used[length], sequence, each, at))
                used[length] += each * times
                at += each * length
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        return cls(*(np.ascontiguousarray(c) for c in table.T))

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.keys, length.astype(np.int64) * self.SPAN + number, "right") - 1
        after = number - self.first[run]
        return self.base[run] + after // self.each[run], self.offset[run] + after % self.each[run] * length


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces`, a written table with part, length and number, with sequence_id and offset.

    All its other columns stay. The driver sees one count for each length; the plan that tasks get
    is bounded by the lengths too, whatever the corpus holds.
    """
    ship(pieces.sparkSession)
    seen = stage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in seen.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan.of(solve(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = seen.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    rest = [c for c in pieces.columns if c not in ("part", "number")]
    # hinted, as both sides grow with the corpus and neither may be broadcast
    known = pieces.join(before.hint("merge"), ["part", "length"]).select(*rest, (F.col("_before") + F.col("number")).alias("_number"))
    names = [*rest, "sequence_id", "offset"]
    at = rest.index("length")

    def put(batches):
        for batch in batches:
            length, number = (np.asarray(batch.column(k)) for k in (at, len(rest)))
            sequence, offset = plan(length, number)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in rest)
    return known.mapInArrow(put, f"{kinds}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): all pieces with their ids and places."""
    return place(stage(cut_documents(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets) of packed pieces; a group is one sequence."""
    order = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return pieces.groupBy("sequence_id").agg(order.alias("_p")).select(
        "sequence_id", F.expr("aggregate(_p, cast('' as binary), (s, p) -> concat(s, p.ids))").alias("ids"),
        F.col("_p.doc_id").alias("doc_ids"), F.col("_p.offset").alias("offsets"),
    )


def digests(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): `packed` without shuffling ids."""
    pieces = stage(cut_documents(docs, tokenizer, end_id, capacity), "pieces")
    return place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)
