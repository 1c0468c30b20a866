"""Token alignment between a byte-level tokenizer (A) and a sentence-piece model (B).

The tokens of both cover the same bytes, a space and the text. Offsets where tokens of both end cut
them into groups, and every A token of a group is linked with every B token of it. Most groups hold
one token of each; their bytes are equal, so an array from each A id to the B id with the same bytes,
made once, names the pair by the A id alone. Such pairs are counted in vectors as long as A's
vocabulary, one for each task. Only pairs of irregular groups become rows that are shuffled.

A pair's count is the number of documents that link it. To look counts up, documents are taken in
blocks of about `BLOCK_CHARS` characters, as a task meets them: a block sends each irregular pair once,
with its number of documents, and gets its total back once, however many links it has. So a pair that
all documents share comes once for each block, and a block's size bounds what a task holds.

Texts are cut at single spaces and line ends between other signs, where neither tokenizer has a token
across; what such a stretch gives is remembered by its worker up to a bound; letters and the signs around them are aligned apart.

Defined results: texts that are null or empty, or whose tokens of either side do not spell the space and
the text (those with a space mark of B inside) have no tokens; special strings are plain text; repeated
rows are documents of their own; an empty table gives an empty result; other columns are not read
unless `extra` names them.
"""

from __future__ import annotations

import struct
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship
from tidemark.llm.sentence_pieces import MARK
from tidemark.llm.tokenizing import _LETTERS, _LONE, _WHITE, byte_signs, once, signs_and_letters
from tidemark.llm.tokenizing import _SIGNS as SIGNS
from tidemark.session import stage

STRETCHES, PARTS = 200_000, 120_000
BLOCK_CHARS = 3_000_000
_CODE = 16  # bits of a B id in the code of a pair
ROWS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, ones binary, odds binary, "
    "pairs binary, vector binary"
)
_OTHER_WHITE = frozenset(c for c in map(chr, range(0x3001)) if _WHITE.match(c)) - set(" \n")
_LINKS = np.dtype([("code", "<u4"), ("n", "<u4")])


def is_letter(sign: str) -> bool:
    return _LETTERS.fullmatch(sign) is not None


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the B id that spells the same bytes as each A id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        if max(self.a.get_vocab_size(), self.b.get_piece_size()) > 1 << _CODE:
            raise ValueError(f"ids of these vocabularies need more than {_CODE} bits")
        byte_of = {s: b for b, s in byte_signs().items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(map(byte_of.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        if any(MARK in p.lstrip(MARK) or "\n" in p for i, p in enumerate(pieces) if self.b_bytes[i] and not self.b.is_byte(i)):
            raise ValueError("a piece holds a space mark after its start, or a line end")
        signs = byte_signs()
        of_model = self.a.model.tokenize
        self._letters = lambda part: [t.id for t in of_model(part.encode().decode("latin-1").translate(signs))]
        self._apart = all(  # letters are a unit of their own for A, and no piece of B holds letters and signs
            self._letters(" " + w) + self._letters(w) == self.a.encode(f" {w}", add_special_tokens=False).ids + self.a.encode(w, add_special_tokens=False).ids
            for w in ("The", "élève", "ŵordless")
        ) and not any(
            is_letter(x) and y in SIGNS or x in SIGNS and is_letter(y)
            for i, p in enumerate(pieces) if self.b_bytes[i] and not self.b.is_byte(i) for x, y in zip(p, p[1:], strict=False)
        )

    def same_bytes(self) -> np.ndarray:
        """For each A id the B id with the same bytes, -1 if there is none. Where a byte has a token
        beside its piece, this is the piece; pairs with the other one count as irregular."""
        ids = sorted(range(len(self.b_bytes)), key=lambda i: (not self.b.is_byte(i), -i))
        of = {self.b_bytes[i]: i for i in ids}
        return np.array([of.get(token, -1) if token else -1 for token in self.a_bytes], np.int64)

    def parts(self, stretch: str) -> list[str]:
        """A stretch cut between its letters and the signs around them, where neither side has a token across."""
        held = signs_and_letters(stretch[1:]) if self._apart else None
        if held is None:
            return [stretch]
        lead, (before, letters, after) = stretch[0], held
        if before or lead == "\n":
            return [p for p in (lead + before, letters, after) if p]
        return [lead + letters, after] if after else [lead + letters]

    def encode(self, parts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for parts as they stand inside a text."""
        plain = [self._apart and _LETTERS.fullmatch(p, 1 if p[0] == " " else 0) is not None for p in parts]
        others = iter(self.a.encode_batch([p for p, k in zip(parts, plain, strict=True) if not k], add_special_tokens=False))
        a = [self._letters(p) if k else next(others).ids for p, k in zip(parts, plain, strict=True)]
        # B adds a space: one that the part has already; before a line end it is a token of its own
        b = self.b.encode([p[1:] if p[0] == " " else p if p[0] == "\n" else "\n" + p for p in parts], num_threads=1)
        return [(x, y if p[0] == " " else y[1:] if p[0] == "\n" else y[2:]) for p, x, y in zip(parts, a, b, strict=True)]


class Known:
    """What parts and stretches give; parts are remembered up to `PARTS`, stretches have numbers as they come.

    A stretch gives the text of its groups, the codes of its links that the array of same bytes names, those
    of the others, and its sizes: A tokens, B tokens, groups, links, whether the tokens spell it.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers, self.same = tokenizers, tokenizers.same_bytes().tolist()
        self.a_size, self.b_size = ([len(x) for x in of] for of in (tokenizers.a_bytes, tokenizers.b_bytes))
        self.a_text, self.b_text = ([str(i) for i in range(len(of))] for of in (tokenizers.a_bytes, tokenizers.b_bytes))
        self.of_part: dict[str, tuple[str, bytes, bytes, tuple]] = {}
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.ones: list[bytes] = []
        self.odds: list[bytes] = []
        self.sizes: list[tuple[int, int, int, int, int]] = []

    def forget(self, limit: int) -> None:
        """Let go of the stretches that came after the first `limit`: the frequent ones come early."""
        for piece in list(islice(reversed(self.number), max(0, len(self.number) - limit))):
            del self.number[piece]
        for held in (self.groups, self.ones, self.odds, self.sizes):
            del held[limit:]

    def _aligned(self, a: list[int], b: list[int]) -> tuple[str, bytes, bytes, tuple]:
        """Groups of two tokenizations that spell the same bytes."""
        a_size, b_size, a_text, b_text, same = self.a_size, self.b_size, self.a_text, self.b_text, self.same
        texts, ones, odds = [], [], []
        i = j = end_a = end_b = 0
        n_a = len(a)
        while i < n_a:
            from_a, from_b = i, j
            end_a += a_size[a[i]]
            end_b += b_size[b[j]]
            i += 1
            j += 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a += a_size[a[i]]
                    i += 1
                else:
                    end_b += b_size[b[j]]
                    j += 1
            if i - from_a == 1 == j - from_b:
                x, y = a[from_a], b[from_b]
                texts.append(f"{a_text[x]}|{b_text[y]}")
                if same[x] == y:
                    ones.append(x)
                else:
                    odds.append(x << _CODE | y)
                continue
            mine, other = a[from_a:i], b[from_b:j]
            texts.append(f"{','.join([a_text[x] for x in mine])}|{','.join([b_text[y] for y in other])}")
            for x in mine:
                for y in other:
                    if same[x] == y:
                        ones.append(x)
                    else:
                        odds.append(x << _CODE | y)
        sizes = (n_a, len(b), len(texts), len(ones) + len(odds), 1)
        return ";".join(texts), struct.pack(f"<{len(ones)}I", *ones), struct.pack(f"<{len(odds)}I", *odds), sizes

    def _parts(self, parts: set[str]) -> dict[str, tuple[str, bytes, bytes, tuple]]:
        """What each of the parts gives that are not remembered."""
        new = list(parts.difference(self.of_part))
        a_bytes, b_bytes = self.tokenizers.a_bytes, self.tokenizers.b_bytes
        found = {}
        for part, (a, b) in zip(new, self.tokenizers.encode(new), strict=True):
            raw = part.encode()
            spelled = b"".join([a_bytes[x] for x in a]) == raw == b"".join([b_bytes[y] for y in b])
            found[part] = self._aligned(a, b) if spelled else ("", b"", b"", (0, 0, 0, 0, 0))
        self.of_part.update(islice(found.items(), max(0, PARTS - len(self.of_part))))
        return found

    def add(self, pieces: list[str]) -> None:
        """Take in the stretches of new pieces."""
        cut = [self.tokenizers.parts(stretch_of(p)) for p in pieces]
        found = self._parts(set().union(*cut))
        known = self.of_part
        for piece, parts in zip(pieces, cut, strict=True):
            held = [known.get(p) or found[p] for p in parts]
            if len(held) == 1:
                text, ones, odds, sizes = held[0]
            else:
                text, ones, odds, sizes = zip(*held, strict=True)
                text, ones, odds = ";".join(text), b"".join(ones), b"".join(odds)
                sizes = (*map(sum, list(zip(*sizes, strict=True))[:4]), min([x[4] for x in sizes]))
            self.number[piece] = len(self.groups)
            self.groups.append(text)
            self.ones.append(ones)
            self.odds.append(odds)
            self.sizes.append(sizes)


def pieces_of(text: str) -> list[str]:
    """Short names of the stretches of a text that is not empty: a stretch without its space, where that is clear.

    Joined, the stretches are a space and the text.
    """
    if not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _OTHER_WHITE.intersection(text)):
        return text.replace("\n", " \n").split(" ")
    first, *rest = _LONE.split(text)
    return [" " + first, *[p if p[0] == "\n" else " " + p for p in rest]]


def stretch_of(piece: str) -> str:
    """The stretch that a short name stands for, with its space or line end first."""
    return piece if piece[0] in " \n" else " " + piece


def _summed(doc: np.ndarray, values: list[bytes], used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, value) of the stretches `used` by documents `doc`, with how often each comes."""
    kinds, at = np.unique(used, return_inverse=True)
    lists = [values[k] for k in kinds.tolist()]
    size = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
    flat = np.frombuffer(b"".join(lists), "<u4").astype(np.int64)
    start = np.cumsum(size) - size
    each = size[at]
    total = int(each.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(each) - each, each)
    keys = np.repeat(doc, each) << 32 | flat[np.repeat(start[at], each) + inside] if total else np.empty(0, np.int64)
    keys, n = np.unique(keys, return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, n


def _by_document(n_docs: int, doc: np.ndarray, code: np.ndarray, n: np.ndarray) -> list[bytes]:
    rows = np.empty(len(code), _LINKS)
    rows["code"], rows["n"] = code, n
    ends = np.searchsorted(doc, np.arange(n_docs + 1))
    return [rows[ends[k] : ends[k + 1]].tobytes() for k in range(n_docs)]


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for every document: its block, sizes, `groups` as text (`a1,a2|b1;a3|b2,b3`) and its links:
    `ones` by A id and `odds` by pair, as bytes of (code, number).

    A row without n_a follows each block, with the pairs that its documents link and in how many of them,
    and one ends each task, with the numbers of documents for each A id. `link_scores` tells them apart.
    """
    ship(docs.sparkSession)
    names = [f.split()[0] for f in ROWS.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in ROWS.split(", ")]

    def rows(**columns):
        n = max(map(len, columns.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds, strict=True)], names
        )

    def blocks(batches):
        """(ids, texts) of about BLOCK_CHARS characters."""
        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                chars += len(texts[-1]) + 1
                if chars >= BLOCK_CHARS:
                    yield ids, texts
                    ids, texts, chars = [], [], 0
        if ids:
            yield ids, texts

    def align(batches):
        known: Known = once(("alignment", a_path, b_path), lambda: Known(Tokenizers(a_path, b_path)))
        part = TaskContext.get().partitionId()
        vector = np.zeros(len(known.same), np.int64)
        for at, (ids, texts) in enumerate(blocks(batches)):
            known.forget(STRETCHES)
            cut = [pieces_of(t) if t and MARK not in t else [] for t in texts]
            new = list(set().union(*cut).difference(known.number))
            for k in range(0, len(new), 10_000):
                known.add(new[k : k + 10_000])
            each = [list(map(known.number.__getitem__, c)) for c in cut]
            groups, sizes = [], np.zeros((len(ids), 5), np.int64)
            table = np.array(known.sizes, np.int64).reshape(-1, 5)
            for k, used in enumerate(each):
                if used:
                    sizes[k] = table[used].sum(axis=0)
                    if sizes[k, 4] < len(used):  # some stretch is not spelled by its tokens
                        each[k], sizes[k] = [], 0
                groups.append(";".join(map(known.groups.__getitem__, each[k])))
            used = np.fromiter((u for e in each for u in e), np.int64)
            doc = np.repeat(np.arange(len(ids)), [len(e) for e in each])
            ones, odds = _summed(doc, known.ones, used), _summed(doc, known.odds, used)
            vector += np.bincount(ones[1], minlength=len(vector))
            codes, n_docs = np.unique(odds[1], return_counts=True)
            pairs = np.empty(len(codes), _LINKS)
            pairs["code"], pairs["n"] = codes, n_docs
            block = part << 32 | at
            yield rows(
                block=[block] * len(ids), doc_id=ids, groups=groups, ones=_by_document(len(ids), *ones), odds=_by_document(len(ids), *odds),
                **{c: sizes[:, k] for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            )
            yield rows(block=[block], pairs=[pairs.tobytes()])
        yield rows(vector=[vector.tobytes()])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, ROWS)


def _exploded(blocks: DataFrame) -> DataFrame:
    """(block, code, n) of the pairs of all blocks."""

    def spread(batches):
        for batch in batches:
            for block, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                links = np.frombuffer(held, _LINKS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(links), block)), pa.array(links["code"].astype(np.int64)), pa.array(links["n"].astype(np.int64))],
                    ["block", "code", "n"],
                )

    return blocks.select("block", "pairs").mapInArrow(spread, "block long, code long, n long")


def _vector_total(vectors: DataFrame, size: int) -> np.ndarray:
    """Sum of the vectors of all tasks: a number for each A id."""

    def spread(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for held in batch.column(0).to_pylist():
                total += np.frombuffer(held, np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["a", "n"])

    out = np.zeros(size, np.int64)
    for row in vectors.select("vector").mapInArrow(spread, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        out[row["a"]] = row["n"]
    return out


class Links:
    """Written alignments with the counts of all pairs."""

    def __init__(self, aligned: DataFrame, a_path: str, b_path: str, extra: list[Column]):
        self.same = Tokenizers(a_path, b_path).same_bytes()
        self.extra = extra
        rows = stage(aligned.select(*[c for c in aligned.columns if c != "groups"], *extra), "alignments")
        self.docs = rows.filter("n_a IS NOT NULL")
        self.blocks = rows.filter("pairs IS NOT NULL")
        #: Documents that link each A id with the B id of the same bytes.
        self.ones = _vector_total(rows.filter("vector IS NOT NULL"), len(self.same))
        #: (code, n_docs) of all other pairs.
        self.odds = stage(_exploded(self.blocks).groupBy("code").agg(F.sum("n").alias("n_docs")), "pairs")

    def pair_counts(self) -> DataFrame:
        """(a_id, b_id, n_docs) of every linked pair."""
        at = np.flatnonzero(self.ones)
        ones = self.odds.sparkSession.createDataFrame(
            pd.DataFrame({"a_id": at, "b_id": self.same[at], "n_docs": self.ones[at]}), "a_id long, b_id long, n_docs long"
        )
        odds = self.odds.select(
            F.shiftright("code", _CODE).alias("a_id"), F.col("code").bitwiseAND((1 << _CODE) - 1).alias("b_id"), F.col("n_docs").cast("long")
        )
        return ones.unionByName(odds)

    def best(self) -> np.ndarray:
        """The highest count of each A id."""
        best = self.ones.copy()
        top = self.odds.groupBy(F.shiftright("code", _CODE).alias("a")).agg(F.max("n_docs").alias("n"))
        for row in top.collect():  # as many rows as A's vocabulary has ids, at most
            best[row["a"]] = max(best[row["a"]], row["n"])
        return best

    def scores(self) -> DataFrame:
        """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum) and the extra columns of every document."""
        ones, best = self.ones, self.best()
        names = [f for f in self.docs.columns if f not in ("block", "ones", "odds", "pairs", "vector")]
        looked_up = _exploded(self.blocks).select("block", "code").join(self.odds, "code").groupBy("block").agg(
            F.collect_list(F.struct("code", "n_docs")).alias("_found")
        )
        found = looked_up.select("block", F.col("_found.code").alias("codes"), F.col("_found.n_docs").alias("counts"))

        def score(docs: pa.Table, counts: pa.Table) -> pa.Table:
            codes, of_code = (np.asarray(counts.column(c).combine_chunks().flatten(), np.int64) for c in ("codes", "counts"))
            order = np.argsort(codes)
            codes, of_code = codes[order], of_code[order]
            n_best, count_sum = [], []
            for mine, other in zip(docs.column("ones").to_pylist(), docs.column("odds").to_pylist(), strict=True):
                a, odd = np.frombuffer(mine, _LINKS), np.frombuffer(other, _LINKS)
                id_a = np.concatenate([a["code"], odd["code"] >> _CODE]).astype(np.int64)
                n = np.concatenate([a["n"], odd["n"]]).astype(np.int64)
                count = np.concatenate([ones[a["code"]], of_code[np.searchsorted(codes, odd["code"])]])
                n_best.append(int(n[count == best[id_a]].sum()))
                count_sum.append(int((n * count).sum()))
            out = docs.select(names)
            return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

        kinds = ", ".join(f"`{c}` {self.docs.schema[c].dataType.simpleString()}" for c in names)
        return self.docs.select("block", "ones", "odds", *names).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
            score, f"{kinds}, n_best long, count_sum long"
        )


def link_scores(docs: DataFrame, a_path: str, b_path: str, extra: list[Column] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum), one row per row of `docs`.

    n_best counts links whose pair has the highest count of its A id, count_sum adds the counts of all
    links. `extra` are columns made from those of `alignments`, such as a digest of `groups`.
    """
    return Links(alignments(docs, a_path, b_path), a_path, b_path, extra or []).scores()
