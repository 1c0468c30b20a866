"""Merge-type sentence pieces by a prefix table.

For every prefix of a text the encoding of that prefix ends in exactly one token: the piece that
ends there, as an automaton reports, and is compatible with the last token of the prefix before it.
Two tokens are compatible when encoding their joined text gives just these two, for then no merge
crosses the border between them. The table is filled from left to right, and the ids are read from
it backwards. Each character is looked at once for every piece that ends there, however long the
text is.

A piece has its space mark at the start only, so a text is cut before every run of marks, and at
line ends, which no piece holds; results of short stretches are remembered up to a bound.

Defined results: a null text is the empty one and has no ids; a character without a piece becomes
the tokens of its UTF-8 bytes; a space mark in a text is a space, also after decoding.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts
from tidemark.llm.tokenizing import PieceTable, once

MARK = "▁"
PAIRS, STRETCHES = 400_000, 400_000
#: Stands before the first token of a stretch, and after a character without a piece.
START = (1 << 20) - 1
REMEMBERED_CHARS = 64
_LINES = re.compile(r"\n[^\n]*|[^\n]+")
_STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceModel:
    """Pieces and scores of a model file, encoding and decoding of single texts."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if len(ids) > START:
            raise ValueError("ids of this vocabulary need more than 20 bits")
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i in ids if model.is_control(i)}
        self.id_of = {
            self.pieces[i]: i for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.score = {p: model.get_score(i) for p, i in self.id_of.items()}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.id_of):
            raise ValueError("a piece holds a space mark after its start, or a line end")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.pairs = PieceTable(self._compatible, PAIRS)  # by both ids in one number
        self.edges = PieceTable(self._edges, PAIRS)
        self.lengths = [len(p) for p in self.pieces]
        ordinary = set(self.id_of.values())
        self.shown = [p if i in ordinary else "" for i, p in enumerate(self.pieces)]

    def _compatible(self, pair: int) -> bool:
        """Whether no merge crosses the border between two tokens; after START, whether the token merges alone.

        Only the last part of the first token and the first part of the second can merge across it.
        Both grow as their tokens are merged alone; of the next growth on either side and the merge
        across, the one with the best score comes first, of equal ones the leftmost.
        """
        two = self.edges[pair & START]
        if pair >> 20 == START:
            return two is not None
        one = self.edges[pair >> 20]
        if one is None or two is None:
            return False
        last, first = one[1], two[0]
        never, score, i, j = float("-inf"), self.score.get, 0, 0
        while True:
            across = score(last[i][1] + first[j][1], never)
            left = last[i + 1][0] if i + 1 < len(last) else never
            right = first[j + 1][0] if j + 1 < len(first) else never
            if across > left and across >= right:
                return False
            if left == right == never:
                return True
            if left >= right:
                i += 1
            else:
                j += 1

    def _edges(self, token: int) -> tuple[list, list] | None:
        """How the first and the last part of a token grow when it is merged alone, as (score, part).

        None for a token that merging its characters does not give.
        """
        steps: list[tuple[int, int, float, str]] = []
        if self._merged(self.pieces[token], steps) != [self.pieces[token]]:
            return None
        first, last = ([(0.0, self.pieces[token][k])] for k in (0, -1))
        for at, n, score, part in steps:
            if at == 0:
                first.append((score, part))
            if at == n - 2:
                last.append((score, part))
        return first, last

    def _merged(self, text: str, steps: list | None = None) -> list[str]:
        """The pieces of one or two joined pieces, by merging the best pair again and again.

        `steps` gets place, number of parts before, score and result of each merge.
        """
        parts = list(text)
        while len(parts) > 1:
            best, at = max(((self.score.get(a + b, float("-inf")), -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best == float("-inf"):
                break
            if steps is not None:
                steps.append((-at, len(parts), best, parts[-at] + parts[1 - at]))
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def stretch(self, text: str) -> list[int]:
        """Ids of a text in which spaces are marks already."""
        # the last token of the prefix that ends at each character; the place after all stands before the first
        last, pairs = [START] * (len(text) + 1), self.pairs
        for end, (length, token) in self.automaton.iter(text):
            if last[end] == START and pairs[last[end - length] << 20 | token]:
                last[end] = token
        ids: list[int] = []
        at, lengths = len(text) - 1, self.lengths
        while at >= 0:
            token = last[at]
            if token == START:  # no piece for this character
                ids.extend(self.byte_ids[b] for b in reversed(text[at].encode()))
                at -= 1
            else:
                ids.append(token)
                at -= lengths[token]
        return ids[::-1]

    @staticmethod
    def stretches(text: str) -> list[str]:
        """The stretches of a text that is not empty; joined, they are the text with its first mark."""
        plain = text.replace(MARK, " ")
        cut = plain.replace("\n", " \n").split(" ")
        if "" not in cut:
            return [p if p[0] == "\n" else MARK + p for p in cut]
        return [q for p in _STRETCH.findall(MARK + plain.replace(" ", MARK)) for q in _LINES.findall(p)]

    def encode(self, text: str | None) -> list[int]:
        return [i for p in self.stretches(text) for i in self.stretch(p)] if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks become spaces, the first one goes, bytes are read as UTF-8."""
        return self.decode_marked(ids).removeprefix(" ")

    def decode_marked(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if i not in self.silent:
                out.append(self.pieces[i].replace(MARK, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)


class WordTable(PieceTable):
    """A table that keeps short words only."""

    def __missing__(self, word: str):
        return super().__missing__(word) if len(word) <= REMEMBERED_CHARS else self.encode(word)


class PieceEncoder:
    """Ids as decimals joined by commas, and the text decoded from them, with remembered words.

    A text in which every space is alone is cut into the words between them, which stand for the stretches
    with their mark. Each word's ids are decoded once; where they give the word back, bytes of
    characters without a piece included, the decoded text of such words is the text itself. Any other text goes by its stretches.
    """

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.words = WordTable(self._word, STRETCHES)

    def _word(self, word: str) -> str | None:
        """Ids of a word; None for an empty one, or where its ids decode to something else."""
        stretch = word if word[:1] == "\n" else MARK + word
        ids = self.model.stretch(stretch)
        # the pieces of ordinary tokens are what they decode to, with marks for spaces
        if "".join(map(self.model.shown.__getitem__, ids)) != stretch and self.model.decode_marked(ids) != stretch.replace(MARK, " "):
            return None
        return ",".join(map(str, ids)) if word else None

    def _both(self, stretch: str) -> tuple[str, str]:
        ids = self.model.stretch(stretch)
        return ",".join(map(str, ids)), self.model.decode_marked(ids)

    def __call__(self, text: str | None) -> tuple[str, str]:
        if not text:
            return "", ""
        plain = text.replace(MARK, " ")
        try:
            return ",".join(map(self.words.__getitem__, plain.replace("\n", " \n").split(" "))), plain
        except TypeError:  # a word without a value of its own
            ids, texts = zip(*map(self._stretch, self.model.stretches(text)), strict=True)
            return ",".join(ids), "".join(texts).removeprefix(" ")

    def _stretch(self, stretch: str) -> tuple[str, str]:
        """Ids and decoded text of a stretch, by its word where that has a value."""
        word = stretch[1:] if stretch[0] == MARK else stretch if stretch[0] == "\n" else ""
        if word and word[0] not in (MARK, "\n") or stretch[0] == "\n":
            if (ids := self.words[word]) is not None:
                return ids, stretch.replace(MARK, " ")
        return self._both(stretch)


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded): ids as an array and the text decoded from them, one row per row of `docs`."""

    def encode(batches):
        encoder = once(("pieces", model), lambda: PieceEncoder(model))
        for batch in parts(batches):
            ids, back = zip(*map(encoder, batch.column(1).to_pylist()), strict=True)
            values = [np.fromstring(i, np.int32, sep=",") for i in ids]
            ends = np.cumsum([0, *map(len, values)])
            values = np.concatenate(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)), pa.array(back, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row of `docs`; nothing is shuffled."""

    def digest(batches):
        encoder = once(("pieces", model), lambda: PieceEncoder(model))
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids, back = encoder(text)
                n.append(ids.count(",") + 1 if ids else 0)
                of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                of_text.append(hashlib.sha256(back.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
