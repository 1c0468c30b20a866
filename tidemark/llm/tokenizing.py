"""Encode texts with the tokenizers library, remembering what was encoded before.

A text is cut where no token can cross the cut. The pieces, mostly words, repeat so often that a
bounded table of pieces answers most of them; only new pieces reach the library, many in one call.
The table lives in the Python worker and serves all its tasks. When it is full, further pieces are
encoded each time they come, so it changes speed and never a result.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import struct
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECES = 500_000
#: Words of letters that reach a model in one call.
SIDE_BY_SIDE = 64
#: Bounds of an encoder with a table of words and one of their letters.
WORDS, UNITS = 400_000, 300_000
_LOADED: dict[str, object] = {}
_CACHED: dict[tuple, object] = {}


def once(key: tuple, make):
    """The object made for `key` in this process; making one lets the one before go, with its table.

    Tables hold methods of the object that holds them, so the old ones are collected before new ones grow.
    """
    if key not in _CACHED:
        if _CACHED:
            _CACHED.clear()
            gc.collect()
        _CACHED[key] = make()
    return _CACHED[key]


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path not in _LOADED:
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def version_digest(path: str) -> str:
    """Names a tokenizer by what decides its results: the file's bytes and the library's version."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + b"\0" + tokenizers.__version__.encode()).hexdigest()


class PieceTable(dict):
    """Values of pieces by a function of one piece; the first `limit` pieces are kept."""

    def __init__(self, encode, limit: int = PIECES):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, piece: str):
        value = self.encode(piece)
        if len(self) < self.limit:
            self[piece] = value
        return value


class WordCounter:
    """Number of tokens for a tokenizer that drops white space before it looks for tokens.

    Spaces and line ends part its words, and no special string holds one, so the words between
    them are counted on their own.
    """

    def __init__(self, path: str):
        encode = load(path).encode
        self.table = PieceTable(lambda word: len(encode(word, add_special_tokens=False).ids))

    def __call__(self, text: str | None) -> int:
        return sum(map(self.table.__getitem__, (text or "").replace("\n", " ").split(" ")))


_SPACE = r"\s\u180e"
_LONE = re.compile(rf"(?<=[^{_SPACE}]) (?=[^{_SPACE}])|(?<=[^{_SPACE}])(?=\n[^{_SPACE}])")
_WHITE = re.compile(rf"[{_SPACE}]")


#: Signs that no contraction or special string holds.
_SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-įıĳ-ňŊ-ɏ]+")


def signs_and_letters(word: str) -> tuple[str, str, str] | None:
    """A word of Latin letters between signs as (signs, letters, signs); None for any other word."""
    letters = word.strip(_SIGNS)
    if not (letters.isalpha() if letters.isascii() else _LETTERS.fullmatch(letters)):
        return None
    at = word.find(letters)
    return word[:at], letters, word[at + len(letters) :]


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable bytes for themselves,
    the others in order for the signs from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


#: A word of Latin letters between signs, as `signs_and_letters` parts it.
_PARTS = rf"^(?P<before>[{re.escape(_SIGNS)}]*)(?P<letters>{_LETTERS.pattern})(?P<after>[{re.escape(_SIGNS)}]*)$"


def _strings(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _each(values, strings: pa.Array) -> pa.Array:
    """The values of strings, by a function that takes the distinct ones as a list."""
    coded = strings.dictionary_encode()
    return pa.array(values(_strings(coded.dictionary)), pa.binary()).take(coded.indices)


class ByteLevelEncoder:
    """Ids, as bytes of unsigned 16-bit numbers, for a byte-level tokenizer with its usual pattern.

    A single space between two other characters begins a new word, and a single line end between
    two other characters is a token of its own. So a text is cut before both; a piece stands for
    itself with its space, or begins with its line end. White space in any other place stays inside
    its piece. Many texts are encoded in one call, and each distinct piece among them once.

    Most pieces are letters with signs around them. Letters are one unit of the usual pattern and the
    signs before and after are others, the first with the space before it, so the library's model gets
    the letters without its splitting. Letters are remembered, as units with or without their space:
    more pieces are new than letters are. New units with a space go to the model side by side: no entry
    of the vocabulary reaches from letters over the next space, so no merge does.
    """

    dtype = "<u2"

    def __init__(self, path: str):
        tokenizer = load(path)
        if tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        encode, number = tokenizer.encode, struct.Struct
        self.whole = lambda piece: number(f"<{len(ids := encode(piece, add_special_tokens=False).ids)}H").pack(*ids)
        self.signs, self.of_model = byte_signs(), tokenizer.model.tokenize
        self.space = self.signs[32]

        vocabulary = tokenizer.get_vocab()
        self.begins = np.zeros(1 << 16, bool)  # ids of entries that begin with a space
        self.begins[[i for t, i in vocabulary.items() if t[:1] == self.space]] = True
        in_words = {self.space, *self._spelled("".join(c for c in map(chr, range(0x250)) if _LETTERS.fullmatch(c)))}
        crossing = any(self.space in t[1:] and in_words.issuperset(t) for t in vocabulary)
        self.side_by_side = 1 if crossing or getattr(tokenizer.model, "ignore_merges", True) else SIDE_BY_SIDE

        #: Letters without a space before them come after a line end or a sign; `heads` hold that and the signs between.
        self.units: dict[str, bytes] = {}
        self.heads = PieceTable(lambda head: self.whole("\n") + self.whole(head[1:]) if head[:1] == "\n" else self.whole(head))
        self.tails = PieceTable(self.whole)
        self.others = PieceTable(lambda piece: self.whole(piece if piece[0] == "\n" else " " + piece), UNITS)
        samples = [f"{a}{w}{b}" for w in ("The", "élève", "ŵordless") for a in ("", "(", "**") for b in ("", ".", ",***")]
        sample, self.plain = "".join(f" {s}\n{s}" for s in samples)[1:], True
        self.plain = self(pa.array([sample]))[0].as_py() == self.whole(sample)

    def _spelled(self, letters: str) -> str:
        """Letters as signs for their bytes; ASCII letters stand for themselves."""
        return letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.signs)

    def _ids(self, spelled: str) -> list[int]:
        return [t.id for t in self.of_model(spelled)]

    def _units(self, units: list[str]) -> list[bytes]:
        """The ids of letters, with or without a space before them; the table takes new ones while it has room."""
        found = list(map(self.units.get, units))
        new = [u for u, v in zip(units, found, strict=True) if v is None]
        spaced, step = [u for u in new if u[0] == " "], self.side_by_side
        spelled = [self.space + self._spelled(u[1:]) for u in spaced]
        ids = np.array([i for at in range(0, len(spelled), step) for i in self._ids("".join(spelled[at : at + step]))], self.dtype)
        starts = (np.flatnonzero(self.begins[ids]) * ids.itemsize).tolist()
        ids = ids.tobytes()
        values = dict(zip(spaced, [ids[a:b] for a, b in zip(starts, [*starts[1:], len(ids)])], strict=True))
        values |= {u: np.array(self._ids(self._spelled(u)), self.dtype).tobytes() for u in new if u[0] != " "}
        self.units.update(islice(values.items(), max(0, PIECES - len(self.units))))
        return [values[u] if v is None else v for u, v in zip(units, found, strict=True)]

    def _loose(self, piece: str) -> bool:
        """Whether a piece is empty or has white space at an end, so that it is not alone."""
        bare = piece[1:] if piece[:1] == "\n" else piece
        return not bare or _WHITE.match(bare[0]) is not None or _WHITE.match(bare[-1]) is not None

    def _values(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces; null for a loose one."""
        parts = pc.extract_regex(pc.utf8_ltrim(pieces, "\n"), _PARTS)
        plain = parts.is_valid().to_numpy(zero_copy_only=False) & self.plain
        before, letters, after = parts.filter(pa.array(plain)).flatten()
        lead = pc.starts_with(pieces, "\n").filter(pa.array(plain))
        spaced = pc.and_(pc.invert(lead), pc.equal(before, ""))
        head = pc.binary_join_element_wise(pc.if_else(lead, "\n", pc.if_else(spaced, "", " ")), before, "")
        unit = pc.binary_join_element_wise(pc.if_else(spaced, " ", ""), letters, "")
        known = pc.binary_join_element_wise(
            _each(lambda heads: [self.heads[h] for h in heads], head), _each(self._units, unit), _each(lambda tails: [self.tails[t] for t in tails], after), b""
        )
        others = [None if self._loose(p) else self.others[p] for p in _strings(pieces.filter(pa.array(~plain)))]
        order = np.empty(len(pieces), np.int64)
        order[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(pieces))
        return pa.concat_arrays([known, pa.array(others, pa.binary())]).take(pa.array(order))

    def _odd(self, texts: list[str]) -> list[bytes]:
        """The ids of texts in which some white space is not alone."""
        cut = [_LONE.split(text) for text in texts]
        inside = lambda piece: "\n" in piece[1:] or _WHITE.search(piece[1:]) is not None
        pieces = list({p for _, *rest in cut for p in rest if not inside(p)})
        values = dict(zip(pieces, _strings(self._values(pa.array(pieces, pa.string()))), strict=True))
        return [
            self.whole(first) + b"".join(v if (v := values.get(p)) is not None else self.whole(p if p[0] == "\n" else " " + p) for p in rest)
            for first, *rest in cut
        ]

    def __call__(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text, a null one as an empty one, and `end` after them."""
        if not len(texts):
            return pa.array([], pa.binary())
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " \n"), " ")
        begin, coded = split.offsets.to_numpy(), split.values.dictionary_encode()
        begin, sizes, n = begin[:-1], np.diff(begin), len(coded.dictionary)
        places = coded.indices.to_numpy().copy()
        firsts = coded.dictionary.take(pa.array(places[begin])).to_pylist()
        values = self._values(coded.dictionary)

        # the first piece of a text has no space before it, and a text with loose pieces is encoded apart: place n has no ids
        places[begin] = n
        odd = np.add.reduceat(np.append(values.is_null().to_numpy(zero_copy_only=False), False)[places], begin, dtype=np.int64) > 0
        odd |= [(f != "" or size > 1) and self._loose(f) for f, size in zip(firsts, sizes.tolist(), strict=True)]
        places[np.repeat(odd, sizes)] = n
        apart = iter(self._odd(_strings(texts.filter(pa.array(odd)))))
        firsts = [next(apart) if o else self.whole(f) for f, o in zip(firsts, odd.tolist(), strict=True)]

        # in this row an end comes before each text's ids; without the first one, and with one more, they come after
        places[begin] = np.arange(n + 1, n + 1 + len(firsts))
        row = pa.concat_arrays([values, pa.array([b"", *(end + f for f in firsts)], pa.binary())]).take(pa.array(places))
        _, ends, data = row.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(row) + 1]
        data = (data.to_pybytes() if data else b"")[len(end) : ends[-1]] + end
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends[[*begin, -1]]), pa.py_buffer(data)])
