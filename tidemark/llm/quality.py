"""Quality classifier by weak labels.

1. Heuristic labellers look at every document and vote good, bad or nothing; they overlap and err.
2. Expectation-maximisation over the counts of vote patterns of all documents estimates how often
   each labeller is right on good and on bad documents, and how many are good. There are at most
   3 ** (number of labellers) patterns, however many documents.
3. The patterns' posteriors label a sample of about `SAMPLE` documents, chosen by a hash of their
   rows, and train a linear scorer on hashed features: word shapes and repeats, as shares of the words.
   A word longer than `SHAPE_CHARS` counts as several words of that length, the last maybe shorter,
   so texts without spaces are seen to their end.
   The sample's bound is a parameter; votes, counts and scores cover all documents.
4. The scorer gives every document the probability that it is good; those below `KEEP` go.

Defined results: a null text and one without words get score 0 and go; repeated rows give a row
each; a table of which no document has a vote is scored 1 where there are words; an empty table gives
an empty result; `filtered` keeps all columns, and only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts
from tidemark.llm.tokenizing import PieceTable, once
from tidemark.session import stage

SAMPLE = 10_000
KEEP = 0.5
DIMENSIONS = 256
EM_ROUNDS = 200
NEWTON_ROUNDS = 25
RIDGE = 1e-3
SHAPE_CHARS = 32
SEGMENT = 50
WORDS = 100_000
#: A score counts as the good share of the corpus for so many words more: a few words say little.
PRIOR = 5
#: With fewer words the worst segment gets no vote.
SHORT = 20

BAD, GOOD, NOTHING = 0, 1, 2
#: Labellers: name, share at or below which it votes good, share at or above which it votes bad.
LABELLERS = (
    ("repeats", 0.03, 0.15),  # words equal to the one before
    ("shouting", 0.12, 0.35),  # letters in upper case
    ("symbols", 0.08, 0.15),  # characters that are neither letters, digits nor white space
    ("separators", 0.03, 0.12),  # words without a letter or digit
    ("exclaiming", 0.05, 0.20),  # words that end in an exclamation mark
    ("worst part", 0.45, 0.90),  # the worst segment's share of repeats, shouted or decorated words
)

_RUNS = re.compile(r"([aA0x])\1+|(.)\2{2,}")


def shape(word: str) -> str:
    """Runs of small letters, capitals, digits and other letters as one sign each, symbols up to twice."""
    signs = "".join(
        "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "x" if c.isalpha() else c
        for c in word
    )
    return _RUNS.sub(lambda m: m[1] or m[2] * 2, signs)


_PLACES = PieceTable(lambda sign: zlib.crc32(sign.encode()) % (DIMENSIONS - 2) + 2, 100_000)
#: Bits of each count of a word; no word is longer than SHAPE_CHARS.
_BITS, _MOST = 13, (1 << 13) - 1


def _describe(word: str) -> int:
    """What the features need of a word in one number: counts, flags, and its shape's feature."""
    end = word[-1] if word[-1] in ".,!" else ""
    core = word[:-1] if end else word
    capital = core[:1].isupper()
    if core.isalpha() and 1 < len(core) < SHAPE_CHARS and core[capital:].islower():  # most words
        letters, symbols, capitals, bare, odd, sign = len(core), len(end), int(capital), False, False, ("Aa" if capital else "a") + end
    else:
        letters, symbols, capitals = sum(map(str.isalpha, word)), sum(not c.isalnum() for c in word), sum(map(str.isupper, word))
        bare = not letters and not any(map(str.isdigit, word))
        odd = bare or (letters > 1 and capitals == letters) or symbols > 2
        sign = shape(word)
    out = 0
    for count in (capitals, letters, symbols, len(word)):
        out = out << _BITS | count
    return (out << 3 | odd << 2 | bare << 1 | (end == "!")) << 8 | _PLACES[sign]


def _parts(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words cut to SHAPE_CHARS, and whether each but the first repeats: equals the part before, or its word the word before."""
    repeats = np.fromiter(map(eq, words, islice(words, 1, None)), bool, len(words) - 1)
    if max(map(len, words)) <= SHAPE_CHARS:
        return words, repeats
    parts = [w[k : k + SHAPE_CHARS] for w in words for k in range(0, len(w), SHAPE_CHARS)]
    again = np.repeat(np.concatenate([[False], repeats]), [-(-len(w) // SHAPE_CHARS) for w in words])[1:]
    return parts, again | np.fromiter(map(eq, parts, islice(parts, 1, None)), bool, len(parts) - 1)


def features(text: str | None) -> tuple[np.ndarray | None, tuple[float, ...]]:
    """Hashed features of a text (None without words) and the shares that the labellers look at.

    The last number is the number of words, those of long words' parts.
    """
    words = (text or "").split()
    if not words:
        return None, ()
    words, repeats = _parts(words)
    n = len(words)
    table = once(("words",), lambda: PieceTable(_describe, WORDS))
    known = np.fromiter(map(table.__getitem__, words), np.int64, n)
    strange = (known >> 10 & 1).astype(bool)
    strange[1:] |= repeats
    vector = np.bincount(known & 255, minlength=DIMENSIONS) / n
    vector[0], vector[1] = 1.0, repeats.sum() / n
    length, symbols, letters, capitals = ((known >> 11 + _BITS * k & _MOST).sum() for k in range(4))
    # the last segment is as long as the others, or the whole text
    whole = strange[: n - n % SEGMENT].reshape(-1, SEGMENT).mean(axis=1)
    worst = max(whole.max(initial=0.0), strange[-SEGMENT:].mean())
    shares = (
        repeats.sum() / n, capitals / max(1, letters), symbols / length, (known >> 9 & 1).sum() / n,
        (known >> 8 & 1).sum() / n, worst if n >= SHORT else 0.6, n,
    )
    return vector, shares


def votes(shares: tuple[float, ...]) -> int:
    """The labellers' votes as one number, three values to a labeller."""
    code = 0
    for share, (_, low, high) in zip(shares, LABELLERS, strict=False):
        code = code * 3 + (GOOD if share <= low else BAD if share >= high else NOTHING)
    return code


def _digits(code: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        code, d = divmod(code, 3)
        out.append(d)
    return out[::-1]


def estimate(counts: dict[int, int]) -> tuple[dict[int, float], np.ndarray, float]:
    """Posterior of being good per vote pattern, P(vote | class) per labeller, share of good documents.

    Starts from the majority of votes, so good is the class on which most votes for good fall.
    """
    codes = sorted(counts)
    given = np.array([_digits(c) for c in codes])
    weight = np.array([counts[c] for c in codes], np.float64)
    good = (given == GOOD).sum(axis=1) - (given == BAD).sum(axis=1) * 2.0
    post = 1 / (1 + np.exp(-good))
    for _ in range(EM_ROUNDS):
        share = np.clip((post * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        table = np.zeros((2, given.shape[1], 3))
        for k, mass in ((BAD, (1 - post) * weight), (GOOD, post * weight)):
            for v in range(3):
                table[k, :, v] = ((given == v) * mass[:, None]).sum(axis=0) + 0.5
            table[k] /= table[k].sum(axis=1, keepdims=True)
        logs = np.log(table[:, np.arange(given.shape[1]), given]).sum(axis=2)
        new = 1 / (1 + np.exp(np.clip(logs[BAD] + np.log(1 - share) - logs[GOOD] - np.log(share), -500, 500)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return dict(zip(codes, post.tolist(), strict=True)), table, float(share)


def fit_linear(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels, by Newton steps."""
    weights = np.zeros(x.shape[1])
    for _ in range(NEWTON_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) / len(x) + RIDGE * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x / len(x) + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class Model:
    weights: np.ndarray
    labellers: np.ndarray | None
    good_share: float

    def score(self, text: str | None) -> float:
        vector, shares = features(text)
        if vector is None:
            return 0.0
        own, n = 1 / (1 + np.exp(-np.clip(vector @ self.weights, -500, 500))), shares[-1]
        return float((n * own + PRIOR * self.good_share) / (n + PRIOR))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    n = docs.count()
    bound = min(1.0, sample / max(n, 1)) * 2**31

    def look(batches):
        for batch in parts(batches):
            codes, vectors = [], []
            for text, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vector, shares = features(text)
                codes.append(None if vector is None else votes(shares))
                vectors.append(None if vector is None or not chosen else vector.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(vectors, pa.binary())], ["code", "vector"])

    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**31)) < bound
    seen = stage(docs.select("text", chosen.alias("chosen")).mapInArrow(look, "code int, vector binary"), "votes")
    counts = {r.code: r["count"] for r in seen.filter("code IS NOT NULL").groupBy("code").count().collect()}
    if not counts:
        return Model(np.eye(1, DIMENSIONS)[0] * 30, None, 1.0)
    posterior, table, share = estimate(counts)
    rows = seen.filter("vector IS NOT NULL").select("code", "vector").collect()
    if not rows:
        return Model(np.eye(1, DIMENSIONS)[0] * 30, table, share)
    x = np.stack([np.frombuffer(r.vector, "<f4") for r in rows]).astype(np.float64)
    return Model(fit_linear(x, np.array([posterior[r.code] for r in rows])), table, share)


def _scores(model: Model):
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in text], dtype="float64")

    return score(F.col("text"))


def scored(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, score, kept), one row per row of `docs`."""
    model = model or fit(docs)
    return docs.select("doc_id", _scores(model).alias("score")).withColumn("kept", F.col("score") >= KEEP)


def filtered(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with all their columns; nothing is shuffled."""
    return docs.filter(_scores(model or fit(docs)) >= KEEP)
