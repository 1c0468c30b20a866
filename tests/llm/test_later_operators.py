"""Packing, importance resampling and token alignment against the libraries and plain Python."""

import hashlib
import math
import random
import re
import zlib
from bisect import bisect
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, importance, packing, queries
from tidemark.llm.ordering import numbered

WORD_BPE, BYTE_BPE, PIECES = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def _fewest(lengths, capacity):
    """The smallest number of sequences, by trying everything."""
    best = len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= lengths[k] and room not in rooms[:i]:
                go(k + 1, [*rooms[:i], room - lengths[k], *rooms[i + 1 :]])
        go(k + 1, [*rooms, capacity - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best if lengths else 0


def _best_fit(lengths, capacity):
    rooms = []
    for w in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= w), default=None)
        if fit is not None:
            rooms.remove(fit)
        rooms.append((capacity if fit is None else fit) - w)
    return len(rooms)


def test_reduction_keeps_the_optimum_and_best_fit_is_best_fit():
    rng = random.Random(1)
    for _ in range(600):
        capacity = rng.choice([10, 20, 37])
        least = rng.choice([1, 3, capacity // 4])
        lengths = [rng.randint(least, capacity) for _ in range(rng.randint(0, 10))]
        counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        reduced = packing.Instance(counts.copy(), capacity)
        reduced.reduce()
        rest = [w for w in range(capacity + 1) for _ in range(int(reduced.counts[w]))]
        assert sum(n for _, n in reduced.patterns) + _fewest(rest, capacity) == _fewest(lengths, capacity)
        plain = packing.Instance(counts.copy(), capacity)
        plain.best_fit()
        assert sum(n for _, n in plain.patterns) == _best_fit(lengths, capacity)
        placed = Counter()
        for held, n in packing.solve(Counter(lengths), capacity):
            assert sum(w * k for w, k in held) <= capacity
            placed.update({w: k * n for w, k in held})
        assert placed == Counter(lengths)


def _check_packing(rows, got, capacity):
    library = Tokenizer.from_file(WORD_BPE)
    want = Counter()
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    inside = defaultdict(list)
    for r in got:
        inside[r.sequence_id].append((r.offset, r.length))
    for held in inside.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r.length for r in got]
    assert len(inside) <= min(_best_fit(lengths, capacity), math.ceil(sum(lengths) / capacity) * 1.3 + 1)


def test_packing(spark, odd_docs):
    _check_packing(_rows(odd_docs), packing.digests(odd_docs, WORD_BPE, 1).collect(), 4096)
    _check_packing(_rows(odd_docs), packing.digests(odd_docs.repartition(3), WORD_BPE, 1, 64).collect(), 64)
    assert packing.digests(odd_docs.limit(0), WORD_BPE, 1).count() == 0
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    _check_packing(_rows(docs), queries.op11_packing(spark, FOLDER).collect(), 4096)


def test_packed_sequences_hold_their_documents(odd_docs):
    pieces = packing.packed(odd_docs, WORD_BPE, 1, 512)
    by_place = {(r.sequence_id, r.offset): r for r in pieces.collect()}
    for r in packing.sequences(pieces).collect():
        ids = np.frombuffer(r.ids, "<u4")
        for doc_id, offset in zip(r.doc_ids, r.offsets, strict=True):
            piece = by_place.pop((r.sequence_id, offset))
            assert piece.doc_id == doc_id and (ids[offset : offset + piece.length] == np.frombuffer(piece.ids, "<u4")).all()
    assert not by_place


def test_crc_matrices_equal_zlib():
    rng = random.Random(2)
    features = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 3, 3, 8, 600]))) for _ in range(400)] + [b"x" * 5000]
    assert importance.crc32_of(features).tolist() == [zlib.crc32(f) for f in features]
    assert importance.crc32_of([]).tolist() == []


def _resampled(docs, target, runs=1, buckets=10_000, per_cent=10, least_words=20):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    features = lambda w: [" ".join(w[k : k + n]) for n in range(1, runs + 1) for k in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for _, text in rows for f in features(words(text))) for rows in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for doc_id, text in docs:
        held = features(words(text))
        weight = sum(map(gain, map(bucket, held))) // len(held) if held else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(held), weight, score, len(words(text)) >= least_words))
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = fit[: per_cent * len(fit) // 100]
    ranked = Counter((*r[:4], k + 1) for k, r in enumerate(drawn))
    ranked.update((*r[:4], None) for r in [r for r in out if not r[4]] + fit[len(drawn) :])
    return ranked


def test_importance(spark, odd_docs):
    target = spark.createDataFrame([(1, "the house of É the\x7fhouse"), (2, None), (None, "x 漢字 the of")], "item_id long, text string")
    plain = [(r.item_id, r.text) for r in target.collect()]
    for options in ({}, {"runs": 2, "buckets": 70_000, "per_cent": 50, "least_words": 3}, {"per_cent": 100, "least_words": 0}):
        got = Counter(map(tuple, importance.resampled(odd_docs, target, **options).collect()))
        assert got == _resampled(_rows(odd_docs), plain, **options)
    assert importance.resampled(odd_docs, target.limit(0)).count() == odd_docs.count()
    assert importance.resampled(odd_docs.limit(0), target).count() == 0
    docs, goal = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    got = Counter(map(tuple, queries.op12_importance(spark, FOLDER).collect()))
    assert got == _resampled(_rows(docs), [(r.item_id, r.text) for r in goal.collect()])


def test_features_stay_right_when_the_table_is_full(monkeypatch):
    monkeypatch.setattr(importance, "KNOWN", 5)
    table = importance.Buckets(1, 1000)
    for texts in (["a b c", "d e"], ["a f", None], ["g " * 9 + "a b c d e f"]):
        n, found = table(texts)
        assert n == [len((t or "").split()) for t in texts]
        assert [f.tolist() for f in found] == [[zlib.crc32(w.encode()) % 1000 for w in (t or "").split()] for t in texts]


def _aligned(rows):
    """Everything by the libraries on whole texts and plain loops."""
    a, b = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    known = alignment.Tokenizers(BYTE_BPE, PIECES)
    per_doc, in_docs = [], Counter()
    for doc_id, text in rows:
        whole = (" " + text).encode() if text else b""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelled = [b"".join(of[i] for i in side) for of, side in zip((known.a_bytes, known.b_bytes), ids, strict=True)]
        if spelled != [whole, whole]:
            ids = ([], [])
        ends = [np.cumsum([len(of[i]) for i in side]).tolist() for of, side in zip((known.a_bytes, known.b_bytes), ids, strict=True)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [
            [side[bisect(end, low) : bisect(end, high)] for side, end in zip(ids, ends, strict=True)]
            for low, high in zip([0, *cuts], cuts, strict=False)
        ]
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        in_docs.update(set(links))
        text_of = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        per_doc.append((doc_id, len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(text_of.encode()).hexdigest() if groups else ""))
    best = {}
    for (x, _), n in in_docs.items():
        best[x] = max(best.get(x, 0), n)
    rows = Counter(
        (i, na, nb, ng, len(links), sum(in_docs[p] == best[p[0]] for p in links), sum(in_docs[p] for p in links), digest)
        for i, na, nb, ng, links, digest in per_doc
    )
    return rows, Counter({(x, y, n): 1 for (x, y), n in in_docs.items()})


def _digest():
    return F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")


def _tuples(df):
    return Counter(
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()
    )


def test_alignment(spark, make_docs, odd_docs, monkeypatch):
    odd = make_docs([
        (200, "ab▁c"), (201, "a \n\n b\r\n\tc  d 　e᠎ f​ g"), (202, "ababa <s> </s> <0x41> <|endoftext|>x ééé don't  I'LL 12345 \x00\x1c y"),
        (203, "\n"), (204, " "), (205, "\n\nx \ny\n z "), (206, "naïve Größe 東京タワー 🙂🙂 \U0001f600"), (207, "aé" * 3000),
    ])
    docs = odd_docs.unionByName(odd)
    want, pairs = _aligned(_rows(docs))
    assert _tuples(alignment.link_scores(docs, BYTE_BPE, PIECES, [_digest()])) == want
    links = alignment.Links(alignment.alignments(docs.repartition(5), BYTE_BPE, PIECES), BYTE_BPE, PIECES, [])
    assert Counter(map(tuple, links.pair_counts().collect())) == pairs
    assert alignment.link_scores(docs.limit(0), BYTE_BPE, PIECES).count() == 0
    whole = _rows(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    assert _tuples(queries.op13_alignment(spark, FOLDER)) == _aligned(whole)[0]


def test_alignment_stays_right_when_tables_are_full(make_docs, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abté(.,") for _ in range(rng.randint(1, 4))) for _ in range(30)) for _ in range(40)]
    want = _aligned(list(enumerate(texts)))[0]
    monkeypatch.setattr(alignment, "STRETCHES", 10)
    monkeypatch.setattr(alignment, "PARTS", 7)
    known = alignment.Known(alignment.Tokenizers(BYTE_BPE, PIECES))
    sizes = {}
    for k, text in enumerate(texts):
        known.forget(alignment.STRETCHES)
        pieces = alignment.pieces_of(text)
        known.add(list(set(pieces).difference(known.number)))
        used = [known.number[p] for p in pieces]
        groups = ";".join(known.groups[u] for u in used)
        sizes[k] = (*np.array([known.sizes[u] for u in used]).sum(axis=0)[:4].tolist(), hashlib.sha256(groups.encode()).hexdigest())
        assert len(known.of_part) <= 7 and len(known.groups) == len(known.number) == len(known.sizes) == len(known.ones) == len(known.odds)
    assert sizes == {r[0]: (*r[1:5], r[7]) for r in want}


def test_stretches_equal_whole_texts():
    known = alignment.Known(alignment.Tokenizers(BYTE_BPE, PIECES))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(4)
    signs = [" ", " ", "(", ",*", "_", "É", "İ", "-", "\n", "a", "b", "The", "é", "漢", "\t", "\r", "1", ".", "'s", "᠎", " ", "\x1c", "🙂"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 14)))
        cut = list(map(alignment.stretch_of, alignment.pieces_of(text)))
        assert "".join(cut) == " " + text
        parts = known.tokenizers.encode([p for s in cut for p in known.tokenizers.parts(s)])
        assert [i for p in parts for i in p[0]] == known.tokenizers.a.encode(" " + text, add_special_tokens=False).ids, text
        assert [i for p in parts for i in p[1]] == library.encode(text), text


def test_numbers_of_equal_rows(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(500)] + [(None, 7)] * 3, "a long, b long")
    got = numbered(rows, [F.asc_nulls_last("a"), F.desc("b")], "n").collect()
    want = sorted(((r.a, r.b) for r in rows.collect()), key=lambda r: (r[0] is None, r[0] or 0, -r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == want and sorted(r.n for r in got) == list(range(1, 504))
