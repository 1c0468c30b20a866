"""Operators on texts against the libraries and plain Python, on odd rows too."""

import gc
import hashlib
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import licenses, minhash, mixing, quality, secret_scan, sentence_pieces, token_counts, token_files, tokenizing
from tidemark.llm.common import PART_ROWS, parts
from tidemark.session import new_path

WORD_BPE, BYTE_BPE, PIECES = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def _rows(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_token_counts_and_their_cache(spark, odd_docs):
    library = Tokenizer.from_file(WORD_BPE)
    cache = new_path(spark, "cache")
    want = Counter(
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048)
        for i, t in _rows(odd_docs).elements()
    )
    for part in (odd_docs.limit(9), odd_docs, odd_docs):
        got = token_counts.token_counts(part, WORD_BPE, cache)
        held = spark.read.parquet(cache)
        assert held.count() == held.select("content").distinct().count()
    assert Counter(map(tuple, got.collect())) == want
    assert token_counts.token_counts(odd_docs.limit(0), WORD_BPE, new_path(spark, "cache")).count() == 0


def test_token_files_round_trip(spark, odd_docs):
    library = Tokenizer.from_file(BYTE_BPE)
    path = new_path(spark, "files")
    token_files.write_files(odd_docs, BYTE_BPE, 2, path)
    got = sorted(token_files.read_files(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i))
    crc = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((i, crc(t)) for i, t in _rows(odd_docs).elements())
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, 3], np.uint32)
    control, data, *_ = token_files.pack(ranks)
    assert (token_files.unpack(control, data, np.array([len(ranks)])) == ranks).all()
    rng = np.random.default_rng(1)
    for n in ([], [0], [1], [4, 0, 3], [5, 8, 0, 0, 1, 2]):
        n = np.array(n, np.int64)
        ranks = (rng.integers(0, 1 << 32, n.sum()) >> rng.choice([0, 8, 16, 24], n.sum())).astype(np.uint32)
        control, data, control_ends, data_ends = token_files.pack(ranks, n)
        assert (token_files.unpack(control, data, n) == ranks).all()
        for k, (c, d) in enumerate(zip(control_ends, data_ends)):
            alone = token_files.pack(ranks[n[:k].sum() : n[: k + 1].sum()])
            assert (control[control_ends[k - 1] if k else 0 : c] == alone[0]).all() and (data[data_ends[k - 1] if k else 0 : d] == alone[1]).all()
    empty = new_path(spark, "files")
    token_files.write_files(odd_docs.limit(0), BYTE_BPE, 2, empty)
    assert token_files.read_files(spark, empty).count() == 0


def test_byte_level_ids_equal_the_library_and_letters_reach_the_model_once(monkeypatch):
    library, seen = Tokenizer.from_file(BYTE_BPE), []

    class Model:
        ignore_merges = library.model.ignore_merges

        def tokenize(self, signs):
            seen.append(signs)
            return library.model.tokenize(signs)

    class Watched:
        model, encode, get_vocab, get_vocab_size = Model(), library.encode, library.get_vocab, library.get_vocab_size

    odd = ["", " ", "\n", "\nhouse", " a", "a  b", "a\n b", "it's", "(\xe9l\xe8ve)", "\xa0", "x\xa0", "\u180e", "\u0131", "\u01c4", "<|endoftext|>", "1.5", "\x00", "\r"]
    odd += [f"{a} word {b}\nend" for a in odd for b in odd]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in odd]
    monkeypatch.setattr(tokenizing, "load", lambda path: Watched())
    for pieces in (tokenizing.PIECES, 3):  # with a full table too
        monkeypatch.setattr(tokenizing, "PIECES", pieces)
        encoder = tokenizing.ByteLevelEncoder(BYTE_BPE)
        texts = pa.array([None, None, *odd, ""]).slice(1)
        for _ in range(2):
            assert encoder(texts, b"\2\0").to_pylist() == [b"\2\0", *(w + b"\2\0" for w in want), b"\2\0"]
        assert len(encoder.units) <= pieces
    assert encoder(pa.array([], pa.string())).to_pylist() == []

    monkeypatch.undo()
    monkeypatch.setattr(tokenizing, "load", lambda path: Watched())
    encoder = tokenizing.ByteLevelEncoder(BYTE_BPE)
    seen.clear()
    encoder(pa.array(["a zebrant zebrant. zebrant, oxlike", "b oxlike! zebrant?"]))
    encoder(pa.array(["c zebrant... oxlike"]))
    words = Counter(w for signs in seen for w in signs.split("\u0120"))
    assert len(seen) == 2 and words["zebrant"] == words["oxlike"] == 1


def test_sentence_pieces_equal_the_library(odd_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter()
    for i, t in _rows(odd_docs).elements():
        ids = library.encode(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter(map(tuple, sentence_pieces.digests(odd_docs, PIECES).collect())) == want
    model = sentence_pieces.PieceModel(PIECES)
    for r in sentence_pieces.encoded(odd_docs, PIECES).collect():
        assert r.decoded == library.decode(r.ids) == model.decode(r.ids)
    assert sentence_pieces.digests(odd_docs.limit(0), PIECES).count() == 0


def test_sentence_pieces_remember_words_and_decode_them_once(monkeypatch):
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.PieceEncoder(PIECES)
    long = "x" * (sentence_pieces.REMEMBERED_CHARS + 1)
    odd = ["", " ", "\n", "\na", " a", "a  b", "a\n b", "\u2581", "a\u2581b", "a\u2581\u2581b", "\U0001f600 x", "x\ud7ff y", "a\x00 b", "<0x41> <s>", f"{long} a {long}"]
    for text in [*odd, *(f"{a} word {b}\nend" for a in odd for b in odd)] * 2:
        ids = library.encode(text)
        assert encoder(text) == (",".join(map(str, ids)), library.decode(ids))
    assert encoder.words["word"] and encoder.words["\nend"] and encoder.words["y\ud7ff"] and encoder.words[""] is None
    assert long not in encoder.words
    monkeypatch.setattr(encoder.model, "stretch", None)  # nothing is encoded or decoded anew
    assert encoder("word word\nend")[1] == "word word\nend"


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def test_an_object_that_holds_itself_is_gone_before_the_next_has_grown():
    class Holder:
        def __init__(self):
            self.table = tokenizing.PieceTable(self.value)

        def value(self, piece):
            return len(piece)

    gc.disable()
    try:
        gone = weakref.ref(tokenizing.once(("first",), Holder))
        tokenizing.once(("second",), Holder)
        assert gone() is None
    finally:
        gc.enable()
        tokenizing._CACHED.clear()


def test_rows_of_a_batch_longer_than_a_part(spark):
    n = 2 * PART_ROWS + 7
    texts = {k: None if k % 97 == 0 else " ".join(f"w{k * j % 53}" for j in range(k % 9)) for k in range(n)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: (list(r.ids), r.decoded) for r in sentence_pieces.encoded(docs, path).collect()}
    assert got == {k: (ids := model.encode(t or ""), model.decode(ids)) for k, t in texts.items()}
    sizes = {r.doc_id: r.n_shingles for r in minhash.sketches(docs, 2).collect()}
    words = {k: (t or "").split() for k, t in texts.items()}
    assert sizes == {k: len({tuple(w[j : j + 2]) for j in range(max(1, len(w) - 1))}) if w else 0 for k, w in words.items()}
    batch = pa.RecordBatch.from_arrays([pa.array(range(n))], ["k"])
    assert [b.num_rows for b in parts([batch, batch.slice(0, 0)])] == [PART_ROWS, PART_ROWS, 7]


def test_secrets(spark, make_docs):
    key = "aZ3kP9xQ7vLm2RtY8sWd4BnC"
    texts = ["", "password=abc password = 'abcdef1' é token:zzzzzzz", "AKIA" + "B" * 16 + " AKIASHORT", "x" + "0a" * 13 + " 0a0a", f"é {key} end",
             "123e4567-e89b-12d3-a456-426614174000", "aaaaaaaaaaaaaaaaaaaaaaaaa1", "example" + key, f"secret={key}", "a1" * 40_000]
    docs = make_docs([*enumerate(texts), (50, None), (1, texts[1])])
    got = secret_scan.scan(docs).collect()
    assert len(got) == 12
    for r in got:
        t = texts[r.doc_id] if r.doc_id < 50 else ""
        base = sorted(
            [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
            + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
            + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        )
        spelled = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert r.spans == (f"entropy:2:{2 + len(key)}" if r.doc_id == 4 else spelled)
    hidden = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert hidden[4] == "é [SECRET] end" and hidden[8] == "[SECRET]" and hidden[0] == "" and hidden[50] is None
    assert secret_scan.redacted(docs).columns == docs.columns and secret_scan.scan(docs.limit(0)).count() == 0


def test_the_allow_list_clears_only_what_it_names(make_docs):
    key = "aZ3kP9xQ7vLm2RtY8sWd4BnC"
    whole = [f"EXAMPLE_KEY={key}", f"/samples/{key}", f"2024-01-01-{key}", f"{key}/xxxx", f"dummy-{key}-example", f"a1/xxxx+{key}=="]
    none = [f"example{key}", f"{key}Sample", f"placeholder_{key}DUMMY", "2024-01-01-some-long-file-name-with-words", "0123456789/abcdefgh/0123456789",
            "123e4567-e89b-12d3-a456-426614174000"]
    docs = make_docs(list(enumerate(whole + none)))
    for r in secret_scan.scan(docs).collect():
        text = (whole + none)[r.doc_id]
        assert r.spans == (f"entropy:0:{len(text)}" if r.doc_id < len(whole) else ""), text
    assert all((key in r.text) == (r.doc_id >= len(whole)) for r in secret_scan.redacted(docs).collect() if key in (whole + none)[r.doc_id])


def _entropy_spans(text, base):
    """The rule of the module in plain Python, window by window."""
    found = []
    for m in re.finditer(rf"(?<![{secret_scan._KEY}])(?=[A-Za-z+/=_-]*[0-9])(?=[0-9+/=_-]*[A-Za-z])[{secret_scan._KEY}]{{{secret_scan.WINDOW},}}", text):
        left = "" if re.search(secret_scan.IDENTIFIER, m[0]) else re.sub(secret_scan.ALLOWED, " ", m[0])
        for run in left.split(" "):
            bits = next(b for p, b in secret_scan.CLASSES if re.search(p, run))
            windows = [run[k : k + secret_scan.WINDOW] for k in range(len(run) - secret_scan.WINDOW + 1)]
            entropy = lambda w: -sum(n / len(w) * np.log2(n / len(w)) for n in Counter(w).values())
            if re.search("[0-9]", run) and re.search("[A-Za-z]", run) and any(entropy(w) >= bits for w in windows):
                found.append((m.start(), 3, m.end()))
                break
    return [f for f in found if not any(f[0] < e and s < f[2] for s, _, e in base)]


def test_all_spans_equal_plain_python(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text").unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    want = Counter()
    for i, t in _rows(docs).elements():
        t = t or ""
        base = sorted(
            [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
            + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
            + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        )
        want[i, ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + _entropy_spans(t, base)))] += 1
    assert Counter((r.doc_id, r.spans) for r in secret_scan.scan(docs).collect()) == want


def test_window_entropy_equals_counting(spark):
    values = ["aB3" * 10, "".join(chr(48 + k % 10) for k in range(45)), "a" * 25, "short1", "aZ3kP9xQ7vLm2RtY8sWd4BnC"]

    def plain(v, w=secret_scan.WINDOW):
        found = [0.0]
        for k in range(len(v) - w + 1):
            counts = np.array(list(Counter(v[k : k + w]).values()))
            found.append(float(-(counts / w * np.log2(counts / w)).sum()))
        return max(found)

    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", secret_scan.window_entropy(df.v).alias("e")).collect():
        assert abs(r.e - plain(r.v)) < 1e-9


def test_licenses(make_docs, odd_docs):
    filler = " ".join(f"w{k}" for k in range(150))
    notice = licenses.TEMPLATES[3][1]
    docs = make_docs([
        (1, "CC BY-NC cc by nc"), (1, "CC BY-NC cc by nc"), (2, None), (3, f"{filler} {notice.replace('copy', 'thing', 1)} {filler}"),
        (4, "This work is licensed under the GNU General Public License, version 3."), (5, "mit license the under"), (None, "under the MIT license"),
    ])
    got = Counter((r.doc_id, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in licenses.scan(docs).collect())
    assert got == Counter([
        (1, 2, 0, 3, "cc-by-nc", "cc-by-nc"), (1, 2, 0, 3, "cc-by-nc", "cc-by-nc"), (2, 0, None, None, "", ""),
        (3, 0, None, None, "", "apache-2"), (4, 0, None, None, "", "gpl-3"), (5, 0, None, None, "", ""), (None, 1, 0, 0, "mit", "mit"),
    ])
    assert licenses.scan(odd_docs).count() == odd_docs.count() and licenses.scan(docs.limit(0)).count() == 0


def test_mix_meets_targets(odd_docs):
    got = mixing.mix(odd_docs, block=4).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in _rows(odd_docs).elements())
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    sources = {(r.source_size, r.target) for r in got}
    for size, target in sources:
        assert abs(sum(r.taken for r in got if r.source_size == size) - target) <= 1
    assert abs(sum(t for _, t in sources) - sum(s for s, _ in sources)) < 1e-6
    assert Counter(got) == Counter(mixing.mix(odd_docs, block=4).collect())
    mixed = mixing.mixed_documents(odd_docs, block=4)
    assert mixed.columns == odd_docs.columns
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert abs(sum(words(r.text) for r in mixed.collect()) - sum(r.taken for r in got)) <= 4
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_mixed_documents_hold_the_words_that_the_slots_read(make_docs):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    rows = [(k, " ".join(f"d{k}w{j}" for j in range(n)), s) for k, (n, s) in enumerate([(5000, "a"), (3, "a"), (700, "a"), (6000, "b"), (40, "b"), (90, "c")])]
    docs = make_docs([*rows, (0, "other text of one id", "a"), rows[2], rows[2]])
    placed, slot = mixing.plan(docs, 16)
    placed, slot = placed.collect(), slot.collect()
    texts = {(i, len(word.findall(t))): word.findall(t) for i, t in _rows(docs)}
    lines = {}
    for r in sorted(placed, key=lambda r: (r["rank"], r.start)):
        lines.setdefault(r["rank"], []).extend(texts[r.doc_id, r.size])
    want = Counter(w for s in slot for w in lines[s["rank"]][s.block * 16 : s.block * 16 + s.words])
    mixed = mixing.mixed_documents(docs, block=16).collect()
    assert Counter(w for r in mixed for w in word.findall(r.text)) == want
    assert all(r.n_chars == len(r.text) for r in mixed) and len(mixed) <= sum((r["rank"] < 3) * 3 for r in placed)
    last = max(int(w.split("w")[1]) for r in mixed if r.doc_id == 0 and r.source == "a" for w in word.findall(r.text) if w.startswith("d0w"))
    assert last > 4900
    assert mixing.word_ranges(" a b\tc  d e", [(0, 1), (1, 2), (3, 4), (4, 5)]) == "a b\nd e"
    assert mixing.word_ranges("a b c", [(1, 2)]) == "b"


def test_taken_words_are_those_that_the_slots_read(make_docs, odd_docs):
    rows = [(k, " ".join(["w"] * n), s) for k, (n, s) in enumerate([(900, "a"), (3, "a"), (0, "a"), (70, "b"), (41, "b"), (9, "c"), (9, "c")])]
    docs = odd_docs.unionByName(make_docs([(1000 + k, t, s) for k, t, s in rows]))
    placed, slot = (d.collect() for d in mixing.plan(docs, 16))
    owner = {}
    for k, r in enumerate(placed):
        for at in range(r.start, r.start + r.size):
            assert owner.setdefault((r["rank"], at), k) == k  # no place has two documents
    read = Counter(owner[s["rank"], s.block * 16 + j] for s in slot for j in range(s.words))
    want = Counter((r.doc_id, r.size, read[k]) for k, r in enumerate(placed))
    assert Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(docs, 16).collect()) == want
    # every block of a source is read once before any is read again
    for rank in {s["rank"] for s in slot}:
        mine = sorted((s.slot, s.block, s.epoch) for s in slot if s["rank"] == rank)
        assert [m[0] for m in mine] == list(range(len(mine)))
        for epoch in {m[2] for m in mine}:
            blocks = [b for _, b, e in mine if e == epoch]
            assert len(blocks) == len(set(blocks))


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 100, 1000):
        at, size, key = np.arange(n), np.full(n, n), np.full(n, 7)
        there = mixing.permuted(at, size, key)
        assert sorted(there) == list(at) and (mixing.permuted(there, size, key, inverse=True) == at).all()


def test_quality_sees_long_words_to_their_end():
    start, rng = "漢字仮名交文" * 6, np.random.default_rng(2)
    letters = "".join(chr(0x4E00 + k) for k in rng.integers(0, 5000, 4000))
    clean, junk = start + letters, start + "!#" * 2000
    assert not np.array_equal(quality.features(clean)[0], quality.features(junk)[0])
    assert quality.features(clean)[1][-1] == -(-len(clean) // quality.SHAPE_CHARS)
    good, bad = (quality.features(" ".join(["word"] * 40 + [w]))[0] for w in (clean, junk))
    assert np.abs(good - bad).sum() > 1  # most units of the text are in the long word
    signs = ("漢" * 19 + "。") * 3000  # 5 in 100
    assert abs(quality.features(signs)[1][2] - 0.05) < 1e-9
    assert quality.features("x" * 40 + " " + "x" * 40)[1][0] == 2 / 4 and quality.features("a a b")[1][0] == 1 / 3


def test_quality_on_labelled_rows(spark, odd_docs):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r.doc_id: r.kept for r in quality.scored(docs).collect()}
    right = Counter((q, got[i]) for i, q in labels.items())
    assert right[1, True] >= 0.99 * (right[1, True] + right[1, False]) and right[0, False] >= 0.9 * (right[0, True] + right[0, False])
    odd = quality.scored(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(not r.kept for r in odd if r.doc_id in (1, 2, 3))
    assert quality.filtered(odd_docs).columns == odd_docs.columns and quality.scored(odd_docs.limit(0)).count() == 0
