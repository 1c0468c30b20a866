"""Every stage of the pipeline recomputed in plain Python from the rows of the stage before, on odd rows."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import public_tokenizers
import sentencepiece
from test_near_duplicates import _groups, _shingles
from test_text_operators import ASSIGN, _entropy_spans

import corpus_pipeline
from tidemark.llm import mixing, quality, secret_scan
from tidemark.session import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sentences(rng, n):
    words = "the of house river and mountain over small green walks sings while bright morning under old trees".split()
    return ". ".join(" ".join(rng.choice(words) for _ in range(rng.randint(6, 14))).capitalize() for _ in range(n)) + "."


def _corpus(make_docs, odd_docs):
    rng = random.Random(12)
    key = "aZ3kP9xQ7vLm2RtY8sWd4BnC"
    rows = [(100 + k, _sentences(rng, rng.randint(2, 12)), "abc"[k % 3]) for k in range(60)]
    rows += [(200 + k, t + " Tail word.", s) for k, (_, t, s) in enumerate(rows[:15])]  # near copies
    rows += [(300 + k, t, s) for k, (_, t, s) in enumerate(rows[:5])] + [rows[7], rows[7]]  # exact copies, repeated rows
    rows += [(400 + k, f"{_sentences(rng, 4)} EXAMPLE_KEY={key} {_sentences(rng, 2)} password: {key}x", "a") for k in range(6)]
    rows += [(500 + k, "!!! $$$ WIN WIN WIN ### @@@ " * 20 + str(k), "b") for k in range(12)]  # junk
    rows += [(600, _sentences(rng, 3), "a"), (600, _sentences(rng, 5), "b")]  # different texts of one id
    return odd_docs.unionByName(make_docs(rows))


def _redacted(text):
    if text is None:
        return None
    base = sorted(
        [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    )
    out, at = "", 0
    for start, _, end in sorted(base + _entropy_spans(text, base)):
        if start >= at:
            out += text[at:start] + secret_scan.MARK
        at = max(at, end)
    return out + text[at:]


def _texts(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_every_stage_equals_plain_python(spark, make_docs, odd_docs):
    folder = new_path(spark, "corpus")
    _corpus(make_docs, odd_docs).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = new_path(spark, "stage")
        stage(spark, seen[-1], folder).write.parquet(path)
        seen.append(spark.read.parquet(path))
    rows = [d.collect() for d in seen]
    assert all(d.columns == docs.columns for d in seen[:5])

    model = quality.fit(docs)
    assert Counter(rows[1]) == Counter(r for r in rows[0] if model.score(r.text) >= quality.KEEP)
    assert not any(500 <= (r.doc_id or 0) < 512 for r in rows[1]) and sum(100 <= (r.doc_id or 0) < 160 for r in rows[1]) >= 60

    sets = {}
    for r in rows[1]:
        if r.doc_id is not None:
            sets.setdefault((r.doc_id, frozenset(_shingles(r.text, 5))), None)
    linked = [(a[0], b[0]) for a, b in combinations(sets, 2) if a[1] and 100 * len(a[1] & b[1]) >= 80 * len(a[1] | b[1])]
    root = _groups(sorted({i for i, _ in sets}), linked)
    kept = {(r.doc_id, r.text) for r in rows[1] if r.doc_id is not None and root[r.doc_id] == r.doc_id}
    assert _texts(rows[2]) == Counter(kept) + Counter((None, r.text) for r in rows[1] if r.doc_id is None)

    assert _texts(rows[3]) == Counter((r.doc_id, _redacted(r.text)) for r in rows[2])
    assert not any("aZ3kP9xQ7vLm2RtY8sWd4BnC" in (r.text or "") for r in rows[3])

    # every word of a source is read as often as the slots read its place
    placed, slot = (d.collect() for d in mixing.plan(seen[3]))
    per_source = Counter()
    for s in slot:
        per_source[s["rank"]] += s.words
    goal = {r["rank"]: r.target for r in placed}
    assert all(abs(per_source[k] - goal[k]) <= 1 for k in goal if goal[k])
    assert sum(len(WORD.findall(r.text)) for r in rows[4]) == sum(per_source.values())
    held = {i for i, _ in _texts(rows[3])}
    assert {r.doc_id for r in rows[4]} <= held

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for r in rows[4]:
        ids = library.encode(r.text or "")
        want[r.doc_id, len(ids), tuple(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in rows[5]) == want
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()) == Counter((w[0], w[1], w[2]) for w in want.elements())


def test_an_empty_table_passes_through(spark, odd_docs):
    folder = new_path(spark, "corpus")
    odd_docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
