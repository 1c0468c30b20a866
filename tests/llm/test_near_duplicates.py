"""Near copies of texts and vectors, and nearest neighbours, against brute force."""

import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import components, minhash, permutation_index, vector_dedup
from tidemark.llm.components import connected_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (3, None), (7, 6)]
    got = {r.node: r.component_id for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{k: 1000 for k in range(1000, 1200)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_round_with_few_edges_writes_one_file(spark, monkeypatch):
    kept, stage = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df, label: kept.append((label, stage(df, label))) or kept[-1][1])
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = connected_components(spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long"))
        assert {r.component_id for r in found.collect()} == {0}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    rounds = [d for label, d in kept if label == "stars"]
    assert len(rounds) > 1 and {len(d.inputFiles()) for d in rounds} == {1}


def test_minhash_groups_equal_brute_force(make_docs, odd_docs):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        for k in range(rng.choice((1, 2, 5, 30))):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((family * 100 + k, " ".join(copy)))
    base = [rng.choice(words) for _ in range(150)]
    rows += [(5000 + k, " ".join(base[:20] + [f"v{k}x{j}" for j in range(k % 6)] + base[20:])) for k in range(300)]  # wider than a block
    docs = make_docs(rows)
    for n, threshold in ((3, 85), (5, 80)):
        sets = {i: _shingles(t, n) for i, t in rows}
        near = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
        want = _groups(sets, near)
        got = {r.doc_id: r for r in minhash.groups(docs, n, threshold).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    kept = minhash.deduplicated(docs, 5, 80)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(want.values())
    odd = minhash.groups(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(r.component_id == r.doc_id for r in odd if r.doc_id in (1, 2, 3, 4))
    assert minhash.groups(docs.limit(0)).count() == 0 and minhash.deduplicated(odd_docs).filter("doc_id = 5").count() == 1


def test_minhash_pairs_whose_hubs_are_strangers(make_docs, monkeypatch):
    rng = random.Random(6)
    # all documents meet in one bucket only: the bands of a crowd, without waiting for chance
    plain = minhash.sketches

    def crowded(docs, n):
        return plain(docs, n).withColumn("bands", F.when(F.col("bands").isNotNull(), F.array(F.lit(7).cast("long"))))

    monkeypatch.setattr(minhash, "sketches", crowded)
    rows = [(k, " ".join(f"s{rng.randrange(10**6)}" for _ in range(60))) for k in range(700)]
    copies = {100: 500, 200: 300, 301: 302}
    for a, b in copies.items():
        words = rows[a][1].split()
        rows[b] = (b, " ".join([*words[:-1], "other"]))
    got = {r.doc_id: r.component_id for r in minhash.groups(make_docs(rows), 3, 85).collect()}
    want = {k: k for k, _ in rows} | {b: a for a, b in copies.items()}
    assert got == want


VECTORS = "vec_id long, embedding array<float>, label int, id string"


def _vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(k, v.tolist(), k % 3, "x") for k, v in enumerate(rng.standard_normal((600, 16)))]
    centre = rng.standard_normal(16)
    rows += [(1000 + k, (centre + 0.05 * rng.standard_normal(16)).tolist(), 1, "x") for k in range(400)]  # wider than a window
    bad = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15]
    rows += [(2000 + k, v, 1, "x") for k, v in enumerate(bad)] + [(3000, rows[0][1], None, "x"), (None, rows[0][1], 0, "x"), (0, *rows[0][1:])]
    return rows, spark.createDataFrame(rows, VECTORS)


def test_vector_groups_equal_brute_force(spark):
    rows, table = _vectors(spark)
    good = {r[0]: (np.array(r[1], np.float32).astype(float), r[2]) for r in rows if r[0] is not None and r[0] < 2000}
    ids, unit = list(good), np.stack([v / np.linalg.norm(v) for v, _ in good.values()])
    labels = np.array([label for _, label in good.values()])
    linked = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    want = _groups(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(linked)), strict=True)])
    got = vector_dedup.groups(table).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id in want:
            assert (r.n_links, r.component_id) == (int(linked[ids.index(r.vec_id)].sum()), want[r.vec_id])
        else:
            assert (r.n_links, r.component_id) == (0, r.vec_id)
    assert vector_dedup.groups(table.limit(0)).count() == 0


def _by_hand(vectors, threshold=0.98):
    """Links and groups of (id, label, vector) rows by the definition, on scaled vectors."""
    distinct = sorted({(i, k, tuple(v)) for i, k, v in vectors})
    unit = [np.array(v) / np.abs(v).max() for _, _, v in distinct]
    unit = [u / np.linalg.norm(u) for u in unit]
    pairs = [
        (x, y) for x, y in combinations(range(len(distinct)), 2) if distinct[x][1] == distinct[y][1] and unit[x] @ unit[y] >= threshold
    ]
    n = [sum(x in p for p in pairs) for x in range(len(distinct))]
    root = _groups(sorted({d[0] for d in distinct}), [(distinct[x][0], distinct[y][0]) for x, y in pairs])
    return sorted((i, n[distinct.index((i, k, tuple(v)))], root[i]) for i, k, v in vectors)


def test_vectors_of_one_id_and_of_any_size(spark):
    rows = [
        (1, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (3, 0, [0.0, 1.0]), (3, 0, [0.0, 1.0]),  # different vectors of one id, a repeated row
        (10, 1, [1e-200, 1e-200]), (11, 1, [1.0, 0.1]),  # no link: cosine 0.77
        (12, 2, [1e200, 1e200]), (13, 2, [1e200, 1e200]), (14, 2, [5e-324, 5e-324]), (15, 2, [1.7e308, 1.6e308]),  # all links
        (20, 3, [1.0, 0.0]), (20, 3, [1.0, 0.01]), (21, 3, [0.0, 1.0]),
    ]
    table = spark.createDataFrame(
        [(i, v, k, "x") for i, k, v in rows] + [(30, [1.0, 0.0, 0.0], 0, "x")], "vec_id long, embedding array<double>, label int, _taken string"
    )
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_dedup.groups(table).collect())
    assert got == [*_by_hand(rows), (30, 0, 30)]


def test_nearest_vectors_of_one_id_ties_and_any_size(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [0.0, 1.0]), (3, [0.0, 1.0]), (5, [2.0, 1.0]), (4, [-2.0, 1.0]), (6, [1e200, 1e200]), (7, [-1e200, -1e200]),
            (8, [1e-300, 2e-300]), (9, [1e-300, 3e-300])]
    table = spark.createDataFrame([(i, v, None, "x") for i, v in rows] + [(2, [1.0], 0, "x")], "vec_id long, embedding array<double>, label int, _taken string")
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    want = []
    for q, a in distinct:
        away = []
        for other in distinct:
            if other != (q, a):
                d = np.abs(np.array(a) - np.array(other[1]))
                away.append((float(d.max() * np.sqrt(((d / d.max()) ** 2).sum())) if d.max() else 0.0, other[0]))
        want += [(q, k + 1, i, d) for k, (d, i) in enumerate(sorted(away)[:10])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in permutation_index.nearest(table, F.lit(True)).collect())
    by_rank = lambda rows: sorted((q, r, i) for q, r, i, _ in rows)
    assert by_rank(got) == by_rank(want)
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=1e-14, atol=0)


def test_vector_pairs_in_a_crowd(spark):
    rng = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(64))
    crowd = unit(centre * 0.95**0.5 + 0.05**0.5 * unit(rng.standard_normal((4000, 64))))
    pairs = [(k, 4000 + k) for k in range(200)]
    held = np.concatenate([crowd, unit(crowd[:200] + 0.19 * unit(rng.standard_normal((200, 64)))), rng.standard_normal((1000, 64))])
    held = held.astype(np.float32).astype(float)
    linked = unit(held) @ unit(held).T >= 0.98
    np.fill_diagonal(linked, False)
    table = spark.createDataFrame([(k, v.tolist(), 1, "x") for k, v in enumerate(held)], VECTORS)
    want = _groups(range(len(held)), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(linked)), strict=True)])
    assert sum(linked[a, b] for a, b in pairs) > 150
    got = vector_dedup.groups(table).collect()
    assert {r.vec_id: r.component_id for r in got} == want
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(linked.sum(axis=1).tolist()))


def test_nearest_recall_and_scores(spark):
    rows, table = _vectors(spark)
    good = {r[0]: np.array(r[1], np.float32).astype(float) for r in rows if r[0] is not None and r[0] < 2000 or r[0] == 3000}
    got = permutation_index.nearest(table, F.col("id") % 50 == 0).collect()
    hits = 0
    asked = [i for i in good if i % 50 == 0]
    assert {r.query_id for r in got} == set(asked)
    for q in asked:
        away = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:][::-1] for m in mine] == sorted(m[1:][::-1] for m in mine)
        assert all(abs(s - np.sqrt(((good[i] - good[q]) ** 2).sum())) < 1e-12 for _, i, s in mine)
        hits += len({i for _, i in away} & {m[1] for m in mine})
    assert hits >= 0.9 * 10 * len(asked)
    few = permutation_index.nearest(table.filter("vec_id < 4"), F.lit(True)).collect()
    assert len(few) == 12
    assert permutation_index.nearest(table.limit(0), F.lit(True)).count() == 0


def test_nearest_recall_where_vectors_share_a_direction(spark):
    rng = np.random.default_rng(8)
    shared, own = rng.standard_normal(32), rng.standard_normal((3000, 32))
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    held = (unit(shared) * 0.9**0.5 + unit(own) * 0.1**0.5).astype(np.float32).astype(float)
    table = spark.createDataFrame([(k, v.tolist(), 0, "x") for k, v in enumerate(held)], VECTORS)
    assert len(permutation_index.fit_pivots(table.selectExpr("vec_id id", "cast(embedding as array<double>) vector"))) == 256
    got = {}
    for r in permutation_index.nearest(table, F.col("id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & set(np.argsort(((held - held[q]) ** 2).sum(axis=1))[1:11].tolist())) for q in got)
    assert len(got) == 60 and hits >= 0.9 * 10 * len(got)


def test_deduplication_keeps_every_different_text(make_docs):
    texts = [(1, "a b c d e f g"), (1, "one two three four five six"), (2, "a b c d e f g"), (3, "other words that stand alone here"), (1, "a b c d e f g"), (None, "x"), (None, "x")]
    kept = [(r.doc_id, r.text) for r in minhash.deduplicated(make_docs(texts)).collect()]
    assert sorted(kept, key=str) == sorted([(1, "a b c d e f g"), (1, "one two three four five six"), (3, "other words that stand alone here"), (None, "x"), (None, "x")], key=str)
    odd = make_docs([(7, "same text of both rows", "b"), (7, "same text of both rows", "a")])
    assert [r.source for r in minhash.deduplicated(odd).collect()] == ["a"] and minhash.deduplicated(odd).columns == odd.columns


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], folder))
    for before, after in zip(seen[:4], seen[1:5], strict=True):
        assert after.columns == docs.columns
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
    texts = seen[2].collect()
    sets = {r.doc_id: _shingles(r.text, 5) for r in texts}
    assert not any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in combinations(sets, 2) if sets[a])
    assert len(texts) == len(sets) == seen[3].count()
    assert seen[5].count() == seen[4].count() and all(r.n_tokens == len(r.ids) for r in seen[5].collect())
