"""N-gram Jaccard join against brute force."""

import random
import re

import pytest

from tidemark.llm import ngram_join


def brute(rows, k, num, den):
    sets, ids = {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
        ids[i] = i
    keys = sorted(k for k in sets if sets[k] and k is not None)
    linked = True
    pairs = [(a, b) for x, a in enumerate(keys) for b in keys[x + 1:]
             if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    while linked:
        linked = False
        for a, b in pairs:
            if ids[a] != ids[b]:
                ids[a] = ids[b] = min(ids[a], ids[b])
                linked = True
    return {i: (len(sets[i]), ids[i]) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.fixture
def copies(words):
    """Families of near copies of one size, some by swaps in a common tail, and unrelated texts."""
    r = random.Random(3)
    rows = []
    for family in range(6):
        base = words(60 + 10 * family)
        for _ in range(25):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                text[r.randrange(len(text))] = r.choice(["same", "other", "third"])
            rows.append(" ".join(text))
    rows += [" ".join(words(r.randint(1, 40))) for _ in range(60)]
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (1, 60, 100)])
def test_matches_brute_force(spark, docs_of, copies, monkeypatch, k, num, den):
    monkeypatch.setattr(ngram_join, "WINDOW", 2)
    monkeypatch.setattr(ngram_join, "GROWTH", 4)
    assert result(ngram_join.jaccard_classes(docs_of(copies), k, num, den)) == brute(copies, k, num, den)


def test_crowded_groups(spark, docs_of, monkeypatch):
    """Sets of one size with one prefix that differ behind it."""
    r = random.Random(9)
    common = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        tail = r.sample(common, 30)
        rows.append((i, " ".join(["p1", "p2", "p3", "p4", "p5", "p6", "p7"] + sorted(tail))))
    monkeypatch.setattr(ngram_join, "WINDOW", 2)
    monkeypatch.setattr(ngram_join, "GROWTH", 4)
    low = {f"p{i}" for i in range(1, 8)}
    import numpy as np

    from tidemark.llm.words import hash_word, mix, _STEPS
    levels = np.full(1 << ngram_join.COUNT_BITS, 9, dtype=np.uint8)
    for w in low:
        h = mix(np.array([hash_word(w)], dtype=np.uint64) * _STEPS[0] + np.uint64(1))
        levels[ngram_join._bucket(h)] = 0
    monkeypatch.setattr(ngram_join, "shingle_levels", lambda docs, k: levels)
    # prefix of 37 - ceil(.83 * 37) + 1 = 7 shingles: all documents are one group
    rows += [(100 + i, " ".join(f"p{j}" for j in range(1, 8)) + " " + " ".join(common[i:i + 30])) for i in range(40)]
    got = result(ngram_join.jaccard_classes(docs_of(rows), 1, 83, 100))
    assert got == brute(rows, 1, 83, 100)


def test_cases(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (6, "a b c"), (7, "x " * 30000), (8, "x " * 30001),
            (9, "à É"), (9, "à É")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(docs_of(rows), 4, 85, 100).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 7), (9, 1, 9), (9, 1, 9)]
    null = docs_of([(None, "a b c d e"), (5, "a b c d e"), (6, "a b c d e")])
    assert sorted(((r.doc_id, r.component_id) for r in ngram_join.jaccard_classes(null, 4, 85, 100).collect()),
                  key=str) == [(5, 5), (6, 5), (None, None)]
    assert ngram_join.jaccard_classes(docs_of([]), 4, 85, 100).collect() == []


def test_bitmaps_bound_the_intersection():
    """Never below the true intersection, also where the bitmaps differ in size; close to it for similar sets."""
    import numpy as np

    r = np.random.default_rng(5)
    for n, m, both in [(0, 0, 0), (1, 1, 0), (1, 1, 1), (16, 17, 15), (17, 16, 16), (250, 260, 180), (700, 700, 560),
                       (1024, 1025, 1000), (2000, 3, 2)]:
        h = r.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
        x, y = np.sort(h[:n]), np.sort(h[n - both:])
        most = ngram_join._most_shared(n, ngram_join._bitmap(x), m, ngram_join._bitmap(y))
        assert both <= most <= min(n, m)
        assert most <= both + 0.3 * (min(n, m) - both) + 2


def test_only_similar_texts_are_compared(spark, docs_of, words, monkeypatch):
    """Documents that share half of their text are candidates, but their texts are not sent to be compared."""
    near = words(120)
    rows = [(1, " ".join(near)), (2, " ".join([*near[:119], "other"]))]
    common = words(60)
    rows += [(10 + i, " ".join(common + words(60))) for i in range(30)]
    asked = []
    wanted = ngram_join._wanted
    monkeypatch.setattr(ngram_join, "_wanted", lambda docs, pairs: asked.append(pairs.count()) or wanted(docs, pairs))
    # all shingles at one level: the order, and so the prefix, is that of the hashes
    import numpy as np
    monkeypatch.setattr(ngram_join, "shingle_levels", lambda docs, k: np.zeros(1 << ngram_join.COUNT_BITS, dtype=np.uint8))
    assert result(ngram_join.jaccard_classes(docs_of(rows), 4, 85, 100)) == brute(rows, 4, 85, 100)
    assert asked[0] > 20 and asked[1] == 1


def test_sieve_passes_few_rows_where_many_are_wanted(spark, monkeypatch):
    """As many wanted values as there are coarse keys: nothing wanted is lost, few others pass, both calls give all rows."""
    from tidemark.llm import scratch

    monkeypatch.setattr(scratch, "COARSE_KEYS", 256)
    rows = spark.range(6000).selectExpr("if(id = 0, null, id) as id", "id as row")
    wanted = spark.range(6000).where("id % 20 = 1").selectExpr("if(id = 1, null, id) as w").union(spark.range(21, 22))
    kept = {r.row for r in scratch.sifted(rows, "id", wanted, "w").collect()}
    gone = {r.row for r in scratch.sifted(rows, "id", wanted, "w", keep=False).collect()}
    assert {i for i in range(6000) if i % 20 == 1 and i != 1} <= kept and len(kept) < 600
    assert not kept & gone and kept | gone == set(range(6000))
    assert scratch.thinned(rows, "id", wanted, "w").count() > 3000
