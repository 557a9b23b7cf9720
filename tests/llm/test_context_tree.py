"""Context-tree weighting against a plain recursive one, base scores against plain counting."""

import math
import random
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from tidemark.llm import context_tree
from tidemark.llm.queries import op12_lm_score


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def line(text, depth):
    return [0xFE] * depth + list(lower(text).encode()) + [0xFF]


def brute_tree(rows, depth):
    """{doc: log10 probability} by the definition: a prediction is a ratio of weighted probabilities at the root."""
    count = defaultdict(lambda: [0, 0])  # (context, most recent byte first; bits so far) -> times 0 and 1 came
    children = defaultdict(set)

    def decisions(x):
        for i in range(depth, len(x)):
            for k in range(8):
                yield tuple(x[i - 1 - d] for d in range(depth)), (1 << k) | (x[i] >> (8 - k)), (x[i] >> (7 - k)) & 1

    for _, text, train in rows:
        for context, bits, bit in decisions(line(text, depth)) if train else ():
            for d in range(depth + 1):
                count[context[:d], bits][bit] += 1
                if d:
                    children[context[:d - 1], bits].add(context[:d])

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(context, bits, path, bit):
        """Log weighted probability of the node with, on ``path``, one more ``bit``."""
        a, b = count.get((context, bits), (0, 0))
        on = path[:len(context)] == context
        own = estimate(a + (on and bit == 0), b + (on and bit == 1))
        if len(context) == depth:
            return own
        nodes = set(children.get((context, bits), ()))
        if on and bit is not None:
            nodes.add(path[:len(context) + 1])
        below = sum(weighted(c, bits, path, bit) if c == path[:len(c)] else plain(c, bits) for c in nodes)
        return np.logaddexp(own, below) - math.log(2)

    @lru_cache(None)
    def plain(context, bits):
        return weighted(context, bits, (None,), None)

    @lru_cache(None)
    def predicted(path, bits, bit):
        before = weighted((), bits, path, None)
        return (weighted((), bits, path, bit) - before) / math.log(10)

    return [sum(predicted(*x) for x in decisions(line(text, depth))) for _, text, _ in rows]


def brute_base(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for _, t, _ in rows]
    c = Counter(w for ws, (_, _, train) in zip(words, rows) if train for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for ws in words]


def table(spark, rows):
    return spark.createDataFrame([(i, t, x, "en", 1, 2, "w", 3.0) for i, t, x in rows],
                                 "doc_id long, text string, learn boolean, lang string, n int, gram long, word string, score double")


def rows_of(r):
    words = ["".join(r.choice("abé语X") for _ in range(r.randint(1, 4))) for _ in range(12)]
    rows = [(i, r.choice([" ", "\n"]).join(r.choice(words) for _ in range(r.randint(0, 9))), i % 3 != 1) for i in range(24)]
    return rows + [(50, None, True), (51, "", False), (52, " \t", True), (53, "unseen Zq", False), (None, "ab", True),
                   (4, *rows[4][1:]), (4, *rows[4][1:]), (54, "ab " * 300, True), (55, "x", None)]


@pytest.mark.parametrize("depth, chunk_bytes, held", [(4, 1 << 25, 1 << 22), (2, 40, 10), (3, 200, 50), (7, 1 << 25, 1 << 22)])
def test_scores(spark, monkeypatch, depth, chunk_bytes, held):
    monkeypatch.setattr(context_tree, "_HELD", held)
    rows = rows_of(random.Random(depth))
    got = context_tree.score_texts(table(spark, rows).repartition(3), spark_col("learn"), depth, chunk_bytes).collect()
    seen = sorted(((x.doc_id or -1, x.train, x.n_bytes, x.n_tokens, x.n_known, x.train_tokens), x.base_score, x.score) for x in got)
    rows = [(i, t, bool(x)) for i, t, x in rows]
    want = sorted(((i or -1, x, len(lower(t).encode()), *base[:3]), base[3], score) for (i, t, x), base, score
                  in zip(rows, brute_base(rows), brute_tree(rows, depth)))
    assert [x[0] for x in seen] == [x[0] for x in want]
    assert [x[1] for x in seen] == pytest.approx([x[1] for x in want], rel=1e-9)
    assert [x[2] for x in seen] == pytest.approx([x[2] for x in want], rel=1e-6)


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_probabilities_add_up():
    """Over the 256 possible next bytes of any context, seen or not."""
    r = np.random.default_rng(3)
    gram = np.unique(r.integers(0, 3, (400, 4)).astype(np.uint64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], np.uint64))
    levels = [context_tree.leaves(gram, r.integers(1, 50, len(gram)))]
    for _ in range(3):
        levels.append(context_tree.above(levels[-1]))
    for context in (0x000102, 0x010101, 0x090909, 0x020009):
        every = (np.uint64(context) << np.uint64(8)) + np.arange(256, dtype=np.uint64)
        assert (10 ** context_tree.log_probability(every, levels[::-1])).sum() == pytest.approx(1)


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 40, 0.5), [1e3, 12345.5, 1e9]])
    assert context_tree.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-10)


def test_nothing_to_learn_from(spark):
    got = context_tree.score_texts(table(spark, [(1, "ab c", False), (2, None, None)]), spark_col("learn")).orderBy("doc_id").collect()
    assert [(x.n_tokens, x.n_known, x.train_tokens) for x in got] == [(3, 0, 0), (1, 0, 0)]
    assert [x.score for x in got] == pytest.approx([-5 * math.log10(256), -math.log10(256)]) and got[0].base_score == 0.0


def test_no_rows(spark, tmp_shared):
    docs = table(spark, []).select("doc_id", "text", "lang")
    docs.write.parquet(f"{tmp_shared}/documents.parquet")
    assert op12_lm_score(spark, tmp_shared).collect() == []
