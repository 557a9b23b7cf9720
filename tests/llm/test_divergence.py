"""The source divergence audit against a plain rewrite of its rules."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import divergence
from tidemark.llm.queries import op11_source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, word int, p int, tile int, value int, block int"


def brute(rows, least=3, top=200):
    docs, n = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        docs[lang or ""].update(set(words))
        n[lang or "", source or ""].update(words)
    out = []
    for lang in docs:
        kept = [w for w, c in docs[lang].items() if c >= least]
        groups = sorted(s for x, s in n if x == lang)

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10 ** 9 * (count[w] + 1) // (total + len(kept)) for w in kept}

        p = {s: shares(n[lang, s]) for s in groups}
        q = shares(sum((n[lang, s] for s in groups), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pair = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in groups if o != s]
            term = [(f(p[s][w], q[w]), w) for w in kept if n[lang, s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank + 1) for rank, (value, item) in enumerate(found)]
    return sorted(out)


def rows_of(r):
    words = [r.choice(["a", "é", "ß", "语", "Q"]) + "".join(r.choice("abxyz") for _ in range(r.randint(0, 3))) for _ in range(300)]
    rows = []
    for i in range(150):
        text = "-".join(words[min(int(r.expovariate(0.03)), 299)] for _ in range(r.randint(0, 80)))
        rows.append((i, text, r.choice(["en", "en", "de", None]), r.choice(["s1", "s1", "s2", "S3", "ö", None, "s4", "s5"])))
    rows += [(500, None, "en", "empty"), (501, "", "fr", "s1"), (502, "once only", "fr", "s2"), (503, "...", None, "s9"),
             (504, "word " * 40000, "en", "s2"), (None, "aa aa", "de", "s1"), (5, *rows[5][1:]), (5, *rows[5][1:]), (600, "x", "alone", "s")]
    return rows


@pytest.mark.parametrize("block_terms, tile_sources, held", [(8192, 64, 200_000), (20, 64, 5), (33, 2, 200_000), (64, 1, 200_000)])
def test_audit(spark, monkeypatch, block_terms, tile_sources, held):
    monkeypatch.setattr(divergence, "_ROWS_AT_ONCE", 7)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rows = rows_of(random.Random(11))
    docs = spark.createDataFrame([(i, t, x, s, 1, "t", 2, 3, 4, 5, 6) for i, t, x, s in rows], SCHEMA).repartition(3)
    got = divergence.audit(docs, 3, 9, block_terms, tile_sources).collect()
    assert sorted(tuple(x) for x in got) == brute(rows, 3, 9)


def test_joint_cells():
    """One block by itself, with counts whose shares are far apart."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(12)
    p0, terms = [3, 10 ** 7, 77], 130
    p = [[r.choice([p0[s], 5 * s + 9, 7 * 10 ** 6 - s]) for _ in range(terms)] for s in range(3)]
    sets = defaultdict(int)
    for s in range(3):
        for t in range(terms):
            if p[s][t] != p0[s]:
                sets[s, t // 64, p[s][t]] |= 1 << t % 64
    rows = [(s, -1, 0, p0[s], terms) for s in range(3)] + [(s, w, np.uint64(m).astype(np.int64), v, 0) for (s, w, v), m in sets.items()]
    r.shuffle(rows)
    cols = dict(zip(("source_no", "word", "mask", "p", "terms"), (pa.array([int(x) for x in c]) for c in zip(*rows))))
    got = divergence._joint(pa.table({"lang": ["x"] * len(rows), "tile": [0] * len(rows), **cols})).to_pylist()
    want = {(a, b): sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in range(terms)) for a in range(3) for b in range(3) if a != b}
    assert {(x["source_no"], x["other_no"]): x["value"] for x in got} == want


def test_no_rows(spark, tmp_shared):
    docs = spark.createDataFrame([], SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_shared}/documents.parquet")
    assert op11_source_divergence(spark, tmp_shared).collect() == []
