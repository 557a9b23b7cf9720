"""The corpus pipeline, stage by stage, on a small documents table."""

import random

import corpus_pipeline
from .test_ngram_join import brute


def test_stages(spark, tmp_path, words):
    r = random.Random(11)
    item = " ".join(words(20))
    base = [" ".join(words(60)) for _ in range(12)]
    rows = [(i, t, "en", "s1") for i, t in enumerate(base)]
    rows += [(20, base[0], "en", "s1"), (21, base[1] + " tail", "en", "s2"), (22, base[2] + "\n" + base[3], "en", "s2"),
             (30, item + " and more", "en", "s2"), (31, " ".join(words(700)) + " " + item, "en", None),
             (40, "12 34 !!", "en", "s1"), (41, None, "en", "s1"), (42, "", None, "s1")]
    r.shuffle(rows)
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[:5] == docs.columns
        before, docs = docs, spark.createDataFrame(out.collect(), out.schema)
        kept.append({x.doc_id: x.text for x in docs.collect()})
        if name == "ngram_jaccard_join":
            groups = brute([(x.doc_id, x.text) for x in before.collect()], 5, 80, 100)
            assert set(kept[-1]) == {i for i, (_, c) in groups.items() if i == c}
    ids = [set(k) for k in kept]
    assert set(range(12)) <= ids[0] and not {40, 41, 42} & ids[0]
    assert 20 not in ids[1] and 22 not in ids[1]  # nothing is left of them
    assert 21 not in ids[2] and 30 not in ids[3]
    assert item not in kept[3][31] and set(range(12)) <= ids[3]
    assert all(x.copies in (1, 2) and x.n_chars == len(x.text) for x in docs.collect())


def test_rows_of_one_doc_id_are_decided_one_by_one(spark, tmp_path, words):
    a, b, c, d, e = (" ".join(words(80)) for _ in range(5))
    rows = [(1, a, "s1"), (1, b, "s1"), (2, a + " tail", "s1"), (3, b + " tail", "s1"), (5, c, "s2"), (5, c, "s1"), (5, c, "s1"),
            (6, a, "s1"), (6, d, "s1"), (7, e, "s1"), (None, a, "s1"), (None, a, "s1"), (8, None, "s1"), (8, "", "s1")]
    want = [(1, a, "s1"), (1, b, "s1"), (5, c, "s1"), (6, d, "s1"), (7, e, "s1"), (8, None, "s1"), (8, "", "s1")]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        out = corpus_pipeline.join_near_copies(spark, docs, str(tmp_path)).collect()
        assert sorted(map(tuple, out), key=str) == sorted(want + [(None, a, "s1")] * 2, key=str)
