"""The Merkle manifest against a plain rewrite of its rules."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.queries import op13_merkle_manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int, digest string, level int"


def h(x):
    return sha256(x.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def climb(nodes, at, digest):
    """(top, siblings of the leaf at ``at``, top as folded from ``digest``)"""
    siblings = []
    while len(nodes) > 1:
        pair = nodes[at - at % 2:at - at % 2 + 2]
        other = pair[:at % 2] + pair[at % 2 + 1:]
        siblings += other
        digest = h("".join(other[:at % 2] + [digest] + other[at % 2:]))
        nodes, at = [h("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)], at // 2
    return nodes[0], siblings, digest


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for rs in trees.values():
        rs.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    subroots = [climb([leaf_of(r) for r in trees[x]], 0, "")[0] for x in langs]
    for q, x in enumerate(langs):
        leaves = [leaf_of(r) for r in trees[x]]
        for at, row in enumerate(trees[x]):
            bad = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None
            claim = leaf_of(row | {"n_chars": row["n_chars"] + 1}) if bad else leaves[at]
            subroot, inner, folded = climb(leaves, at, claim)
            root, outer, folded = climb(subroots, q, folded)
            yield (row["doc_id"], leaves[at], subroot, root, h("".join(inner + outer)), folded, folded == root)


def table(spark, rows):
    return spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "t", 1, "d", 2) for r in rows], SCHEMA)


def row(i, lang, text="x", source="s", n_chars=1):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": n_chars}


ROWS = [row(i, ["en", "Ünï", "zz", None][min(i % 7, 3) if i % 5 else 0], f"té {i}", f"s{i % 3}", i) for i in range(75)]
ROWS += [row(5, "en", None, None, None)] * 3 + [row(None, "en", ""), row(None, None, None, None, None), row(300, "", "long " * 90000),
                                                 row(301, "=x"), row(5, "en", "other")]


@pytest.mark.parametrize("bits", [1, 2, 3, 12])
def test_audit(spark, bits):
    docs = table(spark, ROWS).repartition(5)
    got = merkle.audit(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, bits).collect()
    seen = [(x.doc_id, x.leaf, x.subroot, x.root, h("".join(x.proof)), x.folded_root, x.folded_root == x.root) for x in got]
    assert sorted(seen, key=str) == sorted(brute(ROWS), key=str)
    assert {x[-1] for x in seen} == {True, False}


def test_some_leaves(spark):
    """Proofs of a part of the leaves are those that they have among all."""
    docs = table(spark, ROWS)
    manifest = merkle.build(merkle.manifest_leaves(docs, F.lit(False)), ["doc_id"], 2)
    some = merkle.multiproofs(manifest, manifest.leaves.where("doc_id % 3 = 1"), 2).collect()
    want = {x[0]: x[4] for x in brute([r | {"n_chars": r["n_chars"]} for r in ROWS])}
    assert {x.doc_id for x in some} == {i for i in want if i is not None and i % 3 == 1}
    assert all(h("".join(x.proof)) == want[x.doc_id] and x.folded_root == x.root for x in some)


def test_missing_nodes():
    for n in range(1, 20):
        for mask in range(1, 1 << min(n, 8)):
            have = [i for i in range(n) if mask >> i & 1]
            nodes = [{i: str(i) for i in range(n)}]
            size = n
            while size > 1:
                nodes.append({p: merkle.parent(*[nodes[-1][c] for c in (2 * p, 2 * p + 1) if c < size]) for p in range((size + 1) // 2)})
                size = (size + 1) // 2
            levels, pos = merkle.missing_nodes(np.array(have), n)
            need = set(zip(levels.tolist(), pos.tolist()))
            known = merkle.derived(have, [str(i) for i in have], n, {x: nodes[x[0]][x[1]] for x in need})
            assert known[-1] == nodes[-1]
            for left_out in need:  # none is superfluous
                with pytest.raises(KeyError):
                    merkle.derived(have, [str(i) for i in have], n, {x: nodes[x[0]][x[1]] for x in need - {left_out}})


def test_no_rows(spark, tmp_shared):
    table(spark, ROWS[:0]).select(*FIELDS).write.parquet(f"{tmp_shared}/documents.parquet")
    assert op13_merkle_manifest(spark, tmp_shared).collect() == []
    table(spark, ROWS[:1]).select(*FIELDS).write.parquet(f"{tmp_shared}/one/documents.parquet")
    x = op13_merkle_manifest(spark, f"{tmp_shared}/one").first()
    assert (x.leaf, x.proof_sha256) == (x.root, h("")) and x.subroot == x.leaf
