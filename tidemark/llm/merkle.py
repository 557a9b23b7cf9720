"""A Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf.  The leaves of one tree (a language, say) stand in a fixed
order, and as long as a level has more than one node every two neighbours
become one node of the next; the last of an odd level is hashed alone.  The
subroots of the trees are the leaves of one more tree, whose top is the root.

Building goes by blocks: 2^``BLOCK_BITS`` neighbouring nodes are an aligned
subtree that one task hashes in one go, and the tops of the blocks are the
nodes of the next tier, until every tree has one node.

Proofs are made for whole leaf partitions (the wanted leaves of one block).
Each partition works out the minimal union of coordinates that its leaves need
and cannot derive themselves, all of them are fetched in one join, shared
interior nodes are derived once, and the proof of each leaf is read off the
partition's own nodes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A block holds 2^BLOCK_BITS neighbouring nodes.
BLOCK_BITS = 12

_NODE = "tree string, level int, pos long, n long, digest binary"
#: Low bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33


def field_text(value: Column) -> Column:
    """``-`` for null, otherwise UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(v) for v in values]).cast("binary"), 256))


def tree_key(value: Column) -> Column:
    """A key without nulls that sorts like ``value``, null first."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value.cast("string")))


def parent(*children: str) -> str:
    return sha256("".join(children).encode()).hexdigest()


def placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` plus ``pos``, the place in its tree in this order from 0, and ``n``, the tree's leaves.

    Rows are dealt by range and sorted within partitions; the only thing counted
    across partitions is one number per (tree, partition).  A row number goes
    last into the range key, so equal rows do not meet in one partition.
    """
    keys = ["tree", *order, "__salt"]
    runs = written(rows.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(*keys)
                   .sortWithinPartitions(*keys).drop("__salt").withColumn("__at", F.monotonically_increasing_id()), f"{name}-runs")
    runs = runs.withColumn("__part", F.shiftright("__at", _ROW_BITS))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.groupBy("tree", "__part").agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    offsets = offsets.select("tree", "__part", (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
                             F.sum("__rows").over(tree).alias("n"))
    return written(runs.join(offsets, ["tree", "__part"])
                   .select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "n"), f"{name}-placed")


def _climb(bits: int, level: int):
    """Arrow function: the inner nodes above one block of nodes of ``level``."""
    def run(block: pa.Table) -> pa.Table:
        pos, n = block["pos"].to_numpy(), block["n"][0].as_py()
        order = np.argsort(pos)
        first = int(pos[order[0]])
        held = block["digest"].to_pylist()
        nodes = [held[i].hex() for i in order]
        out = {"level": [], "pos": [], "n": [], "digest": []}
        for step in range(1, bits + 1):
            if n == 1:
                break
            nodes, first, n = [parent(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)], first >> 1, (n + 1) >> 1
            out["level"] += [level + step] * len(nodes)
            out["pos"] += range(first, first + len(nodes))
            out["n"] += [n] * len(nodes)
            out["digest"] += [bytes.fromhex(d) for d in nodes]
        return pa.table({"tree": pa.array([block["tree"][0].as_py()] * len(out["pos"]), pa.string()),
                         "level": pa.array(out["level"], pa.int32()), "pos": pa.array(out["pos"], pa.int64()),
                         "n": pa.array(out["n"], pa.int64()), "digest": pa.array(out["digest"], pa.binary())})

    return run


def all_nodes(leaves: DataFrame, name: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Every node of every tree: tree, level, pos, n (nodes of that level), digest.

    ``leaves``: tree, pos, n, digest.  One pass per tier of ``bits`` levels.
    """
    at = leaves.select("tree", F.lit(0).alias("level"), "pos", "n", "digest")
    found, tier, level = at, at.where("n > 1"), 0
    while not tier.isEmpty():
        blocks = tier.withColumn("block", F.shiftright("pos", bits)).groupBy("tree", "block")
        above = written(blocks.applyInArrow(_climb(bits, level), _NODE), f"{name}-tier")
        found, level = found.unionByName(above), level + bits
        tier = above.where((F.col("level") == level) & (F.col("n") > 1))
    return found


@dataclass
class Manifest:
    """``leaves``: tree, pos, n, digest and the rows' own columns; ``nodes``, ``forest``: see :func:`all_nodes`;
    ``trees``: tree, pos and n in the forest, digest (the subroot).  The root is the forest's node with n = 1."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    forest: DataFrame


def build(leaves: DataFrame, order: Sequence[str], bits: int = BLOCK_BITS) -> Manifest:
    """Manifest of ``leaves`` (tree, digest, columns to order by and any others)."""
    leaves = placed(leaves, [*order, "digest"], "merkle")
    nodes = all_nodes(leaves, "merkle", bits)
    tops = nodes.where("n = 1").select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    trees = placed(tops, ["of"], "merkle-forest")
    return Manifest(leaves, nodes, trees, all_nodes(trees, "merkle-forest", bits))


def missing_nodes(positions: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(levels, positions)`` of the nodes that the proofs of these leaves need and that do not follow from them."""
    levels, found, level = [], [], 0
    here = np.unique(positions)
    while n > 1:
        sibling = here ^ 1
        need = sibling[(sibling < n) & ~np.isin(sibling, here)]
        levels.append(np.full(len(need), level, dtype=np.int32))
        found.append(need)
        here, n, level = np.unique(here >> 1), (n + 1) >> 1, level + 1
    if not found:
        return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
    return np.concatenate(levels), np.concatenate(found)


def _ask(wanted: pa.Table) -> pa.Table:
    levels, pos = missing_nodes(wanted["pos"].to_numpy(), wanted["n"][0].as_py())
    same = lambda c: pa.array([wanted[c][0].as_py()] * len(pos), wanted.schema.field(c).type)
    return pa.table({"tree": same("tree"), "block": same("block"), "level": pa.array(levels), "pos": pa.array(pos)})


def derived(positions: Sequence[int], digests: Sequence[str], n: int, fetched: dict[tuple[int, int], str]) -> list[dict[int, str]]:
    """Per level the known nodes by position: those given, those fetched and those that follow."""
    own, known, level = dict(zip(positions, digests)), [], 0
    while True:
        here = own | {p: d for (at, p), d in fetched.items() if at == level}
        known.append(here)
        if n == 1:
            return known
        own = {p: parent(*[here[c] for c in (2 * p, 2 * p + 1) if c < n]) for p in {c >> 1 for c in own}}
        n, level = (n + 1) >> 1, level + 1


def folded(digest: str, pos: int, n: int, known: Sequence[dict[int, str]]) -> str:
    """The top that a leaf and its siblings give."""
    for level in range(len(known) - 1):
        sibling = known[level].get(pos ^ 1) if pos ^ 1 < n else None
        digest = parent(*([digest] if sibling is None else [digest, sibling] if pos % 2 == 0 else [sibling, digest]))
        pos, n = pos >> 1, (n + 1) >> 1
    return digest


def _expand(wanted: pa.Table, fetched: pa.Table) -> pa.Table:
    """Proofs of one leaf partition; ``fetched`` has its nodes and those of its tree in the forest."""
    n = wanted["n"][0].as_py()
    inner, outer, top = {}, {}, {}
    for forest, level, pos, count, digest in zip(*(fetched[c].to_pylist() for c in ("forest", "level", "pos", "n", "digest"))):
        if not forest:
            inner[level, pos] = digest.hex()
        elif level >= 0:
            outer[level, pos] = digest.hex()
        else:  # -1: the subroot and its place, -2: the root
            top[level] = pos, count, digest.hex()
    place, trees, subroot = top[-1]
    root = top[-2][2]
    pos = wanted["pos"].to_pylist()
    leaf = [d.hex() for d in wanted["digest"].to_pylist()]
    claim = [d.hex() for d in wanted["claim"].to_pylist()]
    known = derived(pos, leaf, n, inner)
    above = derived([place], [known[-1][0]], trees, outer)
    whole = above[-1][0]  # the root as it follows from these leaves and the fetched nodes
    tail = [s for level, here in enumerate(above[:-1]) if (s := here.get((place >> level) ^ 1)) is not None]
    levels = list(enumerate(known[:-1]))
    proof, roots = [], []
    for p, own, claimed in zip(pos, leaf, claim):
        proof.append([s for level, here in levels if (s := here.get((p >> level) ^ 1)) is not None] + tail)
        roots.append(whole if claimed == own else folded(folded(claimed, p, n, known), place, trees, above))
    size = len(pos)
    out = {"leaf": pa.array(leaf), "subroot": pa.array([subroot] * size), "root": pa.array([root] * size),
           "proof": pa.array(proof, pa.list_(pa.string())), "folded_root": pa.array(roots)}
    return pa.table({"doc_id": wanted["doc_id"], "pos": wanted["pos"], **out})


def multiproofs(manifest: Manifest, wanted: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Proofs of some or all leaves.

    ``wanted``: rows of ``manifest.leaves`` with doc_id and ``claim``, the leaf
    digest to be checked.  Returns per row doc_id, pos, leaf, subroot and root
    as built, proof (sibling digests up to the root, left out where there is
    none) and folded_root, what claim and proof give; all digests in hex.
    """
    wanted = wanted.withColumn("block", F.shiftright("pos", bits))
    id_type = wanted.schema["doc_id"].dataType.simpleString()
    ask = "tree string, block long, level int, pos long"
    inner = wanted.select("tree", "block", "pos", "n").groupBy("tree", "block").applyInArrow(_ask, ask) \
        .join(manifest.nodes, ["tree", "level", "pos"]) \
        .select("tree", "block", F.lit(False).alias("forest"), "level", "pos", "n", "digest")
    # the same for each tree's place in the forest, one row per tree and level
    trees = manifest.trees.withColumn("block", F.col("pos"))
    outer = trees.select("tree", "block", "pos", "n").groupBy("tree", "block").applyInArrow(_ask, ask) \
        .join(manifest.forest, ["tree", "level", "pos"]).select("block", "level", "pos", "n", "digest")
    root = manifest.forest.where("n = 1").first()  # one digest; no row in an empty manifest
    place = trees.select("of", F.col("pos").alias("block"))
    of_tree = trees.select("of", F.lit(-1).alias("level"), "pos", "n", "digest") \
        .unionByName(place.join(outer, "block").drop("block")) \
        .unionByName(place.select("of", F.lit(-2).alias("level"), F.lit(0).cast("long").alias("pos"), F.lit(1).cast("long").alias("n"),
                                  F.lit(root.digest if root else b"").cast("binary").alias("digest")))
    of_tree = written(of_tree.withColumnRenamed("of", "tree").withColumn("forest", F.lit(True)), "merkle-of-tree")
    fetched = inner.unionByName(wanted.select("tree", "block").distinct().join(of_tree, "tree"))
    out = f"doc_id {id_type}, pos long, leaf string, subroot string, root string, proof array<string>, folded_root string"
    return wanted.select("tree", "block", "doc_id", "pos", "n", "digest", "claim").groupBy("tree", "block") \
        .cogroup(written(fetched, "merkle-fetched").groupBy("tree", "block")).applyInArrow(_expand, out)


def manifest_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaves of documents: tree (by lang), doc_id, digest, claim.

    The claim is the digest itself, or for ``tampered`` rows that of the row
    with 1 added to n_chars.
    """
    own = [F.col(c) for c in FIELDS]
    changed = [F.col(c).cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    rows = docs.select(tree_key(F.col("lang")).alias("tree"), "doc_id", leaf_digest(own).alias("digest"),
                       F.when(tampered, leaf_digest(changed)).alias("claim"))
    return written(rows.withColumn("claim", F.coalesce("claim", "digest")), "merkle-leaves")


def audit(docs: DataFrame, tampered: Column, bits: int = BLOCK_BITS) -> DataFrame:
    """Per document what :func:`multiproofs` returns, with ``tampered`` documents claiming a changed row.

    Cases: leaves of a tree stand by doc_id, null first, rows of equal doc_id
    by digest; a null lang is a tree of its own, the first; null fields count
    as ``-``; a null n_chars stays null when tampered; equal rows are leaves of
    their own; a tree of one leaf is that leaf; an empty table gives no rows;
    other columns are ignored.
    """
    manifest = build(manifest_leaves(docs, F.coalesce(tampered, F.lit(False))), ["doc_id"], bits)
    return multiproofs(manifest, manifest.leaves, bits)
