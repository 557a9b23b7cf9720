"""How sources of one language differ in their terms (count-level bitmaps).

A group is a (lang, source).  Its kept terms are stored as bitsets of term ids,
one for each count that terms have in the group.  The joint cells of two groups
(how many terms have count a here and b there) are the popcounts of the ANDs of
their bitsets; each cell is multiplied by the divergence of its two counts.
Terms that a group lacks are in no bitset: their cells are the complement.

Term ids are dealt into blocks by hash, so that a block's bitsets of all groups
fit one task whatever the vocabulary; within a block they go by falling
frequency, so that terms of like counts share a 64-bit word.  Sources are dealt
into tiles, and a task takes one block of two tiles.  All arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import written
from tidemark.llm.words import spelled, split_words, text_slices

#: True for bytes of a term ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, after lower-casing A-Z.
LETTER = np.zeros(256, dtype=bool)
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True

#: A kept term is in at least so many documents of its language.
LEAST_DOCS = 3
#: Whole parts of a probability.
SCALE = 1_000_000_000
#: Terms of a block on average, sources of a tile.
BLOCK_TERMS, TILE_SOURCES = 8192, 64
#: Terms reported per group.
TOP_TERMS = 200
#: Counts of (group, term) that a counting task holds before it sums them up and passes them on.
HELD_TERMS = 300_000
#: Bitset words of one side that are ANDed with all others at a time.
_ROWS_AT_ONCE = 256


def _summed(parts: list[tuple], names: list[tuple[str, str]]) -> pa.RecordBatch:
    """One row per (group, term) of the counts of several slices."""
    group, h, n, docs = (np.concatenate(x) for x in list(zip(*parts))[:4])
    terms = pa.chunked_array([x[4] for x in parts])
    order = np.lexsort((h, group))
    first = np.flatnonzero(np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(group[order]) != 0)]))
    langs, sources = (pa.array(x) for x in zip(*names))
    of = group[order][first]
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(of)), sources.take(pa.array(of)), terms.take(pa.array(order[first])).combine_chunks().cast(pa.string()),
         pa.array(np.add.reduceat(n[order], first)), pa.array(np.add.reduceat(docs[order], first))],
        ["lang", "source", "term", "n", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        known = {g: x for x, g in enumerate(dict.fromkeys(groups))}
        names, k = list(known), len(known)
        group_of = np.array([known[g] for g in groups])
        zero = np.zeros(k, dtype=np.int64)  # a group counts without terms too
        parts = [(np.arange(k), zero.astype(np.uint64), zero, zero, pa.array([""] * k, pa.large_string()))]
        for i, j, data, bounds in text_slices(batch.column(0)):
            words = split_words(data, bounds, LETTER)
            if not len(words.starts):
                continue
            unique, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
            in_doc, times = np.unique(words.text_of() * len(unique) + which, return_counts=True)
            doc, term = np.divmod(in_doc, len(unique))
            key = group_of[i + doc] * len(unique) + term
            order = np.argsort(key)
            at = np.flatnonzero(np.diff(key[order], prepend=-1))
            group, term = np.divmod(key[order][at], len(unique))
            parts.append((group, unique[term], np.add.reduceat(times[order], at), np.diff(at, append=len(key)),
                          spelled(words, first[term])))
            if sum(len(x[0]) for x in parts) > HELD_TERMS:
                yield _summed(parts, names)
                parts = []
        if parts:
            yield _summed(parts, names)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); a row with an empty term for each group."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counted = docs.select(text("text"), text("lang"), text("source")) \
        .mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + terms))``, exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", (wide(n) + 1) * F.lit(SCALE).cast("decimal(10,0)"),
                                                   F.greatest(wide(total) + wide(terms), F.lit(1).cast("decimal(21,0)")))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _joint(block: pa.Table) -> pa.Table:
    """Divergences of all pairs of sources over one block of terms.

    Rows with word -1 name the sources: ``p`` is what a count of 0 gives, and
    ``terms`` the number of terms of the block.  The others are 64-bit words of the bitsets: ``p`` is what the bitset's count gives.
    """
    col = {c: block[c].to_numpy() for c in ("source_no", "tile", "word", "mask", "p", "terms")}
    named = col["word"] < 0
    order = np.argsort(col["source_no"][named])
    numbers, tile, p0 = (col[c][named][order] for c in ("source_no", "tile", "p"))
    order = np.lexsort((col["source_no"], col["word"]))[int(named.sum()):]  # word -1 sorts first
    source = np.searchsorted(numbers, col["source_no"][order])
    word, p, mask = col["word"][order], col["p"][order], col["mask"][order].view(np.uint64)
    size = np.bitwise_count(mask).astype(np.int64)
    k = len(numbers)
    value, both, own = np.zeros((k, k), np.int64), np.zeros((k, k), np.int64), np.zeros(k, np.int64)
    np.add.at(own, source, size)
    lacking = p0[None, :]
    cuts = np.flatnonzero(np.diff(word, prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(word)]):
        first = np.flatnonzero(np.diff(source[lo:hi], prepend=-1))
        present = source[lo:hi][first]
        for a in range(lo, hi, _ROWS_AT_ONCE):
            b = min(a + _ROWS_AT_ONCE, hi)
            cells = np.bitwise_count(mask[a:b, None] & mask[None, lo:hi]).astype(np.int64)
            x, y = np.nonzero(cells)
            q, mine = p[lo + y], p[a + x]
            np.add.at(value, (source[a + x], source[lo + y]), cells[x, y] * ((mine - q) ** 2 // q))
            shared = np.add.reduceat(cells, first, axis=1)
            zeros = np.repeat(size[a:b, None], k, axis=1)
            zeros[:, present] -= shared
            np.add.at(both, (source[a:b, None], present[None, :]), shared)
            gap = (p[a:b, None] - lacking) ** 2
            np.add.at(value, source[a:b], zeros * (gap // lacking))
            np.add.at(value.T, source[a:b], zeros * (gap // p[a:b, None]))
    neither = col["terms"].max() - own[:, None] - own[None, :] + both
    value += neither * ((p0[:, None] - p0[None, :]) ** 2 // lacking)
    one_tile = len(np.unique(tile)) == 1
    i, j = np.nonzero((tile[:, None] != tile[None, :]) | (one_tile & ~np.eye(k, dtype=bool)))
    return pa.table({"lang": pa.array([block["lang"][0].as_py()] * len(i), pa.string()), "source_no": pa.array(numbers[i]),
                     "other_no": pa.array(numbers[j]), "value": pa.array(value[i, j])})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
          block_terms: int = BLOCK_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language by divergence from this one (part
    ``pair``), and the ``top_terms`` terms that are over-represented here (part ``term``).

    Cases: null text, lang and source are read as ''; a group without kept terms
    takes part with all counts 0; a language without kept terms has value 0 for
    every pair and no terms; repeated rows are documents of their own, whatever
    their id; an empty table gives no rows; other columns are ignored.  Sums are
    64-bit: a pair's value stays below (SCALE + kept terms)^2.
    """
    counts = written(term_counts(docs), "audit-counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")) \
        .where(F.col("docs") >= least_docs).drop("docs")
    kept = written(kept, "audit-kept")
    langs = counts.select("lang").distinct().join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")), "lang", "left").na.fill(0)
    langs = written(langs.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / block_terms))), "audit-langs")
    by_frequency = Window.partitionBy("lang", "block").orderBy(F.desc("lang_n"), "term")
    ids = kept.join(langs.select("lang", "blocks"), "lang") \
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))) \
        .select("lang", "term", "lang_n", "block", (F.row_number().over(by_frequency) - 1).alias("bit"))
    cells = written(counts.where("term <> ''").select("lang", "source", "term", "n").join(ids, ["lang", "term"]), "audit-cells")

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0, ["total"]) \
        .withColumn("source_no", F.row_number().over(numbered) - 1) \
        .withColumn("tile", F.floor(F.col("source_no") / tile_sources).cast("int")).join(langs, "lang")
    tiles = Window.partitionBy("lang")
    groups = written(groups.withColumn("tiles", F.max("tile").over(tiles) + 1)
                     .withColumn("p0", share(F.lit(0), F.col("total"), F.col("terms"))), "audit-groups")

    # bitset words of every (group, count), and one row per group and block that names the group
    bits = F.expr("bit_or(shiftleft(1L, bit % 64))")
    sets = cells.groupBy("lang", "source", "block", "n", F.floor(F.col("bit") / 64).cast("int").alias("word")).agg(bits.alias("mask")) \
        .join(groups.select("lang", "source", "source_no", "tile", "tiles", "total", "terms"), ["lang", "source"]) \
        .select("lang", "block", "source_no", "tile", "tiles", "word", "mask", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                F.lit(0).cast("long").alias("terms"))
    in_block = cells.select("lang", "block", "bit").groupBy("lang", "block").agg((F.max("bit") + 1).cast("long").alias("in_block"))
    names = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).join(in_block, ["lang", "block"], "left") \
        .select("lang", "block", "source_no", "tile", "tiles", F.lit(-1).alias("word"), F.lit(0).cast("long").alias("mask"),
                F.col("p0").alias("p"), F.coalesce("in_block", F.lit(0)).alias("terms"))
    rows = sets.unionByName(names).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
    sums = rows.groupBy("lang", "block", "low", "high").applyInArrow(_joint, "lang string, source_no int, other_no int, value long") \
        .groupBy("lang", "source_no", "other_no").agg(F.sum("value").alias("value"))
    name = groups.select("lang", "source_no", "source")
    pairs = sums.join(name, ["lang", "source_no"]) \
        .join(name.select("lang", F.col("source_no").alias("other_no"), F.col("source").alias("item")), ["lang", "other_no"])

    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = cells.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"]) \
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q") \
        .withColumn("value", divergence(F.col("p"), F.col("q")))
    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                                        F.row_number().over(ranking).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top_terms))
