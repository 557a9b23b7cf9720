"""Mixing sources to target weights (hash-threshold histograms).

Every document has a fixed 60-bit hash.  A source that takes ``target`` words
out of ``source_size`` keeps each document ``floor(target / source_size)``
times, and once more the documents whose hash is under the source's threshold.
The threshold comes from histograms: words are summed by (source, hash
bucket), the bucket in which the running sum crosses the budget is the
boundary bucket, and only its documents are histogrammed again on the next
hash bits.  Nothing is sorted but the few hundred buckets of one histogram.

Budgets are nested: the documents of a smaller budget are among those of a
larger one, as both are prefixes of one hash order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]++"
WEIGHTS = (3.0, 1.0, 2.0)
#: Hash bits and bits taken by each level of the histogram.
HASH_BITS, LEVEL_BITS = 60, 10


def word_count(text: Column) -> Column:
    """Number of space-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def doc_hash(doc_id: Column, text: Column) -> Column:
    """First 60 bits of the MD5 of the id's decimal text; a row without id hashes its text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), text, F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size)`` -> plus ``target``.

    Sources in code-point order, null last, weigh ``weights`` in turn.  Together
    they get ``share`` of all sizes by weight; no target is above ``most`` times
    its source's size, and what is cut off is shared out again by weight among
    the others.  The fixed point of that resharing is found directly: sources
    are capped in the order of cap / weight, and the first one that its share
    of the rest does not cap ends the search.  One row per source is sorted,
    never documents.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_code_point) - 1) % len(weights)
    weight = reduce(lambda c, i: c.when(turn == i, F.lit(weights[i])), range(1, len(weights)),
                    F.when(turn == 0, F.lit(weights[0])))
    cap = most * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (sizes.withColumn("weight", weight)
              .withColumn("capped_before", F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
              .withColumn("weight_left", F.sum("weight").over(after))
              .withColumn("budget", share * F.sum(F.col("source_size").cast("double")).over(everything)))
    level = (F.col("budget") - F.col("capped_before")) / F.col("weight_left")
    free = level * F.col("weight") <= cap
    ranked = ranked.withColumn("level", F.min(F.when(free, F.struct(F.col("capped_before"), level.alias("level"))))
                               .over(everything)["level"])
    target = F.when(F.col("level").isNull(), cap).otherwise(F.least(cap, F.col("level") * F.col("weight")))
    return ranked.select("source", "source_size", target.alias("target"))


def _thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(source, threshold)``: take the documents of hash < threshold.

    ``docs``: source, size, hash.  ``budgets``: source, budget.  Each level
    descends into the boundary bucket of each source; the loop ends when no
    boundary bucket holds two different hashes, at the latest after
    ``HASH_BITS / LEVEL_BITS`` levels.  A boundary hash is taken if that comes
    nearer to the budget.
    """
    found = None
    # open: source, budget (left to fill inside the bucket), lo (first hash of the bucket)
    open_ = budgets.withColumn("lo", F.lit(0).cast("long"))
    shift = HASH_BITS
    while True:
        shift -= LEVEL_BITS
        width = 1 << shift
        inside = (F.col("hash") >= F.col("lo")) & (F.col("hash") - F.col("lo") < F.lit(width << LEVEL_BITS))
        inner = docs.alias("d").join(open_.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & inside)
        bucket = F.shiftright(F.col("hash") - F.col("lo"), shift)
        histogram = (inner.groupBy(F.col("o.source").alias("source"), "budget", "lo", bucket.alias("bucket"))
                     .agg(F.sum("size").alias("size"), F.min("hash").alias("first"), F.max("hash").alias("last")))
        running = Window.partitionBy("source").orderBy("bucket")
        cum = F.sum("size").over(running)
        at = (histogram.withColumn("cum", cum)
              .where((F.col("cum") > F.col("budget")) & (F.col("cum") - F.col("size") <= F.col("budget")))
              .withColumn("left", F.col("budget") - (F.col("cum") - F.col("size"))))
        level = written(at.select("source", F.col("left").alias("budget"), "size", "first", "last",
                                  (F.col("lo") + F.col("bucket") * F.lit(width)).alias("lo")), "mix-level")
        # the boundary is one hash: take it if half of it or more fits the budget
        single = (F.col("first") == F.col("last"))
        done = level.where(single).select(
            "source", (F.col("first") + F.when(F.col("size") - F.col("budget") < F.col("budget"), 1).otherwise(0))
            .alias("threshold"))
        found = done if found is None else found.unionByName(done)
        open_ = level.where(~single).select("source", "budget", "lo")
        if shift == 0 or open_.isEmpty():
            return found


def mix_plan(docs: DataFrame, share: float = 1.5, most: float = 2.0,
             weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source: source, source_size, target, copies, threshold."""
    rows = written(docs.select("source", word_count(F.col("text")).alias("size"),
                               doc_hash(F.col("doc_id"), F.col("text")).alias("hash")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, share, most, weights), "mix-targets")
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    targets = targets.withColumn("copies", F.least(whole, F.lit(int(most))).cast("long"))
    budgets = targets.select("source", (F.col("target") - F.col("copies") * F.col("source_size")).alias("budget"))
    thresholds = _thresholds(rows.where(F.col("size") > 0), budgets)
    plan = targets.alias("t").join(thresholds.alias("h"), F.col("t.source").eqNullSafe(F.col("h.source")), "left") \
        .select("t.source", "source_size", "target", "copies", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    return written(plan, "mix-plan")


def with_copies(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` and, as struct ``__mix``, source_size, target, copies of the document and its size."""
    p = plan.select(F.col("source").alias("__source"), F.struct("source_size", "target", "copies", "threshold").alias("__plan"))
    copies = F.col("__plan.copies") + F.when(doc_hash(docs["doc_id"], docs["text"]) < F.col("__plan.threshold"), 1).otherwise(0)
    return docs.join(p, docs["source"].eqNullSafe(p["__source"])).select(
        *(docs[c] for c in docs.columns),
        F.struct(F.col("__plan.source_size"), F.col("__plan.target"), copies.alias("copies"),
                 word_count(docs["text"]).alias("size")).alias("__mix"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0,
        weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's), taken.

    ``taken`` is the number of words that the mix takes from the document,
    repeats counted: ``size`` times the number of copies, which is
    ``floor(target / source_size)`` or one more, never above ``most`` rounded
    up.  The words taken from a source miss its target by at most half of the
    document at the threshold.

    Cases: a null or empty text has size 0 and taken 0; a null source is a
    source of its own, the last in order; a row with a null id is placed by its
    text; repeated rows of one id share a hash and are taken together; an empty
    table gives no rows; columns other than doc_id, text and source are ignored.
    """
    rows = docs.select("doc_id", "source", "text")
    mixed = with_copies(rows, mix_plan(rows, share, most, weights))
    return mixed.select("doc_id", "source", "__mix.size", "__mix.source_size", "__mix.target",
                        (F.col("__mix.size") * F.col("__mix.copies")).alias("taken"))
