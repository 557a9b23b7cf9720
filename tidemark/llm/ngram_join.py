"""N-gram Jaccard self-join by grouped prefixes.

A document is the set of its word shingles (64-bit hashes).  Shingles are put
in one global order, rare before frequent; two sets of the wanted similarity
then share a shingle within their *prefixes*.  Documents of one size with the
same prefix form a group that is indexed once:

1. count shingles in a table of fixed size, which gives the order;
2. per document: size, digest of the set, prefix; equal sets are one class,
   classes of the same size and prefix are one group;
3. in the lists of groups per prefix shingle, in size order, a sliding window
   and the list's most central group make pairs, which are filtered by size and
   position, expanded to classes, filtered by bitmaps of the sets and verified
   on the full sets;
4. long lists whose members are still in different components are gone through
   again with a wider window, until none is left.

Members of one component need no further links to get their class, so a
thousand near copies cost a window each and not a million pairs, and no
candidate is dropped: what a window leaves over stays in step 4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import sifted, written
from tidemark.llm.words import NON_SPACE, mix, shingles, split_words, text_slices

#: Buckets of the shingle count table (its order reaches each task as one byte a bucket).
COUNT_BITS = 20
CHUNK = 1 << 12
#: First width of the sliding window and its growth per round.
WINDOW, GROWTH = 8, 8
#: Codec of the largest tables in between: ids, sizes and places of many rows, on disk until the end.
DENSE = "zstd"


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def shingle_levels(docs: DataFrame, k: int) -> np.ndarray:
    """Frequency class of each bucket of shingles: 0 for the rarest, about 4 classes per doubling.

    Tasks send their bucket counts in fixed chunks, summed per chunk; the
    result is one byte for each of the ``2**COUNT_BITS`` buckets.  It only
    orders shingles: any order gives the same links, this one short lists.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, data, bounds in text_slices(batch.column(0)):
                h, _ = shingles(split_words(data, bounds, NON_SPACE), k)
                np.add.at(total, _bucket(h), 1)
        for c, part in enumerate(total.reshape(-1, CHUNK)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                 ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(part, dtype=np.int64)
                sums[c] = sums[c] + part if c in sums else part
        for c, part in sums.items():
            level = np.minimum(4 * np.log2(1 + part), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                             ["chunk", "levels"])

    chunks = docs.select("text").mapInArrow(count, "chunk int, counts binary") \
        .repartition("chunk").mapInArrow(add, "chunk int, levels binary")
    levels = np.zeros((1 << COUNT_BITS) // CHUNK * CHUNK, dtype=np.uint8).reshape(-1, CHUNK)
    for row in chunks.collect():  # 2**COUNT_BITS bytes in one job; an iterator would run a job per partition
        levels[row["chunk"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels.ravel()


def _prefix_length(n: int, num: int, den: int) -> int:
    """A partner has at least ceil(num / den * n) shingles in common with a set of n."""
    return n + (-num * n) // den + 1


SIGNATURE = "doc_id {}, n long, digest binary, grp long, prefix array<long>"


def signatures(docs: DataFrame, levels: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """Per row: doc_id, set size n, digest of the set, group, ordered prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2**COUNT_BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                h, first = shingles(split_words(data, bounds, NON_SPACE), k)
                rank = level[_bucket(h)]
                sizes, digests, groups, prefixes = np.diff(first), [], [], []
                for d in range(j - i):
                    own = h[first[d]:first[d + 1]]
                    n = len(own)
                    digests.append(_digest(own) if n else None)
                    own = own[np.argsort(rank[first[d]:first[d + 1]], kind="stable")][:_prefix_length(n, num, den) if n else 0]
                    at = np.arange(1, len(own) + 1, dtype=np.uint64)
                    groups.append(int(mix((own * mix(at)).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
                                      .view(np.int64)[0]) if n else None)
                    prefixes.append(own.view(np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                flat = pa.array(np.concatenate(prefixes) if prefixes else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sizes.astype(np.int64)), pa.array(digests, pa.binary()),
                     pa.array(groups, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                    ["doc_id", "n", "digest", "grp", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(
        run, SIGNATURE.format(docs.schema["doc_id"].dataType.simpleString()))


def _digest(h: np.ndarray) -> bytes:
    """128 bits of a sorted set of hashes."""
    at = np.arange(1, len(h) + 1, dtype=np.uint64)
    return np.array([mix(h * mix(at)).sum(dtype=np.uint64), mix(h + mix(at + np.uint64(1 << 40))).sum(dtype=np.uint64)],
                    dtype=np.uint64).tobytes()


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The set of each row, in order."""
    for _, _, data, bounds in text_slices(column):
        h, first = shingles(split_words(data, bounds, NON_SPACE), k)
        for a, b in zip(first, first[1:]):
            yield h[a:b]


def _bitmap(h: np.ndarray) -> bytes:
    """A bit for each value of the low bits of a hash, 4 to 8 bits for each hash of the set."""
    m = max(64, 1 << int(4 * len(h) - 1).bit_length())
    bits = np.zeros(m, dtype=np.uint8)
    bits[(h & np.uint64(m - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The bitmap that the same set has at ``size`` bytes."""
    while len(bits) > size:
        bits = bits[:len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def _most_shared(n: int, x: bytes, m: int, y: bytes) -> int:
    """No less than the intersection of two sets of sizes n and m with the bitmaps x and y.

    A bit of one that the other lacks stands for at least one hash that the other lacks.
    """
    x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    x, y = _folded(x, len(y)), _folded(y, len(x))
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def _of_pairs(pairs: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with the columns of both documents, those of b in front of an underscore."""
    x = found.select(F.col("doc_id").alias("a"), *columns)
    y = found.select(F.col("doc_id").alias("b"), *(F.col(c).alias(f"{c}_") for c in columns))
    return pairs.join(x, "a").join(y, "b").select("a", "b", *columns, *(f"{c}_" for c in columns))


def _wanted(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that may be in ``pairs``; what is joined to them leaves the others out."""
    return sifted(docs.select("doc_id", "text"), "doc_id", pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), "doc_id")


def _alike(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs whose bitmaps leave it open that they are similar enough: no similar pair is lost.

    Most candidates end here, at about a tenth of the bytes of their sets.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bits = [], []
            for h in _sets(batch.column(1), k):
                sizes.append(len(h))
                bits.append(_bitmap(h))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())],
                                             ["doc_id", "n", "bits"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [(den + num) * _most_shared(n, x, m, y) >= num * (n + m)
                    for n, x, m, y in zip(*(batch.column(c).to_pylist() for c in ("n", "bits", "n_", "bits_")))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = _wanted(docs, pairs).mapInArrow(bitmaps, f"doc_id {id_type}, n long, bits binary")
    return _of_pairs(pairs, found, "n", "bits").mapInArrow(check, f"a {id_type}, b {id_type}").distinct()


def _verified(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of doc ids whose sets are similar enough."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_sets(batch.column("text"), k), _sets(batch.column("text_"), k)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(_alike(docs, pairs, k, num, den), "ngram-alike")
    # texts, not sets: hashes do not compress
    return _of_pairs(pairs, _wanted(docs, pairs), "text").mapInArrow(check, f"a {id_type}, b {id_type}")


def jaccard_classes(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents with the smallest doc_id that links of similarity >= num / den reach.

    Links join documents with ``den * |intersection| >= num * |union|`` over
    their distinct k-word shingles (words are separated by ASCII white space,
    A-Z lower-cased; a text of fewer words is one shingle).  Returns one row
    per row of ``docs``: doc_id, n_shingles, component_id.

    Cases: a null, empty or blank text has 0 shingles, links with nothing and
    is its own component; a null doc_id gives a row with a null component and
    links nothing; rows that repeat a doc_id are one document; an empty table
    gives no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    sig = written(signatures(docs, shingle_levels(docs, k), k, num, den), "ngram-signatures", DENSE)
    classes = written(sig.where("n > 0 and doc_id is not null").groupBy("grp", "n", "digest")
                      .agg(F.min("doc_id").alias("rep")), "ngram-classes")
    groups = classes.groupBy("grp", "n").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("members"))
    crowded = written(groups.where("members > 1").select("grp", "n", "leader"), "ngram-crowded")
    # members of groups with several classes: leader -> member, in a fixed order
    members = classes.join(crowded, ["grp", "n"]).select("leader", "rep",
        F.row_number().over(Window.partitionBy("leader").orderBy("rep")).alias("place"))
    members = written(members, "ngram-members")

    lists = written(_lists(_leaders(sig, groups)), "ngram-lists", DENSE)
    group_pairs = written(_near(lists, num, den), "ngram-group-pairs")
    has_crowds = not members.isEmpty()

    def expanded(pairs: DataFrame) -> DataFrame:
        """Group pairs as class pairs: each member of one side with the other side's leader."""
        if not has_crowds:
            return pairs
        one = pairs.join(members.select(F.col("leader").alias("a"), "rep"), "a").select(F.col("rep").alias("a"), "b")
        two = pairs.join(members.select(F.col("leader").alias("b"), "rep"), "b").select("a", F.col("rep").alias("b"))
        return pairs.union(one).union(two).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
            .where("a < b").distinct()

    cand = expanded(group_pairs)
    if has_crowds:
        before = Window.partitionBy("leader").orderBy("place").rowsBetween(-WINDOW, -1)
        inside = members.withColumn("near", F.collect_list("rep").over(before)).select("rep", F.explode("near").alias("x"))
        cand = cand.union(members.where("leader < rep").select(F.col("leader").alias("a"), F.col("rep").alias("b"))) \
            .union(inside.select(F.col("x").alias("a"), F.col("rep").alias("b"))).distinct()
    links = written(_verified(docs, cand, k, num, den), "ngram-links")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    def joined(new: DataFrame) -> DataFrame:
        """Roots after new links: the stars found so far stand for all earlier links."""
        return components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(new.select("a", "b")))

    def rooted(df: DataFrame, col: str, out: str) -> DataFrame:
        r = roots.select(F.col("node").alias(col), F.col("root").alias("__root"))
        return df.join(r, col, "left").withColumn(out, F.coalesce("__root", col)).drop("__root")

    # long lists that still hold several components, with ever wider windows
    lo, hi = WINDOW, WINDOW * GROWTH
    longest = lists.agg(F.max("place")).first()[0] or 0
    seen, still = group_pairs, lists  # a list of one component stays one, so each round takes what the last left open
    while lo + 1 < longest:
        rest = rooted(still.where(F.col("listed") > lo + 1), "doc_id", "root")
        if has_crowds:  # a group whose own members are apart may not be skipped for its leader's component
            apart = rooted(members, "rep", "root").groupBy(F.col("leader").alias("doc_id")) \
                .agg((F.min("root") < F.max("root")).alias("apart"))
            rest = rest.join(apart, "doc_id", "left").withColumn("apart", F.coalesce("apart", F.lit(False)))
        else:
            rest = rest.withColumn("apart", F.lit(False))
        split = rest.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max("apart").alias("ap"))
        rest = written(rest.join(split.where("r0 < r1 or ap").select("token"), "token", "left_semi"), "ngram-open")
        if rest.isEmpty():
            break
        still = rest.select(*lists.columns)
        more = written(_between(rest, lo, hi, num, den), "ngram-more")
        if not more.isEmpty():
            seen = seen.union(more)
            new = written(_verified(docs, expanded(more), k, num, den), "ngram-links")
            if not new.isEmpty():
                roots = joined(new)
        lo, hi = hi, hi * GROWTH

    if has_crowds:
        # members of crowded groups that are still apart: the remaining member pairs of group pairs
        crowd = rooted(members, "rep", "root").select("leader", "rep", "root")
        own = members.select(F.col("leader").alias("a"), F.col("leader").alias("b")).distinct()
        both = seen.distinct().union(own)
        left = crowd.select(F.col("leader").alias("a"), F.col("rep").alias("x"), F.col("root").alias("rx"))
        right = crowd.select(F.col("leader").alias("b"), F.col("rep").alias("y"), F.col("root").alias("ry"))
        rest = both.join(left, "a").join(right, "b").where("rx <> ry and x <> y") \
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        rest = written(rest, "ngram-member-pairs")
        if not rest.isEmpty():
            new = written(_verified(docs, rest, k, num, den), "ngram-links")
            if not new.isEmpty():
                roots = joined(new)

    ids = rooted(classes, "rep", "root").select("grp", "n", "digest", "root")
    return (sig.join(ids, ["grp", "n", "digest"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id")))


def _leaders(sig: DataFrame, groups: DataFrame) -> DataFrame:
    """One signature row for the leader of each group.

    A document with one row that leads its group passes as it is.  Only rows
    that share a coarse key with another document go through the exact join,
    so the prefixes of most rows are not shuffled here.
    """
    sig = sig.where("n > 0 and doc_id is not null")
    heads = groups.select(F.col("leader").alias("doc_id"), "grp")
    once = sig.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"), F.min("grp").alias("grp"))
    others = once.join(heads.withColumn("leads", F.lit(True)), ["doc_id", "grp"], "left") \
        .where("times > 1 or leads is null").select("doc_id")
    plain = sifted(sig, "doc_id", others, "doc_id", keep=False)
    rest = sifted(sig, "doc_id", others, "doc_id").join(heads, ["doc_id", "grp"], "left_semi") \
        .dropDuplicates(["doc_id", "grp"])
    return plain.unionByName(rest.select(*plain.columns))


def _in_list():
    return Window.partitionBy("token").orderBy("n", "doc_id")


def _possible(x, num: int, den: int):
    """Size and position filter between the list entry ``x`` and the current row.

    Both hold the shared shingle at place ``i`` (from 0) of ``n`` in the global
    order.  What both hold before it lies in both prefixes, so it is among the
    ``s`` of the ``i`` that are in a list; so at most the smaller ``s`` before
    it and the smaller rest from it on are shared.
    """
    n, i = F.col("n"), F.col("i")
    most = F.least(x["s"], F.col("s")) + F.least(x["n"] - x["i"], n - i)
    return ((den * F.least(x["n"], n) >= num * F.greatest(x["n"], n))
            & ((den + num) * most >= num * (x["n"] + n)))


def _lists(leaders: DataFrame) -> DataFrame:
    """Prefix shingles that two or more groups have: token, doc_id, n, i, s, rare, place in the list, length of the list."""
    rows = (leaders.select("doc_id", "n", F.size("prefix").alias("length"), F.posexplode("prefix").alias("i", "token"))
            .withColumn("place", F.row_number().over(_in_list()))
            .withColumn("listed", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("listed > 1"))
    rows = written(rows, "ngram-shared", DENSE)
    of_doc = Window.partitionBy("doc_id")
    return rows.select("token", "doc_id", "n", "i", "place", "listed", (F.row_number().over(of_doc.orderBy("i")) - 1).alias("s"),
                       (F.col("length") - F.count(F.lit(1)).over(of_doc)).alias("rare"))


def _near(lists: DataFrame, num: int, den: int) -> DataFrame:
    """Possible pairs (a, b) of list entries that are ``WINDOW`` places apart at most,
    and of each entry with the list's most central one, which has the fewest shingles of its own."""
    entry = F.struct("doc_id", "n", "i", "s")
    centre = F.min(F.struct(F.col("rare"), F.col("n").alias("by"), F.col("doc_id").alias("id"), entry.alias("entry"))) \
        .over(Window.partitionBy("token"))["entry"]
    near = F.concat(F.collect_list(entry).over(_in_list().rowsBetween(-WINDOW, -1)), F.array(centre))
    rows = lists.withColumn("near", near)
    near = F.filter("near", lambda x: (x["doc_id"] != F.col("doc_id")) & _possible(x, num, den))
    return _pairs(rows, near)


def _between(rest: DataFrame, lo: int, hi: int, num: int, den: int) -> DataFrame:
    """Possible pairs of different components that are lo + 1 to hi places apart in a list."""
    entry = F.struct("doc_id", "n", "i", "s", "root", "apart")
    near = F.collect_list(entry).over(_in_list().rowsBetween(-hi, -lo - 1))
    ok = F.filter("near", lambda x: ((x["root"] != F.col("root")) | x["apart"] | F.col("apart")) & _possible(x, num, den))
    return _pairs(rest.withColumn("near", near), ok)


def _pairs(rows: DataFrame, partners) -> DataFrame:
    """Distinct pairs (a, b) of entries and their partners; a document's lists are united before they are spread out."""
    own = rows.select(F.col("doc_id").alias("b"), F.transform(partners, lambda x: x["doc_id"]).alias("near")) \
        .where(F.size("near") > 0).groupBy("b").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    pairs = own.select("b", F.explode("near").alias("a"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
