"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Two lines are near copies when one edit (a character replaced, inserted or
removed) turns one into the other.  Every line emits its variants with one
character removed as hashed keys ``(variant, place)`` and itself as a variant
without removal; two lines are within one edit exactly if they meet at

* the same variant and the same place (a replaced character), or
* a variant of one that is the other itself (an inserted or removed one).

All lines that meet at one ``(variant, place)`` are one edit apart from each
other, so the earliest of them decides for the rest: a minimum per key, never
pairs.  The pairs (line, earliest) are verified with the edit distance.

To emit variants only where they can meet, a line is first cut into a few
pieces: its key for piece j is the hash of everything outside that piece, in
the coordinates of the variant.  Lines one edit apart share the key of the
piece that holds the edit.  Lines whose keys nobody shares emit no variant,
and the others only those of the shared piece.  Nothing is lost by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import thinned, written

#: Lines of fewer characters are compared exactly; one edit is a large part of them.
MIN_NEAR_CHARS = 16


def normalised(line: Column) -> Column:
    """A line as compared: outer white space removed, lower case."""
    return F.lower(F.trim(line, F.lit(" \t\x0b\x0c\r")))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, pos, line, h1, h2 of every line that is not blank."""
    rows = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    return (rows.select("doc_id", "pos", normalised(F.col("raw")).alias("line")).where("line <> ''")
            .withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit("second"), "line")))


def _halves(line: Column, size: Column) -> Column:
    """The keys of :func:`_pieces` for two pieces, without the empty sides: array of (role, key)."""
    def keys(role: str, variant: Column, extra: int) -> list[Column]:
        half = F.floor(variant / 2).cast("int")
        left, right = F.substr(line, F.lit(1), half), F.substr(line, half + 1 + extra, size)
        return [F.struct(F.lit(role).alias("role"), F.xxhash64(variant, F.lit(part), side).alias("key"))
                for part, side in ((0, right), (1, left))]

    return F.array(*keys("d", size - 1, 1), *keys("f", size, 0))


def _pieces(line: Column, size: Column, count) -> Column:
    """Keys of a line: array of (role, part, begin, width, key).

    Role 'd' stands for its variants with one character removed (of size - 1
    characters), role 'f' for the line itself.  The piece of the line that the
    key leaves out begins after ``begin`` characters and is ``width`` long.
    """
    def keys(role: str, variant: Column, extra: int) -> Column:
        parts = count(variant)

        def key(j: Column) -> Column:
            begin = F.floor(j * variant / parts).cast("int")
            end = F.floor((j + 1) * variant / parts).cast("int")
            left = F.substr(line, F.lit(1), begin)
            right = F.substr(line, end + 1 + extra, size.cast("int"))
            return F.struct(F.lit(role).alias("role"), j.alias("part"), begin.alias("begin"),
                            (end - begin + extra).alias("width"), F.xxhash64(variant, j, left, right).alias("key"))

        return F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), key)

    return F.concat(keys("d", size - 1, 1), keys("f", size, 0))


def _shared(keys: DataFrame) -> DataFrame:
    """Keys that two lines have, one of them with a removed character."""
    return (keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.max(F.col("role") == "d").alias("d"))
            .where("lo < hi and d").select("key"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, pos, h1, h2)`` of the lines to remove, once per row that has them; see :func:`dedup_lines`.

    Nothing above the last join asks for its order, so a very common line is split.
    """
    size = F.length("line").cast("long")
    near = F.when(F.col("size") >= MIN_NEAR_CHARS, _halves(F.col("line"), F.col("size")))
    unique = written(_lines(docs).withColumn("size", F.length("line")).select("doc_id", "pos", "h1", "h2", near.alias("keys"))
                     .groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "pos", "h1")).alias("id"),
                                              F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")), "lines")
    keys = unique.select("h1", "h2", "id", F.inline("keys"))
    shared = written(_shared(keys), "line-keys")
    suspects = written(thinned(keys, "key", shared, "key").join(shared, "key", "left_semi")
                       .select("h1", "h2", "id").distinct(), "line-suspects")

    # their texts, each read at its first place
    first = suspects.select("h1", "h2", "id", F.col("id.doc_id").alias("doc_id"), F.col("id.pos").alias("pos"))
    read = thinned(_lines(thinned(docs.select("doc_id", "text"), "doc_id", first, "doc_id")), "h1", suspects, "h1")
    texts = written(read.join(first, ["h1", "h2", "doc_id", "pos"]).select("h1", "id", "line").distinct(), "line-texts")

    # finer pieces: about the square root of the size, 16 at least
    fine = _pieces(F.col("line"), size, lambda v: F.greatest(F.lit(16).cast("long"), F.ceil(F.sqrt(v))))
    parts = texts.select("h1", "id", "line", F.inline(fine))
    meeting = written(_shared(parts), "line-fine-keys")
    open_parts = parts.join(meeting, "key", "left_semi") \
        .select("role", "id", "key", F.substr("line", F.col("begin") + 1, F.col("width")).alias("mid"))
    removed = F.transform(F.sequence(F.lit(1), F.length("mid")), lambda i: F.struct(
        i.alias("place"), F.concat(F.substr("mid", F.lit(1), i - 1), F.substr("mid", i + 1, F.length("mid"))).alias("mid")))
    alone = F.array(F.struct(F.lit(0).alias("place"), F.col("mid").alias("mid")))
    variants = open_parts.select("role", "id", "key", F.explode(F.when(F.col("role") == "d", removed).otherwise(alone)).alias("v")) \
        .select("role", "id", F.xxhash64("key", "v.mid").alias("variant"), F.col("v.place").alias("place"))

    # a (variant, place) has at most one line per character of the alphabet
    at_place, at_variant = Window.partitionBy("variant", "place"), Window.partitionBy("variant")
    of = lambda role: F.when(F.col("role") == role, F.col("id"))
    met = variants.select("id", "role", F.min(of("d")).over(at_place).alias("replaced"),
                          F.min(of("f")).over(at_variant).alias("whole"), F.min(of("d")).over(at_variant).alias("shorter"))
    earlier = F.when(F.col("role") == "d", F.array("replaced", "whole")).otherwise(F.array("shorter"))
    pairs = met.select("id", F.explode(earlier).alias("by")).where("by < id").distinct()
    line_of = texts.select("id", "line")
    checked = (pairs.join(line_of, "id").join(line_of.select(F.col("id").alias("by"), F.col("line").alias("other")), "by")
               .where(F.levenshtein("line", "other", 1).between(0, 1)).select("id").distinct())
    near_copies = written(checked, "line-near-copies")

    acts = unique.join(near_copies.withColumn("near", F.lit(True)), "id", "left") \
        .where("copies > 1 or near").select("h1", "h2", "id", F.coalesce("near", F.lit(False)).alias("near"))
    acts = written(acts, "line-acts")
    places = thinned(_lines(docs).select("doc_id", "pos", "h1", "h2"), "h1", acts, "h1")
    later = (F.col("doc_id") > F.col("id.doc_id")) | ((F.col("doc_id") == F.col("id.doc_id")) & (F.col("pos") > F.col("id.pos")))
    return places.join(acts, ["h1", "h2"]).where(F.col("near") | later).select("doc_id", "pos", "h1", "h2")


def dedup_lines(docs: DataFrame, removed_col: str | None = None) -> DataFrame:
    """``docs`` without lines that an earlier line of the corpus repeats.

    Lines (separated by ``\\n``) are compared without outer white space and in
    lower case.  A line goes if an earlier one, by (doc_id, line number), is
    equal or, for lines of at least ``MIN_NEAR_CHARS`` characters, one edit
    away, whether or not that one is itself removed.  All columns stay; text
    has the remaining lines.  ``removed_col`` names a column for their number.

    Cases: a null text stays null; blank lines stay; a text whose lines all go
    becomes empty; documents with a null doc_id are kept as they are and remove
    nothing; rows that repeat a doc_id count as one document, so their equal
    lines at equal places stay in both; an empty table gives no rows.
    """
    gone = repeated_lines(docs.select("doc_id", "text")) \
        .groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_set(F.xxhash64("pos", "h1", "h2")).alias("__gone"))
    joined = docs.join(gone, docs["doc_id"] == gone["__doc"], "left")
    line = F.transform(F.split(docs["text"], "\n", -1), lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def stays(s: Column) -> Column:
        norm = normalised(s["x"])
        mark = F.xxhash64(s["i"], F.xxhash64(norm), F.xxhash64(F.lit("second"), norm))
        return ~F.array_contains("__gone", mark)

    kept = F.array_join(F.transform(F.filter(line, stays), lambda s: s["x"]), "\n")
    text = F.when(F.col("__gone").isNull(), docs["text"]).otherwise(kept)
    out = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    if removed_col:
        out.append(F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias(removed_col))
    return joined.select(*out)
