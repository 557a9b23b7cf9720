"""Personal data by fixed patterns and bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four fixed patterns.  They seed a bootstrap: identifier-like
tokens (with digits or an ``@``) are instances, the words before them and their
shape are lexical patterns.  Base spans are cut out of such tokens first and are
instances of their kind; what is left beside them are instances of their own.
Spark scores the graph of patterns and instances in rounds: a pattern's
confidence for a kind is the mean score of its distinct instances (those seen as
base spans score 1), an instance's score is that of its best accepted pattern.
Confidences only rise, so the accepted patterns only grow; the rounds end with
the first that accepts no more.  Accepted patterns then mark instances that no
base pattern knows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import written

KINDS = ("email", "ip", "card", "phone")

# The fixed patterns, written so that no text makes them backtrack at length:
# a lookbehind lets a match begin only where a run begins (or the last match
# ended), and possessive quantifiers take runs whole.  Chains of digits of the
# wrong length are passed over by the card pattern itself.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What each pattern needs in a text.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"

#: Tokens with a digit or @, together with following tokens that hold digits.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9]\S*+)*+"
#: Characters of the text before a candidate in which its context words are looked for.
CONTEXT_CHARS = 64
#: An accepted pattern has this confidence and as many distinct known instances at least.
CONFIDENCE, SUPPORT = 0.75, 3
#: Stands for an identifier among context words.
MARK = "<id>"
#: Digits of a discovered identifier without @, at least.
LEAST_DIGITS = 5

SPAN = "array<struct<start:long,end:long,text:string,before:string>>"


def located(text: Column, pattern: str, hits: Column) -> Column:
    """Matches of a pattern with their places in code points and the text before each.

    ``split`` gives what lies between the matches that ``regexp_extract_all``
    gives; their lengths, added up in turn, are the places.
    """
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    begin = lambda acc, x: acc["at"] + F.length(x["g"])
    out = F.aggregate(
        pairs, F.struct(F.lit(0).cast("long").alias("at"), F.from_json(F.lit("[]"), SPAN).alias("out")),
        lambda acc, x: F.struct(
            (begin(acc, x) + F.length(x["h"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                begin(acc, x).alias("start"), (begin(acc, x) + F.length(x["h"])).alias("end"), x["h"].alias("text"),
                F.right(x["g"], F.lit(CONTEXT_CHARS)).alias("before")))).alias("out")),
        lambda acc: acc["out"])
    return F.when(F.size(hits) > 0, out).otherwise(F.from_json(F.lit("[]"), SPAN))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(OCTETS)
    if kind == "card":
        return F.call_function("luhn_check", digits(text))
    if kind == "phone":
        return F.length(digits(text)).between(9, 15)
    return F.lit(True)


def _found(docs: DataFrame) -> DataFrame:
    """row, doc_id, base (sorted spans with kind number), candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    hit = {}
    for kind in KINDS:
        got = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        if NEEDS[kind]:
            got = F.when(F.contains("text", F.lit(NEEDS[kind])), got).otherwise(F.array().cast("array<string>"))
        hit[kind] = got.alias(f"hit_{kind}")
    rows = rows.select("*", *hit.values(), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hit_any"))

    def base(number: int, kind: str) -> Column:
        spans = located(F.col("text"), PATTERNS[kind], F.col(f"hit_{kind}"))
        return F.transform(F.filter(spans, lambda s: valid(kind, s["text"])), lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))

    return rows.select("row", "doc_id", F.array_sort(F.concat(*(base(i, k) for i, k in enumerate(KINDS)))).alias("base"),
                       located(F.col("text"), CANDIDATE, F.col("hit_any")).alias("candidates"))


def _pieces() -> Column:
    """A candidate cut at the base spans over it: array of (start, end, token, before, kind).

    ``start`` and ``end`` count from the candidate's start.  Base spans have
    their kind, what lies between them has none; of overlapping base spans the
    later one begins where the one before ends.
    """
    size = F.length("text").cast("long")
    clip = lambda at: F.least(F.greatest(at - F.col("start"), F.lit(0).cast("long")), size)
    over = F.transform(F.filter("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start"))), lambda s: F.struct(
        clip(s["start"]).alias("from"), clip(s["end"]).alias("to"), s["kind"].alias("kind")))
    none = F.lit(None).cast("int")
    cut = F.aggregate(
        over, F.struct(F.lit(0).cast("long").alias("at"), F.slice(over, 1, 0).alias("out")),
        lambda acc, s: F.struct(F.greatest(acc["at"], s["to"]).alias("at"), F.concat(acc["out"], F.array(
            F.struct(acc["at"].alias("from"), F.greatest(acc["at"], s["from"]).alias("to"), none.alias("kind")),
            F.struct(F.greatest(acc["at"], s["from"]).alias("from"), F.greatest(acc["at"], s["to"]).alias("to"),
                     s["kind"].alias("kind")))).alias("out")),
        lambda acc: F.concat(acc["out"], F.array(F.struct(acc["at"].alias("from"), F.greatest(acc["at"], size).alias("to"), none.alias("kind")))))
    return F.transform(F.filter(cut, lambda s: s["from"] < s["to"]), lambda s: F.struct(
        (F.col("start") + s["from"]).alias("start"), (F.col("start") + s["to"]).alias("end"), s["kind"].alias("kind"),
        F.substr("text", (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")).alias("token"),
        F.right(F.concat("before", F.substr("text", F.lit(1), s["from"].cast("int"))), F.lit(CONTEXT_CHARS)).alias("before")))


def _candidates(found: DataFrame) -> DataFrame:
    """Identifier-like tokens with their kind, if they are base spans, and their patterns."""
    rows = found.select("row", "base", F.inline("candidates"))
    whole = F.array(F.struct("start", "end", F.lit(None).cast("int").alias("kind"), F.col("text").alias("token"), "before"))
    crossed = F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    rows = rows.select("row", F.inline(F.when(crossed, _pieces()).otherwise(whole)))
    free = F.col("kind").isNull()  # base spans stay as they are
    head = F.when(free, F.length(F.regexp_extract("token", r"^[\s\"'<\[{(,;]*", 0))).otherwise(0)
    tail = F.when(free, F.length(F.regexp_extract("token", r"[\s.,;:!?\"')>\]}]*$", 0))).otherwise(0)
    rows = rows.withColumns({"start": F.col("start") + head, "end": F.col("end") - tail,
                             "token": F.substr("token", head + 1, F.length("token") - head - tail)}).where("start < end")
    words = F.transform(F.filter(F.split(F.lower("before"), r"\s+"), lambda w: w != ""),
                        lambda w: F.when(w.rlike("[0-9@]"), F.lit(MARK)).otherwise(w))
    n = F.size(words)
    shape = F.regexp_replace(F.regexp_replace("token", "[0-9]", "0"), "[A-Za-z]+", "a")
    two = F.when(n >= 2, F.concat(F.lit("words "), F.element_at(words, -2), F.lit(" "), F.element_at(words, -1)))
    one = F.when(n >= 1, F.concat(F.lit("shape "), F.element_at(words, -1), F.lit(" "), shape))
    return rows.select("row", "start", "end", "token", "kind", F.filter(F.array(two, one), lambda p: p.isNotNull()).alias("patterns"))


def _accepted(candidates: DataFrame) -> DataFrame:
    """``(pattern, kind, confidence)`` of the accepted patterns.

    A token may be a base span of several kinds at different places and seeds
    each of them; a pattern's instances are its distinct tokens.
    """
    seen = written(candidates.select("token", "kind", F.explode("patterns").alias("pattern"))
                   .groupBy("pattern", "token").agg(F.collect_set("kind").alias("kinds")), "pii-graph")
    edges = seen.select("pattern", "token")
    seeds = seen.select("token", F.explode("kinds").alias("kind")).distinct().withColumn("score", F.lit(1.0))
    degree = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
    known, before = seeds, 0
    while True:
        scored = (edges.join(known, "token").groupBy("pattern", "kind")
                  .agg(F.sum("score").alias("total"), F.count(F.lit(1)).alias("support")).join(degree, "pattern")
                  .select("pattern", "kind", (F.col("total") / F.col("instances")).alias("confidence"), "support")
                  .where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT)))
        accepted = written(scored, "pii-patterns")
        count = accepted.count()
        if count == before:
            return accepted.select("pattern", "kind", "confidence")
        before = count
        # instances of accepted patterns are known in the next round, at their best pattern's confidence
        told = edges.join(accepted, "pattern").groupBy("token", "kind").agg(F.max("confidence").alias("score"))
        known = seeds.unionByName(told).groupBy("token", "kind").agg(F.max("score").alias("score"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, base and spans, sorted arrays of (start, kind, end).

    Places count code points, the end is exclusive, kind is the number in
    ``KINDS``.  ``spans`` are the base spans and those that accepted patterns
    add where no base span lies.

    Cases: a null text is an empty one; equal places are ordered by kind; rows
    with a null or repeated doc_id are searched like others; an empty table
    gives no rows; other columns are ignored.
    """
    found = written(_found(docs.select("doc_id", "text")), "pii-found")
    candidates = written(_candidates(found), "pii-candidates")
    accepted = _accepted(candidates)
    unknown = candidates.where("kind is null").where(
        F.contains("token", F.lit("@")) | (F.length(digits(F.col("token"))) >= LEAST_DIGITS))
    best = Window.partitionBy("row", "start").orderBy(F.desc("confidence"), "kind")
    added = (unknown.select("row", "start", "end", F.explode("patterns").alias("pattern")).join(accepted, "pattern")
             .withColumn("place", F.row_number().over(best)).where("place = 1")
             .groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")))
    return found.join(added, "row", "left").select(
        "doc_id", "base", F.when(F.col("added").isNull(), F.col("base"))
        .otherwise(F.array_sort(F.concat("base", "added"))).alias("spans"))


def count_of(spans: Column, kind: str) -> Column:
    """Number of the spans of a kind (a second parameter of the lambda would be the place in the array)."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    name = lambda s: reduce(lambda c, i: c.when(s["kind"] == i, F.lit(KINDS[i])), range(1, len(KINDS)),
                            F.when(s["kind"] == 0, F.lit(KINDS[0])))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
