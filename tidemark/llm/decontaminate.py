"""Benchmark decontamination with a generalised suffix automaton.

The automaton of the normalised test items knows every word sequence that
occurs in an item.  Training words are streamed through it: each step gives the
longest suffix of what was read that occurs in some item, so a match of at
least ``window`` words is an occurrence of the item's last ``window`` words.

Benchmark items are dealt into blocks of a bounded number of words
(``BLOCK_WORDS``).  A task builds the automaton of a block and leaves it as
arrays in the shared folder; only the files' names reach the driver.  A pass
over the documents holds up to ``PASS_BLOCKS`` of them in a Python worker, so
neither the driver nor a task grows with the benchmark; a larger one takes more
passes.  Within a pass, words that cannot lie in an occurrence (no ``anchor``
consecutive words of an item around them) are passed over in numpy, and only
the rest is streamed.
"""

from __future__ import annotations

import io
import json
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import filesystem, thinned, without, written
from tidemark.llm.words import _STEPS, ALNUM, Words, mix, split_words, text_slices
from tidemark.session import shared_dir

#: Words of benchmark text in one automaton, about (a block holds whole items).  Building takes 1 KB a word at most.
BLOCK_WORDS = 200_000
#: Automata that a worker holds in one pass; each takes about 100 bytes a word.
PASS_BLOCKS = 4
#: Consecutive words of the prefilter, at most.
ANCHOR = 5


class SuffixAutomaton:
    """Generalised suffix automaton over integer words with item sets per state, as it is built."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _extend(self, last: int, x: int) -> int:
        known = self.next[last].get(x)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, x, known)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, x, q)
        return new

    def _split(self, p: int, x: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = copy
            p = self.link[p]
        return copy

    def build(self, items: list[list[int]]) -> SuffixAutomaton:
        for words in items:
            last = 0
            for x in words:
                last = self._extend(last, x)
        n = len(self.length)
        # the state of the last `window` words, for states that hold longer matches
        self.clamp = list(range(n))
        order = sorted(range(1, n), key=self.length.__getitem__)
        for v in order:
            if self.length[self.link[v]] >= self.window:
                self.clamp[v] = self.clamp[self.link[v]]
        #: items with an occurrence that ends in a state of ``window`` words
        self.items: dict[int, set[int]] = {}
        #: whole items of fewer words, at the state that they end in
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, words in enumerate(items):
            v = 0
            for i, x in enumerate(words):
                v = self.next[v][x]
                if i + 1 >= self.window:
                    u = v
                    while self.length[self.link[u]] >= self.window:
                        u = self.link[u]
                    self.items.setdefault(u, set()).add(item)
            if 0 < len(words) < self.window:
                self.short.setdefault(v, []).append((len(words), item))
        #: nearest state on the way to the root, itself included, with such an item; 0 for none
        self.short_at = [0] * n
        for v in order:
            self.short_at[v] = v if v in self.short else self.short_at[self.link[v]]
        return self

    def arrays(self, n_words: int) -> dict[str, np.ndarray]:
        n = len(self.length)
        edges = sorted((v * n_words + x, u) for v, following in enumerate(self.next) for x, u in following.items())

        def per_state(entries: dict[int, list]) -> tuple[np.ndarray, list]:
            begins, flat = np.zeros(n + 1, dtype=np.int32), []
            for v in range(n):
                flat += entries.get(v, ())
                begins[v + 1] = len(flat)
            return begins, flat

        item_begin, items = per_state({v: sorted(found) for v, found in self.items.items()})
        short_begin, short = per_state(self.short)
        whole = lambda values: np.array(values, dtype=np.int32)
        return {"edge": np.array([e for e, _ in edges], dtype=np.int64), "to": whole([u for _, u in edges]),
                "link": whole(self.link), "length": whole(self.length), "clamp": whole(self.clamp),
                "item_begin": item_begin, "item": whole(items), "short_at": whole(self.short_at),
                "short_begin": short_begin, "short_len": whole([m for m, _ in short]), "short_item": whole([i for _, i in short])}


def _key(columns: list[np.ndarray]) -> np.ndarray:
    return mix(sum((c + np.uint64(1)) * _STEPS[j] for j, c in enumerate(columns)))


def build_block(items: list[tuple[str, str]], window: int) -> bytes:
    """The automaton of one block of (id, text) items and its prefilter, as the bytes of an array file."""
    ids, vocabulary, sequences = [], {}, []
    for item_id, text in items:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        w = split_words(raw, np.array([0, len(raw)]), ALNUM).hashes().tolist()
        if w:
            ids.append(item_id)
            sequences.append([vocabulary.setdefault(x, len(vocabulary)) for x in w])
    hashes = np.array(list(vocabulary), dtype=np.uint64)
    order = np.argsort(hashes)
    anchor = min([ANCHOR, window, *map(len, sequences)])
    grams = [np.zeros(0, dtype=np.uint64)]
    for s in sequences:
        h = hashes[np.array(s)]
        grams.append(_key([h[j:len(h) - anchor + 1 + j] for j in range(anchor)]))
    out = io.BytesIO()
    np.savez(out, ids=np.frombuffer(json.dumps(ids).encode(), dtype=np.uint8), hashes=hashes[order], order=order.astype(np.int32),
             anchor=np.array([anchor]), grams=np.unique(np.concatenate(grams)),
             **SuffixAutomaton(window).build(sequences).arrays(max(len(vocabulary), 1)))
    return out.getvalue()


class BlockMatcher:
    """The automaton of one block, read from its arrays, with the numpy prefilter in front."""

    def __init__(self, raw: bytes, window: int):
        held = np.load(io.BytesIO(raw))
        self.window = window
        self.ids = json.loads(held["ids"].tobytes())
        self.hashes, self.order, self.grams, self.anchor = held["hashes"], held["order"], held["grams"], int(held["anchor"][0])
        self.n_words = max(len(self.hashes), 1)
        # flat Python arrays: single values are read from them faster than from numpy's
        flat = lambda name, code: array(code, held[name].tobytes())
        self.edge = flat("edge", "q")
        for name in ("to", "link", "length", "clamp", "item_begin", "item", "short_at", "short_begin", "short_len", "short_item"):
            setattr(self, name, flat(name, "i"))

    def numbers(self, hashes: np.ndarray) -> list[int]:
        """Word numbers of the block's vocabulary; -1 for other words."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, self.order[at], -1).tolist()

    def runs(self, keys: np.ndarray, text_of: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(text, first, end)`` of runs of words around which an occurrence may lie.

        ``keys`` has the key of the ``anchor`` words that begin at each word.
        """
        if not len(keys) or not len(self.grams):
            return
        at = np.searchsorted(self.grams, keys)
        at[at == len(self.grams)] = 0
        starts = np.flatnonzero(self.grams[at] == keys)
        starts = starts[text_of[starts] == text_of[starts + self.anchor - 1]]
        if len(starts):
            cut = np.flatnonzero((np.diff(starts) > 1) | (np.diff(text_of[starts]) > 0))
            for a, b in zip(starts[np.r_[0, cut + 1]].tolist(), starts[np.r_[cut, len(starts) - 1]].tolist()):
                yield int(text_of[a]), a, b + self.anchor

    def _following(self, v: int, x: int) -> int:
        """The state after word ``x``; 0 for none."""
        edge = v * self.n_words + x
        at = bisect_left(self.edge, edge)
        return self.to[at] if at < len(self.edge) and self.edge[at] == edge else 0

    def scan(self, words: list[int], offset: int, spans: list[list[int]], items: set[str]) -> None:
        """Stream ``words`` (numbered from ``offset``); add merged hit spans and items."""
        v = matched = 0
        for i, x in enumerate(words, offset):
            if x < 0:
                v = matched = 0
                continue
            u = self._following(v, x)
            while v and not u:
                v = self.link[v]
                matched = self.length[v]
                u = self._following(v, x)
            if not u:
                matched = 0
                continue
            v, matched = u, matched + 1
            hit = 0
            if matched >= self.window:
                hit, u = self.window, self.clamp[v]
                items.update(self.ids[k] for k in self.item[self.item_begin[u]:self.item_begin[u + 1]])
            u = self.short_at[v]
            while u:
                for k in range(self.short_begin[u], self.short_begin[u + 1]):
                    if matched >= self.short_len[k]:
                        hit = max(hit, self.short_len[k])
                        items.add(self.ids[self.short_item[k]])
                u = self.short_at[self.link[u]]
            if hit:
                add_span(spans, i + 1 - hit, i + 1)


def add_span(spans: list[list[int]], start: int, end: int) -> None:
    """Add a span that ends last to sorted, disjoint, not touching ones; it may begin before some of them."""
    while spans and spans[-1][0] >= start:
        spans.pop()
    if spans and spans[-1][1] >= start:
        spans[-1][1] = max(end, spans[-1][1])
    else:
        spans.append([start, end])


def match_words(words: Words, matchers: list[BlockMatcher]) -> tuple[dict[int, list[list[int]]], dict[int, set[str]]]:
    """Per text with a hit: its merged spans (words counted within the text) and its items."""
    hashes, text_of = words.hashes(), words.text_of()
    keys: dict[int, np.ndarray] = {}
    spans: dict[int, list[list[int]]] = {}
    items: dict[int, set[str]] = {}
    for m in matchers:
        n = len(hashes) - m.anchor + 1
        if m.anchor not in keys:
            keys[m.anchor] = _key([hashes[j:n + j] for j in range(m.anchor)]) if n > 0 else hashes[:0]
        own: dict[int, list[list[int]]] = {}
        for d, a, b in m.runs(keys[m.anchor], text_of):
            m.scan(m.numbers(hashes[a:b]), a - int(words.first[d]), own.setdefault(d, []), items.setdefault(d, set()))
        for d, found in own.items():
            if found:
                spans.setdefault(d, []).extend(found)
    for d, found in spans.items():
        if len(matchers) > 1:
            spans[d] = []
            for start, end in sorted(found, key=lambda s: s[1]):
                add_span(spans[d], start, end)
    return spans, items


def block_files(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> tuple[str, list[str]]:
    """Build the automata of a benchmark in tasks: the folder and the names of their files.

    Blocks are dealt by hash and hold ``block_words`` words on average, counted
    as half of the characters, the most there can be.  A lost task builds its
    block again under another name; only committed names are returned.
    """
    folder = shared_dir(benchmark.sparkSession, "llm-automata")
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()) \
        .select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.floor(F.length("text") / 2) + 1)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))

    def build(table: pa.Table) -> pa.Table:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.npz"
        with store.open_output_stream(f"{root}/{name}") as out:
            out.write(build_block(list(zip(table["item_id"].to_pylist(), table["text"].to_pylist())), window))
        return pa.table({"name": pa.array([name])})

    names = written(dealt.groupBy("block").applyInArrow(build, "name string"), "decontaminate-blocks")
    return folder, sorted(r["name"] for r in names.toLocalIterator())


@lru_cache(maxsize=1)
def _held(folder: str, names: tuple[str, ...], window: int) -> list[BlockMatcher]:
    """The automata of one pass, kept by a Python worker for its next task."""
    store, root = filesystem(folder)
    out = []
    for name in names:
        with store.open_input_file(f"{root}/{name}") as f:
            out.append(BlockMatcher(f.read(), window))
    return out


MATCH_SCHEMA = ("doc_id {}, n_words long, spans array<struct<start:int,end:int>>, "
                "cuts array<struct<start:int,end:int>>, item_ids array<string>")


def _matched(docs: DataFrame, folder: str, names: list[str], window: int, id_type: str) -> DataFrame:
    held = tuple(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                words = split_words(data, bounds, ALNUM)
                spans, items = match_words(words, _held(folder, held, window))
                cuts = {d: _characters(words, data, bounds, d, found) for d, found in spans.items()}
                as_pairs = lambda found: [{"start": a, "end": b} for a, b in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts().astype(np.int64)),
                     pa.array([as_pairs(spans.get(d, ())) for d in range(j - i)], pair),
                     pa.array([as_pairs(cuts.get(d, ())) for d in range(j - i)], pair),
                     pa.array([sorted(items.get(d, ())) for d in range(j - i)], pa.list_(pa.string()))],
                    ["doc_id", "n_words", "spans", "cuts", "item_ids"])

    return docs.mapInArrow(run, MATCH_SCHEMA.format(id_type))


def _characters(words: Words, data: np.ndarray, bounds: np.ndarray, d: int, spans: list[list[int]]) -> list[tuple[int, int]]:
    """Word spans of text ``d`` as spans of code points."""
    begins = np.flatnonzero((data[bounds[d]:bounds[d + 1]] & 0xC0) != 0x80)
    at = words.first[d] + np.array(spans)
    starts = np.searchsorted(begins, words.starts[at[:, 0]] - bounds[d])
    ends = np.searchsorted(begins, words.ends[at[:, 1] - 1] - bounds[d])
    return list(zip(starts.tolist(), ends.tolist()))


def merged(spans: Column) -> Column:
    """Union of spans as sorted, disjoint, not touching spans."""
    empty = F.slice(spans, 1, 0)
    return F.aggregate(F.array_sort(spans), empty, lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1),
                 F.array(F.struct(F.element_at(done, -1)["start"].alias("start"),
                                  F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(s))))


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = BLOCK_WORDS,
                    pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """Where benchmark items occur in documents.

    Words are maximal runs of letters a-z (after lower-casing A-Z), digits and
    all non-ASCII characters.  An occurrence is ``window`` consecutive words of
    an item, or a whole item of fewer words.  Returns, per row of ``docs``:
    doc_id, n_words, spans (word positions, end exclusive, merged), cuts (the
    same in code points of the text), item_ids (as strings, sorted).

    Cases: a null or empty text has no words and no spans; items with a null
    id or text, or without words, are never found; repeated items are found
    together and listed once; an empty benchmark or table gives no spans or no
    rows; repeated documents are each judged alone; other columns are ignored.
    """
    folder, names = block_files(benchmark, window, block_words)
    passes = [names[i:i + pass_blocks] for i in range(0, len(names), pass_blocks)] or [[]]
    rows = docs.select("doc_id", "text")
    if len(passes) == 1:
        return _matched(rows, folder, names, window, docs.schema["doc_id"].dataType.simpleString())
    # rows are told apart by their place, since ids may repeat
    tagged = written(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows") \
        .select(F.struct("row", "doc_id").alias("doc_id"), "text")
    all_rows = None
    for some in passes:
        part = written(_matched(tagged, folder, some, window, tagged.schema["doc_id"].dataType.simpleString()), "decontaminate-pass")
        all_rows = part if all_rows is None else all_rows.unionByName(part)
    return (all_rows.groupBy(F.col("doc_id").alias("at"))
            .agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
                 F.flatten(F.collect_list("cuts")).alias("cuts"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
            .select("at.doc_id", "n_words", merged(F.col("spans")).alias("spans"),
                    merged(F.col("cuts")).alias("cuts"), "item_ids"))


def hit_words(spans: Column) -> Column:
    """Number of words in disjoint spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def over_limit(n_hit: Column, n_words: Column, percent: int = 5) -> Column:
    """The coverage limit: hit words are at least ``percent`` of all words."""
    return (n_hit > 0) & (n_hit * 100 >= n_words * percent)


def cut_out(text: Column, cuts: Column) -> Column:
    """``text`` without the given spans of code points."""
    begins = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda s: s["end"]))
    ends = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.length(text)))
    return F.array_join(F.zip_with(begins, ends, lambda b, e: F.substr(text, b + 1, e - b)), "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5) -> DataFrame:
    """``docs`` (all columns) without benchmark text.

    Documents over the coverage limit go (hit words are ``percent`` of all or
    more); from the others the spans over the length limit (``window`` words)
    are cut out.  Documents without a hit are not touched, nor shuffled.  Cases:
    as in :func:`match_benchmark`; every row is judged by its own text, also
    rows that share a doc_id or have none.
    """
    # rows of equal key have equal texts, hence equal spans
    key = F.sha2(F.concat(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")), F.lit("\n"),
                          F.coalesce("text", F.lit(""))).cast("binary"), 256)
    rows = docs.withColumn("__key", key)
    hits = match_benchmark(rows.select(F.col("__key").alias("doc_id"), "text"), benchmark, window).where("size(spans) > 0")
    n_hit = hit_words(F.col("spans"))
    hits = written(hits.select("doc_id", F.struct(over_limit(n_hit, F.col("n_words"), percent).alias("over"), "cuts").alias("hit"))
                   .groupBy("doc_id").agg(F.first("hit").alias("hit")), "decontaminate-hits")
    some = hits.where("not hit.over").select(F.col("doc_id").alias("__id"), F.col("hit.cuts").alias("__cuts"))
    found = thinned(rows, "__key", some, "__id")
    found = found.join(some, found["__key"] == some["__id"])
    text = cut_out(found["text"], F.col("__cuts"))
    cleaned = found.select(*(text.alias(c) if c == "text" else found[c] for c in docs.columns))
    return without(rows, "__key", hits, "doc_id").select(*docs.columns).unionByName(cleaned)
