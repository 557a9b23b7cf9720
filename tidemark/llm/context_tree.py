"""Language-model scores by context-tree weighting.

A text is a sequence of bytes, ended by a byte that UTF-8 never uses; before
its first byte stand ``depth`` bytes of another unused value.  Each byte is
eight binary decisions.  A decision has a context tree of its own: its node at
depth d is given by the d bytes before, and holds how often the training texts
went either way there.  A node's estimate is Krichevsky-Trofimov's; its
weighted probability is half its estimate's and half the product of its
children's, and that fixes how much of a prediction each depth gets.

What is counted is (depth + 1)-grams of bytes.  All nodes that end in the same
two bytes lie under one another, so a task takes the distinct grams of one such
pair and has the whole subtree; the levels above it are a few thousand rows.
For scoring, the corpus is cut into chunks: a chunk asks once for each distinct
gram (and word) in it, whose log probabilities are worked out once for all
chunks and joined back, and then sums them over its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import written
from tidemark.llm.words import LOWER, NON_SPACE, spelled, split_words, text_slices, whole_hashes

#: Bytes of context; a gram has one more and must fit 8 bytes.
DEPTH = 4
#: Bytes no UTF-8 text has: before the first byte, after the last one.
PAD, END = 0xFE, 0xFF
#: A chunk's texts have about so many bytes (a longer text alone).
CHUNK_BYTES = 32 << 20
#: Grams or words that are held, besides twice the distinct ones, before equal ones are summed up.
_HELD = 500_000

_U = np.uint64


# --- the tree ---

_COEFFICIENTS = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x >= 0.5 (Stirling's series from 10 on)."""
    x = x.astype(np.float64)
    shift, y = np.zeros_like(x), x.copy()
    while (small := y < 10).any():
        shift[small] += np.log(y[small])
        y[small] += 1
    z = 1 / (y * y)
    series = np.zeros_like(y)
    for c in reversed(_COEFFICIENTS):
        series = series * z + c
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series / y - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Level:
    """Nodes of one depth: ``key`` (context and bits so far) ascending, counts, log weighted probability, share of the
    prediction that the node keeps for its own estimate."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        own = log_estimate(zeros, ones)
        self.key, self.zeros, self.ones = key, zeros, ones
        self.estimate = (ones + 0.5) / (zeros + ones + 1.0)
        if below is None:
            self.weighted, self.share = own, np.ones(len(key))
        else:
            self.weighted = np.logaddexp(own, below) - np.log(2)
            self.share = np.exp(own - np.log(2) - self.weighted)


def decisions(gram: np.ndarray, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(key, bit)`` of the eight decisions of a gram's last byte after the context ``gram >> shift``."""
    context, byte = (gram >> _U(shift)) << _U(8), gram & _U(255)
    for k in range(8):
        yield context | _U(1 << k) | (byte >> _U(8 - k)), ((byte >> _U(7 - k)) & _U(1)).astype(np.int64)


def _grouped(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, which = np.unique(key, return_inverse=True)
    return unique, *(np.bincount(which, v, len(unique)) for v in values)


def leaves(gram: np.ndarray, n: np.ndarray) -> Level:
    """The deepest level, from training grams and their counts."""
    parts = list(decisions(gram, 8))
    bit = np.concatenate([b for _, b in parts])
    times = np.tile(n, 8)
    return Level(*_grouped(np.concatenate([k for k, _ in parts]), times * (1 - bit), times * bit), None)


def above(level: Level) -> Level:
    """The level above: a context loses its oldest byte."""
    key = ((level.key >> _U(16)) << _U(8)) | (level.key & _U(255))
    key, zeros, ones, below = _grouped(key, level.zeros, level.ones, level.weighted)
    return Level(key, zeros, ones, below)


def log_probability(gram: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each gram's last byte after the others; ``levels`` from the root down."""
    total = np.zeros(len(gram))
    depth = len(levels) - 1
    each = [list(decisions(gram, 8 * (depth + 1 - d))) for d in range(depth + 1)]
    for k in range(8):
        p = np.full(len(gram), 0.5)
        for d in range(depth, -1, -1):  # a node without training counts predicts 1/2 whatever is below
            key, bit = each[d][k]
            level = levels[d]
            at = np.minimum(np.searchsorted(level.key, key), len(level.key) - 1)
            seen = level.key[at] == key
            p = np.where(seen, level.share[at] * level.estimate[at] + (1 - level.share[at]) * p, 0.5)
        total += np.log10(np.where(bit == 1, p, 1 - p))
    return total


# --- grams of texts ---

def grams(data: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(grams, first)`` of a slice of texts: one gram for each byte and the end; text d has ``first[d]:first[d + 1]``.

    The most recent byte of a context comes first, then older ones, then the byte predicted.
    """
    sizes = np.diff(bounds)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    texts = np.arange(len(sizes))
    line = np.empty(len(data) + (depth + 1) * len(sizes), dtype=np.uint8)  # pads, text, end
    starts = first[:-1] + depth * texts
    at = np.arange(len(data)) + np.repeat(starts + depth - bounds[:-1], sizes)
    line[at] = LOWER[data]
    for d in range(depth):
        line[starts + d] = PAD
    line[starts + depth + sizes] = END
    place = np.arange(first[-1]) + np.repeat(depth * (texts + 1), sizes + 1)
    wide = line.astype(_U)
    out = np.zeros(len(place), dtype=_U)
    for d in range(1, depth + 1):
        out |= wide[place - d] << _U(8 * (depth + 1 - d))
    return out | wide[place], first


def _chunked(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, chunk, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            sizes = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1])
            out = np.empty(len(sizes), dtype=np.int64)
            for x, n in enumerate(sizes.tolist()):
                if size and size + n > chunk_bytes:
                    chunk, size = chunk + 1, 0
                size += n + 1
                out[x] = task << 32 | chunk
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "chunk"])

    return run


class _Distinct:
    """Distinct keys with sums of their counts, and for words their spelling."""

    def __init__(self):
        self.parts, self.held, self.merged = [], 0, 0

    def add(self, keys: np.ndarray, n: np.ndarray, words: pa.Array | None = None) -> None:
        self.parts.append((keys, n, words))
        self.held += len(keys)
        if self.held > _HELD + 2 * self.merged:
            self.parts = [self.all()]
            self.held = self.merged = len(self.parts[0][0])

    def all(self) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        keys, n = (np.concatenate(x) for x in list(zip(*self.parts))[:2])
        unique, first, which = np.unique(keys, return_index=True, return_inverse=True)
        words = None
        if self.parts[0][2] is not None:
            words = pa.chunked_array([x[2] for x in self.parts]).take(pa.array(first)).combine_chunks()
        return unique, np.bincount(which, n, len(unique)).astype(np.int64), words


def _asked(depth: int):
    """Arrow function: the distinct grams and words of each chunk, with their counts in training texts."""
    def rows(chunk: int, grams_: pa.Array, words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), chunk)), grams_, words, pa.array(n.astype(np.int64))],
                                          ["chunk", "gram", "word", "n"])

    def answer(chunk: int, found: _Distinct, words: _Distinct, ends: int) -> Iterator[pa.RecordBatch]:
        keys, n, _ = found.all()
        yield rows(chunk, pa.array(keys.view(np.int64)), pa.nulls(len(n), pa.string()), n)
        # the empty word stands for the ends
        words.add(np.zeros(1, dtype=_U), np.array([ends]), pa.array([""], pa.large_string()))
        _, n, texts = words.all()
        yield rows(chunk, pa.nulls(len(n), pa.int64()), texts.cast(pa.string()), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            chunks = batch.column(2).to_numpy()
            for lo, hi in _runs(chunks):
                if chunks[lo] != now:
                    if now is not None:
                        yield from answer(now, found, words, ends)
                    now, found, words, ends = int(chunks[lo]), _Distinct(), _Distinct(), 0
                train = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                ends += int(train.sum())
                for i, j, data, bounds in text_slices(batch.column(0).slice(lo, hi - lo)):
                    keys, first = grams(data, bounds, depth)
                    learnt = np.repeat(train[i:j], np.diff(first))
                    for some, counts in ((keys[learnt], True), (keys[~learnt], False)):
                        unique, n = np.unique(some, return_counts=True)
                        found.add(unique, n if counts else np.zeros(len(n), dtype=np.int64))
                    split = split_words(data, bounds, NON_SPACE)
                    if len(split.starts):
                        unique, at, which = np.unique(split.hashes(), return_index=True, return_inverse=True)
                        words.add(unique, np.bincount(which, train[i:j][split.text_of()], len(at)), spelled(split, at))
        if now is not None:
            yield from answer(now, found, words, ends)

    return run


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])) if len(values) else []


# --- the model ---

_NODES = "key long, zeros double, ones double, weighted double"


def _subtree(depth: int):
    """Levels from ``depth`` up to 2 of the grams that end in one pair of bytes."""
    def run(gram: np.ndarray, n: np.ndarray) -> list[Level]:
        levels = [leaves(gram[n > 0], n[n > 0])]
        for _ in range(depth - 2):
            levels.append(above(levels[-1]))
        return levels[::-1]

    return run


def _top_of_subtree(depth: int):
    def run(table: pa.Table) -> pa.Table:
        top = _subtree(depth)(table["gram"].to_numpy().view(_U), table["n"].to_numpy())[0]
        return pa.table({"key": top.key.view(np.int64), "zeros": top.zeros, "ones": top.ones, "weighted": top.weighted})

    return run


def _upper_levels(grams_: DataFrame, depth: int) -> list[Level]:
    """Depths 0 and 1, from the sums over depth 2: at most 256 * 255 rows reach the driver, whatever the corpus.

    Log probabilities are summed as decimals, so that the order does not matter.
    """
    second = grams_.where("n > 0").groupBy("pair").applyInArrow(_top_of_subtree(depth), _NODES)
    parent = F.shiftright("key", 16) * 256 + F.col("key").bitwiseAND(255)
    rows = second.groupBy(parent.alias("key")).agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"),
        F.sum(F.col("weighted").cast("decimal(28,9)")).cast("double").alias("below")).orderBy("key").toPandas()
    first = Level(rows["key"].to_numpy().astype(np.uint64), rows["zeros"].to_numpy(), rows["ones"].to_numpy(), rows["below"].to_numpy())
    return [above(first), first]


def gram_scores(grams_: DataFrame, depth: int) -> DataFrame:
    """``gram, score``: log10 probability of each gram's last byte; ``grams_``: gram, n (times in training), pair."""
    upper = _upper_levels(grams_, depth)
    if not len(upper[0].key):  # nothing to learn from: every decision is even
        return grams_.select("gram", F.lit(8 * np.log10(0.5)).alias("score"))
    shared = grams_.sparkSession.sparkContext.broadcast(upper)

    def run(table: pa.Table) -> pa.Table:
        gram, n = table["gram"].to_numpy().view(_U), table["n"].to_numpy()
        lower = _subtree(depth)(gram, n) if (n > 0).any() else [Level(np.array([0], _U), np.zeros(1), np.zeros(1), None)] * (depth - 1)
        return pa.table({"gram": table["gram"], "score": log_probability(gram, shared.value + lower)})

    return grams_.groupBy("pair").applyInArrow(run, "gram long, score double")


# --- scoring ---

def _score(depth: int, n_tokens: int, n_distinct: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        is_word = answers["word"].is_valid().to_numpy()
        gram, value = answers["gram"].filter(pa.array(~is_word)).to_numpy().view(_U), answers["value"].to_numpy()
        order = np.argsort(gram)
        gram, score = gram[order], value[~is_word][order]
        unique = np.concatenate([[True], gram[1:] != gram[:-1]])
        index, score = pd.Index(gram[unique]), score[unique]
        held = answers["word"].filter(pa.array(is_word)).combine_chunks()
        count, count_of, at_end = value[is_word], pd.Index(whole_hashes(held)), pc.equal(held, "").to_numpy(zero_copy_only=False)
        of = lambda c: np.log10((c + 0.5) / (n_tokens + 0.5 * (n_distinct + 1)))
        ends = float(count[at_end][0])
        unique_words = ~count_of.duplicated()
        count, count_of = count[unique_words], count_of[unique_words]
        out = []
        for batch in texts.to_batches():
            for i, j, data, bounds in text_slices(batch.column("text")):
                keys, first = grams(data, bounds, depth)
                total = np.add.reduceat(score[index.get_indexer(keys)], first[:-1])
                split = split_words(data, bounds, NON_SPACE)
                base = np.full(j - i, of(ends))
                known = np.full(j - i, int(ends > 0))
                if len(split.starts):
                    c = count[count_of.get_indexer(split.hashes())]
                    text_of = split.text_of()
                    base = base + np.bincount(text_of, of(c), j - i)
                    known = known + np.bincount(text_of, c > 0, j - i).astype(np.int64)
                out.append(pa.table({"doc_id": batch.column("doc_id").slice(i, j - i), "train": batch.column("train").slice(i, j - i),
                                     "n_bytes": np.diff(bounds), "n_tokens": split.counts().astype(np.int64) + 1,
                                     "n_known": known.astype(np.int64), "base_score": base, "score": total}))
        return pa.concat_tables(out)

    return run


def score_texts(docs: DataFrame, train: Column, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, train, n_bytes, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z).  ``score`` is the log10 probability of the
    bytes and the end under the tree of the rows where ``train`` holds;
    ``-score / log10(2) / (n_bytes + 1)`` is the code length per byte.
    ``base_score`` is that of the words and the end under word counts of the
    same rows with half a count added.  ``depth`` is 2 to 7 bytes.

    Cases: a null text is empty and has its end only; a null ``train`` does not
    hold; rows with a null or repeated doc_id are scored, and counted, like
    others; without training rows every byte has probability 1/256 and every
    token the same base probability; an empty table gives no rows; other
    columns are ignored.  A long text is a chunk of its own.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    rows = written(rows.mapInArrow(_chunked(chunk_bytes), f"doc_id {id_type}, text string, train boolean, chunk long"), "ctw-texts", "zstd")
    asked = written(rows.select("text", "train", "chunk").mapInArrow(_asked(depth), "chunk long, gram long, word string, n long"), "ctw-asked")

    pair = F.shiftrightunsigned("gram", 8 * (depth - 1))
    grams_ = asked.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")).withColumn("pair", pair)
    scores = gram_scores(written(grams_, "ctw-grams"), depth)
    counts = written(asked.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "ctw-words")
    n_tokens, n_distinct = counts.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()

    answers = asked.where("gram is not null").select("chunk", "gram").join(scores, "gram") \
        .select("chunk", "gram", F.lit(None).cast("string").alias("word"), F.col("score").alias("value")) \
        .unionByName(asked.where("word is not null").select("chunk", "word").join(counts, "word")
                     .select("chunk", F.lit(None).cast("long").alias("gram"), "word", F.col("n").cast("double").alias("value")))
    out = f"doc_id {id_type}, train boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double"
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(depth, n_tokens, n_distinct), out) \
        .select("doc_id", "train", "n_bytes", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
