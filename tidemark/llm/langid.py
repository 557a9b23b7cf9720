"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 2- and 3-grams of the lower-cased letters of a text, other
characters being one kind of gap, hashed to ``FEATURES`` columns.  A text's
value of a feature is its share of the text's n-grams times the feature's
inverse document frequency.  Document frequencies cover every document that
may be learned from; the weights are trained with follow-the-regularised-leader
(FTRL-proximal, elastic net) on a bounded sample of labelled documents, and a
temperature fitted on a part of the sample kept aside calibrates the scores.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import thinned, written
from tidemark.llm.words import mix

FEATURES = 1 << 15
#: Labelled documents per language that are fitted on (the bound of the sample).
SAMPLE_PER_LANGUAGE = 1500
#: Part of the sample, in percent, that only fits the temperature.
ASIDE = 20
#: Values are shares times this, which puts the learning rate in its usual range.
SCALE = 50.0
SLICE_CHARS = 1 << 18

#: Stands for every character that is not a letter.
_GAP = 0
_folded = _letters = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code point and letter flag of each code point of the first three planes and the rest."""
    global _folded, _letters
    if _folded is None:
        n = 0x40000
        _letters = np.zeros(0x110000, dtype=bool)
        _folded = np.arange(0x110000, dtype=np.uint32)
        for c in range(n):
            ch = chr(c)
            if ch.isalpha():
                _letters[c] = True
                low = ch.lower()
                if len(low) == 1:
                    _folded[c] = ord(low)
        _folded[~_letters] = _GAP
    return _folded, _letters


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(feature, first, letters)``: hashed n-grams of all texts, where each text's begin, letters per text."""
    folded, _ = _tables()
    joined = "".join((t or "") + "\n" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])])
    x = np.zeros(len(points) + 2, dtype=np.uint64)  # a gap stands before and after each text
    x[1:-1] = folded[points]
    letter = x != 0
    # one position per letter or gap after a letter; repeated gaps give nothing
    two = mix(x[:-1] * np.uint64(0x9E3779B1) + x[1:] + np.uint64(1 << 40))
    three = mix((x[:-2] * np.uint64(0x85EBCA77) + x[1:-1]) * np.uint64(0xC2B2AE3D) + x[2:])
    shift = np.uint64(64 - FEATURES.bit_length() + 1)
    has2 = (letter[:-1] | letter[1:])[:-1]
    has3 = letter[1:-1]
    position = np.arange(len(has3))
    f = np.concatenate([(two[:-1] >> shift)[has2], (three >> shift)[has3]]).astype(np.int32)
    at = np.concatenate([position[has2], position[has3]])
    text = np.searchsorted(bounds, at, side="right") - 1
    order = np.argsort(text, kind="stable")
    f, text = f[order], text[order]
    count = np.concatenate([[0], np.cumsum(letter[1:])])
    return f, np.searchsorted(text, np.arange(len(texts) + 1)), count[bounds[1:]] - count[bounds[:-1]]


def _slices(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    texts = column.to_pylist()
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= SLICE_CHARS):
            size += len(texts[j] or "")
            j += 1
        yield i, j, texts[i:j]
        i = j


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Per feature the number of documents that have it, and the number of documents.

    Each task sends at most ``FEATURES + 1`` counts, which are summed by
    feature; that many numbers reach the driver whatever the input is.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, dtype=np.int64)
        seen = np.zeros(FEATURES, dtype=bool)
        for batch in batches:
            for i, j, texts in _slices(batch.column(0)):
                f, first, _ = _grams(texts)
                for d in range(j - i):
                    own = f[first[d]:first[d + 1]]
                    seen[own] = True
                    total[:-1] += seen
                    seen[own] = False
                total[-1] += j - i
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["feature", "df"])

    sums = docs.select("text").mapInArrow(count, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for row in sums.toLocalIterator():
        out[row["feature"]] = row["df"]
    return out[:-1], int(out[-1])


@dataclass
class Model:
    """Languages, weight of each feature times its idf, bias, temperature."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=np.array(self.languages), table=self.table, bias=self.bias,
                 temperature=self.temperature)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Model:
        x = np.load(io.BytesIO(raw))
        return Model(x["languages"].tolist(), x["table"], x["bias"], float(x["temperature"]))

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Logits per text and language, and letters per text."""
        f, first, letters = _grams(texts)
        n = np.diff(first)
        out = np.tile(self.bias, (len(texts), 1))
        full = np.flatnonzero(n)
        if len(full):
            sums = np.add.reduceat(self.table[f].astype(np.float64), first[full], axis=0)
            out[full] += SCALE * sums / n[full, None]
        return out, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        z, letters = self.logits(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        p = _softmax(z / self.temperature)
        best = np.argmax(p, axis=1)
        known = letters > 0
        return ([self.languages[b] if k else "und" for b, k in zip(best, known)],
                np.where(known, p[np.arange(len(p)), best], 0.0))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fit(samples: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, epochs: int = 3, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net; samples are (class, features, values).  Returns weights, bias."""
    z = np.zeros((FEATURES + 1, n_classes))
    n = np.zeros_like(z)

    def weights(rows: np.ndarray) -> np.ndarray:
        zz = z[rows]
        w = -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[rows])) / alpha + l2)
        return np.where(np.abs(zz) <= l1, 0.0, w)

    for epoch in range(epochs):
        for s in np.random.default_rng(epoch).permutation(len(samples)):
            y, rows, values = samples[s]
            w = weights(rows)
            p = _softmax(values @ w)
            p[y] -= 1.0
            g = values[:, None] * p
            sigma = (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / alpha
            z[rows] += g - sigma * w
            n[rows] += g * g
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature of the least negative log likelihood, by golden section on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(z / np.exp(t))[np.arange(len(y)), y]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    a, b, r = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(learn: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on ``learn`` (doc_id, text, lang; rows without lang or text teach nothing).

    The sample is, per language, the ``per_language`` documents of the smallest
    hashed id and text; one task fits it, as its size is bounded by that parameter.
    """
    learn = learn.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    df, n_docs = document_frequencies(learn)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    rows = learn.withColumn("id_hash", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    chosen = written(rows.select("lang", "id_hash").distinct()
                     .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("id_hash")))
                     .where(F.col("place") <= per_language), "langid-sample")
    sample = thinned(rows.select("text", "lang", "id_hash"), "id_hash", chosen, "id_hash") \
        .join(chosen, ["lang", "id_hash"]).dropDuplicates(["lang", "id_hash"])

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _slices(batch.column(0)):
                f, first, letters = _grams(texts)
                rows, values = [], []
                for d in range(j - i):
                    own, n = np.unique(f[first[d]:first[d + 1]], return_counts=True)
                    rows.append(own)
                    values.append((SCALE * n / max(n.sum(), 1)).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i),
                     pa.array(rows, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                    ["lang", "place", "features", "shares"]).filter(pa.array(letters > 0))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            f, s = batch.column(2), batch.column(3)
            for k, (lang, place) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                own = f[k].values.to_numpy()
                rows.append((lang, place, own, s[k].values.to_numpy() * idf[own]))
        rows.sort(key=lambda r: r[:2])
        languages = sorted({r[0] for r in rows})
        number = {x: k for k, x in enumerate(languages)}
        bias = np.array([FEATURES]), np.array([1.0])
        samples = [(number[lang], np.concatenate([own, bias[0]]), np.concatenate([x, bias[1]]), place % 100 < ASIDE)
                   for lang, place, own, x in rows]
        fitted = [s[:3] for s in samples if not s[3]] or [s[:3] for s in samples]
        if languages:
            w, b = _fit(fitted, len(languages))
            aside = [s for s in samples if s[3]]
            z = np.array([x[:-1] @ w[own[:-1]] + b for _, own, x, _ in aside]).reshape(-1, len(languages))
            model = Model(languages, (w * idf[:, None]).astype(np.float32), b,
                          _temperature(z, np.array([s[0] for s in aside], dtype=int)))
        else:
            model = Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0), 1.0)
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], ["model"])

    vectors = sample.select("text", "lang", "place").mapInArrow(
        featured, "lang string, place int, features array<int>, shares array<float>")
    return Model.load(vectors.repartition(1).mapInArrow(fit, "model binary").first()["model"])


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score (calibrated probability of lang_pred).

    The whole text is used.  Cases: a null text or one without letters is
    ``und`` with score 0; without any learned language all are ``und``; rows
    with a null or repeated doc_id are predicted like others; an empty table
    gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _slices(batch.column(1)):
                languages, scores = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(languages, pa.string()), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _slices(batch.column(text)):
                languages, scores = shared.value.predict(texts)
                keep = [x != "und" and s >= least for x, s in zip(languages, scores)]
                yield batch.slice(i, j - i).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
