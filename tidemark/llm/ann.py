"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are turned by one random rotation and kept in the lists of a coarse
quantiser, each list in blocks of bounded size that store the rotated vectors
column by column.  Within a probed list, distances to a query are summed over
blocks of columns; after each, a hypothesis test on the partial sum (for a
random rotation, ``d`` of ``D`` columns estimate the whole distance with a
relative error of about ``1 / sqrt(d)``) abandons the candidates that cannot be
among the nearest.  What is left is scored exactly on the original vectors.

A query scans its nearest lists first.  The k-th distance found there is taken
to the other lists: those that lie wholly beyond it (by the triangle
inequality) are left out, in the others only the vectors whose distance from
the centroid allows a nearer one are scanned, under that limit from the start.

The quantiser is fitted on a bounded sample; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import written

#: Vectors that the quantiser is fitted on, at most.
SAMPLE_VECTORS = 16_000
#: Vectors per list that are aimed at; one list holds everything below twice that.
LIST_VECTORS = 512
MOST_LISTS = 4096
#: Vectors of a block of a list, and queries of a batch, about.
BLOCK_VECTORS, BATCH_QUERIES = 1024, 256
#: Part of the lists that a query probes at most, and vectors that the lists scanned first hold, per neighbour wanted.
#: In data without clusters the neighbours lie in almost all lists; the README has the recall by part.
PROBED, LEAST_PER_NEIGHBOUR = 0.9, 50
#: Columns per step of the scan and significance of its test.
COLUMNS, EPSILON = 16, 2.1
#: Relative slack of bounds by the triangle inequality.
ROUNDING = 1e-9


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part, v as doubles.

    Left out: null ids, null or empty vectors, vectors with null or non-finite
    components, zero vectors, and vectors whose number of components is not the
    commonest (the larger one on a tie).  Of rows that repeat an id, the
    smallest vector counts.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.where("vec_id is not null and embedding is not null")
            .select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
            .where(finite).where(F.exists(v, lambda x: x != 0)))
    rows = written(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "ann-vectors")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.empty((0, 0))


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _fit(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids by k-means."""
    distinct = np.unique(sample, axis=0)
    rng = np.random.default_rng(1)
    centres = distinct[rng.permutation(len(distinct))[:lists]].copy()
    for _ in range(rounds):
        nearest = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        count = np.bincount(nearest, minlength=len(centres))
        full = count > 0
        centres[full] = sums[full] / count[full, None]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(1)[None, :] - 2 * x @ centres.T


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)]
                          or [np.empty(0, dtype=np.int64)])


def fit_centres(vectors: DataFrame, n: int, lists: int) -> np.ndarray:
    """Centroids fitted by one task on a hashed share of the ``n`` vectors.

    The share is set so that about 0.9 ``SAMPLE_VECTORS`` are expected.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1))) for b in batches if b.num_rows]
        if parts:
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            centres = _fit(x[np.argsort(ids, kind="stable")], lists)
            yield pa.RecordBatch.from_arrays([pa.array([centres.tobytes()], pa.binary())], ["centres"])

    share = int(min(1.0, 0.9 * SAMPLE_VECTORS / max(n, 1)) * (1 << 40))
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < share)
    row = sample.repartition(1).mapInArrow(run, "centres binary").first()
    size = vectors.select(F.size("v")).first()
    return np.frombuffer(row["centres"]).reshape(-1, size[0]) if row else np.empty((0, 0))


def _dealt(rows: DataFrame, per_part: int) -> DataFrame:
    """``rows`` with a column part: each list is dealt into parts of about ``per_part`` rows by hashed id."""
    sizes = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / per_part).alias("parts"))
    return rows.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))


INDEX = "list int, radii binary, ids binary, rotated binary, vectors binary"


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - y) ** 2).sum(1))


def build_index(vectors: DataFrame, centres: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Index blocks of every vector, by distance from the centroid; number of vectors and radius of each list."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)  # MOST_LISTS centroids at most
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                nearest = _nearest(x, shared.value)
                yield pa.RecordBatch.from_arrays([pa.array(nearest.astype(np.int32)), pa.array(_apart(x, shared.value[nearest])),
                                                  *b.columns], ["list", "radius", "vec_id", "v"])

    def block(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("radius")
        x = _matrix(table.column("v").combine_chunks())
        turned = (x @ rotation(x.shape[1])).astype(np.float32)
        return pa.table({"list": pa.array([table.column("list")[0].as_py()], pa.int32()),
                         "radii": pa.array([table.column("radius").to_numpy().tobytes()], pa.binary()),
                         "ids": pa.array([table.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                         "rotated": pa.array([np.ascontiguousarray(turned.T).tobytes()], pa.binary()),
                         "vectors": pa.array([x.tobytes()], pa.binary())})

    lists = written(vectors.mapInArrow(assign, f"list int, radius double, vec_id {id_type}, v array<double>"), "ann-lists")
    blocks = _dealt(lists, BLOCK_VECTORS).select("list", "radius", "vec_id", "v", "part").groupBy("list", "part") \
        .applyInArrow(block, INDEX)
    sizes, radii = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres))
    for row in lists.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("r")).collect():  # MOST_LISTS rows
        sizes[row["list"]], radii[row["list"]] = row["n"], row["r"]
    return written(blocks, "ann-index"), sizes, radii


def scan_block(query: np.ndarray, turned: np.ndarray, ids: np.ndarray, rotated: np.ndarray, vectors: np.ndarray,
               own: int, k: int, within: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of the k nearest rows of a block ``within`` a distance, by the adaptive scan."""
    size = len(query)
    alive = np.flatnonzero(ids != own)
    sums = np.zeros(len(ids))
    limit = within * within
    slack = 1e-11 * (query @ query)  # rounding of the single precision columns
    for begin in range(0, size, COLUMNS):
        end = min(begin + COLUMNS, size)
        # one column block of the candidates that are left
        diff = rotated[begin:end, alive] - turned[begin:end, None]
        sums[alive] += (diff * diff).sum(0)
        if begin == 0 and len(alive) > k:  # first limit: the full distances of the most promising ones
            best = alive[np.argpartition(sums[alive], k - 1)[:k]]
            limit = min(limit, ((vectors[best] - query) ** 2).sum(1).max())
        if end < size and np.isfinite(limit):
            bound = limit * (1 + EPSILON / np.sqrt(end)) ** 2 * end / size
            alive = alive[sums[alive] <= bound * (1 + 1e-5) + slack]
    # exact distances on the original vectors; single precision only sorted out clear losers
    exact = _apart(vectors[alive], query)
    order = np.lexsort((ids[alive], exact))[:k]
    order = order[exact[order] <= within]
    return ids[alive][order], exact[order]


def probe_lists(x: np.ndarray, within: np.ndarray | None, centres: np.ndarray, sizes: np.ndarray, radii: np.ndarray,
                k: int, probed: float) -> list[np.ndarray]:
    """The lists of each query: the nearest, which hold enough vectors, or, with the
    distances ``within`` which those found k others, the further ones."""
    full = np.flatnonzero(sizes)
    at = np.argsort(_distances(x, centres[full]), axis=1, kind="stable")
    first = np.minimum((np.cumsum(sizes[full][at], axis=1) < LEAST_PER_NEIGHBOUR * k).sum(1) + 1, len(full))
    if within is None:
        return [full[at[i, :first[i]]] for i in range(len(x))]
    last = np.maximum(first, int(np.ceil(probed * len(full))))
    out = []
    for i in range(len(x)):
        lists = full[at[i, first[i]:last[i]]]
        away = _apart(centres[lists], x[i])
        out.append(lists[away - radii[lists] <= within[i] + ROUNDING * (away + radii[lists])])
    return out


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, probed: float = PROBED) -> DataFrame:
    """The k nearest of all other ``vectors`` (vec_id, embedding) for each query (a subset of them).

    Returns query_id, rank (from 1), vec_id, score: Euclidean distances in
    double precision on the original vectors, ties to the smaller vec_id; all
    candidates if there are fewer than k.

    Cases: see :func:`usable` for vectors that take no part, as query or as
    candidate; repeated ids count once; an empty table gives no rows; other
    columns are ignored.
    """
    rows = usable(vectors)
    n = rows.count()
    lists = min(MOST_LISTS, n // LIST_VECTORS, max(1, min(n, SAMPLE_VECTORS) // 16)) if n >= 2 * LIST_VECTORS else 1
    centres = fit_centres(rows, n, lists)
    index, sizes, radii = build_index(rows, centres)
    shared = rows.sparkSession.sparkContext.broadcast((centres, sizes, radii))  # MOST_LISTS centroids at most
    asked = rows.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def probe(far: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    within = b.column(2).to_numpy()
                    chosen = probe_lists(_matrix(b.column(1)), within if far else None, *shared.value, k, probed)
                    at = pa.array(np.repeat(np.arange(b.num_rows), [len(c) for c in chosen]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(chosen).astype(np.int32)),
                                                      *(c.take(at) for c in b.columns)], ["list", "vec_id", "v", "within"])
        return run

    def batch(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        return pa.table({"list": pa.array([table.column("list")[0].as_py()], pa.int32()),
                         "query_ids": pa.array([table.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                         "queries": pa.array([_matrix(table.column("v").combine_chunks()).tobytes()], pa.binary()),
                         "withins": pa.array([table.column("within").to_numpy().tobytes()], pa.binary())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = None
        for b in batches:
            for at, radius, ids, rotated, x, query_ids, q, within in zip(*(b.column(c).to_pylist() for c in (
                    "list", "radii", "ids", "rotated", "vectors", "query_ids", "queries", "withins"))):
                ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                x, q = np.frombuffer(x).reshape(len(ids), -1), np.frombuffer(q).reshape(len(query_ids), -1)
                rotated = np.frombuffer(rotated, np.float32).reshape(x.shape[1], len(ids))
                turn = rotation(x.shape[1]) if turn is None else turn
                turned = (q @ turn).astype(np.float32)
                # only vectors of a ring around the centroid can be near enough
                radius, within, away = np.frombuffer(radius), np.frombuffer(within), _apart(q, shared.value[0][at])
                reach = within + ROUNDING * (away + radius[-1])
                lo, hi = np.searchsorted(radius, away - reach, "left"), np.searchsorted(radius, away + reach, "right")
                found = [scan_block(q[i], turned[i], ids[a:z], rotated[:, a:z], x[a:z], query_ids[i], k, within[i])
                         for i, (a, z) in enumerate(zip(lo, hi))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, [len(f[0]) for f in found])), pa.array(np.concatenate([f[0] for f in found])),
                     pa.array(np.concatenate([f[1] for f in found]))], ["query_id", "vec_id", "score"])

    def scanned(asking: DataFrame, far: bool) -> DataFrame:
        probes = written(asking.select("vec_id", "v", "within")
                         .mapInArrow(probe(far), f"list int, vec_id {id_type}, v array<double>, within double"), "ann-probes")
        batches = _dealt(probes, BATCH_QUERIES).select("list", "vec_id", "v", "within", "part").groupBy("list", "part") \
            .applyInArrow(batch, "list int, query_ids binary, queries binary, withins binary")
        return index.join(batches, "list").mapInArrow(search, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)

    near = written(ranked(scanned(asked.withColumn("within", F.lit(float("inf"))), False)), "ann-near")
    kth = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("within"))
    further = asked.join(kth, "vec_id", "left").withColumn("within", F.coalesce("within", F.lit(float("inf"))))
    return ranked(near.drop("rank").unionByName(scanned(further, True))).select("query_id", "rank", "vec_id", "score")
