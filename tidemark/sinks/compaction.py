"""K8 by size: small files of a table's partitions are packed into larger ones.

Only the small files are rewritten.  The files of a partition folder that are
below ``small_below`` bytes are dealt, smallest first, into bins of about
``target`` bytes; a bin of two files or more becomes one file.  Larger files and
lone small ones are not read.  Files are taken in batches of a bounded number,
each one job whose files are exchanged under a journal (``swap.py``): a run that
dies is rolled back before the journal and finished after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sinks.swap import MOVES, _fs, _path, finish_moves, journal_moves
from tidemark.sources.manifest import decoded_path

TARGET_BYTES = 512 << 20
#: Files exchanged by one job and one journal, at most (one bin may exceed it).
BATCH_FILES = 5000


def data_files(spark: SparkSession, table_path: str) -> DataFrame:
    """``(path, length, folder)`` of the Parquet files of a table, contents not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
            .load(table_path).select("path", "length", F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder")))


def packed(files: DataFrame, target: int = TARGET_BYTES, small_below: int | None = None) -> DataFrame:
    """``(path, length, folder, bin)`` of the files to rewrite.

    A bin ends with the file that reaches the target, so it holds less than
    target + small_below bytes.  ``bin`` counts within a folder.
    """
    small = files.where(F.col("length") < (small_below or target // 2))
    before = Window.partitionBy("folder").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, -1)
    dealt = small.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target))
    return dealt.withColumn("_files", F.count(F.lit(1)).over(Window.partitionBy("folder", "bin"))) \
        .where("_files > 1").drop("_files")


def _batches(plan: DataFrame, limit: int) -> Iterator[list[list]]:
    """Whole bins, as lists of (path, folder), together at most ``limit`` files unless one bin has more."""
    batch, held, at = [], 0, None
    bins = plan.groupBy("folder", "bin").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("folder", "bin")
    for folder, _, paths in bins.toLocalIterator():
        if batch and held + len(paths) > limit:
            yield batch
            batch, held = [], 0
        batch.append([(p, folder) for p in paths])
        held += len(paths)
    if batch:
        yield batch


def compact(spark: SparkSession, table_path: str, target: int = TARGET_BYTES, small_below: int | None = None,
            batch_files: int = BATCH_FILES) -> int:
    """Compact a table; the number of files that have been replaced.

    Files of one bin may lack columns that others have (NULL then); a column
    whose types differ raises before anything is exchanged.  A missing table
    raises, one without small files is left as it is.  The table has one writer
    at a time.
    """
    finish_moves(spark, table_path)
    replaced = 0
    for batch in _batches(packed(data_files(spark, table_path), target, small_below), batch_files):
        replaced += _compact_batch(spark, table_path, batch)
    return replaced


def _compact_batch(spark: SparkSession, table_path: str, batch: list[list]) -> int:
    work = f"{table_path.rstrip('/')}/{MOVES}/{uuid.uuid4().hex}"
    old = [path for members in batch for path, _ in members]
    fs = _fs(spark, work)
    try:
        # at most BATCH_FILES names, and the footers of these files only
        bins = spark.createDataFrame([(p, i) for i, members in enumerate(batch) for p, _ in members], "_path string, _bin int")
        rows = spark.read.option("mergeSchema", True).parquet(*old)
        columns = rows.columns
        rows = rows.withColumn("_path", decoded_path(F.col("_metadata.file_path"))) \
            .join(F.broadcast(bins), "_path")
        rows.repartition(len(batch), "_bin").select("_bin", *columns).write.partitionBy("_bin").parquet(f"{work}/data")
        moves = []
        for i, members in enumerate(batch):
            made = _path(spark, f"{work}/data/_bin={i}")
            if fs.exists(made):  # files without rows leave none
                for status in fs.listStatus(made):
                    path = status.getPath()
                    moves.append((path.toString(), f"{members[0][1]}/{path.getName()}"))
        journal_moves(spark, work, old, moves)
    except BaseException:
        fs.delete(_path(spark, work), True)
        raise
    finish_moves(spark, table_path)
    return len(old)
