"""Two-phase replacement of a folder (a partition or a table).

The new rows are written to a folder beside the old ones first; only when that
job has committed are the two exchanged by renames.  A job that fails leaves
the old rows as they were.  A driver that dies between the renames leaves all
rows under the swap folder, and the next replacement of the same target, or
:func:`recover`, finishes the exchange.

Swap folders start with ``_``, so Spark's readers do not see them.  A target
has one writer at a time.  Renames are metadata operations on HDFS-like
stores; a reader that lists the target between the two renames finds it
missing, never half of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SWAP = "_swap"
#: Where exchanges of single files are prepared and journalled, under the table.
MOVES = "_moves"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def swap_folder(target: str) -> str:
    """Where replacements of ``target`` are prepared: beside it, invisible to readers."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/{SWAP}/{name.replace('=', '-')}"


def _rename(spark: SparkSession, fs, source: str, target: str) -> None:
    to = _path(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_path(spark, source), to):
        raise RuntimeError(f"cannot rename {source} to {target}")


def _exchange(spark: SparkSession, work: str, target: str) -> None:
    fs = _fs(spark, target)
    if fs.exists(_path(spark, target)):
        _rename(spark, fs, target, f"{work}/old")
    _rename(spark, fs, f"{work}/new", target)
    fs.delete(_path(spark, work), True)


def recover(spark: SparkSession, target: str) -> bool:
    """Finish what a dead writer of ``target`` left: True if the target was missing and has been put back.

    A committed new folder takes the place, otherwise the old rows return.
    Unfinished writes are removed.  Exchanges of files in the target's table
    that have been journalled are finished first.
    """
    finish_moves(spark, table_of(target))
    fs, folder = _fs(spark, target), swap_folder(target)
    if not fs.exists(_path(spark, folder)):
        return False
    restored = False
    for status in fs.listStatus(_path(spark, folder)):
        work = status.getPath().toString()
        if not fs.exists(_path(spark, target)) and fs.exists(_path(spark, f"{work}/old")):
            committed = fs.exists(_path(spark, f"{work}/new/_SUCCESS"))
            _rename(spark, fs, f"{work}/new" if committed else f"{work}/old", target)
            restored = True
        fs.delete(_path(spark, work), True)
    return restored


def recover_table(spark: SparkSession, table_path: str) -> list[str]:
    """:func:`recover` for a table and all its partitions; the partitions put back.

    For the start of a run, before any writer of the table.
    """
    restored = [table_path] if recover(spark, table_path) else []
    folder = f"{table_path.rstrip('/')}/{SWAP}"
    fs = _fs(spark, folder)
    if fs.exists(_path(spark, folder)):
        for status in fs.listStatus(_path(spark, folder)):
            column, _, value = status.getPath().getName().partition("-")
            target = f"{table_path.rstrip('/')}/{column}={value}"
            if recover(spark, target):
                restored.append(target)
    return restored


def table_of(target: str) -> str:
    """The table that a partition folder belongs to; a table itself is its own."""
    path = target.rstrip("/")
    while "=" in path.rpartition("/")[2]:
        path = path.rpartition("/")[0]
    return path


def journal_moves(spark: SparkSession, work: str, old: list[str], new: list[tuple[str, str]]) -> None:
    """Commit an exchange of files: ``old`` ones go, ``new`` ones (from, to) come.

    The journal is a folder that Spark commits; from then on the exchange is
    finished by whoever comes next, see :func:`finish_moves`.
    """
    lines = [(json.dumps({"old": p}),) for p in old] + [(json.dumps({"new": list(m)}),) for m in new]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{work}/journal")


def finish_moves(spark: SparkSession, table_path: str) -> int:
    """Finish the journalled file exchanges of a table, drop the others; the number finished.

    Old files go first: a reader may find rows missing until the end, never
    twice.  Every step can be repeated.
    """
    folder = f"{table_path.rstrip('/')}/{MOVES}"
    fs, done = _fs(spark, folder), 0
    if not fs.exists(_path(spark, folder)):
        return 0
    for status in fs.listStatus(_path(spark, folder)):
        work = status.getPath().toString()
        if fs.exists(_path(spark, f"{work}/journal/_SUCCESS")):
            steps = [json.loads(r.value) for r in spark.read.text(f"{work}/journal").toLocalIterator()]
            for step in steps:
                if "old" in step:
                    fs.delete(_path(spark, step["old"]), False)
            for source, target in (step["new"] for step in steps if "new" in step):
                if fs.exists(_path(spark, source)):
                    _rename(spark, fs, source, target)
            done += 1
        fs.delete(_path(spark, work), True)
    return done


def replace_folder(df: DataFrame, target: str, write: Callable[[DataFrame, str], None] | None = None) -> None:
    """``target`` gets the rows of ``df``, which may be read from it."""
    spark = df.sparkSession
    recover(spark, target)
    work = f"{swap_folder(target)}/{uuid.uuid4().hex}"
    try:
        (write or (lambda rows, path: rows.write.parquet(path)))(df, f"{work}/new")
    except BaseException:
        _fs(spark, work).delete(_path(spark, work), True)
        raise
    _exchange(spark, work, target)


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def exchange_folder(spark: SparkSession, prepared: str, target: str, write_empty: Callable[[str], None]) -> None:
    """``target`` becomes the committed folder ``prepared``, or if there is none what ``write_empty`` writes."""
    recover(spark, target)
    fs, work = _fs(spark, target), f"{swap_folder(target)}/{uuid.uuid4().hex}"
    if fs.exists(_path(spark, prepared)):
        _rename(spark, fs, prepared, f"{work}/new")
        fs.create(_path(spark, f"{work}/new/_SUCCESS"), True).close()  # its job has committed: recovery goes forward
    else:
        write_empty(f"{work}/new")
    _exchange(spark, work, target)
