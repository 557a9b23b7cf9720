"""Table sinks (K1-K8) over Parquet directory tables.

Every write goes through Spark's commit protocol: task output is staged and
only committed by the job, so a lost executor re-runs its tasks without
leaving partial files in the table.  Replacements of a partition or a table
are prepared beside it and exchanged afterwards (``swap.py``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.swap import SWAP, exchange_folder, finish_moves, remove, replace_folder


def partition_dir(table_path: str, part_col: str, value) -> str:
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y%m%d%H")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return f"{table_path.rstrip('/')}/{part_col}={value}"


def replace_partition(df: DataFrame, table_path: str, part_col: str, value) -> str:
    """K1 / K2 (``table$YYYYMMDD`` / ``$YYYYMMDDHH`` with WRITE_TRUNCATE).

    Exactly one partition directory is exchanged, in two phases: a job that
    fails leaves the old rows.  Unlike a dynamic partition overwrite, an empty
    ``df`` empties the partition (T12).  The first write creates the table.
    """
    target = partition_dir(table_path, part_col, value)
    replace_folder(df.drop(part_col) if part_col in df.columns else df, target)
    return target


def replace_partitions(df: DataFrame, table_path: str, part_cols: Sequence[str]) -> None:
    """Replace every partition present in ``df`` in one job (dynamic
    partition overwrite); partitions absent from ``df`` are left alone.

    Rows are rebalanced on the partition keys first; AQE splits a skewed key
    (one hot day) across several writers instead of one task.
    """
    (df.hint("rebalance", *part_cols)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*part_cols).parquet(table_path))


def replace_listed_partitions(df: DataFrame, table_path: str, part_col: str, values: Sequence) -> list[str]:
    """Replace the partitions of all ``values`` by the rows of ``df``, written in one job.

    Unlike a dynamic overwrite, a value without rows gets an empty partition
    (T12).  Rows of other values are an error of the caller and are not written.
    The job commits before the first partition is exchanged.
    """
    spark = df.sparkSession
    staged = f"{table_path.rstrip('/')}/{SWAP}/listed-{uuid.uuid4().hex}"
    kept = df.filter(F.col(part_col).isin([F.lit(v) for v in values]))
    kept.hint("rebalance", part_col).write.partitionBy(part_col).parquet(staged)
    rows = spark.read.schema(df.drop(part_col).schema)
    targets = []
    for value in values:
        target = partition_dir(table_path, part_col, value)
        exchange_folder(spark, partition_dir(staged, part_col, value), target, lambda path: rows.parquet(staged).limit(0).write.parquet(path))
        targets.append(target)
    remove(spark, staged)
    return targets


def reload_window_days(df: DataFrame, date_col: str, run_date: dt.date, offsets: Sequence[int],
                       table_path: str, part_col: str = "report_date") -> list[dt.date]:
    """Reload the days ``run_date - offset`` from ``df``, each replacing its partition.

    A day of the window without rows is emptied (T12), which a dynamic
    overwrite would not do.  The offsets are a short configured list; each
    day's filter reaches the scan.
    """
    days = sorted({run_date - dt.timedelta(days=o) for o in offsets})
    for day in days:
        replace_partition(df.filter(F.to_date(date_col) == F.lit(day)), table_path, part_col, day)
    return days


def append(df: DataFrame, table_path: str, part_cols: Sequence[str] = ()) -> None:
    """K4: repeated loads append."""
    w = df.write.mode("append")
    if part_cols:
        w = w.partitionBy(*part_cols)
    w.parquet(table_path)


def replace_table(df: DataFrame, table_path: str) -> None:
    """K7: WRITE_TRUNCATE of a whole table, in two phases (a job that fails leaves the old rows)."""
    replace_folder(df, table_path)


def export_csv(df: DataFrame, path: str) -> None:
    """K5: header row, comma separated, uncompressed; one file per task."""
    df.write.mode("overwrite").option("header", True).option("compression", "none").csv(path)


def relayout_year_month(df: DataFrame, date_col: str, table_path: str,
                        max_records_per_file: int = 5_000_000) -> None:
    """K8 (re-aimed from moving files into ``YYYY/YYYYMM/``): rewrite rows into
    a table partitioned by (year, yyyymm), compacting small daily files.

    Runs bring a window of days.  The months of ``df`` are rewritten from its
    rows and the rows they already hold for other days, so a later run adds
    its days to a month and a repeated run changes nothing.  Files that are
    read are replaced only when the job commits (dynamic overwrite).
    ``rebalance`` on the partition keys gives few, large files per month; AQE
    splits a month that is much larger than the rest, and the per-file record
    bound only splits files.

    Held rows are read with the schema of the whole table, so they keep columns
    that this run does not have, and rows lack what only the other side has
    (NULL).  A column whose type differs between run and table raises.  After a
    run that brings new columns, readers need ``mergeSchema`` to see them in
    all months.
    """
    out = (df.withColumn("year", F.year(date_col))
             .withColumn("yyyymm", F.date_format(date_col, "yyyyMM")))
    spark = df.sparkSession
    finish_moves(spark, table_path)
    try:
        own = spark.read.option("mergeSchema", True).parquet(table_path).drop("year", "yyyymm").schema
    except AnalysisException as e:  # no table yet, or one without files
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        types = {f.name.lower(): f.dataType.simpleString() for f in own}
        clash = [f"{f.name}: {types[f.name.lower()]} in the table, {f.dataType.simpleString()} in the run" for f in out.schema
                 if types.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString()]
        if clash:
            raise ValueError(f"types differ from those of {table_path}: {'; '.join(clash)}")
        held = spark.read.schema(T.StructType([*own, out.schema["year"], out.schema["yyyymm"]])).parquet(table_path)
        # only dates and months reach these joins: one row each
        months = out.select(F.col("yyyymm").alias("_month")).distinct()
        days = out.select(F.to_date(date_col).alias("_day")).distinct()
        rest = (held.join(months, F.col("yyyymm").eqNullSafe(F.col("_month")), "left_semi")
                    .join(days, F.to_date(date_col).eqNullSafe(F.col("_day")), "left_anti"))
        out = out.unionByName(rest, allowMissingColumns=True)
    (out.hint("rebalance", "year", "yyyymm")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("year", "yyyymm").parquet(table_path))
