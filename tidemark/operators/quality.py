"""Data-quality checks (Q1-Q10).  Each returns a DataFrame of findings.

Work is a handful of partial/final aggregates and equi-joins on (table, date):
the alert sets stay distributed, nothing is looped on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions import temporal as tf
from tidemark.operators.aggregates import count_by
from tidemark.operators.joins import anti, full_outer
from tidemark.sources.manifest import nonempty_files

# Which datasets are ingestion-time partitioned.
INGESTION_PARTITIONED_MARKERS = ("pos", "jda")


def control_vs_data(control: DataFrame, data_counts: DataFrame, brand: str) -> DataFrame:
    """Q1 / M1: control rows left-joined to loaded row counts.

    ``control`` has the 7-string JDA control layout (``IntefaceName``,
    ``TotalRec``, ``BatchDate`` ...); ``data_counts`` is ``(table_name,
    data_date, data_row_count)`` (aggregate before join, J9).
    """
    c = control.select(
        "IntefaceName",
        tf.parse_ddmmyyyy_prefix("BatchDate").alias("ctrl_date"),
        F.col("TotalRec").cast("bigint").alias("ctrl_row_count"))
    d = data_counts.select(F.col("table_name").alias("table_name_frm_data"),
                           "data_date", "data_row_count")
    cond = (c["IntefaceName"] == d["table_name_frm_data"]) & (c["ctrl_date"] == d["data_date"])
    return (c.join(d, cond, "left")
             .select("IntefaceName", "ctrl_date", "ctrl_row_count", "table_name_frm_data",
                     "data_date", "data_row_count", F.lit(brand).alias("brand"))
             .orderBy("IntefaceName", "ctrl_date"))


def partition_expr(dataset: str, part_col: str = "_partition_date",
                   report_col: str = "report_date") -> Column:
    """Q4: ingestion-date partition for pos/jda datasets, else ``report_date``."""
    low = dataset.lower()
    if any(m in low for m in INGESTION_PARTITIONED_MARKERS):
        return F.col(part_col)
    return F.to_date(F.col(report_col))


def count_by_date(df: DataFrame, date_expr: Column, date_col: str = "partition_date",
                  count_col: str = "row_count") -> DataFrame:
    """Q3: rows per partition date, ordered."""
    return count_by(df, [date_expr.alias(date_col)], count_col).orderBy(date_col)


def env_row_compare(dev: DataFrame, prod: DataFrame, dev_date: Column,
                    prod_date: Column) -> DataFrame:
    """Q2: per-date counts of two environments, full outer join, diff and ratio.

    ``diff``/``dup`` are NULL where a date exists on one side only.
    """
    return compare_counts(count_by(dev, [dev_date.alias("date_dev")], "count_dev"),
                          count_by(prod, [prod_date.alias("date_prod")], "count_prod"))


def compare_counts(d: DataFrame, p: DataFrame) -> DataFrame:
    """Q2 on counts: ``(date_dev, count_dev)`` against ``(date_prod, count_prod)``."""
    j = full_outer(d, p, d["date_dev"] == p["date_prod"])
    return (j.select("date_dev", "count_dev", "date_prod", "count_prod",
                     (F.col("count_dev") - F.col("count_prod")).alias("diff"),
                     (F.col("count_dev") / F.col("count_prod")).alias("dup"))
             .orderBy(F.col("date_prod").asc_nulls_first()))


def expected_pairs(dates: DataFrame, tables: Sequence[str], date_col: str = "run_date") -> DataFrame:
    """(table, date) pairs expected to exist: each date row is fanned out over
    the configured table list with ``explode`` (a generator, not a join)."""
    arr = F.array(*[F.lit(t) for t in tables])
    return dates.select(F.explode(arr).alias("table_name"), F.col(date_col))


def daily_file_summary(manifest: DataFrame) -> DataFrame:
    """(table_name, file_date, n_files, has_data): one partial/final aggregate
    that the daily checks share (its shuffle is reused, not recomputed)."""
    return manifest.groupBy("table_name", "file_date").agg(
        F.count(F.lit(1)).alias("n_files"), F.max(F.col("length") > 0).alias("has_data"))


def missing_daily_files(summary: DataFrame, expected: DataFrame) -> DataFrame:
    """Q5: expected (table, run_date) with no file of that date; tables with
    empty files only are Q10's.  ``summary`` is ``daily_file_summary(manifest)``."""
    found = summary.select("table_name", F.col("file_date").alias("run_date"))
    miss = anti(expected, found, ["table_name", "run_date"])
    return miss.withColumn(
        "expected_pattern",
        F.concat(F.col("table_name"), F.lit("/"), F.date_format("run_date", "yyyy_MM_dd"),
                 F.lit("_*.jsonl")))


def missing_control_files(ctrl_manifest: DataFrame, expected: DataFrame) -> DataFrame:
    """Q6: expected (table, run_date) with no control file of that UTC date."""
    found = ctrl_manifest.select("table_name", F.col("ctrl_date").alias("run_date")).distinct()
    return anti(expected, found, ["table_name", "run_date"])


def empty_files(manifest: DataFrame) -> DataFrame:
    """Q8: zero-byte files."""
    return manifest.filter(F.col("length") == 0)


def unprocessed_files(manifest: DataFrame, load_log: DataFrame) -> DataFrame:
    """Q9: landed files that no load picked up (manifest left-anti load log)."""
    return anti(manifest, load_log.select("path").distinct(), ["path"])


def no_load_decision(manifest: DataFrame) -> DataFrame:
    """Q10: (table, date) whose files are all empty -> the load is skipped."""
    return (manifest.groupBy("table_name", "file_date")
            .agg(F.count(F.lit(1)).alias("n_files"),
                 F.sum(F.when(F.col("length") > 0, 1).otherwise(0)).alias("n_nonempty"))
            .filter(F.col("n_nonempty") == 0)
            .select("table_name", "file_date", "n_files", F.lit("skip").alias("decision")))


def intraday_shortfall(manifest: DataFrame, daily_totals: dict[str, int], run_dates: DataFrame) -> DataFrame:
    """Q7: files found between 00:00 and the end of each run hour (UTC) versus
    ``floor(total / 24) * (hour + 1)``, for every configured table on every
    ``run_date`` of ``run_dates``, with files or without.

    Hourly counts are a partial/final aggregate; the running total is a window
    over at most 24 rows per (table, day), so no group can grow with the data.
    Hours without any file still get a row (hours are generated, not found).
    Per T17, a daily total below 24 gives an expectation of 0 (no alert).
    """
    ts = tf.epoch_ms_to_utc(F.col("file_epoch_ms"))
    hourly = count_by(manifest.select("table_name", F.to_date(ts).alias("run_date"),
                                      F.hour(ts).alias("run_hour")),
                      ["table_name", "run_date", "run_hour"], "n")
    grid = (expected_pairs(run_dates, list(daily_totals))
            .select("table_name", "run_date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("run_hour")))
    totals = F.create_map(*[x for k, v in daily_totals.items() for x in (F.lit(k), F.lit(v))])
    w = (Window.partitionBy("table_name", "run_date").orderBy("run_hour")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (grid.join(hourly, ["table_name", "run_date", "run_hour"], "left")
           .withColumn("found", F.sum(F.coalesce("n", F.lit(0))).over(w))
           .withColumn("total", totals[F.col("table_name")])
           .withColumn("expected", F.floor(F.col("total") / 24).cast("bigint") * (F.col("run_hour") + 1)))
    return (out.filter(F.col("found") < F.col("expected"))
               .select("table_name", "run_date", "run_hour", F.col("found").cast("bigint").alias("found"),
                       "expected"))


def smallest_nonempty_file(manifest: DataFrame) -> DataFrame:
    """O2: the smallest non-empty file per (table, date) -- the schema sample.

    A top-1 per group (the group limit is pushed below the shuffle)."""
    w = Window.partitionBy("table_name", "file_date").orderBy(F.col("length").asc(), F.col("path").asc())
    return (nonempty_files(manifest).withColumn("_r", F.row_number().over(w))
            .filter(F.col("_r") == 1).drop("_r"))
