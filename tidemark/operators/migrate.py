"""Migrations and backfills.

The originals loop over dates on the driver, issuing one query per date.  Here
each migration is one job: the typed projection runs over every source date
and a dynamic partition overwrite replaces each date's partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.typed import Field, retype_columns, typed_projection
from tidemark.sinks.partitions import replace_partitions


def migrate_by_date(stage: DataFrame, fields: Sequence[Field], date_col: str,
                    run_date: dt.date, source: str | None = None, parse: bool = True) -> DataFrame:
    """G1 (and G3 with ``parse=False``): typed projection of every source date;
    ``report_date`` = the row's own source date, ``run_date`` = the run day."""
    return typed_projection(stage, fields, source=source, parse=parse, extra=[
        F.to_date(F.col(date_col)).alias("report_date"), F.lit(run_date).alias("run_date")])


def migrate_hourly(stage: DataFrame, fields: Sequence[Field], ts_col: str,
                   run_time: dt.datetime, source: str | None = None) -> DataFrame:
    """Hour grain; ``report_date`` is the DATETIME of the hour and
    ``report_hour`` (yyyyMMddHH) the partition value.  Plain casts only."""
    hour = F.date_trunc("hour", F.col(ts_col).cast("timestamp_ntz")).cast("timestamp_ntz")
    return typed_projection(stage, fields, source=source, parse=False, extra=[
        hour.alias("report_date"),
        F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_date"),
        F.date_format(hour, "yyyyMMddHH").alias("report_hour")])


def migrate_retype(df: DataFrame, retypes: Mapping[str, str], part_col: str) -> DataFrame:
    """``* EXCEPT(cols)`` + casts, per ingestion date (the partition column
    stays last so one dynamic overwrite replaces each date)."""
    out = retype_columns(df, retypes)
    return out.select(*[c for c in out.columns if c != part_col], part_col)


def write_migration(df: DataFrame, table_path: str, part_col: str = "report_date") -> None:
    """Replace every migrated date in one job."""
    replace_partitions(df, table_path, [part_col])


def backfill_latest(df: DataFrame, keys: Sequence[str], visible_col: str,
                    order: Sequence[str], cutoffs: Sequence[dt.date],
                    cutoff_col: str = "cutoff") -> DataFrame:
    """The latest row per key at *each* cut-off, in one pass.

    Visible rows at cut-off ``c`` are those with ``visible_col <= c``; the winner
    is the maximum of ``order`` (which must be unique per key; newest first).

    1. each row gets the index of the first cut-off that sees it (CASE chain,
       no join); rows after the last cut-off are dropped;
    2. per (key, bucket) keep the best row -- a partial/final aggregate, so a
       hot key is combined in every map task before the shuffle;
    3. a bucket's winner is a candidate for its own and every later cut-off:
       ``explode`` at most ``len(cutoffs)`` copies, and take the best per
       (key, cut-off).  Work is bounded by rows + keys x cut-offs; there is no
       cross join with the cut-off list.
    """
    cuts = sorted(set(cutoffs))
    n = len(cuts)
    vis = F.to_date(F.col(visible_col))
    bucket = F.lit(None).cast("int")
    for i in reversed(range(n)):
        bucket = F.when(vis <= F.lit(cuts[i]), F.lit(i)).otherwise(bucket)
    payload = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[F.col(c) for c in order], F.struct(*payload).alias("_row")))
    per_bucket = (df.withColumn("_b", bucket).filter(F.col("_b").isNotNull())
                    .groupBy(*keys, "_b").agg(best.alias("_best")))
    cut_arr = F.array(*[F.lit(c) for c in cuts])
    fanned = per_bucket.select(*keys, "_best",
                               F.explode(F.sequence(F.col("_b"), F.lit(n - 1))).alias("_i"))
    winners = fanned.groupBy(*keys, "_i").agg(F.max("_best").alias("_best"))
    return winners.select(F.element_at(cut_arr, F.col("_i") + 1).alias(cutoff_col), *keys,
                          *[F.col("_best._row")[c].alias(c) for c in payload])


def visible_at(col: str, cutoff: dt.date) -> Column:
    return F.to_date(F.col(col)) <= F.lit(cutoff)
