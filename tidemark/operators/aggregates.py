"""Counts, grouped maxima and distinct projections.

All of these are hash aggregates with a partial (map-side) stage, so a hot
group is combined inside each map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_by(df: DataFrame, keys: Sequence[Column | str], count_col: str = "row_count") -> DataFrame:
    """A1: ``SELECT keys, COUNT(*) ... GROUP BY keys``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def footer_counts(spark: SparkSession, path: str, part_cols: Sequence[str], count_col: str = "row_count",
                  where: Column | None = None) -> DataFrame:
    """A1 by partition columns of a Parquet table, from the footers alone.

    The count is pushed into the version 2 Parquet source, which answers it from
    each file's footer: no column is read (``PushedAggregation: [COUNT(*)]`` in
    the plan).  ``where`` may use partition columns only; another filter would
    stop the push-down, so it raises.  Partitions without rows give none.
    """
    used = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(used)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # concerns version 2 scans only
    try:
        spark.conf.set(used, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
        table = spark.read.parquet(path)
    finally:
        spark.conf.set(used, before)
    if where is not None:
        spark.createDataFrame([], T.StructType([table.schema[c] for c in part_cols])).where(where)  # raises for other columns
        table = table.where(where)
    return table.groupBy(*part_cols).agg(F.count(F.lit(1)).alias(count_col))


def group_max(df: DataFrame, keys: Sequence[str], maxima: dict[str, str]) -> DataFrame:
    """A2: ``GROUP BY`` many columns with ``MAX`` of others ({out: in})."""
    return df.groupBy(*keys).agg(*[F.max(src).alias(out) for out, src in maxima.items()])


def group_distinct(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3: ``GROUP BY`` with no aggregate == distinct projection."""
    return df.select(*keys).distinct()


def distinct_values(df: DataFrame, col: Column | str, alias: str) -> DataFrame:
    """Distinct partition dates (ordering is applied by the caller's sink)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(alias)).distinct()
