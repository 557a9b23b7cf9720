"""Counts from Parquet footers, and the comparison run built on them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import footer_counts
from tidemark.operators.latest import flag_latest
from tidemark.plans.jobs import comparison_run


def days(spark, path, counts):
    rows = [(i, "x" * 50, dt.date(2024, 1, d)) for d, n in counts.items() for i in range(n)]
    spark.createDataFrame(rows, "id int, v string, day date").repartition(3).write.partitionBy("day").parquet(path)


def test_no_column_is_read(spark, tmp_shared):
    days(spark, f"{tmp_shared}/t", {1: 5, 2: 7, 3: 1})
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = footer_counts(spark, f"{tmp_shared}/t", ["day"], "n", F.col("day") >= F.lit(dt.date(2024, 1, 2)))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<day:date,count(*):bigint>" in plan
    assert {(r.day.day, r.n) for r in got.collect()} == {(2, 7), (3, 1)}
    # another scan of the session is as before
    assert "BatchScan" not in spark.read.parquet(f"{tmp_shared}/t")._jdf.queryExecution().executedPlan().toString()


def test_filters_on_data_raise(spark, tmp_shared):
    days(spark, f"{tmp_shared}/t", {1: 2})
    with pytest.raises(Exception, match="id"):
        footer_counts(spark, f"{tmp_shared}/t", ["day"], "n", F.col("id") > 0)


def test_comparison_run_replaces_table_and_export(spark, tmp_shared):
    days(spark, f"{tmp_shared}/dev", {1: 5, 2: 4})
    days(spark, f"{tmp_shared}/prod", {2: 8, 3: 1})
    for _ in range(2):
        comparison_run(spark, f"{tmp_shared}/dev", f"{tmp_shared}/prod", "day", f"{tmp_shared}/out/table", f"{tmp_shared}/out/csv")
    schema = spark.read.parquet(f"{tmp_shared}/out/table").schema
    day = lambda d: d and d.day
    for back in (spark.read.parquet(f"{tmp_shared}/out/table"), spark.read.schema(schema).option("header", True).csv(f"{tmp_shared}/out/csv")):
        got = {(day(r.date_dev), r.count_dev, day(r.date_prod), r.count_prod, r["diff"], r.dup) for r in back.collect()}
        assert got == {(1, 5, None, None, None, None), (2, 4, 2, 8, -4, 0.5), (None, None, 3, 1, None, None)}


def test_a_total_order_carries_no_other_columns(spark):  # R7
    df = spark.createDataFrame([(1, 1, 1, "a" * 9), (1, 1, 2, "b"), (None, 5, 3, None)], "k int, o int, id int, wide string")
    out = flag_latest(df, ["k"], ["o", "id"], "f", total=True)
    assert {(r.id, r.f) for r in out.collect()} == {(1, "No"), (2, "Yes"), (3, "Yes")}
    for line in out._jdf.queryExecution().executedPlan().toString().splitlines():
        assert "HashAggregate" not in line or "wide" not in line
