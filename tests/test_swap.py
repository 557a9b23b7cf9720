"""Two-phase replacement: failing jobs, dead writers."""

import os
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.typed import Field, enforce_required
from tidemark.sinks import swap
from tidemark.sinks.partitions import replace_partition, replace_table


def local(path):
    return path.replace("file:", "")


def rows(spark, path):
    return sorted(r.v for r in spark.read.parquet(path).select("v").collect())


@pytest.fixture
def table(spark, tmp_shared):
    replace_partition(spark.range(100).select(F.col("id").alias("v")), tmp_shared, "day", 1)
    replace_partition(spark.range(3).select(F.col("id").alias("v")), tmp_shared, "day", 2)
    return tmp_shared


def test_a_job_that_raises_leaves_the_day(spark, table):  # K1, D7
    bad = spark.range(100).select(F.when(F.col("id") != 57, F.col("id")).alias("v")).repartition(4)
    with pytest.raises(PySparkException):
        replace_partition(enforce_required(bad, [Field("v", "INT64", "REQUIRED")]), table, "day", 1)
    assert rows(spark, f"{table}/day=1") == list(range(100)) and len(rows(spark, table)) == 103
    assert not os.listdir(f"{local(table)}/_swap/day-1")


def test_a_job_that_raises_leaves_the_table(spark, tmp_shared):  # K7
    replace_table(spark.range(5).select(F.col("id").alias("v")), f"{tmp_shared}/t")
    with pytest.raises(PySparkException):
        replace_table(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("v")), f"{tmp_shared}/t")
    assert rows(spark, f"{tmp_shared}/t") == list(range(5))
    # the new rows may come from the table itself
    replace_table(spark.read.parquet(f"{tmp_shared}/t").where("v > 2"), f"{tmp_shared}/t")
    assert rows(spark, f"{tmp_shared}/t") == [3, 4]


def dead_writer(spark, table, renamed_old, committed):
    """What a driver leaves that dies during a replacement of day 1 by the rows 7, 8."""
    work = f"{local(table)}/_swap/day-1/abc"
    spark.createDataFrame([(7,), (8,)], "v long").write.parquet(f"{work}/new")
    if not committed:
        os.remove(f"{work}/new/_SUCCESS")
    if renamed_old:
        shutil.move(f"{local(table)}/day=1", f"{work}/old")


@pytest.mark.parametrize("renamed_old, committed, want", [
    (False, False, list(range(100))), (False, True, list(range(100))), (True, True, [7, 8]), (True, False, list(range(100)))])
def test_recovery_after_a_dead_writer(spark, table, renamed_old, committed, want):
    dead_writer(spark, table, renamed_old, committed)
    assert swap.recover_table(spark, table) == ([f"{table}/day=1"] if renamed_old else [])
    assert rows(spark, f"{table}/day=1") == want and rows(spark, f"{table}/day=2") == [0, 1, 2]
    assert swap.recover_table(spark, table) == []


def test_the_next_replacement_recovers_first(spark, table):
    dead_writer(spark, table, True, True)
    with pytest.raises(PySparkException):
        replace_partition(spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("v")), table, "day", 1)
    assert rows(spark, f"{table}/day=1") == [7, 8]
    replace_partition(spark.range(2).select(F.col("id").alias("v")).limit(0), table, "day", 1)
    assert rows(spark, f"{table}/day=1") == []
