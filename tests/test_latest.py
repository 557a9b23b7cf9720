import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.latest import flag_latest, latest_per_key, latest_with_eod


def test_one_row_per_key_and_newest(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (2, 5, "c"), (None, 1, "d"), (None, 2, "e")],
                               "k int, o int, v string")
    out = {(r.k, r.v) for r in latest_per_key(df, ["k"], [F.col("o").desc()]).collect()}
    assert out == {(1, "b"), (2, "c"), (None, "e")}


def test_group_limit_is_pushed_below_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    plan = latest_per_key(df, ["k"], [F.col("o").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40, unique_by=lambda t: t[1]))
def test_matches_max_by_on_unique_order(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int")
    got = {(r.k, r.o) for r in latest_per_key(df, ["k"], [F.col("o").desc()]).collect()}
    expect = {}
    for k, o in rows:
        expect[k] = max(expect.get(k, o), o)
    assert got == set(expect.items())


def test_flag_latest_keeps_all_rows_and_null_keys(spark):  # R7
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 4)], "k int, o int")
    out = sorted((r.o, r.f) for r in flag_latest(df, ["k"], ["o"], "f").collect())
    assert out == [(1, "No"), (2, "Yes"), (3, "No"), (4, "Yes")]


def test_latest_with_eod(spark):  # R5
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2), "x"), (1, dt.date(2024, 1, 3), "y")],
                               "k int, p date, v string")
    r = latest_with_eod(df, ["k"], "p").first()
    assert (r.v, r.EOD_Date) == ("y", dt.date(2024, 1, 2))
    r = latest_with_eod(df, ["k"], "p", shift_days=0).first()
    assert r.EOD_Date == dt.date(2024, 1, 3)


def test_broadcast_probe_bounds(spark):
    from tidemark.operators.joins import fits_broadcast, maybe_broadcast

    small = spark.range(10)
    assert fits_broadcast(small, max_rows=10) and not fits_broadcast(small, max_rows=9)
    assert not fits_broadcast(small, max_rows=100, max_probe_bytes=0)   # estimate rules it out
    plan = spark.range(100).join(maybe_broadcast(small), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
