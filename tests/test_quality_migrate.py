import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.migrate import backfill_latest


def test_control_vs_data(spark):  # Q1
    ctrl = spark.createDataFrame([("T1", "B", "1", "10", "05012024235959", "R", "x"),
                                  ("T2", "B", "1", "3", "05012024000000", "R", "y")],
                                 "IntefaceName string, BuCode string, FileCount string, TotalRec string, "
                                 "BatchDate string, Requester string, DIHBatchID string")
    counts = spark.createDataFrame([("T1", dt.date(2024, 1, 5), 9)], "table_name string, data_date date, data_row_count long")
    rows = q.control_vs_data(ctrl, counts, "brand_a").collect()
    assert [(r.IntefaceName, r.ctrl_row_count, r.data_row_count) for r in rows] == [("T1", 10, 9), ("T2", 3, None)]


def test_env_row_compare_unmatched_dates(spark):  # Q2
    dev = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "d date")
    prod = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)], "d date")
    rows = {(r.date_dev, r.date_prod): (r.diff, r.dup) for r in q.env_row_compare(dev, prod, F.col("d"), F.col("d")).collect()}
    assert rows[(dt.date(2024, 1, 1), dt.date(2024, 1, 1))] == (1, 2.0)
    assert rows[(dt.date(2024, 1, 2), None)] == (None, None)
    assert rows[(None, dt.date(2024, 1, 3))] == (None, None)


def test_intraday_shortfall_rule(spark):  # Q7, T17
    base = 1704067200000  # 2024-01-01 00:00 UTC
    m = spark.createDataFrame([("a", base + 10), ("b", base + 10)], "table_name string, file_epoch_ms long")
    days = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "run_date date")
    out = q.intraday_shortfall(m, {"a": 48, "b": 23, "never": 48}, days)
    assert out.filter("table_name = 'never' and found = 0").count() == 48   # no file at all is the worst shortfall
    assert out.filter("table_name = 'a' and run_date = '2024-01-02'").count() == 24
    rows = {(r.table_name, r.run_hour): (r.found, r.expected) for r in out.filter("run_date = '2024-01-01'").collect()}
    assert rows[("a", 0)] == (1, 2) and rows[("a", 23)] == (1, 48)
    assert not any(k[0] == "b" for k in rows)   # total < 24 -> expected 0, never alerts


def test_missing_and_skip(spark):  # Q5, Q10
    m = spark.createDataFrame([("a", dt.date(2024, 1, 1), 0, "p1"), ("b", dt.date(2024, 1, 1), 5, "p2")],
                              "table_name string, file_date date, length long, path string")
    exp = q.expected_pairs(spark.createDataFrame([(dt.date(2024, 1, 1),)], "run_date date"), ["a", "b", "c"])
    assert sorted(r.table_name for r in q.missing_daily_files(q.daily_file_summary(m), exp).collect()) == ["c"]
    assert [r.table_name for r in q.no_load_decision(m).collect()] == ["a"]


def test_backfill_matches_brute_force(spark):  # G6
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 4), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40)), i)
            for i in range(120)]
    df = spark.createDataFrame(rows, "k int, d date, v int")
    cuts = [dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 2, 5)]
    got = {(r.cutoff, r.k): (r.d, r.v) for r in backfill_latest(df, ["k"], "d", ["d", "v"], cuts).collect()}
    expect = {}
    for c in cuts:
        for k, d, v in rows:
            if d <= c and ((c, k) not in expect or (d, v) > expect[(c, k)]):
                expect[(c, k)] = (d, v)
    assert got == expect
