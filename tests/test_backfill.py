"""Models at many cut-offs and advanced snapshots against one full rank per cut-off."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import only_keys
from tidemark.operators.latest import advance_latest, latest_per_key
from tidemark.plans import jobs
from tidemark.plans import models as M
from tidemark.sinks.partitions import replace_listed_partitions, replace_partition

D = dt.date
DAYS = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(20)]
CUTS = [D(2023, 12, 31), DAYS[3], DAYS[4], DAYS[11], DAYS[19]]


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def at(df, cutoff):
    return rows_of(df.filter(F.col("cutoff") == F.lit(cutoff)).drop("cutoff"))


@pytest.mark.parametrize("cut", ["partition", "parsed", "compact"])
def test_accounting_stock_at_cutoffs(spark, cut):  # M2-M4, G6
    r = random.Random(1)
    rows = []
    for _ in range(300):
        day = r.choice(DAYS)
        # INTRND need not be the partition's day; a hot key holds a third of the rows
        rows.append((r.choice([1, 1, 2, None]), r.choice([1, 1, 2, 3]), int(r.choice(DAYS).strftime("%y%m%d")), day, r.randint(0, 3)))
    df = spark.createDataFrame(rows, "INSTOR int, INSKU int, INTRND int, _partition_date date, v int").distinct()
    got = M.accounting_stock_balance_at({"acstk": df}, CUTS, cut)
    for c in CUTS:
        assert at(got, c) == rows_of(M.accounting_stock_balance({"acstk": df}, c, cut))


def test_product_detail_at_cutoffs(spark):  # M14, G6
    r = random.Random(2)
    hist = spark.createDataFrame([(r.randint(1, 6), r.randint(1, 3), 1, 2, 3, 4, "c", "s", r.choice(["b", "c"]), None, r.choice(DAYS)) for _ in range(60)],
                                 "PID int, PIdOD long, DEPT_ID int, SUBDEPT_ID int, CLASS int, SUB_CLASS int, CATEGORY_ID string, "
                                 "SUB_CATEGORY_ID string, BRAND_ID string, SUPPLIER_ID string, TRANS_DATE date")
    master = spark.createDataFrame([(r.randint(1, 8), "o", "d", "sd", "c", "sc", "x", "y", "z", "l", r.choice(DAYS)) for _ in range(30)],
                                   "pid int, pidod string, dept string, sub_dpt string, class string, sub_cls string, catid string, "
                                   "subcatid string, brandid string, lastsupplierid string, updateon date")
    detail = spark.createDataFrame([(i, r.choice([1, 2, 3, 9, None]), r.choice(DAYS)) for i in range(80)], "no int, pid int, createon date")
    inputs = {"product_history": hist, "productmaster": master, "detail": detail}
    got = M.product_detail_at(inputs, CUTS, ["no", "pid", "createon"])
    for c in CUTS:
        assert at(got, c) == rows_of(M.product_detail(inputs, c, ["no", "pid", "createon"]))


def test_listed_partitions_are_replaced_or_emptied(spark, tmp_shared):  # G6, T12
    old = spark.createDataFrame([(1,), (2,)], "v int")
    for c in CUTS:
        replace_partition(old, tmp_shared, "cutoff", c)
    new = spark.createDataFrame([(7, CUTS[1]), (8, CUTS[3])], "v int, cutoff date")
    replace_listed_partitions(new, tmp_shared, "cutoff", CUTS[:4])
    got = sorted((r.cutoff, r.v) for r in spark.read.parquet(tmp_shared).collect())
    assert got == [(CUTS[1], 7), (CUTS[3], 8), (CUTS[4], 1), (CUTS[4], 2)]
    with pytest.raises(Exception):
        replace_listed_partitions(new.withColumn("v", F.raise_error(F.lit("no")).cast("int")), tmp_shared, "cutoff", CUTS)
    assert sorted((r.cutoff, r.v) for r in spark.read.parquet(tmp_shared).collect()) == got
    assert all(os.path.isdir(f"{tmp_shared.replace('file:', '')}/cutoff={c}") for c in CUTS)


def test_advanced_snapshots_equal_the_full_rank(spark, tmp_shared):  # R1, M12
    r = random.Random(3)
    order = [F.col("o").desc(), F.col("v").desc()]
    # late rows arrive days after their own date; from day 10 on the rows of days 2 and 3 are other ones
    first = [(r.choice(["hot", "hot", "a", "b", None]), r.randint(0, 50), r.randint(0, 3), r.choice(DAYS)) for _ in range(200)]
    second = [x for x in first if x[3] not in DAYS[2:4]] + [("a", 1, 1, DAYS[2]), ("new", 3, 1, DAYS[3])]
    schema = "k string, o int, v int, arrived date"
    v1, v2 = spark.createDataFrame(first, schema).distinct(), spark.createDataFrame(second, schema).distinct()
    snapshot = None
    for i, day in enumerate(DAYS):
        rows = v1 if i < 10 else v2
        full = latest_per_key(rows.filter(F.col("arrived") <= F.lit(day)), ["k"], order)
        delta = rows.filter(F.col("arrived") == F.lit(day))
        if snapshot is None:
            out = full
        elif i == 10:
            old = [x.filter(F.col("arrived").isin([F.lit(d) for d in DAYS[2:4]])).select("k") for x in (v1, v2)]
            out = advance_latest(snapshot, delta, ["k"], order, old[0].union(old[1]), rows.filter(F.col("arrived") <= F.lit(day)))
        else:
            out = advance_latest(snapshot, delta, ["k"], order)
        replace_partition(out, tmp_shared, "day", day)
        snapshot = spark.read.parquet(f"{tmp_shared}/day={day}")
        assert sorted(map(str, ((x.k, x.o, x.v) for x in snapshot.collect()))) == sorted(map(str, ((x.k, x.o, x.v) for x in full.collect())))


def test_only_keys_reduces_up_to_its_bound(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    wanted = spark.createDataFrame([(3,), (3,), (5,), (None,)], "w long")
    assert sorted(r.k for r in only_keys(df, "k", wanted, 2).collect()) == [3, 5]
    assert only_keys(df, "k", wanted, 1).count() == 1000


def test_models_without_a_cutoff_and_with_arguments_run_as_marts(spark, tmp_shared):  # E2, M14, M17
    sku = spark.createDataFrame([("1", "c", "t")], "sku_id string, code string, type string")
    side = lambda cols: spark.createDataFrame([("1", *"xyz"[:len(cols)])], ["sku_id", *cols])
    inputs = {"skucodes": sku, "channels": side(["channel_id", "channel_display_name_th", "channel_display_name_en"]),
              "images": side(["size", "url", "cdn_url"]), "price": side(["price_type", "price_exclude_vat", "price_include_vat"])}
    jobs.mart_run("dim_product_attribute_v2", inputs, CUTS[1], f"{tmp_shared}/dim")
    r = spark.read.parquet(f"{tmp_shared}/dim").first()
    assert (r.sku_id, r.cdn_url, r._partition_date) == ("1", "z", CUTS[1])
    ctrl = spark.createDataFrame([("BU01", "JDA_X_Y", "1", "2", "01012024235959", "ETL", "B", "t", CUTS[1])],
                                 "BuCode string, IntefaceName string, FileCount string, TotalRec string, BatchDate string, Requester string, "
                                 "DIHBatchID string, table_name string, _partition_date date")
    data = spark.createDataFrame([("t", CUTS[1])], "table_name string, _partition_date date")
    assert jobs.run_model("data_vs_ctrl", {"ctrl": ctrl, "data": data}, CUTS[1], brand="x").columns
    assert set(jobs.MODELS) >= {"data_vs_ctrl", "product_detail", "dim_product_attribute", "dim_product_attribute_v2", "fact_transport_daily"}
