import datetime as dt
import json
import os

from tidemark.plans import jobs

D = dt.date


def test_daily_landing_load_replaces_the_day(spark, tmp_shared):  # E1
    root = tmp_shared.replace("file:", "")
    os.makedirs(f"{root}/landing", exist_ok=True)
    with open(f"{root}/landing/2024_01_05_1704445200000_0.jsonl", "w") as fh:
        for i in range(3):
            fh.write(json.dumps({"_airbyte_ab_id": str(i), "_airbyte_emitted_at": 0,
                                 "_airbyte_data": {"ID": str(i), "Amount": "1.5", "ts": "2024-01-05T01:02:03Z"}}) + "\n")
    dictionary = spark.createDataFrame(
        [("Tb", "id", "int", "NO", 1), ("Tb", "amount", "money", "YES", 2), ("Tb", "ts", "datetime", "0", 3)],
        "Table_Name string, Field_Name string, Field_Type string, IS_NULLABLE string, ORD int")
    fields = jobs.fields_from_dictionary(dictionary, "tb", ("Table_Name", "Field_Name", "Field_Type", "IS_NULLABLE"), "ORD")
    assert [f.name for f in fields] == ["id", "amount", "ts"]
    for _ in range(2):   # rerun of the same day replaces, never duplicates
        jobs.daily_landing_load(spark, f"{root}/landing", fields, D(2024, 1, 5), D(2024, 1, 6), f"{root}/table")
    back = spark.read.parquet(f"{root}/table")
    assert back.count() == 3 and {r.run_date for r in back.collect()} == {D(2024, 1, 6)}


def test_mart_backfill_skips_commented_entries(spark, tmp_shared):  # E2, G6
    pm = spark.createDataFrame([(1, dt.datetime(2024, 1, d), D(2024, 1, d), d) for d in (1, 3, 5)],
                               "pid int, updateon timestamp_ntz, report_date date, v int")
    config = [("product_master_snapshot", 1, 3), ("#sku_snapshot", 2, 1)]
    done = jobs.mart_backfill(config, {"product_master_snapshot": {"productmaster": pm}}, D(2024, 1, 6), tmp_shared)
    assert list(done) == ["product_master_snapshot"]
    back = spark.read.parquet(f"{tmp_shared}/product_master_snapshot")
    got = {(r._partition_date, r.v, r.report_date) for r in back.collect()}
    assert got == {(D(2024, 1, 3), 3, D(2024, 1, 3)), (D(2024, 1, 4), 3, D(2024, 1, 3)),
                   (D(2024, 1, 5), 5, D(2024, 1, 5))}


def test_delimited_and_control_loads(spark, tmp_shared):  # E3
    root = tmp_shared.replace("file:", "")
    os.makedirs(f"{root}/in", exist_ok=True)
    with open(f"{root}/in/sales_2024-01-05.TXT", "w") as fh:
        fh.write("StoreID|Amount\n1|NULL\n2|3.5\n")
    with open(f"{root}/in/sales_2024-01-05.ctrl", "w") as fh:
        fh.write("IntefaceName|BuCode|FileCount|TotalRec|BatchDate|Requester|DIHBatchID\n"
                 "sales|BU01|1|2|05012024000000|ETL|B1\n")
    jobs.delimited_load(spark, f"{root}/in/*.TXT", "StoreID string, Amount double", D(2024, 1, 5),
                        f"{root}/sales", null_marker="NULL")
    jobs.control_load(spark, f"{root}/in/*.ctrl", D(2024, 1, 5), f"{root}/ctrl")
    sales = sorted((r.StoreID, r.Amount, r._partition_date) for r in spark.read.parquet(f"{root}/sales").collect())
    assert sales == [("1", None, D(2024, 1, 5)), ("2", 3.5, D(2024, 1, 5))]
    assert spark.read.parquet(f"{root}/ctrl").first().TotalRec == "2"
