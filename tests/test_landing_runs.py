"""Loads from listings and streams of file names, with the load log."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import no_load_decision, unprocessed_files
from tidemark.operators.typed import Field
from tidemark.plans import jobs
from tidemark.sinks.load_log import LoadLog
from tidemark.sources import manifest as mf
from tidemark.streaming.intraday import hourly_counts_view, hourly_file_counts, intraday_file_ingest

FIELDS = [Field("id", "INT64", "REQUIRED"), Field("ts", "DATETIME", "NULLABLE")]


def epoch(day, hour, minute=0):
    return int(dt.datetime(2024, 1, day, hour, minute, tzinfo=dt.timezone.utc).timestamp() * 1000)


def land(root, table, day, epoch_ms, n, rows, mtime=None):
    folder = f"{root}/landing/{table}"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/2024_01_{day:02}_{epoch_ms}_{n}.jsonl"
    with open(path, "w") as fh:
        for i, ts in rows:
            fh.write(json.dumps({"_airbyte_ab_id": "x", "_airbyte_emitted_at": 0, "_airbyte_data": {"ID": str(i), "ts": ts}}) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))


def logged(log):
    return sorted((r.run, r.path.rsplit("/", 1)[1].split("_", 3)[3]) for r in log.entries().collect())


def test_hours_follow_the_file_names(spark, tmp_shared):  # X1
    root, table = tmp_shared.replace("file:", ""), f"{tmp_shared}/table"
    log = LoadLog(spark, f"{tmp_shared}/log")

    def run(checkpoint, cap=1000):
        intraday_file_ingest(spark, f"{root}/landing", "t", FIELDS, table, f"{tmp_shared}/{checkpoint}", log, cap)
        return sorted((r.report_hour, r.id) for r in spark.read.parquet(table).collect())

    a, b, c = epoch(5, 10, 1), epoch(5, 11), epoch(5, 10, 59)
    # rows without a time, or with that of another hour, belong to their file's hour
    land(root, "t", 5, a, 0, [(1, None), (2, "2024-01-04T23:00:00Z")])
    land(root, "t", 5, b, 0, [(3, "2024-01-05T11:00:00Z")])
    land(root, "t", 5, b, 1, [])  # an empty file
    land(root, "other", 5, a, 0, [(9, None)])
    assert run("ck1") == [(2024010510, 1), (2024010510, 2), (2024010511, 3)]
    assert logged(log) == [("hour-2024010510", f"{a}_0.jsonl"), ("hour-2024010511", f"{b}_0.jsonl")]
    # a late file of hour 10 under the name of the next day: the hour is rebuilt from both
    land(root, "t", 6, c, 7, [(4, None)])
    want = [(2024010510, 1), (2024010510, 2), (2024010510, 4), (2024010511, 3)]
    assert run("ck1") == want
    entries = [("hour-2024010510", f"{a}_0.jsonl"), ("hour-2024010510", f"{c}_7.jsonl"), ("hour-2024010511", f"{b}_0.jsonl")]
    assert logged(log) == entries
    # nothing new; replays from fresh checkpoints, also file by file, change neither the table nor the log
    assert run("ck1") == want and run("ck2") == want and run("ck3", cap=1) == want and logged(log) == entries


def test_file_counts_with_late_files(spark, tmp_shared):  # X3
    root = tmp_shared.replace("file:", "")

    def run(cap, table, checkpoint):
        hourly_file_counts(spark, f"{root}/landing/*", f"{tmp_shared}/{table}", f"{tmp_shared}/{checkpoint}", cap)
        return sorted((r.report_hour, r.table_name, r.n_files) for r in hourly_counts_view(spark, f"{tmp_shared}/{table}").collect())

    now = 1_700_000_000
    land(root, "t", 6, epoch(6, 15), 0, [(1, None), (2, None)], now)
    land(root, "t", 5, epoch(5, 10), 0, [(1, None)], now + 60)
    land(root, "t", 5, epoch(5, 10), 1, [(1, None)], now + 120)
    land(root, "u", 5, epoch(5, 10), 0, [(1, None)], now + 180)
    want = [("2024010510", "t", 2), ("2024010510", "u", 1), ("2024010615", "t", 1)]
    assert run(1, "one", "ck1") == want and len(os.listdir(f"{root}/ck1/commits")) >= 4
    assert run(100, "many", "ck2") == want
    # a file that is a month late, by its name and by its age
    land(root, "u", 1, epoch(1, 3), 0, [(1, None)], now - 30 * 86400)
    want = [("2024010103", "u", 1), *want]
    assert run(1, "one", "ck1") == want and run(100, "many", "ck2") == want
    # nothing new; a replay from a fresh checkpoint over the same table
    assert run(1, "one", "ck1") == want and run(2, "one", "ck3") == want


def test_daily_loads_skip_and_log(spark, tmp_shared):  # E1, S1-S3, Q8-Q10
    root = tmp_shared.replace("file:", "")
    log = LoadLog(spark, f"{tmp_shared}/log")
    land(root, "t", 5, epoch(5, 10), 0, [(1, None), (2, None)])
    land(root, "t", 5, epoch(6, 1), 1, [(3, None)])
    land(root, "t", 6, epoch(6, 9), 0, [(4, None)])
    land(root, "t", 7, epoch(7, 9), 0, [])
    sizes = [(f"file:{root}/landing/t/{f}", os.path.getsize(f"{root}/landing/t/{f}")) for f in os.listdir(f"{root}/landing/t")]
    files = mf.parse_data_manifest(mf.files_from_inventory(spark.createDataFrame(sizes, "key string, bytes long"), "key", "bytes"))
    days = [dt.date(2024, 1, d) for d in (5, 6, 7, 8)]
    load = lambda day: jobs.daily_manifest_load(spark, files, "t", FIELDS, day, day, f"{tmp_shared}/table", log)
    assert log.entries().count() == 0
    assert [load(d) for d in (days[0], days[2], days[3], days[0])] == ["load", "skip", "skip", "load"]
    assert [(r.table_name, r.file_date, r.n_files) for r in no_load_decision(files).collect()] == [("t", days[2], 1)]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_shared}/table").collect()) == [1, 2, 3]
    assert [r.file_date for r in unprocessed_files(files, log.entries()).orderBy("path").collect()] == [days[1], days[2]]
    assert [r.run for r in log.entries().collect()] == ["day-2024-01-05"] * 2
    # a load that fails leaves the day and the log as they were
    land(root, "t", 5, epoch(5, 11), 5, [("x", None)])
    more = files.unionByName(files.filter("seq = 1").withColumn("path", F.lit(f"file:{root}/landing/t/2024_01_05_{epoch(5, 11)}_5.jsonl")))
    with pytest.raises(Exception):
        jobs.daily_manifest_load(spark, more, "t", FIELDS, days[0], days[0], f"{tmp_shared}/table", log)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_shared}/table").collect()) == [1, 2, 3] and log.entries().count() == 2


def test_hourly_load_takes_the_hour_of_the_epoch(spark, tmp_shared):  # X1, S4
    root = tmp_shared.replace("file:", "")
    log = LoadLog(spark, f"{tmp_shared}/log")
    land(root, "t", 5, epoch(5, 10), 0, [(1, None)])
    land(root, "t", 6, epoch(5, 10, 59), 1, [(2, None)])
    land(root, "t", 5, epoch(5, 11), 0, [(3, None)])
    files = mf.parse_data_manifest(mf.list_files(spark, f"{root}/landing/*/*"))
    load = lambda h: jobs.hourly_landing_load(spark, files, "t", FIELDS, dt.datetime(2024, 1, 5, h), dt.datetime(2024, 1, 5, h, 30),
                                              f"{tmp_shared}/table", log)
    assert [load(10), load(12), load(10)] == ["load", "skip", "load"]
    got = spark.read.parquet(f"{tmp_shared}/table").orderBy("id").collect()
    assert [(r.id, r.report_hour, r.report_date, r.run_date) for r in got] == [
        (i, 2024010510, dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 10, 30)) for i in (1, 2)]
    assert {r.run for r in log.entries().collect()} == {"hour-2024010510"} and log.entries().count() == 2
