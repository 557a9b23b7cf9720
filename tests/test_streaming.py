import json
import os

from pyspark.sql import functions as F

from tidemark.operators.typed import Field, typed_projection
from tidemark.sources.files import read_envelope_jsonl
from tidemark.streaming.intraday import HOUR_FMT, intraday_ingest

FIELDS = [Field("id", "INT64", "REQUIRED"), Field("ts", "DATETIME", "REQUIRED")]


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for i, ts in rows:
            fh.write(json.dumps({"_airbyte_ab_id": str(i), "_airbyte_emitted_at": 0,
                                 "_airbyte_data": {"ID": str(i), "ts": ts}}) + "\n")


def test_hour_rebuild_keeps_earlier_files_and_is_idempotent(spark, tmp_shared):  # X1
    root = tmp_shared.replace("file:", "")
    landing, table = f"{root}/landing", f"{root}/table"
    typed = lambda df: typed_projection(df, FIELDS)
    hour_of = F.date_format("ts", HOUR_FMT)

    def read_hours(hours):
        days = sorted({f"{h[:4]}-{h[4:6]}-{h[6:8]}" for h in hours})
        return typed(read_envelope_jsonl(spark, [f"{landing}/d={d}" for d in days]))

    def run(ckpt):
        intraday_ingest(spark, f"{landing}/*", typed, read_hours, hour_of, table, ckpt)
        return sorted((r.report_hour, r.id) for r in spark.read.parquet(table).collect())

    land(f"{landing}/d=2024-01-05", "a.jsonl", [(1, "2024-01-05T10:01:00Z"), (2, "2024-01-05T11:00:00Z")])
    assert run(f"{root}/ck1") == [(2024010510, 1), (2024010511, 2)]
    # a late file for hour 10: the hour is rebuilt from every file, nothing is lost
    land(f"{landing}/d=2024-01-05", "b.jsonl", [(3, "2024-01-05T10:30:00.123Z")])
    assert run(f"{root}/ck1") == [(2024010510, 1), (2024010510, 3), (2024010511, 2)]
    # no new files: nothing changes; full replay from a fresh checkpoint: same table
    assert run(f"{root}/ck1") == [(2024010510, 1), (2024010510, 3), (2024010511, 2)]
    assert run(f"{root}/ck2") == [(2024010510, 1), (2024010510, 3), (2024010511, 2)]


def test_hourly_counts_change_log_keeps_newest_count(spark, tmp_shared):  # X3
    from tidemark.streaming.intraday import hourly_counts, hourly_counts_view

    root = tmp_shared.replace("file:", "")
    landing = f"{root}/landing"
    fields = FIELDS + [Field("kind", "STRING", "NULLABLE")]
    typed = lambda df: typed_projection(df, fields)

    def land_kind(name, rows):
        os.makedirs(f"{landing}/d=2024-01-05", exist_ok=True)
        with open(f"{landing}/d=2024-01-05/{name}", "w") as fh:
            for i, ts, kind in rows:
                fh.write(json.dumps({"_airbyte_ab_id": str(i), "_airbyte_emitted_at": 0,
                                     "_airbyte_data": {"id": str(i), "ts": ts, "kind": kind}}) + "\n")

    def run():
        hourly_counts(spark, f"{landing}/*", typed, "ts", "kind", f"{root}/counts", f"{root}/ck")
        return sorted((r.report_hour, r.table_name, r.n_files) for r in hourly_counts_view(spark, f"{root}/counts").collect())

    land_kind("a.jsonl", [(1, "2024-01-05T10:01:00Z", "t1"), (2, "2024-01-05T10:20:00Z", "t1"),
                          (3, "2024-01-05T11:00:00Z", "t2")])
    assert run() == [("2024010510", "t1", 2), ("2024010511", "t2", 1)]
    # a later batch adds to hour 10 (within the watermark): the view shows the new total
    land_kind("b.jsonl", [(4, "2024-01-05T10:40:00Z", "t1")])
    assert run() == [("2024010510", "t1", 3), ("2024010511", "t2", 1)]


def test_hourly_counts_do_not_depend_on_the_files_per_batch(spark, tmp_shared):  # X3
    from tidemark.streaming.intraday import hourly_counts, hourly_counts_view

    root = tmp_shared.replace("file:", "")
    landing = f"{root}/landing"
    fields = FIELDS + [Field("kind", "STRING", "NULLABLE")]
    typed = lambda df: typed_projection(df, fields)
    # three files, the newest event time first in order of arrival
    for n, (day, hour) in enumerate([("06", 15), ("05", 10), ("06", 1)]):
        folder = f"{landing}/d=2024-01-{day}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{n}.jsonl", "w") as fh:
            fh.write("".join(json.dumps({"_airbyte_ab_id": f"{n}", "_airbyte_emitted_at": 0, "_airbyte_data": {
                "id": f"{n}", "ts": f"2024-01-{day}T{hour:02}:0{m}:00Z", "kind": "t"}}) + "\n" for m in range(n + 1)))
        os.utime(f"{folder}/{n}.jsonl", (1_700_000_000 + 60 * n,) * 2)

    def run(cap, table, checkpoint):
        hourly_counts(spark, f"{landing}/*", typed, "ts", "kind", f"{root}/{table}", f"{root}/{checkpoint}", max_files_per_trigger=cap)
        return sorted((r.report_hour, r.table_name, r.n_files) for r in hourly_counts_view(spark, f"{root}/{table}").collect())

    want = [("2024010510", "t", 2), ("2024010601", "t", 3), ("2024010615", "t", 1)]
    assert run(1, "one", "ck1") == want and len(os.listdir(f"{root}/ck1/commits")) >= 3
    assert run(1000, "many", "ck2") == want
    # a replay from a fresh checkpoint over the same table changes nothing
    assert run(2, "one", "ck3") == want
