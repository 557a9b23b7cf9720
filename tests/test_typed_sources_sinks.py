import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import typed as ty
from tidemark.sinks.partitions import (export_csv, relayout_year_month, replace_partition,
                                       replace_partitions)
from tidemark.sources import files as src
from tidemark.sources import manifest as mf


def dictionary(spark, rows):
    return spark.createDataFrame(rows, "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, "
                                       "IS_NULLABLE string, ORDINAL int")


def test_map_types_and_modes(spark):  # D1, D2
    d = ty.map_types(dictionary(spark, [
        ("t", "a", " BigInt ", "0", 1), ("t", "b", "nvarchar", "NO", 2), ("t", "c", "money", "0.0", 3),
        ("t", "d", "datetime2", "YES", 4), ("t", "e", "bit", "", 5), ("t", "f", "varbinary", "1", 6)]))
    fields = ty.table_fields(d, "t", "ORDINAL")
    assert [(f.name, f.type, f.mode) for f in fields] == [
        ("a", "INT64", "REQUIRED"), ("b", "STRING", "REQUIRED"), ("c", "FLOAT64", "REQUIRED"),
        ("d", "DATETIME", "NULLABLE"), ("e", "BOOLEAN", "NULLABLE"), ("f", "BYTES", "NULLABLE")]


def test_unknown_type_fails_at_plan_time(spark):
    d = ty.map_types(dictionary(spark, [("t", "a", "geography", "1", 1)]))
    with pytest.raises(ValueError):
        ty.table_fields(d, "t", "ORDINAL")


def test_envelope_upper_case_keys_and_failfast(spark, tmp_shared):  # S5, T4, T5
    p = tmp_shared.replace("file:", "")
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/a.jsonl", "w") as fh:
        fh.write('{"_airbyte_ab_id":"1","_airbyte_emitted_at":1,"_airbyte_data":{"ID":"7","Amount":2.5,"extra":{"n":1}}}\n')
    df = src.read_envelope_jsonl(spark, p)
    fields = [ty.Field("id", "INT64", "REQUIRED"), ty.Field("amount", "FLOAT64", "NULLABLE"),
              ty.Field("missing", "STRING", "NULLABLE")]
    r = ty.typed_projection(df, fields).first()
    assert (r.id, r.amount, r.missing) == (7, 2.5, None)
    with open(f"{p}/b.jsonl", "w") as fh:
        fh.write('{"_airbyte_ab_id": broken\n')
    with pytest.raises(Exception):
        src.read_envelope_jsonl(spark, p).collect()


def test_delimited_null_marker_and_multiline(spark, tmp_shared):  # S6, T13
    p = tmp_shared.replace("file:", "")
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/x_2024-01-05.dat", "w") as fh:
        fh.write('a|b\n1|"two\nlines"\n2|NULL\n3|\n')
    schema = "a string, b string"
    with_marker = src.read_delimited(spark, p, schema, null_marker="NULL").orderBy("a").collect()
    without = src.read_delimited(spark, p, schema).orderBy("a").collect()
    assert [r.b for r in with_marker] == ["two\nlines", None, None]
    assert [r.b for r in without] == ["two\nlines", "NULL", None]
    files = mf.files_by_suffix_date(mf.list_files(spark, p), "dat").collect()
    assert files[0].file_date == dt.date(2024, 1, 5)


def test_manifest_parsing_and_discovery(spark):  # S1, S10, S15
    files = spark.createDataFrame([("gs://b/landing/tbA/2024_01_05_1704445200000_0.jsonl", 10),
                                   ("gs://b/landing/erp_x/2024_01_05_1704445200000_1.jsonl", 0)],
                                  "path string, length bigint")
    m = mf.parse_data_manifest(files)
    r = m.orderBy("path").first()
    assert (r.table_name, r.file_date, r.file_epoch_ms, r.seq) == ("erp_x", dt.date(2024, 1, 5), 1704445200000, 1)
    assert [x.table_name for x in mf.discover_tables(m, ("erp_",)).collect()] == ["tbA"]
    assert mf.files_for_hour(m, "2024010509").count() == 2
    ctrl = spark.createDataFrame([("gs://b/c/src_tbA_1704412800.ctrl", 5)], "path string, length bigint")
    c = mf.parse_control_manifest(ctrl, "src").first()
    assert (c.table_name, c.ctrl_date) == ("tbA", dt.date(2024, 1, 5))


def test_schema_drift_statuses(spark):  # D6
    inferred = spark.createDataFrame([("ID", "INT64"), ("zipcode", "INT64"), ("new", "STRING")],
                                     "field string, inferred_type string")
    declared = spark.createDataFrame([("id", "STRING"), ("zipcode", "STRING"), ("test_add", "INT64")],
                                     "field string, declared_type string")
    got = {r.field: (r.status, r.staging_type) for r in ty.schema_drift(inferred, declared).collect()}
    assert got == {"id": ("both", "STRING"), "zipcode": ("both", "STRING"),
                   "test_add": ("declared_only", "FLOAT64"), "new": ("undeclared", None)}


def test_required_checks(spark):  # D7
    df = spark.createDataFrame([(1, "a"), (None, "b")], "a int, b string")
    fields = [ty.Field("a", "INT64", "REQUIRED"), ty.Field("b", "STRING", "NULLABLE")]
    assert ty.required_violations(df, fields).count() == 1
    with pytest.raises(Exception):
        ty.enforce_required(df, fields).collect()


def test_retype_moves_columns_last(spark):  # D8
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string")
    out = ty.retype_columns(df, {"b": "INT64"})
    assert out.columns == ["a", "c", "b"] and out.first().b == 3


def test_dictionary_coverage_substring(spark):  # D11
    tables = spark.createDataFrame([("SRC_TBPRODUCT",), ("missing",)], "TABLE_NAME string")
    folders = spark.createDataFrame([("daily_tbproduct_source",), ("other",)], "folder string")
    got = {(r.table, r.status) for r in ty.dictionary_coverage(tables, folders, "src_").collect()}
    assert got == {("SRC_TBPRODUCT", "matched"), ("missing", "not found")}


def test_replace_partition_idempotent_and_empty(spark, tmp_shared):  # K1, T12
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, report_date date")
    replace_partitions(df, tmp_shared, ["report_date"])
    day1 = df.filter(F.col("report_date") == dt.date(2024, 1, 1))
    replace_partition(day1, tmp_shared, "report_date", dt.date(2024, 1, 1))
    replace_partition(day1, tmp_shared, "report_date", dt.date(2024, 1, 1))
    assert spark.read.parquet(tmp_shared).count() == 2
    replace_partition(day1.limit(0), tmp_shared, "report_date", dt.date(2024, 1, 1))
    assert [r.v for r in spark.read.parquet(tmp_shared).collect()] == [2]


def test_relayout_and_export(spark, tmp_shared):  # K8, K5
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1), (dt.date(2024, 2, 5), 2)], "d date, v int")
    relayout_year_month(df, "d", f"{tmp_shared}/ym")
    back = spark.read.parquet(f"{tmp_shared}/ym")
    assert sorted(r.yyyymm for r in back.collect()) == [202401, 202402]
    export_csv(df, f"{tmp_shared}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_shared}/csv").count() == 2


def test_control_readers(spark, tmp_shared):  # S8, S9
    p = tmp_shared.replace("file:", "")
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/CTRL_X_2024-01-05.ctrl", "w") as fh:
        fh.write("IntefaceName|BuCode|FileCount|TotalRec|BatchDate|Requester|DIHBatchID\nX|BU01|1|42|05012024235959|ETL|B1\n")
    with open(f"{p}/POS_X_2024-01-05.LOG", "w") as fh:
        fh.write("FileCreateDate|FileCreateTime|DataRowCount\n20240105|235959|42\n")
    assert src.read_control_jda(spark, f"{p}/*.ctrl").first().TotalRec == "42"
    assert src.read_control_pos(spark, f"{p}/*.LOG").first().DataRowCount == 42


def test_monthly_history_layout(spark, tmp_shared):  # S14
    p = tmp_shared.replace("file:", "")
    for m in ("202401", "202402"):
        os.makedirs(f"{p}/2024/{m}", exist_ok=True)
        with open(f"{p}/2024/{m}/a.TXT", "w") as fh:
            fh.write(f"k|m\n1|{m}\n")
    assert src.read_monthly_history(spark, p, 2024, "k string, m string").count() == 2


def test_audit_columns_hour_grain_and_hour_partition(spark, tmp_shared):  # D5, K2
    df = spark.createDataFrame([(1,)], "v int")
    out = ty.add_audit_columns(df, dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 10, 30), grain="hour")
    r = out.first()
    assert (r.report_date, r.run_date) == (dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 10, 30))
    assert dict(out.dtypes)["report_date"] == "timestamp_ntz"
    target = replace_partition(out, tmp_shared, "report_hour", dt.datetime(2024, 1, 5, 10))
    assert target.endswith("report_hour=2024010510")
    assert spark.read.parquet(tmp_shared).first().report_hour == 2024010510


def test_relayout_adds_days_and_repeats_change_nothing(spark, tmp_shared):  # K8
    from tidemark.sinks.partitions import relayout_year_month

    def days(*ds):
        return spark.createDataFrame([(d, dt.date(2024, 1, d)) for d in ds], "v int, d date")

    path = f"{tmp_shared}/ym"
    for run in (days(1, 2), days(3), days(3)):
        relayout_year_month(run, "d", path)
    back = spark.read.parquet(path)
    assert sorted(r.v for r in back.collect()) == [1, 2, 3]
    assert {(r.year, r.yyyymm) for r in back.collect()} == {(2024, 202401)}


def test_relayout_keeps_columns_that_a_run_lacks(spark, tmp_shared):  # K8
    from tidemark.sinks.partitions import relayout_year_month

    path, day = f"{tmp_shared}/ym", lambda d: dt.date(2024, 1, d)
    relayout_year_month(spark.createDataFrame([], "v int, d date"), "d", path)
    relayout_year_month(spark.createDataFrame([(1, "a", day(1)), (2, "b", day(2))], "v int, name string, d date"), "d", path)
    relayout_year_month(spark.createDataFrame([(3, day(2)), (4, day(3))], "v int, d date"), "d", path)
    relayout_year_month(spark.createDataFrame([(5, 0.5, day(4))], "v int, share double, d date"), "d", path)
    back = spark.read.option("mergeSchema", True).parquet(path)
    assert sorted((r.v, r.name, r.share) for r in back.collect()) == [
        (1, "a", None), (3, None, None), (4, None, None), (5, None, 0.5)]
    with pytest.raises(ValueError, match="v: int in the table, string in the run"):
        relayout_year_month(spark.createDataFrame([("6", day(5))], "v string, d date"), "d", path)
    assert spark.read.parquet(path).count() == 4


def test_reload_empties_a_day_without_rows(spark, tmp_shared):  # X2, T12
    from tidemark.sinks.partitions import reload_window_days

    path, run = f"{tmp_shared}/reload", dt.date(2024, 1, 3)
    old = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, run)], "v int, d date")
    reload_window_days(old, "d", run, (0, 1, 2), path)
    reload_window_days(old.filter("v <> 2").withColumn("v", old.v * 10), "d", run, (0, 1), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 30]


def test_one_yes_per_key_with_ties(spark):  # R7
    from tidemark.operators.latest import flag_latest

    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), ("b", 2, "z"), (None, 1, "x")],
                               "k string, o int, v string")
    out = flag_latest(df, ["k"], ["o"], "f").collect()
    assert sorted((r.k or "", r.v) for r in out if r.f == "Yes") == [("", "x"), ("a", "y"), ("b", "z")]
    assert len(out) == 5


def test_inventory_keeps_empty_files_that_a_scan_leaves_out(spark, tmp_path):  # S1, S2, Q8
    from tidemark.operators.quality import empty_files

    folder = tmp_path / "sales"
    folder.mkdir()
    (folder / "2024_01_05_1704412800000_0.jsonl").write_text("")
    (folder / "2024_01_05_1704412800000_1.jsonl").write_text("abc")
    listing = spark.createDataFrame([(f"file:{f}", f.stat().st_size) for f in sorted(folder.iterdir())],
                                    "object string, bytes long")
    manifest = mf.parse_data_manifest(mf.files_from_inventory(listing, "object", "bytes"))
    assert [(r.table_name, r.seq) for r in empty_files(manifest).collect()] == [("sales", 0)]
    assert [r.seq for r in mf.nonempty_files(manifest).collect()] == [1]
    assert mf.list_files(spark, f"{folder}/*").count() == 1


def test_named_files_have_one_part_whatever_the_record_limit(spark, tmp_shared):
    from tidemark.sinks.files import write_named_files

    rows = spark.range(25).withColumn("name", F.lit("feed_2024-01-05.TXT"))
    key = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(key)
    spark.conf.set(key, "10")
    try:
        written = write_named_files(rows, f"{tmp_shared}/named", "name", ["id"])
    finally:
        spark.conf.set(key, before)
    assert len(written) == 1
    assert src.read_delimited(spark, f"{tmp_shared}/named/*.TXT", "id string").count() == 25


def test_history_month_dealt_over_files_is_read_whole(spark, tmp_shared):  # S14
    from tidemark.sinks.files import with_dealt_names, write_named_files

    rows = spark.range(1000).withColumn("month", F.when(F.col("id") < 900, "2024/202401/h_202401").otherwise("2023/202312/h_202312"))
    named = with_dealt_names(rows, "file_name", F.col("month"), ".TXT", 100)
    files = write_named_files(named, f"{tmp_shared}/dealt", "file_name", ["id"])
    by_month = [sum("202401" in f for f in files), sum("202312" in f for f in files)]
    assert 5 <= by_month[0] <= 9 and by_month[1] == 1
    read = lambda years: sorted(int(r.id) for r in src.read_monthly_history(spark, f"{tmp_shared}/dealt", years, "id string").collect())
    assert read([2023, 2024]) == list(range(1000)) and read(2023) == list(range(900, 1000))
