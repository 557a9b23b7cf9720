"""Inputs on which loads used to fail or lose rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import temporal as tf
from tidemark.operators import typed as ty
from tidemark.sources import files as src
from tidemark.sources import manifest as mf


def write(path, text):
    path = path.replace("file:", "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_control_files_with_blanks_and_signs_in_their_names(spark, tmp_shared):  # S7, S8, S9
    head = "FileCreateDate|FileCreateTime|DataRowCount\n"
    for name, n in (("A B_2024-01-05", 1), ("c+d%20_2024-01-06", 2), ("undated", 3)):
        write(f"{tmp_shared}/{name}.LOG", f"{head}20240105|235959|{n}\n")
    got = src.dated_rows(src.read_control_pos(spark, f"{tmp_shared}/*.LOG")).collect()
    assert {(r.DataRowCount, r.file_date) for r in got} == {(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 1, 6)), (3, None)}
    listed = {r.path for r in mf.list_files(spark, f"{tmp_shared}/*").collect()}
    decoded = {r.p for r in src.with_source_file(spark.read.text(f"{tmp_shared}/*")).select(
        mf.decoded_path(F.col("source_path")).alias("p")).distinct().collect()}
    assert {p.rsplit("/", 1)[1] for p in listed} == {p.rsplit("/", 1)[1] for p in decoded}


def test_empty_text_is_kept_with_and_without_a_marker(spark, tmp_shared):  # S6, T13
    write(f"{tmp_shared}/x.TXT", 'a|b|c\n""||NULL\n"say ""hi"""|"two\nlines"|x\n')
    read = lambda **k: [tuple(r) for r in src.read_delimited(spark, f"{tmp_shared}/x.TXT", "a string, b string, c string", **k).collect()]
    assert read() == [("", None, "NULL"), ('say "hi"', "two\nlines", "x")]
    assert read(null_marker="NULL") == [("", None, None), ('say "hi"', "two\nlines", "x")]


def test_large_feeds_without_line_breaks_are_split(spark, tmp_shared):  # S6
    write(f"{tmp_shared}/x.TXT", "k|v\n" + "".join(f"{i}|{'x' * 50}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        one = src.read_delimited(spark, f"{tmp_shared}/x.TXT", "k int, v string")
        many = src.read_delimited(spark, f"{tmp_shared}/x.TXT", "k int, v string", multi_line=False)
        assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 4
        assert many.agg(F.count("v"), F.sum("k")).first() == one.agg(F.count("v"), F.sum("k")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("fraction, micros", [("", 0), (".1", 100000), (".12", 120000), (".123", 123000), (".1234", 123400),
                                              (".12345", 123450), (".123456", 123456), (".1234567", 123456), (".123456789", 123456)])
def test_fraction_digits(spark, fraction, micros):  # D4
    df = spark.createDataFrame([(f"2024-01-05T10:11:12{fraction}Z",)], "t string")
    r = df.select(tf.parse_temporal("t", "DATETIME").alias("a"), tf.parse_temporal("t", "TIMESTAMP").cast("timestamp_ntz").alias("b"),
                  tf.parse_temporal("t", "DATE").alias("c")).first()
    assert r.a == r.b == dt.datetime(2024, 1, 5, 10, 11, 12, micros) and r.c == dt.date(2024, 1, 5)


def test_a_text_that_is_no_date_still_raises(spark):  # D4
    with pytest.raises(Exception, match="(?i)cannot.*pars|malformed|invalid"):
        spark.createDataFrame([("2024-01-05T10:11:12.12345678901x",)], "t string").select(tf.parse_temporal("t", "DATETIME")).collect()


def test_unknown_table_raises(spark):  # D1
    d = spark.createDataFrame([("t", "a", "int", "NO", 2), ("t", "b", "int", "NO", 1)],
                              "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, IS_NULLABLE string, N int")
    assert [f.name for f in ty.table_fields(ty.map_types(d), "T", "N")] == ["b", "a"]
    with pytest.raises(ValueError, match="not in the dictionary"):
        ty.table_fields(ty.map_types(d), "other", "N")
