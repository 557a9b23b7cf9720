"""Landed-file manifests.

A manifest is a DataFrame ``(table, path, length, file_date, file_epoch_ms,
seq)``.  Listing uses the ``binaryFile`` source with only ``path``/``length``
selected, so file contents are never read; names are parsed with
``regexp_extract``, so the whole check runs on executors.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import temporal as tf

# Landed file-name formats.
#   data files     <table>/<YYYY_MM_DD>_<epoch ms>_<n>.jsonl
#   control files  <source>_<table>_<epoch s>.ctrl
#   delimited      <name>_<YYYY-MM-DD>.<ext>   (ext: dat/ctrl for JDA, TXT/LOG for POS)
DATA_NAME = r"(\d{4})_(\d{2})_(\d{2})_(\d+)_(\d+)\.jsonl$"
CONTROL_NAME = r"^(.+)_(\d+)\.ctrl$"
SUFFIX_DATE_NAME = r"_(\d{4}-\d{2}-\d{2})\.([A-Za-z]+)$"


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def folder_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def list_files(spark: SparkSession, path_glob: str | Sequence[str]) -> DataFrame:
    """``(path, length)`` of the non-empty files under ``path_glob``.

    Spark's file scan leaves out files of length 0.  Checks that have to see
    them (Q8, Q10) take their listing from ``files_from_inventory``."""
    return (spark.read.format("binaryFile").load(path_glob)
            .select("path", "length"))


def decoded_path(path: Column) -> Column:
    """A path as listings give it, from the URI form of ``_metadata.file_path``."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def files_from_inventory(inventory: DataFrame, path_col: str, size_col: str) -> DataFrame:
    """``(path, length)`` of every file, empty ones included, from a table
    of the store's listing (such as the inventory reports of object stores)."""
    return inventory.select(F.col(path_col).alias("path"), F.col(size_col).cast("bigint").alias("length"))


def parse_data_manifest(files: DataFrame) -> DataFrame:
    """table = parent folder; date, epoch and sequence from the file name.

    The name is split once into an attribute and the parts are read from it,
    so the (non-cheap) string work is not repeated per output column; files
    whose name does not follow the data-file pattern are not data files.
    """
    named = (files.withColumn("_name", F.substring_index("path", "/", -1))
                  .filter(F.col("_name").rlike(DATA_NAME))
                  .withColumn("_parts", F.split(F.regexp_replace("_name", r"\.jsonl$", ""), "_")))
    part = lambda i: F.element_at("_parts", i)
    return named.select(
        F.substring_index(F.substring_index("path", "/", -2), "/", 1).alias("table_name"),
        "path", "length",
        F.make_date(part(1).cast("int"), part(2).cast("int"), part(3).cast("int")).alias("file_date"),
        part(4).cast("bigint").alias("file_epoch_ms"),
        part(5).cast("int").alias("seq"))


def nonempty_files(manifest: DataFrame) -> DataFrame:
    """Zero-byte files are dropped."""
    return manifest.filter(F.col("length") > 0)


def files_for_day(manifest: DataFrame, day: dt.date | Column) -> DataFrame:
    """S3: files whose name starts with the report date."""
    d = day if isinstance(day, Column) else F.lit(day)
    return manifest.filter(F.col("file_date") == d)


def file_hour(manifest: DataFrame) -> Column:
    """UTC ``yyyyMMddHH`` of the file epoch."""
    return F.date_format(tf.epoch_ms_to_utc(F.col("file_epoch_ms")), "yyyyMMddHH")


def files_for_hour(manifest: DataFrame, yyyymmddhh: str) -> DataFrame:
    """Files of the day whose epoch (UTC) falls inside the run's hour."""
    return manifest.filter(file_hour(manifest) == F.lit(yyyymmddhh))


def files_by_suffix_date(files: DataFrame, ext: str, day: dt.date | None = None) -> DataFrame:
    """Files named ``*_<YYYY-MM-DD>.<ext>``, with the date parsed out."""
    name = file_name(F.col("path"))
    out = (files.withColumn("file_date", F.to_date(F.regexp_extract(name, SUFFIX_DATE_NAME, 1)))
                .filter(F.regexp_extract(name, SUFFIX_DATE_NAME, 2) == F.lit(ext)))
    return out if day is None else out.filter(F.col("file_date") == F.lit(day))


def suffix_date(path: Column) -> Column:
    """The date of a path ``*_<YYYY-MM-DD>.<ext>``; NULL for other names."""
    return F.try_to_date(F.regexp_extract(file_name(path), SUFFIX_DATE_NAME, 1), "yyyy-MM-dd")


def parse_control_manifest(files: DataFrame, source: str) -> DataFrame:
    """``<source>_<table>_<epoch s>.ctrl`` -> (table, path, epoch_s, ctrl_date UTC)."""
    name = file_name(F.col("path"))
    prefix = F.lit(source + "_")
    stem = F.regexp_extract(name, CONTROL_NAME, 1)
    return (files.filter(F.startswith(name, prefix))
            .select(F.substr(stem, F.lit(len(source) + 2)).alias("table_name"), "path", "length",
                    F.regexp_extract(name, CONTROL_NAME, 2).cast("bigint").alias("epoch_s"))
            .withColumn("ctrl_date", F.to_date(tf.epoch_s_to_utc(F.col("epoch_s")))))


def control_files_for_date(ctrl_manifest: DataFrame, run_date: dt.date) -> DataFrame:
    """Exact UTC-date match.  (The two 100,000 s listing windows of the
    original only narrowed a bucket listing and are not needed here.)"""
    return ctrl_manifest.filter(F.col("ctrl_date") == F.lit(run_date))


def discover_tables(manifest: DataFrame, excluded_prefixes: Sequence[str]) -> DataFrame:
    """Table list from folder names, without blanks and without the folders
    of excluded sources (prefixes, case-insensitive), which have jobs of their own."""
    t = F.lower(F.trim(F.col("table_name")))
    keep = (t != "") & F.col("table_name").isNotNull()
    for prefix in excluded_prefixes:
        keep &= ~F.startswith(t, F.lit(prefix.lower()))
    return manifest.select("table_name").distinct().filter(keep)
