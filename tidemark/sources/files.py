"""File sources: JSON-lines envelopes, delimited feeds, control files.

All readers are plain ``spark.read`` scans with a declared schema: files are
split across executors, nothing is sampled on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.manifest import suffix_date

# Landing envelope and control-file layouts.
ENVELOPE_PREFIX = "_airbyte_"
ENVELOPE_SCHEMA = "_airbyte_ab_id string, _airbyte_emitted_at bigint, _airbyte_data map<string,string>"
JDA_CONTROL_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "IntefaceName", "BuCode", "FileCount", "TotalRec", "BatchDate", "Requester", "DIHBatchID")])
POS_CONTROL_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in (
    "FileCreateDate", "FileCreateTime", "DataRowCount")])
DELIMITER = "|"
NULL_MARKER = "NULL"
#: Stands for "no marker": with an empty marker Spark would read quoted empty fields as NULL.
NO_MARKER = "\x00"


def read_envelope_jsonl(spark: SparkSession, paths: str | Sequence[str],
                        mode: str = "FAILFAST") -> DataFrame:
    """Landing rows ``{_airbyte_ab_id, _airbyte_emitted_at, _airbyte_data{...}}``.

    The payload is read as ``map<string,string>``: any field (new ones too) is
    kept, numbers keep their JSON text, and keys are lower-cased so ``ID``
    matches a declared ``id`` (T4).  ``FAILFAST`` makes a malformed line fail
    the load (T5) instead of turning into NULLs.
    """
    df = spark.read.schema(ENVELOPE_SCHEMA).option("mode", mode).json(paths)
    return df.withColumn("_airbyte_data", F.transform_keys("_airbyte_data", lambda k, v: F.lower(k)))


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
                   null_marker: str | None = None, mode: str = "FAILFAST", multi_line: bool = True) -> DataFrame:
    """``|``-delimited text with one header row.

    A quoted empty field is the text ``''`` and an unquoted one is NULL, with a
    marker or without.  ``null_marker`` (``NULL``) is honoured only for the
    feeds that use it (T13); elsewhere the text ``NULL`` stays a string.
    ``multi_line`` allows line breaks in quoted fields, at the price of one
    task per file; feeds without them set it to False and are split.
    """
    return (spark.read.schema(schema).option("sep", DELIMITER).option("header", True).option("escape", '"')
            .option("nullValue", null_marker or NO_MARKER).option("emptyValue", "")
            .option("multiLine", multi_line).option("mode", mode).option("enforceSchema", True).csv(paths))


def read_control_jda(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JDA control files, 7 string fields."""
    return read_delimited(spark, paths, JDA_CONTROL_SCHEMA)


def read_control_pos(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """POS control files, 3 integer fields."""
    return read_delimited(spark, paths, POS_CONTROL_SCHEMA)


def with_source_file(df: DataFrame, col: str = "source_path") -> DataFrame:
    """Attach each row's file path (the hidden ``_metadata`` column)."""
    return df.withColumn(col, F.col("_metadata.file_path"))


def dated_rows(df: DataFrame, col: str = "file_date") -> DataFrame:
    """Each row with the date in the name of its file (``*_<YYYY-MM-DD>.<ext>``)."""
    return df.withColumn(col, suffix_date(F.col("_metadata.file_path")))


def infer_envelope_fields(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S13 (re-aimed): infer the payload schema from *all* rows, not one sample
    line, and return it as ``(field, inferred_type)`` rows."""
    inferred = spark.read.json(paths).schema
    payload = inferred[ENVELOPE_PREFIX + "data"].dataType if \
        (ENVELOPE_PREFIX + "data") in inferred.fieldNames() else T.StructType([])
    rows = [(f.name, _warehouse_name(f.dataType)) for f in payload.fields]
    return spark.createDataFrame(rows, "field string, inferred_type string")


def _warehouse_name(t: T.DataType) -> str:
    if isinstance(t, (T.LongType, T.IntegerType)):
        return "INT64"
    if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "FLOAT64"
    if isinstance(t, T.BooleanType):
        return "BOOLEAN"
    if isinstance(t, T.StructType):
        return "RECORD"
    return "STRING"


def read_monthly_history(spark: SparkSession, root: str, years: int | Sequence[int], schema,
                         null_marker: str | None = None) -> DataFrame:
    """One read of ``<root>/<YEAR>/<YYYYMM>/*.TXT`` for whole years
    (instead of twelve separate loads each).  A month may be any number of files."""
    years = [years] if isinstance(years, int) else years
    return read_delimited(spark, [f"{root.rstrip('/')}/{y}/*/*.TXT" for y in years], schema, null_marker)
