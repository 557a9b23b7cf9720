"""Landing rows that cannot be loaded, split off with file and reason.

The strict readers fail a load on the first bad row.  Here every line is judged
by the conversions of the typed projection, without raising: good lines go on
to that projection, the others keep their text, their file and the reasons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import temporal as tf
from tidemark.operators.typed import Field, typed_projection
from tidemark.sources.files import ENVELOPE_SCHEMA
from tidemark.sources.manifest import decoded_path

REJECT_SCHEMA = "path string, record string, reasons array<string>"
_CORRUPT = "_corrupt"


def _convertible(text: Column, f: Field) -> Column:
    """Whether the typed projection can convert a text that is not NULL."""
    trimmed = F.trim(text)
    if f.type == "INT64":
        whole = F.regexp_like(trimmed, F.lit(r"^[+-]?[0-9]+$"))
        fraction = F.regexp_replace(trimmed, r"^([+-]?[0-9]*\.[0-9])[0-9]*$", "$1").try_cast("decimal(38,9)")
        ok = F.when(whole, trimmed.try_cast("bigint").isNotNull()).otherwise(F.round(fraction).try_cast("bigint").isNotNull())
        return (trimmed == "") | ok
    if f.type == "FLOAT64":
        return (trimmed == "") | trimmed.try_cast("double").isNotNull()
    if f.type == "BOOLEAN":
        return F.lower(trimmed).isin("", "true", "false")
    if f.type == "BYTES":
        return F.try_to_binary(text, F.lit("base64")).isNotNull()
    if f.type == "TIME":
        ok = F.regexp_like(text, F.lit(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"))
    elif f.type == "TIMESTAMP":
        ok = F.try_to_timestamp(tf.cut_to_micros(text), F.lit(tf.ISO_INSTANT_PATTERN)).isNotNull()
    elif f.type in ("DATE", "DATETIME"):
        ok = F.try_to_timestamp(tf.cut_to_micros(text), F.lit(tf.ISO_UTC_PATTERN)).isNotNull()
    else:
        return F.lit(True)
    return ((text == "") & F.lit(f.mode == "NULLABLE")) | ok


def _reason(text: Column, f: Field) -> Column:
    """Why a value cannot be loaded, or NULL."""
    missing = text.isNull()
    if f.type in ("INT64", "FLOAT64", "BOOLEAN"):  # blank text of these types is NULL
        missing |= F.trim(text) == ""
    kept = F.when(text.isNotNull() & ~_convertible(text, f), F.lit(f"{f.name}: not {f.type}"))
    return F.when(missing, F.lit(f"{f.name}: required")).otherwise(kept) if f.mode == "REQUIRED" else kept


def judged_lines(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[Field]) -> DataFrame:
    """path, record (the line), ``_airbyte_data`` (keys lower-cased) and reasons (empty for a good line); blank lines are none."""
    lines = spark.read.text(paths).select(decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("record"))
    schema = f"{ENVELOPE_SCHEMA}, {_CORRUPT} string"
    parsed = lines.filter(F.trim("record") != "").withColumn(
        "row", F.from_json("record", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    data = F.transform_keys(F.col("row._airbyte_data"), lambda k, v: F.lower(k))
    malformed = F.col(f"row.{_CORRUPT}").isNotNull() | F.col("row._airbyte_data").isNull()
    rows = parsed.select("path", "record", F.when(~malformed, data).alias("_airbyte_data"), malformed.alias("malformed"))
    reasons = F.filter(F.array(*[_reason(F.col("_airbyte_data")[f.name], f) for f in fields]), lambda r: r.isNotNull())
    judged = F.struct("_airbyte_data", F.when(F.col("malformed"), F.array(F.lit("malformed"))).otherwise(reasons).alias("reasons"))
    # one row each: filters on generated columns stay above them, so a line is parsed and judged once
    # and not again for every mention of its values in a filter that the optimizer has moved to the scan
    return rows.select("path", "record", F.inline(F.array(judged)))


def split_lines(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[Field]) -> tuple[DataFrame, DataFrame]:
    """``(typed rows of the good lines, rejects)``."""
    lines = judged_lines(spark, paths, fields)
    good = F.size("reasons") == 0
    # the guard keeps the conversions from being evaluated for lines that are filtered out
    guarded = lines.filter(good).withColumn("_airbyte_data", F.when(good, F.col("_airbyte_data")))
    return typed_projection(guarded, fields), lines.filter(~good).select("path", "record", "reasons")
