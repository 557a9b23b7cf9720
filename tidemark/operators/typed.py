"""Dictionary-driven typing.

The data dictionary is a DataFrame ``(TABLE_NAME, COLUMN_NAME, DATA_TYPE,
IS_NULLABLE)``.  Mapping spellings to warehouse types is a join against the
type map; only the resulting per-table field list -- metadata the size of a
table's column list -- is brought to the driver, because a projection's
columns must be known when the plan is built.  Row data never leaves the
executors.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import casts, temporal

# Source type spellings per warehouse type (first match wins).
TYPE_SPELLINGS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("STRING", ("string", "char", "nchar", "nvarchar", "varchar", "sysname", "text",
                "uniqueidentifier")),
    ("INT64", ("integer", "int", "tinyint", "smallint", "bigint")),
    ("FLOAT64", ("float", "numeric", "decimal", "money")),
    ("BOOLEAN", ("bit", "boolean")),
    ("BYTES", ("varbinary",)),
    ("DATE", ("date",)),
    ("TIME", ("time",)),
    ("DATETIME", ("datetime", "datetime2", "smalldatetime")),
    ("TIMESTAMP", ("timestamp",)),
)
# IS_NULLABLE texts that mean REQUIRED.
REQUIRED_MARKERS = ("0", "0.0", "NO")

SPARK_TYPES = {"STRING": "string", "INT64": "bigint", "FLOAT64": "double",
               "BOOLEAN": "boolean", "BYTES": "binary", "DATE": "date", "TIME": "time",
               "DATETIME": "timestamp_ntz", "TIMESTAMP": "timestamp"}
TEMPORAL = ("DATE", "TIME", "DATETIME", "TIMESTAMP")
AUDIT_COLUMNS = ("report_date", "run_date")


@dataclass(frozen=True)
class Field:
    name: str
    type: str           # warehouse type (STRING, INT64, ...)
    mode: str           # REQUIRED / NULLABLE

    @property
    def spark_type(self) -> str:
        return SPARK_TYPES[self.type]


def type_map_frame(spark: SparkSession) -> DataFrame:
    """(spelling, warehouse_type, rank) rows of the fixed spelling list."""
    rows = [(s, wt, i) for i, (wt, spellings) in enumerate(TYPE_SPELLINGS) for s in spellings]
    return spark.createDataFrame(rows, "spelling string, warehouse_type string, rank int")


def normalise_dictionary(raw: DataFrame, columns: Sequence[str] = (
        "TABLE_NAME", "COLUMN_NAME", "DATA_TYPE", "IS_NULLABLE"),
        keep: Sequence[str] = ()) -> DataFrame:
    """Rename a sheet's four header columns (they differ per source) and
    lower-case table and column names; ``keep`` carries extra columns (e.g.
    the row order of the sheet)."""
    t, c, d, n = columns
    return raw.select(F.lower(F.col(t)).alias("TABLE_NAME"), F.lower(F.col(c)).alias("COLUMN_NAME"),
                      F.col(d).cast("string").alias("DATA_TYPE"),
                      F.col(n).cast("string").alias("IS_NULLABLE"), *keep)


def map_types(dictionary: DataFrame) -> DataFrame:
    """D1 + D2: add ``warehouse_type`` (NULL when the spelling is unknown) and
    ``mode``.  The type map is a fixed ~30-row table, broadcast by design."""
    spark = dictionary.sparkSession
    tm = F.broadcast(type_map_frame(spark))
    spelled = dictionary.withColumn("_spelling", F.lower(F.trim(F.col("DATA_TYPE"))))
    joined = spelled.join(tm, spelled["_spelling"] == tm["spelling"], "left")
    # First match wins: a spelling listed twice keeps its lowest rank.
    best = joined.groupBy(*dictionary.columns).agg(
        F.min_by("warehouse_type", "rank").alias("warehouse_type"))
    return best.withColumn(
        "mode", F.when(F.col("IS_NULLABLE").isin(*REQUIRED_MARKERS), F.lit("REQUIRED"))
                 .otherwise(F.lit("NULLABLE")))


def table_fields(typed_dictionary: DataFrame, table: str, order_col: str) -> list[Field]:
    """The field list of one table, in the order of ``order_col`` (rows of a
    DataFrame have none of their own).  Unknown tables and spellings raise
    here, when the plan is built, instead of producing a broken load."""
    d = typed_dictionary.filter(F.col("TABLE_NAME") == table.lower()).orderBy(order_col)
    rows = d.select("COLUMN_NAME", "DATA_TYPE", "warehouse_type", "mode").collect()
    if not rows:
        raise ValueError(f"table {table} is not in the dictionary")
    bad = [(r.COLUMN_NAME, r.DATA_TYPE) for r in rows if r.warehouse_type is None]
    if bad:
        raise ValueError(f"cannot map data type(s) for table {table}: {bad}")
    return [Field(r.COLUMN_NAME, r.warehouse_type, r.mode) for r in rows]


def cast_plain(value: Column, source_type: str, f: Field) -> Column:
    """Plain cast of an already-typed source column (no text parsing).
    FLOAT64 -> INT64 still rounds half away from zero (T1)."""
    if f.type == "INT64":
        if source_type in ("double", "float") or source_type.startswith("decimal"):
            return casts.float_to_int64(value)
        if source_type == "string":
            return casts.text_to_int64(value)
    if f.type == "BOOLEAN" and source_type == "string":
        return casts.text_to_boolean(value)
    return value.cast(f.spark_type)


def cast_text(value: Column, f: Field) -> Column:
    """One landing text value -> the declared type."""
    if f.type in TEMPORAL:
        return temporal.parse_temporal(value, f.type, nullable=f.mode == "NULLABLE")
    if f.type == "INT64":
        return casts.text_to_int64(value)
    if f.type == "FLOAT64":
        return casts.text_to_double(value)
    if f.type == "BOOLEAN":
        return casts.text_to_boolean(value)
    if f.type == "BYTES":
        return casts.text_to_binary(value)
    return value.cast("string")


def typed_columns(stage: DataFrame, fields: Sequence[Field], source: str | None = "_airbyte_data",
                  parse: bool = True) -> list[Column]:
    """D3: the per-column expression list, in dictionary order.

    ``source`` names the envelope map (keys already lower-cased); ``None``
    reads flat text columns of the same names.
    """
    if source:
        return [cast_text(F.col(source)[f.name], f).alias(f.name) for f in fields]
    if parse:
        return [cast_text(F.col(f.name), f).alias(f.name) for f in fields]
    types = {k.lower(): v for k, v in stage.dtypes}
    return [cast_plain(F.col(f.name), types[f.name.lower()], f).alias(f.name) for f in fields]


def typed_projection(stage: DataFrame, fields: Sequence[Field], source: str | None = "_airbyte_data",
                     parse: bool = True, extra: Sequence[Column] = ()) -> DataFrame:
    """D3 as a projection; ``extra`` columns (partition/audit expressions over
    the stage) are computed in the same select."""
    return stage.select(*typed_columns(stage, fields, source, parse), *extra)


def add_audit_columns(df: DataFrame, report_date: dt.date | dt.datetime | Column,
                      run_date: dt.date | dt.datetime, grain: str = "day") -> DataFrame:
    """``report_date`` and ``run_date`` as DATE (daily) or DATETIME (hourly)."""
    t = "date" if grain == "day" else "timestamp_ntz"

    def lit(v):
        if isinstance(v, Column):
            return v.cast(t)
        return F.lit(v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()).cast(t)

    return df.withColumn("report_date", lit(report_date)).withColumn("run_date", lit(run_date))


def staging_type(f: Field) -> str:
    """D6 staging rule: numbers land as FLOAT64, everything else as STRING."""
    return "FLOAT64" if f.type in ("INT64", "FLOAT64") else "STRING"


def schema_drift(inferred: DataFrame, declared: DataFrame) -> DataFrame:
    """D6 as a report: field sets ``(field, inferred_type)`` and ``(field,
    declared_type)`` full-outer-joined case-insensitively.

    status: ``both`` / ``declared_only`` (added to staging as NULLs) /
    ``undeclared`` (kept in staging, not projected).  ``staging_type`` follows
    the numbers-to-FLOAT64 rule for declared fields.
    """
    i = inferred.select(F.lower("field").alias("i_field"), "inferred_type")
    d = declared.select(F.lower("field").alias("d_field"), "declared_type")
    j = i.join(d, i["i_field"] == d["d_field"], "full")
    return j.select(
        F.coalesce("d_field", "i_field").alias("field"), "inferred_type", "declared_type",
        F.when(F.col("i_field").isNull(), "declared_only")
         .when(F.col("d_field").isNull(), "undeclared").otherwise("both").alias("status"),
        F.when(F.col("declared_type").isin("INT64", "FLOAT64"), "FLOAT64")
         .when(F.col("declared_type").isNotNull(), "STRING").alias("staging_type"),
        F.lit("NULLABLE").alias("staging_mode"))


def required_violations(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Rows breaking a REQUIRED declaration, with the offending columns."""
    req = [f.name for f in fields if f.mode == "REQUIRED"]
    if not req:
        return df.filter(F.lit(False)).withColumn("null_columns", F.array().cast("array<string>"))
    nulls = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in req]),
                     lambda x: x.isNotNull())
    return df.withColumn("null_columns", nulls).filter(F.size("null_columns") > 0)


def enforce_required(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """D7 as a guard: fails the job when a REQUIRED column holds NULL.

    Each REQUIRED column becomes ``coalesce(col, raise_error(...))``: the check
    rides in the same projection (no extra pass, and -- unlike a filter, which
    Catalyst would push below the projection and so re-evaluate every parse --
    each value is computed once).
    """
    req = {f.name.lower() for f in fields if f.mode == "REQUIRED"}
    types = {c.lower(): t for c, t in df.dtypes}
    cols = []
    for c in df.columns:
        if c.lower() in req:
            err = F.raise_error(F.lit(f"REQUIRED column {c} is NULL")).cast(types[c.lower()])
            cols.append(F.coalesce(F.col(c), err).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def retype_columns(df: DataFrame, retypes: Mapping[str, str]) -> DataFrame:
    """``SELECT * EXCEPT(cols), CAST(col AS type) ...`` -- retyped columns
    move to the end.  FLOAT64 -> INT64 rounds half away from zero (T1)."""
    others = [c for c in df.columns if c not in retypes]
    out = []
    for c, t in retypes.items():
        dtype = dict(df.dtypes)[c]
        if t.upper() in ("INT64", "BIGINT") and dtype in ("double", "float"):
            out.append(casts.float_to_int64(c).alias(c))
        else:
            out.append(F.col(c).cast(SPARK_TYPES.get(t.upper(), t)).alias(c))
    return df.select(*others, *out)


def substrings(col: Column, alias: str = "fragment") -> Column:
    """All substrings of ``col`` (lengths 1..len) as an array, for turning
    'contains' into an equi-join key; bounded by len^2 per value."""
    n = F.length(col)
    return F.flatten(F.transform(
        F.sequence(F.lit(1), n),
        lambda start: F.transform(F.sequence(F.lit(1), n - start + 1),
                                  lambda ln: F.substring(col, start, ln))))


def dictionary_coverage(dictionary_tables: DataFrame, folders: DataFrame, strip_prefix: str) -> DataFrame:
    """Does some landed folder contain the dictionary table name (leading
    ``strip_prefix`` left out, case-insensitive)?  Returns (table, folder|NULL, status).

    'Contains' is evaluated as an equi-join of the name against every
    substring of each folder name, so no cross product is formed.
    """
    names = dictionary_tables.select(
        F.col("TABLE_NAME").alias("table"),
        F.regexp_replace(F.lower("TABLE_NAME"), "^" + strip_prefix, "").alias("needle")).distinct()
    frags = folders.select(F.col("folder"),
                           F.explode(F.array_distinct(substrings(F.lower("folder")))).alias("needle"))
    # a short needle can match very many folder substrings: skew-safe left join
    from tidemark.operators.joins import left_join_many

    j = left_join_many(names, frags, ["needle"])
    return j.select("table", "folder",
                    F.when(F.col("folder").isNotNull(), "matched").otherwise("not found").alias("status"))
