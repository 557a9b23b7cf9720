"""Schemas of landed tables by aggregation, and a ledger of them.

``observed_fields`` reads the landing folders of all tables in one scan, keeps
each payload as a variant and counts, per table and field, in how many rows the
field is present and with which JSON types.  The counts are partial aggregates,
so what is shuffled grows with the number of fields and types, not with rows.

The ledger holds one row per (table, field): its widest type so far and the
runs that first and last had it.  Types only widen:

    none < INT64 < FLOAT64 < STRING,  BOOLEAN < STRING,  RECORD < STRING

Staged drops are written under the version of their table's ledger, which grows
when a type widens.  A reader declares the schema of each version, so no footer
is read to merge schemas; fields that a drop lacks are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.partitions import partition_dir, replace_partition
from tidemark.sources.files import ENVELOPE_PREFIX
from tidemark.sources.manifest import folder_name

VARIANT_ENVELOPE = f"{ENVELOPE_PREFIX}data variant"
LEDGER_SCHEMA = "field string, type string, first_run string, last_run string, version int"
#: Spark types of the warehouse's; a field seen only as JSON null is kept as text.
SPARK_TYPES = {"INT64": T.LongType(), "FLOAT64": T.DoubleType(), "BOOLEAN": T.BooleanType()}


def json_type(value: Column) -> Column:
    """Warehouse type of a variant value; NULL for a JSON null."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "VOID", F.lit(None).cast("string")).when(kind == "BIGINT", "INT64")
            .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "FLOAT64").when(kind == "BOOLEAN", "BOOLEAN")
            .when(kind.startswith("OBJECT"), "RECORD").otherwise("STRING"))


def widest(types: Column) -> Column:
    """The type that holds all of an array of types (NULLs left out); NULL for none."""
    seen = F.array_distinct(F.array_compact(types))
    numbers = F.forall(seen, lambda t: t.isin("INT64", "FLOAT64"))
    return (F.when(F.size(seen) == 0, F.lit(None).cast("string")).when(F.size(seen) == 1, F.element_at(seen, 1))
            .when(numbers, "FLOAT64").otherwise("STRING"))


def widest_of(a: str | None, b: str | None) -> str | None:
    """:func:`widest` of two types on the driver, for the few fields of one table."""
    if a is None or b is None or a == b:
        return a or b
    return "FLOAT64" if {a, b} == {"INT64", "FLOAT64"} else "STRING"


def observed_fields(spark: SparkSession, paths: str | Sequence[str], mode: str = "FAILFAST") -> DataFrame:
    """S13 for all tables in one job: ``(table_name, field, inferred_type, n_rows, n_present, n_null, types, conflict)``.

    A table is the folder of its files.  Field names are lower-cased (T4); two
    keys of one row that differ in case count as one field with two values.
    ``n_present`` counts values that are not a JSON null, ``n_null`` those that
    are; ``types`` lists the types seen, ``conflict`` says that they have no
    common type but text.  Rows without a payload count in ``n_rows`` only; a
    table without any field has no row.
    """
    rows = spark.read.schema(VARIANT_ENVELOPE).option("mode", mode).json(paths) \
        .select(folder_name(F.url_decode("_metadata.file_path")).alias("table_name"), F.col(f"{ENVELOPE_PREFIX}data").alias("payload"))
    entries = F.transform(F.map_entries(F.try_variant_get("payload", "$", "map<string,variant>")), lambda e: F.struct(
        F.lower(e["key"]).alias("field"), json_type(e["value"]).alias("type")))
    # one entry without a field per row counts the rows in the same scan
    row = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("type")))
    counted = (rows.select("table_name", F.inline(F.concat(row, F.coalesce(entries, F.slice(row, 1, 0)))))
               .groupBy("table_name", "field", "type").agg(F.count(F.lit(1)).alias("n")))
    facts = counted.where("field is not null").groupBy("table_name", "field").agg(
        F.array_sort(F.collect_set("type")).alias("types"),
        F.coalesce(F.sum(F.when(F.col("type").isNotNull(), F.col("n"))), F.lit(0)).alias("n_present"),
        F.coalesce(F.sum(F.when(F.col("type").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    totals = counted.where("field is null").select("table_name", F.col("n").alias("n_rows"))
    inferred = widest(F.col("types"))
    return facts.join(totals, "table_name").select(
        "table_name", "field", inferred.alias("inferred_type"), "n_rows", "n_present", "n_null", "types",
        F.coalesce((inferred == "STRING") & (F.size("types") > 1), F.lit(False)).alias("conflict"))


def read_ledger(spark: SparkSession, ledger: str, table: str) -> list:
    """The ledger's rows of one table, by field; empty before its first run."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(partition_dir(ledger, "table_name", table)).orderBy("version", "field").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def note_fields(spark: SparkSession, ledger: str, table: str, fields: dict[str, str | None], run: str) -> int:
    """Take a run's ``{field: type}`` into the ledger; the version its rows are staged under.

    Known fields widen, new ones are added, absent ones stay.  A new field does
    not need a new version (older files lack it, which reads as NULL); a wider
    type does.  Fields differ by case only once (lower case).  The ledger of a
    table is exchanged in two phases and has one writer; a run that repeats
    changes nothing but ``last_run``.
    """
    rows = read_ledger(spark, ledger, table)
    version = max((r.version for r in rows), default=1)
    now = {r.field: r for r in rows if r.version == version}
    fields = {k.lower(): v for k, v in fields.items()}
    merged, wider = {}, False
    for name in sorted({*now, *fields}):
        old = now[name].type if name in now else None
        new = widest_of(old, fields.get(name))
        wider |= name in now and SPARK_TYPES.get(new) != SPARK_TYPES.get(old)
        merged[name] = (name, new, now[name].first_run if name in now else run, run if name in fields else now[name].last_run)
    held = [tuple(r) for r in rows if r.version < version or wider]
    version += wider
    if {name: row[1] for name, row in merged.items()} != {n: r.type for n, r in now.items()} or wider \
            or any(row[3] != now[n].last_run for n, row in merged.items()):
        out = spark.createDataFrame([*held, *((*row, version) for row in merged.values())], LEDGER_SCHEMA)
        replace_partition(out.coalesce(1), ledger, "table_name", table)
    return version


def staging_schema(rows: list, version: int) -> T.StructType:
    return T.StructType([T.StructField(r.field, SPARK_TYPES.get(r.type, T.StringType())) for r in rows if r.version == version])


def stage_drop(spark: SparkSession, landing: str, staging: str, ledger: str, table: str, run: str) -> int:
    """K3: stage the landed rows of one table, with whatever fields they have; the version used.

    The payload is read once for its fields and once for its values, each field
    as the ledger's type.  A value that its type cannot hold becomes NULL, which
    the ledger rules out for values of this run.  A run that repeats replaces
    its own drop, in every version.
    """
    seen = {r.field: r.inferred_type for r in observed_fields(spark, landing).select("field", "inferred_type").collect()}
    before = max((r.version for r in read_ledger(spark, ledger, table)), default=1)
    version = note_fields(spark, ledger, table, seen, run)
    schema = staging_schema(read_ledger(spark, ledger, table), version)
    payload = F.try_variant_get(f"{ENVELOPE_PREFIX}data", "$", "map<string,variant>")
    entries = F.transform(F.map_entries(payload), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))

    def value(f: T.StructField) -> Column:
        first = F.try_element_at(F.filter("entries", lambda e: e["key"] == f.name), F.lit(1))["value"]
        return F.try_variant_get(first, "$", f.dataType.simpleString()).alias(f.name)

    rows = spark.read.schema(VARIANT_ENVELOPE).option("mode", "FAILFAST").json(landing) \
        .select(entries.alias("entries")).select(*(value(f) for f in schema))
    root = f"{staging.rstrip('/')}/{table}"
    for v in range(1, before + 1):  # a repeated run may have staged under an older version
        if v != version and _has_drop(spark, f"{root}/version={v}", run):
            replace_partition(rows.limit(0), f"{root}/version={v}", "run", run)
    replace_partition(rows, f"{root}/version={version}", "run", run)
    return version


def _has_drop(spark: SparkSession, folder: str, run: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(partition_dir(folder, "run", run))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_staged(spark: SparkSession, staging: str, ledger: str, table: str) -> DataFrame:
    """All drops of a table with the ledger's newest schema and their ``run``, without reading footers for a schema."""
    rows = read_ledger(spark, ledger, table)
    newest = max(r.version for r in rows)
    target = staging_schema(rows, newest)
    root, parts = f"{staging.rstrip('/')}/{table}", []
    for version in sorted({r.version for r in rows}):
        # a version may lack drops: all of its rows were staged again under a later one
        schema = T.StructType([*staging_schema(rows, version), T.StructField("run", T.StringType())])
        try:
            part = spark.read.schema(schema).option("basePath", f"{root}/version={version}").parquet(f"{root}/version={version}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        have = set(part.columns)
        parts.append(part.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target),
                                 "run"))
    return reduce(DataFrame.unionByName, parts)
