"""Landing loads, typing, sinks and migrations.

These stand-ins write real files: a test table is rendered the way a source
system lands it (JSON-lines envelope, ``|``-delimited text, control files),
written under the shared checkpoint folder, loaded back through the same
operators a production load uses, and returned.  The oracle is the original
table, so a round trip that loses or alters a value fails the check.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.functions import temporal as tf
from tidemark.operators.migrate import (backfill_latest, migrate_by_date, migrate_hourly,
                                        migrate_retype, write_migration)
from tidemark.operators.quality import count_by_date, partition_expr
from tidemark.operators.typed import (add_audit_columns, dictionary_coverage, enforce_required,
                                      map_types, required_violations, retype_columns,
                                      schema_drift, table_fields, typed_projection)
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sinks.partitions import (append, export_csv, relayout_year_month,
                                       reload_window_days, replace_partition, replace_partitions,
                                       replace_table)
from tidemark.sources.files import (JDA_CONTROL_SCHEMA, POS_CONTROL_SCHEMA, dated_rows, infer_envelope_fields,
                                    read_control_jda, read_control_pos, read_delimited,
                                    read_envelope_jsonl, read_monthly_history)
from tidemark.sources.manifest import discover_tables, list_files
from tidemark.operators.unions import union_all
from tidemark.sinks.files import with_dealt_names, write_named_files

REPORT_DATE = dt.date(2024, 1, 31)
RUN_DATE = dt.date(2024, 2, 1)
#: Rows of a rendered monthly history file, about.
HISTORY_ROWS_PER_FILE = 1_000_000

# Data dictionaries of the stand-in sources, as a source team would supply them
# (mixed case, padded spellings, every IS_NULLABLE form).
DICTIONARY_ROWS = [
    ("ORDERS", "O_ORDERKEY", " BigInt ", "0", 1),
    ("ORDERS", "O_CUSTKEY", "int", "NO", 2),
    ("ORDERS", "O_ORDERSTATUS", "nchar", "1", 3),
    ("ORDERS", "O_TOTALPRICE", "money", "YES", 4),
    ("ORDERS", "O_ORDERDATE", "datetime2", "0.0", 5),
    ("ORDERS", "O_ORDERPRIORITY", "varchar", "", 6),
    ("Customer", "c_custkey", "bigint", "0", 1),
    ("Customer", "c_name", "nvarchar", "1", 2),
    ("Customer", "c_nationkey", "smallint", "1", 3),
    ("Customer", "c_acctbal", "decimal", "1", 4),
    ("Customer", "c_mktsegment", "varchar", "1", 5),
    ("Customer", "c_phone", "varchar", "1", 6),
    ("events", "event_id", "bigint", "NO", 1),
    ("events", "ts", "datetime", "NO", 2),
    ("events", "user_id", "int", "YES", 3),
    ("events", "event_type", "varchar", "YES", 4),
    ("events", "value", "float", "YES", 5),
    ("documents", "doc_id", "bigint", "NO", 1),
    ("documents", "lang", "char", "NO", 2),
    ("documents", "quality", "tinyint", "NO", 3),
    ("documents", "toxic", "bit", "YES", 4),
]


def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DICTIONARY_ROWS, "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, "
                         "IS_NULLABLE string, ORDINAL int")


_FIELDS: dict[tuple[str, str], list] = {}


def fields_of(spark: SparkSession, table: str):
    """The typed field list of ``table``.  The dictionary is static
    configuration, so its mapping job runs once per application and table."""
    key = (spark.sparkContext.applicationId, table.lower())
    if key not in _FIELDS:
        d = map_types(dictionary(spark).withColumn("TABLE_NAME", F.lower("TABLE_NAME"))
                      .withColumn("COLUMN_NAME", F.lower("COLUMN_NAME")))
        _FIELDS[key] = table_fields(d, table, order_col="ORDINAL")
    return list(_FIELDS[key])


def iso_text(col: str, digits: int = 6):
    frac = {0: "", 3: ".SSS", 6: ".SSSSSS"}[digits]
    return F.date_format(F.col(col), f"yyyy-MM-dd'T'HH:mm:ss{frac}'Z'")


def envelope(df: DataFrame, id_col: str, payload: dict, keep=()) -> DataFrame:
    """Render rows as landing JSON lines (one ``value`` string per row, plus
    the ``keep`` columns, e.g. a folder partition)."""
    body = F.struct(
        F.concat(F.lit("ab-"), F.col(id_col).cast("string")).alias("_airbyte_ab_id"),
        F.lit(1706745600000).alias("_airbyte_emitted_at"),
        F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in payload.items()])
         .alias("_airbyte_data"))
    return df.select(F.to_json(body).alias("value"), *keep)


def customer_envelope(t: Tables, extra: bool = False) -> DataFrame:
    payload = {"C_CUSTKEY": F.col("c_custkey").cast("string"),   # code given as text
               "c_name": "c_name",
               "c_nationkey": "c_nationkey",                     # JSON number
               "C_ACCTBAL": "c_acctbal",                         # upper-case key (T4)
               "c_mktsegment": "c_mktsegment"}
    if extra:
        payload["loyalty_tier"] = F.when(F.col("c_acctbal") > 5000, "gold").otherwise("silver")
    return envelope(t.customer, "c_custkey", payload)


# ---------------------------------------------------------------- typing ----

@query("typed_projection", ("D1", "D2", "D3", "D4", "D5", "D7", "T2"), oracle="""
SELECT *, DATE '2024-01-31' AS report_date, DATE '2024-02-01' AS run_date FROM orders
""")
def typed_projection_query(spark, sf_dir):
    """orders rendered as landing text (a map of strings), then typed by the
    dictionary, REQUIRED-checked and stamped with the audit dates."""
    o = Tables(spark, sf_dir).orders
    stage = o.select(F.create_map(
        F.lit("o_orderkey"), F.col("o_orderkey").cast("string"),
        F.lit("o_custkey"), F.col("o_custkey").cast("string"),
        F.lit("o_orderstatus"), F.col("o_orderstatus"),
        F.lit("o_totalprice"), F.col("o_totalprice").cast("string"),
        F.lit("o_orderdate"), iso_text("o_orderdate", 0),
        F.lit("o_orderpriority"), F.col("o_orderpriority")).alias("_airbyte_data"))
    fields = fields_of(spark, "orders")
    typed = enforce_required(typed_projection(stage, fields), fields)
    return add_audit_columns(typed, REPORT_DATE, RUN_DATE)


@query("parse_temporal", ("D4",), oracle="""
SELECT event_id,
       CASE event_type WHEN 'error' THEN NULL
                       WHEN 'click' THEN date_trunc('second', ts)
                       WHEN 'view' THEN date_trunc('millisecond', ts) ELSE ts END AS ts_parsed,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS date_parsed
FROM events
""")
def parse_temporal_query(spark, sf_dir):
    """ISO texts with 0, 3 and 6 fraction digits, and '' for a NULLABLE field."""
    ev = Tables(spark, sf_dir).events
    text = (F.when(F.col("event_type") == "error", F.lit(""))
             .when(F.col("event_type") == "click", iso_text("ts", 0))
             .when(F.col("event_type") == "view", iso_text("ts", 3))
             .otherwise(iso_text("ts", 6)))
    staged = ev.select("event_id", text.alias("t"))
    return staged.select("event_id",
                         tf.parse_temporal("t", "DATETIME").alias("ts_parsed"),
                         tf.parse_temporal("t", "DATE").alias("date_parsed"))


@query("retype_columns", ("D8", "T1", "G4"), oracle="""
SELECT * EXCLUDE (o_custkey, o_totalprice), CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(round(o_totalprice) AS BIGINT) AS o_totalprice
FROM orders
""")
def retype_columns_query(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return retype_columns(o, {"o_custkey": "STRING", "o_totalprice": "INT64"})


@query("required_violations", ("D7",), oracle="""
SELECT d.doc_id, d.lang, l.quality, l.toxic, 'quality' AS null_columns
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL OR d.lang IS NULL OR d.doc_id IS NULL
""")
def required_violations_query(spark, sf_dir):
    """Documents joined to their labels: unlabelled documents break the
    REQUIRED ``quality`` declaration."""
    t = Tables(spark, sf_dir)
    docs = t.documents.select("doc_id", "lang")
    joined = docs.join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")
    bad = required_violations(joined, fields_of(spark, "documents"))
    return bad.withColumn("null_columns", F.array_join("null_columns", ","))


@query("migrate_cast_only", ("G3", "T1"), oracle="""
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       DATE '2024-01-31' AS report_date, DATE '2024-02-01' AS run_date
FROM customer
""")
def migrate_cast_only_query(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    fields = [f for f in fields_of(spark, "customer") if f.name != "c_phone"]
    typed = typed_projection(c, fields, source=None, parse=False)
    return add_audit_columns(typed, REPORT_DATE, RUN_DATE)


# ----------------------------------------------------- sources round trip ---

@query("envelope_roundtrip", ("S5", "T4", "T5", "D3", "K1"), oracle="""
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS c_phone, DATE '2024-02-01' AS run_date,
       DATE '2024-01-31' AS report_date
FROM customer
""")
def envelope_roundtrip(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = shared_dir(spark, "envelope")
    customer_envelope(t).write.text(f"{root}/landing/customer")
    stage = read_envelope_jsonl(spark, f"{root}/landing/customer")
    fields = fields_of(spark, "customer")
    typed = add_audit_columns(typed_projection(stage, fields), REPORT_DATE, RUN_DATE)
    replace_partition(typed, f"{root}/table", "report_date", REPORT_DATE)
    return spark.read.parquet(f"{root}/table")


@query("delimited_roundtrip", ("S6", "T13", "K1", "S12"), oracle="""
SELECT *, DATE '2024-01-31' AS _partition_date FROM orders
""")
def delimited_roundtrip(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    root = shared_dir(spark, "delimited")
    text = o.select(*[F.col(c).cast("string").alias(c) for c in o.columns if c != "o_orderdate"],
                    iso_text("o_orderdate", 3).alias("o_orderdate"))
    text.write.option("sep", "|").option("header", True).csv(f"{root}/landing")
    schema = ", ".join(f"{c} string" for c in text.columns)
    stage = read_delimited(spark, f"{root}/landing", schema, null_marker="NULL")
    typed = typed_projection(stage, fields_of(spark, "orders"), source=None)
    replace_partition(typed, f"{root}/table", "_partition_date", REPORT_DATE)
    return spark.read.parquet(f"{root}/table")


@query("schema_drift_report", ("D6", "S13"), oracle="""
SELECT * FROM (VALUES
  ('c_custkey', 'STRING', 'INT64', 'both', 'FLOAT64', 'NULLABLE'),
  ('c_name', 'STRING', 'STRING', 'both', 'STRING', 'NULLABLE'),
  ('c_nationkey', 'INT64', 'INT64', 'both', 'FLOAT64', 'NULLABLE'),
  ('c_acctbal', 'FLOAT64', 'FLOAT64', 'both', 'FLOAT64', 'NULLABLE'),
  ('c_mktsegment', 'STRING', 'STRING', 'both', 'STRING', 'NULLABLE'),
  ('c_phone', NULL, 'STRING', 'declared_only', 'STRING', 'NULLABLE'),
  ('loyalty_tier', 'STRING', NULL, 'undeclared', NULL, 'NULLABLE'))
  v(field, inferred_type, declared_type, status, staging_type, staging_mode)
WHERE (SELECT COUNT(*) FROM customer) > 0
""")
def schema_drift_report(spark, sf_dir):
    """Fields inferred over *all* landed customer rows versus the declared
    dictionary (mixed-case keys, a code sent as text, an undeclared field, a
    declared field that never lands)."""
    t = Tables(spark, sf_dir)
    root = shared_dir(spark, "drift")
    customer_envelope(t, extra=True).write.text(f"{root}/landing")
    inferred = infer_envelope_fields(spark, f"{root}/landing")
    declared = spark.createDataFrame([(f.name, f.type) for f in fields_of(spark, "customer")],
                                     "field string, declared_type string")
    return schema_drift(inferred, declared)


@query("stage_field_addition", ("K3",), oracle="""
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS loyalty_tier, 1 AS drop_id FROM customer
UNION ALL
SELECT c_custkey, c_name, CASE WHEN c_acctbal > 5000 THEN 'gold' ELSE 'silver' END, 2 FROM customer
""")
def stage_field_addition(spark, sf_dir):
    """Two staging drops of customer; the second adds a field.  Reading the
    staging table with ``mergeSchema`` keeps both, NULL-filling the first."""
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")
    root = shared_dir(spark, "staging")
    c.drop("c_acctbal").write.parquet(f"{root}/stage/drop_id=1")
    (c.withColumn("loyalty_tier", F.when(F.col("c_acctbal") > 5000, "gold").otherwise("silver"))
      .drop("c_acctbal").write.parquet(f"{root}/stage/drop_id=2"))
    staged = spark.read.option("mergeSchema", True).parquet(f"{root}/stage")
    return staged.select("c_custkey", "c_name", "loyalty_tier", F.col("drop_id").cast("int"))


def _control_lines(t: Tables) -> DataFrame:
    from tidemark.plans.reconcile import control_file_rows

    rows = control_file_rows(t)
    year_end = F.make_date(F.substring("BatchDate", 5, 4).cast("int"), F.lit(12), F.lit(31))
    return rows.withColumn("file_name", F.concat(
        F.lit("CTRL_"), F.col("IntefaceName"), F.lit("_"),
        F.date_format(year_end, "yyyy-MM-dd"), F.lit(".ctrl")))


@query("control_read_jda", ("S7", "S8"), oracle="""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
ctrl AS (
  SELECT 'orders' AS IntefaceName, CAST(COUNT(*) AS VARCHAR) AS TotalRec, d FROM o GROUP BY d
  UNION ALL
  SELECT 'lineitem', CAST(COUNT(*) AS VARCHAR), o.d
  FROM lineitem l LEFT JOIN o ON l.l_orderkey = o.o_orderkey WHERE o.d IS NOT NULL GROUP BY o.d)
SELECT IntefaceName, 'BU01' AS BuCode, '1' AS FileCount, TotalRec,
       strftime(d, '%d%m%Y') || '235959' AS BatchDate, 'ETL' AS Requester,
       'B' || strftime(d, '%Y%m%d') AS DIHBatchID,
       make_date(year(d), 12, 31) AS file_date
FROM ctrl
""")
def control_read_jda(spark, sf_dir):
    root = shared_dir(spark, "ctrl")
    lines = _control_lines(Tables(spark, sf_dir))
    write_named_files(lines, f"{root}/outbound", "file_name",
                      [c.name for c in JDA_CONTROL_SCHEMA.fields], sep="|")
    return dated_rows(read_control_jda(spark, f"{root}/outbound/*.ctrl"))


@query("control_read_pos", ("S7", "S9"), oracle="""
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS FileCreateDate, CAST(235959 AS BIGINT) AS FileCreateTime,
       COUNT(*) AS DataRowCount, make_date(year(d), 12, 31) AS file_date
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY d
""")
def control_read_pos(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("d"))
    per_day = o.groupBy("d").agg(F.count(F.lit(1)).alias("DataRowCount"))
    lines = per_day.select(
        F.date_format("d", "yyyyMMdd").alias("FileCreateDate"), F.lit("235959").alias("FileCreateTime"),
        F.col("DataRowCount").cast("string").alias("DataRowCount"),
        F.concat(F.lit("SALES_"), F.year("d").cast("string"), F.lit("-12-31.LOG")).alias("file_name"))
    root = shared_dir(spark, "poslog")
    write_named_files(lines, f"{root}/outbound", "file_name",
                      [c.name for c in POS_CONTROL_SCHEMA.fields], sep="|")
    return dated_rows(read_control_pos(spark, f"{root}/outbound/*.LOG"))


@query("dictionary_coverage", ("D11",), oracle="""
WITH folders AS (
  SELECT DISTINCT CASE event_type WHEN 'purchase' THEN 'ERP_purchase'
                                  WHEN 'error' THEN 'side_error' ELSE event_type END AS folder
  FROM events),
dict AS (SELECT * FROM (VALUES ('SRC_SIGNUP'), ('SRC_purchase'), ('error'), ('refund'), ('SRC_View'))
         v(TABLE_NAME))
SELECT d.TABLE_NAME AS "table", f.folder,
       CASE WHEN f.folder IS NULL THEN 'not found' ELSE 'matched' END AS status
FROM dict d LEFT JOIN folders f
  ON contains(lower(f.folder), regexp_replace(lower(d.TABLE_NAME), '^src_', ''))
""")
def dictionary_coverage_query(spark, sf_dir):
    from tidemark.plans.filechecks import landed_files
    from tidemark.sources.manifest import folder_name

    folder = (F.when(F.col("event_type") == "purchase", F.lit("ERP_purchase"))
               .when(F.col("event_type") == "error", F.lit("side_error"))
               .otherwise(F.col("event_type")))
    folders = (landed_files(Tables(spark, sf_dir), folder)
               .select(folder_name(F.col("path")).alias("folder")).distinct())
    dict_tables = spark.createDataFrame(
        [("SRC_SIGNUP",), ("SRC_purchase",), ("error",), ("refund",), ("SRC_View",)], "TABLE_NAME string")
    return dictionary_coverage(dict_tables, folders, "src_")


# ------------------------------------------------------------------ sinks ---

@query("replace_partition_idempotent", ("K1", "K7", "T12"), oracle="""
SELECT year(o_orderdate) AS o_year, COUNT(*) AS n_rows, round(SUM(o_totalprice), 2) AS total
FROM orders WHERE year(o_orderdate) <> 2001 GROUP BY 1
""")
def replace_partition_idempotent(spark, sf_dir):
    """Initial load of orders by year, then 1998 replaced twice with its own
    rows (idempotent), a third time by a job that fails on a row (the old rows
    stay), and 2001 replaced with an empty result (emptied)."""
    o = Tables(spark, sf_dir).orders.withColumn("o_year", F.year("o_orderdate"))
    root = shared_dir(spark, "replace")
    replace_table(o.filter(F.lit(False)), f"{root}/orders_by_year")   # K7 creates/clears the table
    replace_partitions(o, f"{root}/orders_by_year", ["o_year"])
    for _ in range(2):
        replace_partition(o.filter(F.col("o_year") == 1998), f"{root}/orders_by_year", "o_year", 1998)
    bad_row = F.when(F.col("o_totalprice") >= 0, F.raise_error(F.lit("bad row")).cast("double"))
    failed = False
    try:
        replace_partition(o.filter(F.col("o_year") == 1998).withColumn("o_totalprice", bad_row), f"{root}/orders_by_year", "o_year", 1998)
    except PySparkException:
        failed = True
    if not failed and not o.filter(F.col("o_year") == 1998).isEmpty():
        raise RuntimeError("the write of a bad row did not fail")
    replace_partition(o.filter(F.lit(False)), f"{root}/orders_by_year", "o_year", 2001)
    back = spark.read.parquet(f"{root}/orders_by_year")
    return back.groupBy(F.col("o_year").cast("bigint").alias("o_year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("relayout_year_month", ("K8",), oracle="""
SELECT year(l_shipdate) AS year, strftime(l_shipdate, '%Y%m') AS yyyymm, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1, 2
""")
def relayout_year_month_query(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    root = shared_dir(spark, "relayout")
    # two runs that share days and split months: the second adds to the first and replaces what it repeats
    relayout_year_month(li.filter(F.dayofmonth("l_shipdate") <= 20), "l_shipdate", f"{root}/lineitem_ym")
    relayout_year_month(li.filter(F.dayofmonth("l_shipdate") >= 15), "l_shipdate", f"{root}/lineitem_ym")
    back = spark.read.parquet(f"{root}/lineitem_ym")
    return back.groupBy(F.col("year").cast("bigint").alias("year"),
                        F.col("yyyymm").cast("string").alias("yyyymm")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("append_history", ("K4", "S14"), oracle="""
SELECT year(l_shipdate) AS year, strftime(l_shipdate, '%Y%m') AS yyyymm, COUNT(*) AS n_rows,
       round(SUM(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY 1, 2
""")
def append_history(spark, sf_dir):
    """Monthly delimited history files (``YEAR/YYYYMM/*.TXT``) loaded a year
    range at a time and appended to one history table."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_extendedprice", "l_shipdate")
    root = shared_dir(spark, "history")
    text = li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"),
                     F.col("l_extendedprice").cast("string").alias("l_extendedprice"),
                     iso_text("l_shipdate", 0).alias("l_shipdate"),
                     F.date_format("l_shipdate", "yyyy").alias("yyyy"),
                     F.date_format("l_shipdate", "yyyyMM").alias("yyyymm"))
    month = F.concat(F.col("yyyy"), F.lit("/"), F.col("yyyymm"), F.lit("/history_"), F.col("yyyymm"))
    write_named_files(with_dealt_names(text, "file_name", month, ".TXT", HISTORY_ROWS_PER_FILE),
                      f"{root}/monthly", "file_name", ["l_orderkey", "l_extendedprice", "l_shipdate"], sep="|")
    schema = "l_orderkey string, l_extendedprice string, l_shipdate string"
    years = sorted(int(p.rsplit("/", 1)[-1]) for p in _subdirs(spark, f"{root}/monthly"))
    for first, last in ((years[0], years[len(years) // 2]), (years[len(years) // 2] + 1, years[-1])):
        if first > last:
            continue
        batch = read_monthly_history(spark, f"{root}/monthly", [y for y in years if first <= y <= last], schema)
        append(batch.select(F.col("l_orderkey").cast("bigint"),
                            F.col("l_extendedprice").cast("double"),
                            tf.parse_iso_utc("l_shipdate").alias("l_shipdate")), f"{root}/table")
    back = spark.read.parquet(f"{root}/table")
    return back.groupBy(F.year("l_shipdate").cast("bigint").alias("year"),
                        F.date_format("l_shipdate", "yyyyMM").alias("yyyymm")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


def _subdirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()]


@query("csv_export_roundtrip", ("K5", "Q3"), oracle="""
SELECT CAST(l_shipdate AS DATE) AS partition_date, COUNT(*) AS row_count
FROM lineitem GROUP BY 1
""")
def csv_export_roundtrip(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    root = shared_dir(spark, "export")
    export_csv(count_by_date(li, F.to_date("l_shipdate")), f"{root}/compare_csv")
    return (spark.read.option("header", True)
            .schema("partition_date date, row_count bigint").csv(f"{root}/compare_csv"))


@query("partition_date_filter", ("S12", "Q4", "P4"), oracle="""
SELECT CAST(ts AS DATE) AS partition_date, COUNT(*) AS row_count
FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15' GROUP BY 1
""")
def partition_date_filter(spark, sf_dir):
    """Events landed into an ingestion-date partitioned table; the cut-off is a
    partition filter (directories after the cut-off are never listed)."""
    ev = Tables(spark, sf_dir).events.withColumn("_partition_date", F.to_date("ts"))
    root = shared_dir(spark, "ingest")
    replace_partitions(ev, f"{root}/jda_events", ["_partition_date"])
    back = spark.read.parquet(f"{root}/jda_events")
    part = partition_expr("jda_events")
    return count_by_date(back.filter(part <= F.lit(dt.date(2024, 1, 15))), part)


# ------------------------------------------------------------- migrations ---

def _events_stage(ev: DataFrame) -> DataFrame:
    return ev.select(F.create_map(
        F.lit("event_id"), F.col("event_id").cast("string"),
        F.lit("ts"), iso_text("ts", 6),
        F.lit("user_id"), F.col("user_id").cast("string"),
        F.lit("event_type"), F.col("event_type"),
        F.lit("value"), F.col("value").cast("string")).alias("_airbyte_data"),
        F.to_date("ts").alias("ds"))


@query("migrate_by_date", ("G1", "D3", "D4"), oracle="""
SELECT event_id, ts, user_id, event_type, value, DATE '2024-02-01' AS run_date,
       CAST(ts AS DATE) AS report_date
FROM events
""")
def migrate_by_date_query(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    root = shared_dir(spark, "migrate")
    migrated = migrate_by_date(_events_stage(ev), fields_of(spark, "events"), "ds", RUN_DATE,
                               source="_airbyte_data")
    write_migration(migrated, f"{root}/events_daily", "report_date")
    return spark.read.parquet(f"{root}/events_daily")


@query("migrate_hourly", ("G2", "K2"), oracle="""
SELECT strftime(ts, '%Y%m%d%H') AS report_hour, date_trunc('hour', ts) AS report_date,
       COUNT(*) AS n_events, round(SUM(value), 2) AS total_value
FROM events GROUP BY 1, 2
""")
def migrate_hourly_query(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    root = shared_dir(spark, "migrate_h")
    fields = fields_of(spark, "events")
    migrated = migrate_hourly(ev, fields, "ts", dt.datetime(2024, 2, 1, 0, 30))
    write_migration(migrated, f"{root}/events_hourly", "report_hour")
    back = spark.read.parquet(f"{root}/events_hourly")
    return back.groupBy(F.col("report_hour").cast("string").alias("report_hour"), "report_date").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total_value"))


@query("migrate_retype", ("G4", "D8"), oracle="""
SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority,
       CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(round(o_totalprice) AS BIGINT) AS o_totalprice,
       last_day(CAST(o_orderdate AS DATE)) AS _partition_date
FROM orders
""")
def migrate_retype_query(spark, sf_dir):
    """Orders ingested in month-end batches, re-typed per ingestion date."""
    o = Tables(spark, sf_dir).orders.withColumn("_partition_date", F.last_day(F.to_date("o_orderdate")))
    root = shared_dir(spark, "retype")
    out = migrate_retype(o, {"o_custkey": "STRING", "o_totalprice": "INT64"}, "_partition_date")
    write_migration(out, f"{root}/orders_test", "_partition_date")
    return spark.read.parquet(f"{root}/orders_test")


BACKFILL_CUTOFFS = [dt.date(1996, 12, 31), dt.date(1997, 12, 31), dt.date(1998, 12, 31),
                    dt.date(1999, 12, 31), dt.date(2000, 12, 31)]


@query("backfill_cutoffs", ("G6", "P4", "R1"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT c.cutoff, o.*, row_number() OVER (PARTITION BY c.cutoff, o.o_custkey
                                           ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rnk
  FROM (VALUES (DATE '1996-12-31'), (DATE '1997-12-31'), (DATE '1998-12-31'),
               (DATE '1999-12-31'), (DATE '2000-12-31')) c(cutoff)
  JOIN orders o ON CAST(o.o_orderdate AS DATE) <= c.cutoff) t
WHERE rnk = 1
""")
def backfill_cutoffs(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return backfill_latest(o, ["o_custkey"], "o_orderdate", ["o_orderdate", "o_orderkey"],
                           BACKFILL_CUTOFFS)


@query("local_date_shift", ("T14", "LOCAL_DATE"), oracle="""
SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_date, COUNT(*) AS n_events
FROM events GROUP BY 1
""")
def local_date_shift(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return ev.groupBy(tf.local_date("ts").alias("local_date")).agg(F.count(F.lit(1)).alias("n_events"))


@query("reload_window", ("X2",), oracle="""
SELECT CAST(ts AS DATE) AS report_date, COUNT(*) AS n_rows, round(SUM(value), 2) AS total_value
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-19' AND DATE '2024-01-20'
GROUP BY 1
""")
def reload_window(spark, sf_dir, run_date: dt.date = dt.date(2024, 1, 20), offsets=(0, 1)):
    """Late files: each run reloads the dates ``run_date - offset`` for the
    configured offsets.  Here the table already holds the window's dates with
    other rows, and one date that has nothing any more."""
    ev = Tables(spark, sf_dir).events
    root = shared_dir(spark, "reload")
    gone = run_date + dt.timedelta(days=3650)
    old = ev.filter(F.to_date("ts") == F.lit(run_date))
    for day in (run_date, gone):
        replace_partition(old, f"{root}/events", "report_date", day)
    reload_window_days(ev, "ts", run_date, offsets, f"{root}/events")
    reload_window_days(ev, "ts", gone, (0,), f"{root}/events")
    back = spark.read.parquet(f"{root}/events")
    return back.groupBy("report_date").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.round(F.sum("value"), 2).alias("total_value"))


@query("infer_schema_report", ("S13", "S15", "S5"), oracle="""
SELECT table_name, field,
       CASE WHEN type IN ('BIGINT', 'INTEGER') THEN 'INT64'
            WHEN type = 'DOUBLE' THEN 'FLOAT64' ELSE 'STRING' END AS inferred_type
FROM (SELECT 'nation' AS table_name, column_name AS field, column_type AS type FROM (DESCRIBE nation)
      UNION ALL
      SELECT 'region', column_name, column_type FROM (DESCRIBE region)
      UNION ALL
      SELECT 'supplier', column_name, column_type FROM (DESCRIBE supplier))
WHERE (SELECT COUNT(*) FROM supplier) > 0
""")
def infer_schema_report(spark, sf_dir):
    """Landing folders of three tables (envelope JSON-lines); the table list is
    discovered from the folder names (S15) and each table's payload schema is
    inferred over all of its rows (S13)."""
    t = Tables(spark, sf_dir)
    root = shared_dir(spark, "infer")
    for name in ("nation", "region", "supplier"):
        df = t.read(name)
        key = df.columns[0]
        envelope(df, key, {c: c for c in df.columns}).write.text(f"{root}/landing/{name}")
    files = list_files(spark, f"{root}/landing/*/*").select(
        F.regexp_extract("path", r"/landing/([^/]+)/[^/]+$", 1).alias("table_name"), "path", "length")
    tables = sorted(r.table_name for r in discover_tables(files, ()).collect())
    reports = [infer_envelope_fields(spark, f"{root}/landing/{name}")
               .select(F.lit(name).alias("table_name"), "field", "inferred_type") for name in tables]
    return union_all(reports)
