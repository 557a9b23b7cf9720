"""Landed-file checks (Q5-Q10, S1-S4, S10, S15, A7, O2) over a manifest.

The manifest is derived from ``events``: every event is one landed JSON-lines
file of its event type, stamped with the event time; its size is
``floor(value) * 100`` bytes, so events below 1.0 are zero-byte files.
Control files are derived the same way.  The checks then run exactly as on a
real listing (``tidemark.sources.manifest.list_files``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.functions import temporal as tf
from tidemark.operators.quality import (daily_file_summary, empty_files, expected_pairs, intraday_shortfall,
                                        missing_control_files, missing_daily_files,
                                        no_load_decision, smallest_nonempty_file,
                                        unprocessed_files)
from tidemark.plans.registry import query
from tidemark.sources.manifest import (discover_tables, file_hour, nonempty_files,
                                       parse_control_manifest, parse_data_manifest)

# Configuration of the stand-in landing zone.
EXPECTED_TABLES = ("signup", "error", "click", "view", "purchase", "refund")
DAILY_FILE_TOTALS = {"signup": 48, "error": 48, "click": 96, "view": 96, "purchase": 24,
                     "refund": 48}
LAST_LOAD_HOUR_UTC = 22


def landed_files(t: Tables, folder=None):
    """(path, length) of the synthetic landing zone."""
    ev = t.events
    folder = F.col("event_type") if folder is None else folder
    name = F.concat(F.date_format("ts", "yyyy_MM_dd"), F.lit("_"),
                    tf.utc_to_epoch_ms(F.col("ts")).cast("string"), F.lit("_"),
                    F.col("event_id").cast("string"), F.lit(".jsonl"))
    return ev.select(F.concat(F.lit("landing/"), folder, F.lit("/"), name).alias("path"),
                     (F.floor("value").cast("bigint") * 100).alias("length"))


def run_dates(files):
    """Every day of the landing zone's time span, also those on which nothing landed."""
    span = files.agg(F.min("file_date").alias("first"), F.max("file_date").alias("last"))
    return span.filter("first is not null").select(F.explode(F.sequence("first", "last")).alias("run_date"))


def landed_manifest(t: Tables):
    return parse_data_manifest(landed_files(t))


def control_files(t: Tables):
    """One ``src_<table>_<epoch s>.ctrl`` per (type, day) whose first event has
    value >= 5; other days have no control file."""
    ev = t.events.withColumn("d", F.to_date("ts"))
    first = ev.groupBy("event_type", "d").agg(F.min_by("value", "ts").alias("v"),
                                              F.min("ts").alias("first_ts"))
    return (first.filter(F.col("v") >= 5)
            .select(F.concat(F.lit("ctrl/src_"), F.col("event_type"), F.lit("_"),
                             F.floor(tf.utc_to_epoch_ms(F.col("first_ts")) / 1000).cast("string"),
                             F.lit(".ctrl")).alias("path"),
                    F.lit(120).cast("bigint").alias("length")))


_MANIFEST_SQL = """
WITH m AS (
  SELECT event_type AS table_name,
         'landing/' || event_type || '/' || strftime(ts, '%Y_%m_%d') || '_' ||
           CAST(epoch_us(ts) // 1000 AS VARCHAR) || '_' || CAST(event_id AS VARCHAR) || '.jsonl' AS path,
         CAST(floor(value) AS BIGINT) * 100 AS length,
         CAST(ts AS DATE) AS file_date, ts
  FROM events),
dates AS (SELECT CAST(unnest(generate_series(min(file_date), max(file_date), INTERVAL 1 DAY)) AS DATE) AS run_date FROM m),
expected AS (
  SELECT t.table_name, d.run_date FROM dates d,
    (VALUES ('signup'), ('error'), ('click'), ('view'), ('purchase'), ('refund')) t(table_name))
"""


@query("missing_files", ("Q5", "S1", "S2", "S3"), oracle=_MANIFEST_SQL + """
SELECT e.table_name, e.run_date,
       e.table_name || '/' || strftime(e.run_date, '%Y_%m_%d') || '_*.jsonl' AS expected_pattern
FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.table_name = e.table_name AND m.file_date = e.run_date)
""")
def missing_files(spark, sf_dir):
    summary = daily_file_summary(landed_manifest(Tables(spark, sf_dir)))
    return missing_daily_files(summary, expected_pairs(run_dates(summary), EXPECTED_TABLES))


@query("control_missing", ("Q6", "S10", "J12"), oracle=_MANIFEST_SQL + """
, first AS (
  SELECT event_type AS table_name, CAST(ts AS DATE) AS ctrl_date, arg_min(value, ts) AS v
  FROM events GROUP BY 1, 2)
SELECT e.table_name, e.run_date FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.v >= 5 AND f.table_name = e.table_name
                                        AND f.ctrl_date = e.run_date)
""")
def control_missing(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ctrl = parse_control_manifest(control_files(t), "src")
    dates = run_dates(landed_manifest(t))
    return missing_control_files(ctrl, expected_pairs(dates, EXPECTED_TABLES))


@query("empty_files", ("Q8", "S1"), oracle=_MANIFEST_SQL + """
SELECT table_name, path, length, file_date FROM m WHERE length = 0
""")
def empty_files_query(spark, sf_dir):
    return empty_files(landed_manifest(Tables(spark, sf_dir))).select(
        "table_name", "path", "length", "file_date")


@query("unprocessed_files", ("Q9", "J12"), oracle=_MANIFEST_SQL + """
SELECT table_name, path, file_date FROM m
WHERE path NOT IN (SELECT path FROM m WHERE length > 0 AND hour(ts) < 22)
""")
def unprocessed_files_query(spark, sf_dir):
    m = landed_manifest(Tables(spark, sf_dir))
    hour = F.hour(tf.epoch_ms_to_utc(F.col("file_epoch_ms")))
    load_log = nonempty_files(m).filter(hour < LAST_LOAD_HOUR_UTC).select("path")
    return unprocessed_files(m, load_log).select("table_name", "path", "file_date")


@query("intraday_shortfall", ("Q7", "A7", "S4", "T17"), oracle=_MANIFEST_SQL + """
, hourly AS (SELECT table_name, CAST(ts AS DATE) AS run_date, CAST(hour(ts) AS INTEGER) AS run_hour,
                    COUNT(*) AS n FROM m GROUP BY ALL),
totals AS (SELECT * FROM (VALUES ('signup', 48), ('error', 48), ('click', 96), ('view', 96),
                                 ('purchase', 24), ('refund', 48)) v(table_name, total)),
grid AS (SELECT table_name, run_date, CAST(h AS INTEGER) AS run_hour FROM totals, dates, range(0, 24) r(h)),
cum AS (SELECT g.table_name, g.run_date, g.run_hour,
               SUM(COALESCE(h.n, 0)) OVER (PARTITION BY g.table_name, g.run_date ORDER BY g.run_hour
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS found
        FROM grid g LEFT JOIN hourly h USING (table_name, run_date, run_hour))
SELECT c.table_name, c.run_date, c.run_hour, CAST(c.found AS BIGINT) AS found,
       CAST(floor(t.total / 24) AS BIGINT) * (c.run_hour + 1) AS expected
FROM cum c JOIN totals t USING (table_name)
WHERE c.found < CAST(floor(t.total / 24) AS BIGINT) * (c.run_hour + 1)
""")
def intraday_shortfall_query(spark, sf_dir):
    m = landed_manifest(Tables(spark, sf_dir))
    return intraday_shortfall(m, DAILY_FILE_TOTALS, run_dates(m))


@query("files_per_run_hour", ("S4", "A7"), oracle=_MANIFEST_SQL + """
SELECT table_name, strftime(ts, '%Y%m%d%H') AS run_hour_key, COUNT(*) AS n_files,
       CAST(SUM(length) AS BIGINT) AS total_bytes
FROM m GROUP BY 1, 2
""")
def files_per_run_hour(spark, sf_dir):
    m = landed_manifest(Tables(spark, sf_dir))
    return m.groupBy("table_name", file_hour(m).alias("run_hour_key")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"))


@query("smallest_file", ("O2", "S13"), oracle=_MANIFEST_SQL + """
SELECT table_name, file_date, path, length FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, file_date ORDER BY length, path) AS r
  FROM m WHERE length > 0) WHERE r = 1
""")
def smallest_file(spark, sf_dir):
    return smallest_nonempty_file(landed_manifest(Tables(spark, sf_dir))).select(
        "table_name", "file_date", "path", "length")


@query("skip_decision", ("Q10", "S2"), oracle=_MANIFEST_SQL + """
SELECT table_name, strftime(ts, '%Y%m%d%H') AS file_date, COUNT(*) AS n_files, 'skip' AS decision
FROM m GROUP BY 1, 2 HAVING SUM(CASE WHEN length > 0 THEN 1 ELSE 0 END) = 0
""")
def skip_decision(spark, sf_dir):
    """Per intraday run (table, UTC hour): every landed file empty -> skip."""
    m = landed_manifest(Tables(spark, sf_dir))
    return no_load_decision(m.withColumn("file_date", file_hour(m)))


@query("discover_tables", ("S15",), oracle="""
SELECT DISTINCT CASE event_type WHEN 'purchase' THEN 'ERP_purchase'
                                WHEN 'error' THEN 'side_error'
                                ELSE event_type END AS table_name
FROM events
WHERE event_type NOT IN ('purchase', 'error')
""")
def discover_tables_query(spark, sf_dir):
    folder = (F.when(F.col("event_type") == "purchase", F.lit("ERP_purchase"))
               .when(F.col("event_type") == "error", F.lit("side_error"))
               .otherwise(F.col("event_type")))
    m = parse_data_manifest(landed_files(Tables(spark, sf_dir), folder))
    return discover_tables(m, ("erp_", "side_"))

