"""Landing runs on real files (X1, X3, E1): events landed as JSON-lines envelope
files named by date, epoch and number, loaded by the intraday and daily jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.functions import temporal as tf
from tidemark.operators.quality import empty_files, unprocessed_files
from tidemark.plans.jobs import daily_manifest_load, quarantined_load
from tidemark.plans.loads import envelope, fields_of, iso_text
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sinks.files import write_named_lines
from tidemark.sinks.load_log import LoadLog
from tidemark.sources.manifest import files_from_inventory, folder_name, list_files, parse_data_manifest
from tidemark.streaming.intraday import hourly_counts_view, hourly_file_counts, intraday_file_ingest


#: Landed files that a micro-batch of X3 takes.
FILES_PER_BATCH = 100


def _lines(events: DataFrame, name) -> DataFrame:
    """Event rows as envelope lines, each with the name of its file."""
    payload = {"event_id": F.col("event_id").cast("string"), "ts": iso_text("ts", 6),
               "user_id": "user_id", "event_type": "event_type", "value": "value"}
    return envelope(events.withColumn("name", name), "event_id", payload, keep=["name"])


def _name(folder, day, epoch_ms, number):
    return F.concat(folder, F.lit("/"), F.date_format(day, "yyyy_MM_dd"), F.lit("_"), epoch_ms.cast("string"), F.lit("_"),
                    number.cast("string"), F.lit(".jsonl"))


def _blocks(events: DataFrame) -> DataFrame:
    """Events with the name of a file per (type, third of a day, number of two), stamped with its first event."""
    parts = ["event_type", "day", "third", "number"]
    rows = events.withColumn("day", F.to_date("ts")).withColumn("third", F.floor(F.hour("ts") / 8)) \
        .withColumn("number", F.col("event_id") % 2)
    first = rows.groupBy(*parts).agg(F.min("ts").alias("first"))
    return rows.join(first, parts).withColumn("name", _name(F.col("event_type"), F.col("day"), tf.utc_to_epoch_ms(F.col("first")), F.col("number")))


@query("intraday_stream_hours", ("X1", "K2", "S4", "S5"), oracle="""
SELECT strftime(ts, '%Y%m%d%H') AS report_hour, COUNT(*) AS n_rows,
       round(SUM(value), 2) AS total_value, COUNT(DISTINCT event_type = 'purchase' AND ts >= (SELECT date_trunc('day', max(ts)) - INTERVAL 1 DAY FROM events)) AS n_files
FROM events GROUP BY 1
""")
def intraday_stream_hours(spark, sf_dir):
    """Two scheduled runs over a file per hour; the second sees late files (the
    purchases of the last two days) for hours the first run already loaded, and
    those hours are rebuilt with every row.  ``n_files``: files in the load log."""
    ev = Tables(spark, sf_dir).events
    root = shared_dir(spark, "intraday")
    landing, table, log = f"{root}/landing", f"{root}/events_hourly", LoadLog(spark, f"{root}/load_log")
    fields = fields_of(spark, "events")
    # one aggregated scalar: the newest event day
    last_day = ev.agg(F.max(F.to_date("ts"))).first()[0]
    late = (F.col("event_type") == "purchase") & (F.to_date("ts") >= F.lit(last_day - dt.timedelta(days=1)))
    hour = F.date_trunc("hour", "ts")
    for number, some in enumerate((~late, late)):
        name = _name(F.lit("events"), F.to_date("ts"), tf.utc_to_epoch_ms(hour.cast("timestamp_ntz")), F.lit(number))
        write_named_lines(_lines(ev.filter(some), name), landing, "name", "value")
        intraday_file_ingest(spark, landing, "events", fields, table, f"{root}/_checkpoint", log)
    back = spark.read.parquet(table).groupBy(F.col("report_hour").cast("string").alias("report_hour")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total_value"))
    logged = log.entries().groupBy(F.substring("run", 6, 10).alias("report_hour")).agg(F.count(F.lit(1)).alias("n_files"))
    return back.join(logged, "report_hour", "left")


@query("hourly_counts_stream", ("X3", "A7"), oracle="""
WITH f AS (SELECT event_type AS table_name, min(ts) AS first
           FROM events GROUP BY event_type, CAST(ts AS DATE), hour(ts) // 8, event_id % 2)
SELECT strftime(first, '%Y%m%d%H') AS report_hour, table_name, COUNT(*) AS n_files FROM f GROUP BY 1, 2
""")
def hourly_counts_stream(spark, sf_dir):
    """Files of the landing area by the hour of their epoch, in batches of
    ``FILES_PER_BATCH``; a second run sees those of the first type, which come late."""
    ev = _blocks(Tables(spark, sf_dir).events)
    root = shared_dir(spark, "hourly")
    landing, table = f"{root}/landing", f"{root}/counts"
    for late in (False, True):
        write_named_lines(_lines(ev.filter((F.col("event_type") == "click") == late), F.col("name")), landing, "name", "value")
        hourly_file_counts(spark, f"{landing}/*", table, f"{root}/_checkpoint", FILES_PER_BATCH)
    return hourly_counts_view(spark, table).select(F.col("report_hour").cast("string").alias("report_hour"), "table_name", "n_files")


#: Tables and days that the landing runs load; the others stay unprocessed.
DAILY_TABLES, EMPTY_TABLE, N_DAYS = ("click", "view", "error"), "error", 2


@query("daily_landing_runs", ("S1", "S2", "S3", "Q8", "Q9", "Q10", "D5", "K1"), oracle="""
WITH f AS (SELECT event_type AS table_name, CAST(ts AS DATE) AS file_date, COUNT(*) AS n_rows, round(SUM(value), 2) AS total_value,
                  COUNT(DISTINCT hour(ts) // 8 * 2 + event_id % 2) AS n_files
           FROM events GROUP BY 1, 2),
d AS (SELECT *, table_name IN ('click', 'view') AND file_date < (SELECT min(file_date) FROM f) + INTERVAL 2 DAY AS loaded FROM f)
SELECT table_name, file_date, n_files, CASE WHEN table_name = 'error' THEN n_files ELSE 0 END AS n_empty,
       CASE WHEN loaded THEN 0 ELSE n_files END AS n_unprocessed,
       CASE WHEN loaded THEN n_rows END AS n_rows, CASE WHEN loaded THEN total_value END AS total_value
FROM d
""")
def daily_landing_runs(spark, sf_dir):
    """Daily loads from a listing that holds empty files too (the table
    ``error`` lands only such), each entered in the load log, one of them
    repeated; what the log does not have is unprocessed."""
    ev = Tables(spark, sf_dir).events
    root = shared_dir(spark, "daily")
    write_named_lines(_lines(_blocks(ev), F.col("name")), f"{root}/landing", "name", "value")
    # the store's inventory report: a table of the listing, written once
    size = F.when(folder_name(F.col("path")) == EMPTY_TABLE, 0).otherwise(F.col("length"))
    list_files(spark, f"{root}/landing/*/*").select("path", size.alias("size")).coalesce(8).write.parquet(f"{root}/inventory")
    manifest = parse_data_manifest(files_from_inventory(spark.read.parquet(f"{root}/inventory"), "path", "size"))
    log, fields = LoadLog(spark, f"{root}/load_log"), fields_of(spark, "events")
    first_day = ev.agg(F.min(F.to_date("ts"))).first()[0]
    loaded = None
    for table in DAILY_TABLES if first_day is not None else ():
        days = [first_day + dt.timedelta(days=d) for d in (*range(N_DAYS), 0)]
        done = [daily_manifest_load(spark, manifest, table, fields, day, day + dt.timedelta(days=1), f"{root}/loaded/{table}", log)
                for day in days]
        if "load" in done:
            rows = spark.read.parquet(f"{root}/loaded/{table}").select("event_type", "value", "report_date")
            loaded = rows if loaded is None else loaded.unionByName(rows)
    if loaded is None:
        loaded = spark.createDataFrame([], "event_type string, value double, report_date date")
    keys = ["table_name", "file_date"]
    count = lambda files, name: files.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    out = count(manifest, "n_files").join(count(empty_files(manifest), "n_empty"), keys, "left") \
        .join(count(unprocessed_files(manifest, log.entries()), "n_unprocessed"), keys, "left").na.fill(0)
    rows = loaded.groupBy(F.col("event_type").alias("table_name"), F.col("report_date").alias("file_date")) \
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total_value"))
    return out.join(rows, keys, "left")


@query("quarantine_load", ("T5", "S5", "D3", "D7"), oracle="""
WITH e AS (SELECT *, CASE event_id % 100 WHEN 1 THEN 'malformed' WHEN 2 THEN 'user_id: not INT64' WHEN 3 THEN 'ts: required'
                     WHEN 4 THEN 'ts: not DATETIME,value: not FLOAT64' ELSE '' END AS reasons FROM events)
SELECT event_type, reasons, COUNT(*) AS n_rows, round(SUM(CASE WHEN reasons = '' THEN value END), 2) AS total_value
FROM (SELECT CASE WHEN reasons = '' THEN event_type END AS event_type, reasons, value FROM e) GROUP BY 1, 2
""")
def quarantine_load(spark, sf_dir):
    """Four of a hundred landed lines are bad in one way or another: they end
    in the rejects table, the other rows in the day's partition."""
    ev = Tables(spark, sf_dir).events
    root = shared_dir(spark, "quarantine")
    bad = F.col("event_id") % 100
    ts = F.when(bad == 3, F.lit(None)).when(bad == 4, F.lit("yesterday")).otherwise(iso_text("ts", 6))
    payload = {"event_id": F.col("event_id").cast("string"), "ts": ts, "event_type": "event_type",
               "user_id": F.when(bad == 2, F.lit("1e")).otherwise(F.col("user_id").cast("string")),
               "value": F.when(bad == 4, F.lit("1,5")).otherwise(F.col("value").cast("string"))}
    lines = envelope(ev, "event_id", payload, keep=["event_id"])
    cut = F.when(bad == 1, F.expr("left(value, length(value) - 9)")).otherwise(F.col("value"))
    lines.select(cut.alias("value")).write.text(f"{root}/landing")
    day = dt.date(2024, 1, 31)
    quarantined_load(spark, f"{root}/landing", fields_of(spark, "events"), day, day, f"{root}/table", f"{root}/rejects", 0.1)
    loaded = spark.read.parquet(f"{root}/table").groupBy("event_type", F.lit("").alias("reasons")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 2).alias("total_value"))
    rejects = spark.read.parquet(f"{root}/rejects").groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n_rows"))
    return loaded.unionByName(rejects.select(F.lit(None).cast("string").alias("event_type"), "reasons", "n_rows",
                                             F.lit(None).cast("double").alias("total_value")))
