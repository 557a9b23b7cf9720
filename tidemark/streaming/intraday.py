"""Intraday ingestion on Structured Streaming.

X1.  The original job runs every 30 minutes, re-lists the files of the run's
hour and replaces that hour's partition.  Here a stream of file names runs with
``trigger(availableNow=True)`` on the same cadence; ``foreachBatch`` finds the
hours of the new files by the epoch in their names, lists those hours' days and
rebuilds each hour from *all* its landed files, then replaces only those hour
partitions.  Rebuilding (not appending the micro-batch) keeps the write
idempotent: a re-run or a retried batch produces the same partition.
``intraday_ingest`` does the same by a column of the rows instead.

X3.  Files per (hour, table) as keyed state over the stream of file names: a
name is counted once, under its own epoch, and never expires, so neither late
files nor the files per batch change a count.  ``hourly_counts`` counts rows by
recounting the touched days.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import temporal as tf
from tidemark.operators.typed import Field, enforce_required, typed_projection
from tidemark.sinks.load_log import LoadLog
from tidemark.sinks.partitions import replace_partitions
from tidemark.sources.files import ENVELOPE_SCHEMA, read_envelope_jsonl
from tidemark.sources.manifest import decoded_path, file_hour, list_files, nonempty_files, parse_data_manifest

HOUR_FMT = "yyyyMMddHH"
#: Schema of the source of file names; only path and length are read.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: Files of any age are taken, however much newer the newest one is.
_ANY_AGE = "36500d"


def envelope_stream(spark: SparkSession, landing_glob: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming read of landing JSON-lines (schema declared, FAILFAST parse)."""
    return (spark.readStream.schema(ENVELOPE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("mode", "FAILFAST")
            .json(landing_glob)
            .withColumn("_airbyte_data", F.transform_keys("_airbyte_data", lambda k, v: F.lower(k))))


def rebuild_hours_batch(read_hours: Callable[[list[str]], DataFrame], hour_of: Column,
                        table_path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for X1.

    ``hour_of`` maps a typed row to its ``yyyyMMddHH`` hour; ``read_hours``
    returns typed rows of every landed file that can hold the given hours and
    should read only those files: with epoch-stamped file names that is
    ``sources.manifest.files_for_hour`` over the landing manifest (exactly the
    hour's files); with day folders it is the folders of the hours' days.  The hour keys
    of a micro-batch -- one or two per 30-minute run, at most a few hundred in
    a catch-up -- are the only values brought to the driver.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        # rows without a time belong to no hour
        hours = sorted(r[0] for r in batch.select(hour_of.alias("h")).where("h is not null").distinct().collect())
        if not hours:
            return
        rebuilt = (read_hours(hours).withColumn("report_hour", hour_of)
                   .filter(F.col("report_hour").isin(hours)))
        replace_partitions(rebuilt, table_path, ["report_hour"])

    return run


def intraday_ingest(spark: SparkSession, landing_glob: str, typed: Callable[[DataFrame], DataFrame],
                    read_hours: Callable[[list[str]], DataFrame], hour_of: Column,
                    table_path: str, checkpoint: str) -> None:
    """One scheduled run of X1: process every file landed since the last run."""
    q = (typed(envelope_stream(spark, landing_glob)).writeStream
         .foreachBatch(rebuild_hours_batch(read_hours, hour_of, table_path))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def recount_days_batch(read_days: Callable[[list[str]], DataFrame], ts_col: str, table_col: str,
                       table_path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for X3.

    ``read_days`` returns typed rows of every landed file that can hold the
    given ``yyyy-MM-dd`` days.  Only the day keys of a micro-batch are brought
    to the driver.  A retried batch recounts the same days."""
    day = F.date_format(ts_col, "yyyy-MM-dd")

    def run(batch: DataFrame, epoch_id: int) -> None:
        days = sorted(r[0] for r in batch.where(F.col(ts_col).isNotNull()).select(day.alias("d")).distinct().collect())
        if not days:
            return
        counts = (read_days(days).filter(day.isin(days))
                  .groupBy(F.date_format(ts_col, HOUR_FMT).alias("report_hour"), F.col(table_col).alias("table_name"))
                  .agg(F.count(F.lit(1)).alias("n_files")))
        replace_partitions(counts.withColumn("report_day", F.to_date("report_hour", HOUR_FMT)), table_path, ["report_day"])

    return run


def hourly_counts_view(spark: SparkSession, table_path: str) -> DataFrame:
    """Current count per (hour, table)."""
    return spark.read.parquet(table_path)


def hourly_counts(spark: SparkSession, landing_glob: str, typed: Callable[[DataFrame], DataFrame],
                  ts_col: str, table_col: str, table_path: str, checkpoint: str,
                  read_days: Callable[[list[str]], DataFrame] | None = None,
                  max_files_per_trigger: int = 1000) -> None:
    """Count of landed rows per (hour, table), for every file landed so far.

    ``read_days`` should read only the files that can hold the given days (see
    ``rebuild_hours_batch``); without it every landed file is read again for
    each micro-batch.  ``max_files_per_trigger`` bounds the work of a batch;
    the result does not depend on it."""
    def read_all(days: list[str]) -> DataFrame:
        return typed(read_envelope_jsonl(spark, [landing_glob]))

    q = (typed(envelope_stream(spark, landing_glob, max_files_per_trigger)).writeStream
         .foreachBatch(recount_days_batch(read_days or read_all, ts_col, table_col, table_path))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


# --- by file names ---

def file_stream(spark: SparkSession, landing_glob: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Manifest rows (``parse_data_manifest``) of landed files, each once; contents are not read."""
    files = (spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", max_files_per_trigger)
             .option("maxFileAge", _ANY_AGE).load(landing_glob).select("path", "length"))
    return parse_data_manifest(files)


def rebuild_file_hours_batch(spark: SparkSession, landing: str, table: str, fields: Sequence[Field], table_path: str,
                             log: LoadLog) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of :func:`intraday_file_ingest`.

    Only the hours of a micro-batch and the paths of those hours' files reach
    the driver; of the landing area, the names of those hours' days are listed.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        hours = sorted(r[0] for r in batch.filter(F.col("table_name") == table).select(file_hour(batch).alias("h")).distinct().collect())
        if not hours:
            return
        # a file's hour is that of its epoch, the date in its name may be another
        days = [r[0] for r in batch.filter(file_hour(batch).isin(hours)).select("file_date").distinct().collect()]
        days = sorted({f"{d:%Y_%m_%d}" for d in days} | {f"{h[:4]}_{h[4:6]}_{h[6:8]}" for h in hours})
        listed = parse_data_manifest(list_files(spark, _existing(spark, [f"{landing}/{table}/{d}_*" for d in days])))
        files = nonempty_files(listed.filter(file_hour(listed).isin(hours)))
        paths = sorted(r.path for r in files.select("path").collect())
        stage = read_envelope_jsonl(spark, paths).withColumn("__path", decoded_path(F.col("_metadata.file_path")))
        epoch = F.element_at(F.split(F.regexp_extract("__path", r"([^/]+)\.jsonl$", 1), "_"), 4).cast("bigint")
        rows = typed_projection(stage, fields, extra=[F.date_format(tf.epoch_ms_to_utc(epoch), HOUR_FMT).alias("report_hour")])
        replace_partitions(enforce_required(rows, fields), table_path, ["report_hour"])
        log.record_runs(files.withColumn("run", F.concat(F.lit("hour-"), file_hour(files))))

    return run


def _existing(spark: SparkSession, globs: list[str]) -> list[str]:
    """The patterns that match something: a reader raises for one that does not."""
    jvm = spark.sparkContext._jvm
    found = []
    for glob in globs:
        path = jvm.org.apache.hadoop.fs.Path(glob)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path):
            found.append(glob)
    return found


def intraday_file_ingest(spark: SparkSession, landing: str, table: str, fields: Sequence[Field], table_path: str,
                         checkpoint: str, log: LoadLog, max_files_per_trigger: int = 1000) -> None:
    """One scheduled run over ``<landing>/<table>/<date>_<epoch>_<n>.jsonl``.

    Every file that landed since the last run is entered in the load log with
    its hour.  Values of the rows decide nothing: a row without a time stays in
    its file's hour."""
    q = (file_stream(spark, f"{landing}/{table}/*", max_files_per_trigger).writeStream
         .foreachBatch(rebuild_file_hours_batch(spark, landing, table, fields, table_path, log))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def overlay_counts_batch(table_path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of :func:`hourly_file_counts`: changed counts over the stored ones, by day.

    Counts are absolute, so a retried batch writes the same."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.withColumn("report_day", F.to_date("report_hour", HOUR_FMT))
        days = [r[0] for r in changed.select("report_day").distinct().collect()]
        if not days:
            return
        try:
            held = spark.read.schema("report_hour string, table_name string, n_files bigint, report_day date") \
                .parquet(table_path).filter(F.col("report_day").isin(days))
        except AnalysisException as e:  # nothing has been counted yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            changed = changed.unionByName(held.join(batch, ["report_hour", "table_name"], "left_anti"))
        replace_partitions(changed, table_path, ["report_day"])

    return run


def hourly_file_counts(spark: SparkSession, landing_glob: str, table_path: str, checkpoint: str,
                       max_files_per_trigger: int = 1000) -> None:
    """Number of landed files per (hour of their epoch, table).

    The state is one number per (hour, table); there is no watermark that late
    files could fall behind.  A replay from a fresh checkpoint over the same
    table ends with the same counts."""
    files = file_stream(spark, landing_glob, max_files_per_trigger)
    counts = files.groupBy(file_hour(files).alias("report_hour"), "table_name").agg(F.count(F.lit(1)).alias("n_files"))
    q = (counts.writeStream.outputMode("update").foreachBatch(overlay_counts_batch(table_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
