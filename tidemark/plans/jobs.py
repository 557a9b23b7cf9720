"""End-to-end jobs: what a scheduled run does, as one call each.

E1  ``daily_landing_load``   landing JSON-lines -> typed day partition
    ``daily_manifest_load``  the same for the files that a listing has for a day
    ``quarantined_load``     the same with a rejects table and a limit for it
    ``hourly_landing_load``  the files whose epoch falls into an hour -> hour partition
    ``delimited_load``       ``|``-delimited feed -> ingestion-date partition
E2  ``mart_run``             one model for one cut-off -> its day partition
    ``mart_backfill``        a model over configured offsets (G6), ``#`` entries skipped
E3  ``control_load``         control files -> control table partition
E5  ``comparison_run``       rows per partition of two environments -> table and CSV

Each job is a single Spark plan ending in a partition replacement, so a rerun
of the same day replaces, never duplicates.
"""

from __future__ import annotations

import datetime as dt
import inspect
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import footer_counts
from tidemark.operators.quality import compare_counts
from tidemark.operators.typed import (Field, add_audit_columns, enforce_required, map_types,
                                      normalise_dictionary, table_fields, typed_projection)
from tidemark.plans import models as M
from tidemark.sinks.load_log import LoadLog
from tidemark.sinks.partitions import export_csv, partition_dir, replace_partition, replace_table
from tidemark.sinks.swap import replace_folder
from tidemark.sources.files import read_control_jda, read_delimited, read_envelope_jsonl
from tidemark.sources.manifest import files_for_day, files_for_hour, nonempty_files
from tidemark.sources.quarantine import REJECT_SCHEMA, split_lines

# name -> (model function, keyword arguments); the 42 SQL models map onto these.
MODELS: dict[str, tuple[Callable[..., DataFrame], dict]] = {
    "accounting_stock_balance": (M.accounting_stock_balance, {}),
    "accounting_stock_balance_parsed": (M.accounting_stock_balance, {"cut": "parsed"}),
    "accounting_stock_balance_compact": (M.accounting_stock_balance, {"cut": "compact"}),
    "sku_snapshot": (M.sku_snapshot, {}),
    "sku_snapshot_shifted": (M.sku_snapshot, {"shifted": True}),
    "stock_balance": (M.stock_balance, {}),
    "stock_balance_shifted": (M.stock_balance, {"shifted": True}),
    "replenishment_profile": (M.replenishment_profile, {}),
    "replenishment_profile_same_day": (M.replenishment_profile, {"eod_shift": 0}),
    "allocate_stock_bychannel": (M.allocate_stock_bychannel, {}),
    "product_master_snapshot": (M.product_master_snapshot, {}),
    "product_warehouse_snapshot": (M.product_warehouse_snapshot, {}),
    "productwarehouse_product_detail": (M.productwarehouse_product_detail, {}),
    "data_vs_ctrl": (M.data_vs_ctrl, {}),                     # M1, with brand=
    "product_detail": (M.product_detail, {}),                 # M14, with detail_cols=
    "product_detail_by_createon": (M.product_detail, {"master_date_col": "createon"}),
    "dim_product_attribute": (M.dim_product_attribute, {}),   # M16-M18 take no cut-off
    "dim_product_attribute_v2": (M.dim_product_attribute_v2, {}),
    "fact_transport_daily": (M.fact_transport_daily, {}),
}


def fields_from_dictionary(dictionary: DataFrame, table: str, header: Sequence[str], order_col: str) -> list[Field]:
    """The typed field list of ``table`` from a dictionary sheet whose
    four columns (table, column, type, nullable) are named ``header`` (the
    names differ per source) and whose rows ``order_col`` numbers."""
    d = normalise_dictionary(dictionary, header, keep=[order_col])
    return table_fields(map_types(d), table, order_col=order_col)


def daily_landing_load(spark: SparkSession, landing: str | Sequence[str], fields: Sequence[Field],
                       report_date: dt.date, run_date: dt.date, table_path: str) -> str:
    """Envelope JSON-lines of one report date -> typed rows with audit
    columns -> the ``report_date`` partition replaced (empty input empties it)."""
    stage = read_envelope_jsonl(spark, landing)
    typed = enforce_required(typed_projection(stage, fields), fields)
    return replace_partition(add_audit_columns(typed, report_date, run_date), table_path,
                             "report_date", report_date)


def _paths(files: DataFrame) -> list[str]:
    """The paths of one table's files of a day or an hour; only they reach the driver."""
    return sorted(r.path for r in files.select("path").collect())


def daily_manifest_load(spark: SparkSession, manifest: DataFrame, table: str, fields: Sequence[Field], report_date: dt.date,
                        run_date: dt.date, table_path: str, log: LoadLog) -> str:
    """E1 from a listing (``parse_data_manifest``): the files whose name starts
    with the report date (S3), without empty ones (S2), become the day's
    partition and are entered in the load log.  Without any file left the load
    is skipped and the partition stays as it is (Q10).  Returns ``load`` or
    ``skip``; a repeated run replaces both the partition and its entry."""
    files = nonempty_files(files_for_day(manifest.filter(F.col("table_name") == table), report_date))
    paths = _paths(files)
    if not paths:
        return "skip"
    daily_landing_load(spark, paths, fields, report_date, run_date, table_path)
    log.record(table, f"day-{report_date.isoformat()}", files)
    return "load"


class TooManyRejects(RuntimeError):
    """A load was given up; the table is as it was, the rejects are written."""


def quarantined_load(spark: SparkSession, landing: str | Sequence[str], fields: Sequence[Field], report_date: dt.date,
                     run_date: dt.date, table_path: str, rejects_path: str, most_rejects: float = 0.01) -> int:
    """E1 with a rejects table (T5): lines that cannot be loaded go to its
    ``report_date`` partition with file and reasons, the others replace the day.
    If more than the share ``most_rejects`` of the lines is rejected, the load
    fails before the day is exchanged.  Returns the number of rejects."""
    rows, rejects = split_lines(spark, landing, fields)
    rejected = spark.read.schema(REJECT_SCHEMA).parquet(replace_partition(rejects, rejects_path, "report_date", report_date)).count()
    audited = add_audit_columns(rows, report_date, run_date).drop("report_date")

    def write(df: DataFrame, path: str) -> None:
        df.write.parquet(path)
        loaded = spark.read.schema(df.schema).parquet(path).count()
        if rejected > most_rejects * (rejected + loaded):
            raise TooManyRejects(f"{rejected} of {rejected + loaded} lines of {report_date} were rejected")

    replace_folder(audited, partition_dir(table_path, "report_date", report_date), write)
    return rejected


def hourly_landing_load(spark: SparkSession, manifest: DataFrame, table: str, fields: Sequence[Field], hour: dt.datetime,
                        run_time: dt.datetime, table_path: str, log: LoadLog) -> str:
    """X1 as one scheduled run: the files whose epoch (UTC) falls into the hour
    (S4), whatever their rows say, replace the ``report_hour`` partition."""
    key = hour.strftime("%Y%m%d%H")
    files = nonempty_files(files_for_hour(manifest.filter(F.col("table_name") == table), key))
    paths = _paths(files)
    if not paths:
        return "skip"
    typed = enforce_required(typed_projection(read_envelope_jsonl(spark, paths), fields), fields)
    replace_partition(add_audit_columns(typed, hour, run_time, grain="hour"), table_path, "report_hour", hour)
    log.record(table, f"hour-{key}", files)
    return "load"


def delimited_load(spark: SparkSession, paths: str | Sequence[str], schema, ingest_date: dt.date,
                   table_path: str, null_marker: str | None = None) -> str:
    """Delimited feed of one ingestion day -> ``_partition_date`` partition."""
    df = read_delimited(spark, paths, schema, null_marker=null_marker)
    return replace_partition(df, table_path, "_partition_date", ingest_date)


def control_load(spark: SparkSession, paths: str | Sequence[str], ingest_date: dt.date,
                 table_path: str) -> str:
    """Control files of one ingestion day -> control table partition."""
    return replace_partition(read_control_jda(spark, paths), table_path, "_partition_date", ingest_date)


def run_model(model: str, inputs: Mapping[str, DataFrame], cutoff: dt.date, **arguments) -> DataFrame:
    """The rows of a configured model; ``arguments`` are those it needs besides
    its inputs (the brand of M1, the columns of M14).  A model without a cut-off
    describes its inputs as they are on the day of the run."""
    fn, fixed = MODELS[model]
    wants_cutoff = {"cutoff": cutoff} if "cutoff" in inspect.signature(fn).parameters else {}
    return fn(inputs, **wants_cutoff, **fixed, **arguments)


def mart_run(model: str, inputs: Mapping[str, DataFrame], cutoff: dt.date, table_path: str, **arguments) -> str:
    """One model for one cut-off, replacing the cut-off's partition.

    The output table is partitioned by run (``_partition_date`` = cut-off);
    rows keep their own ``report_date``.  A downstream model reads one run
    with ``_partition_date = cutoff`` (as M15 reads M13's output)."""
    return replace_partition(run_model(model, inputs, cutoff, **arguments), table_path, "_partition_date", cutoff)


def parse_backfill_config(rows: Sequence[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """G6 configuration: (model, start, end) offsets in days; entries whose
    name starts with ``#`` are switched off."""
    return [(m.strip(), int(s), int(e)) for m, s, e in rows if not m.strip().startswith("#")]


def mart_backfill(config: Sequence[tuple[str, int, int]], inputs: Mapping[str, Mapping[str, DataFrame]],
                  run_date: dt.date, output_root: str) -> dict[str, list[dt.date]]:
    """For each active config entry, run the model for cut-offs
    ``run_date - start`` ... ``run_date - end`` (offsets in either order), oldest
    first, each replacing its own partition of ``<output_root>/<model>``."""
    done: dict[str, list[dt.date]] = {}
    for model, start, end in parse_backfill_config(config):
        cutoffs = [run_date - dt.timedelta(days=o) for o in range(max(start, end), min(start, end) - 1, -1)]
        for c in cutoffs:
            mart_run(model, inputs[model], c, f"{output_root.rstrip('/')}/{model}")
        done[model] = cutoffs
    return done



def comparison_run(spark: SparkSession, dev_path: str, prod_path: str, part_col: str, table_path: str, csv_path: str,
                   from_date: dt.date | None = None) -> DataFrame:
    """Q2 as a run: rows per partition of a table in two environments, counted
    from file footers, replace the comparison table and its CSV export.  The
    export is written from the table, so the two agree."""
    since = None if from_date is None else F.col(part_col) >= F.lit(from_date)
    sides = [footer_counts(spark, path, [part_col], f"count_{env}", since).withColumnRenamed(part_col, f"date_{env}")
             for env, path in (("dev", dev_path), ("prod", prod_path))]
    replace_table(compare_counts(*sides), table_path)
    report = spark.read.parquet(table_path)
    export_csv(report, csv_path)
    return report
