"""The ledger of loaded files.

Each load writes the files that it took (path, length) under its table and run
name, after its rows are in place.  A run that is repeated replaces its own
entry, so a replay never lists a file twice; a run that fails before its rows
are in place leaves no entry.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.partitions import partition_dir, replace_partitions
from tidemark.sinks.swap import replace_folder

LOG_SCHEMA = "path string, length bigint, table_name string, run string"


class LoadLog:
    """Entries under ``<root>/table_name=<table>/run=<run>/``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def record(self, table: str, run: str, files: DataFrame) -> None:
        """``files``: path, length of what the run loaded."""
        folder = partition_dir(self.root, "table_name", table)
        replace_folder(files.select("path", F.col("length").cast("bigint").alias("length")), partition_dir(folder, "run", run))

    def record_runs(self, files: DataFrame) -> None:
        """``files``: path, length, table_name, run; every run among them replaces its entry, in one job."""
        replace_partitions(files.select("path", F.col("length").cast("bigint").alias("length"), "table_name", "run"),
                           self.root, ["table_name", "run"])

    def entries(self) -> DataFrame:
        """path, length, table_name, run; a file that several runs took is listed by each."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self.root)
        except AnalysisException as e:  # nothing has been loaded yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)
