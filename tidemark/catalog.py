"""Access to the input tables of a scale-factor directory.

Each table is one parquet file/dir ``<sf_dir>/<name>.parquet``.  Reads are lazy,
so column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy accessor: ``Tables(spark, d).orders`` is a parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)
