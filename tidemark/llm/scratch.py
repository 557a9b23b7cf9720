"""Intermediate tables of the operators in this package.

A table written to the cluster's shared folder cuts the lineage: when an
executor is lost, later stages reread files instead of recomputing the scan.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Distinct values of a coarse key; it bounds every broadcast made from one.
COARSE_KEYS = 1 << 20


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder as tasks see it, and the folder's path there."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again."""
    spark: SparkSession = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def coarse_key(col):
    """A key of at most ``COARSE_KEYS`` values for any hashable column."""
    return F.pmod(F.xxhash64(col), F.lit(COARSE_KEYS)).cast("int")


def thinned(df: DataFrame, col: str, wanted: DataFrame, wanted_col: str) -> DataFrame:
    """The rows of ``df`` whose ``col`` may be among ``wanted_col``.

    Only the distinct coarse keys of the wanted values are broadcast: at most
    ``COARSE_KEYS`` integers however large the input is.  Rows that share a
    coarse key by chance pass too, so an exact join has to follow; nothing
    wanted is lost.
    """
    keys = (wanted.where(F.col(wanted_col).isNotNull())
            .select(coarse_key(F.col(wanted_col)).alias("__coarse")).distinct())
    return (df.withColumn("__coarse", coarse_key(F.col(col)))
            .join(F.broadcast(keys), "__coarse", "left_semi").drop("__coarse"))


def sifted(df: DataFrame, col: str, wanted: DataFrame, wanted_col: str, keep: bool = True) -> DataFrame:
    """Like :func:`thinned` with 64 times the keys in as many broadcast rows: each row holds the marks of 64 keys.

    Where millions of values are wanted the keys of ``thinned`` are all taken
    and every row passes.  With ``keep=False`` the rows that are surely not
    wanted: together the two calls give every row of ``df`` once.
    """
    def place(c):
        key = F.pmod(F.xxhash64(c), F.lit(64 * COARSE_KEYS))
        return F.shiftright(key, 6).cast("int").alias("__word"), key.bitwiseAND(63).cast("int").alias("__bit")

    marks = wanted.where(F.col(wanted_col).isNotNull()).select(*place(F.col(wanted_col))) \
        .groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__marks"))
    word, bit = place(F.col(col))
    rows = df.withColumns({"__at": word, "__of": bit})
    return (rows.join(F.broadcast(marks), F.expr("__at = __word and bit_get(__marks, __of) = 1"), "left_semi" if keep else "left_anti")
            .select(*df.columns))


def without(df: DataFrame, col: str, unwanted: DataFrame, unwanted_col: str) -> DataFrame:
    """The rows of ``df`` whose ``col`` is not among ``unwanted_col``.

    Rows whose coarse key no unwanted value has pass without a shuffle; only
    the others are compared exactly.
    """
    keys = (unwanted.where(F.col(unwanted_col).isNotNull())
            .select(coarse_key(F.col(unwanted_col)).alias("__coarse")).distinct())
    clear = (df.withColumn("__coarse", coarse_key(F.col(col)))
             .join(F.broadcast(keys), "__coarse", "left_anti").drop("__coarse"))
    gone = unwanted.select(F.col(unwanted_col).alias("__gone")).distinct()
    rest = thinned(df, col, unwanted, unwanted_col).join(gone, F.col(col) == F.col("__gone"), "left_anti")
    return clear.unionByName(rest)
