"""Writing delimited files under source-system file names.

Spark cannot choose output file names, so rows are written partitioned by the
target name into a staging folder (one file per name: rows are shuffled on
the name) and each file is then renamed through the Hadoop FileSystem API.
The renames are metadata operations on the driver, the same kind of work a
job commit does; no row passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_dealt_names(df: DataFrame, name_col: str, stem: Column, suffix: str, rows_per_file: int) -> DataFrame:
    """``df`` with file names ``<stem>_<n><suffix>`` that deal each stem's rows over files of
    about ``rows_per_file`` rows, for :func:`write_named_files`, whose tasks take a name each.

    Rows are dealt by the hash of all their columns, so a rerun deals alike;
    equal rows meet in one file.
    """
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_parts"))
    files = df.groupBy(stem.alias("_stem")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_parts"))
    return (df.withColumn("_stem", stem).join(files, "_stem")
            .withColumn(name_col, F.concat("_stem", F.lit("_"), dealt.cast("string"), F.lit(suffix)))
            .drop("_stem", "_parts"))


def write_named_files(df: DataFrame, out_dir: str, name_col: str, cols: Sequence[str],
                      sep: str = "|", header: bool = True) -> list[str]:
    """Write ``cols`` of ``df`` to ``<out_dir>/<name>`` for each value of
    ``name_col`` (which may contain sub-folders).  Returns the written paths."""
    staging = f"{out_dir.rstrip('/')}/_staging"
    (df.select(*[F.col(c).cast("string") for c in cols], name_col)
       .repartition(name_col)
       .write.mode("overwrite").option("sep", sep).option("header", header)
       .option("compression", "none").option("maxRecordsPerFile", 0).partitionBy(name_col).csv(staging))
    return _named(df, staging, out_dir, name_col)


def write_named_lines(df: DataFrame, out_dir: str, name_col: str, line_col: str) -> list[str]:
    """The same for lines of text that are ready, such as JSON."""
    staging = f"{out_dir.rstrip('/')}/_staging"
    (df.select(line_col, name_col).repartition(name_col)
       .write.mode("overwrite").option("compression", "none").option("maxRecordsPerFile", 0).partitionBy(name_col).text(staging))
    return _named(df, staging, out_dir, name_col)


def _named(df: DataFrame, staging: str, out_dir: str, name_col: str) -> list[str]:
    """Move each name's only part file to its place."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    root = Path(staging)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    written = []
    for st in fs.listStatus(root):
        d = st.getPath()
        if not st.isDirectory() or not d.getName().startswith(name_col + "="):
            continue
        name = unquote(d.getName()[len(name_col) + 1:])
        parts = [s.getPath() for s in fs.listStatus(d) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:  # a second part would have a name that no reader's pattern matches
            raise RuntimeError(f"{name}: {len(parts)} parts, one file expected")
        target = Path(f"{out_dir.rstrip('/')}/{name}")
        fs.mkdirs(target.getParent())
        fs.rename(parts[0], target)
        written.append(target.toString())
    fs.delete(root, True)
    return written
