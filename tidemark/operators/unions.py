"""UNION ALL of aligned inputs (U1, U2) and wildcard table sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; every input must expose the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def aligned(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Project ``df`` onto the output column list ``{name: expression}``.

    This is how a positional ``UNION ALL`` branch is written here: each branch
    names its expressions (and casts) for the shared output columns, and the
    branches are then combined by name, so a reordered source cannot shift
    values into the wrong column.
    """
    return df.select(*[(F.col(e) if isinstance(e, str) else e).alias(n)
                       for n, e in columns.items()])


def table_set(frames: Mapping[str, DataFrame], suffix_col: str = "table_name") -> DataFrame:
    """A wildcard table set.  Tables are stacked by name (missing columns
    become NULL) and each row carries its table suffix, like ``_TABLE_SUFFIX``."""
    tagged = [df.withColumn(suffix_col, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
