"""Join helpers for the enrichment models.

Broadcast policy.  A side is broadcast only after a check proves it small:
inputs whose estimated size is large are rejected without running anything,
and the rest are counted exactly with ``limit(max_rows + 1).count()``.  When
the bound does not hold the plan keeps a shuffle join (sort-merge, with AQE
skew splitting).
Everything else is left to AQE, which re-plans a join as broadcast only from
measured shuffle sizes.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row bound under which a dimension may be broadcast.  A few hundred thousand
# narrow rows is a few MB per executor.
DEFAULT_BROADCAST_ROWS = 200_000


# Inputs whose optimizer size estimate exceeds this are not probed at all: a
# probe would still schedule one task per input split.
MAX_PROBE_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (planning only, no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_probe_bytes: int = MAX_PROBE_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Two steps: the optimizer's estimate rules out large inputs without running
    anything; small ones are then counted exactly with a bounded probe
    (``limit(max_rows + 1).count()``), so the decision never rests on an
    estimate alone."""
    if estimated_bytes(df) > max_probe_bytes:
        return False
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_probe_bytes: int = MAX_PROBE_BYTES) -> DataFrame:
    """``broadcast(df)`` when the bounded probe passes, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_probe_bytes) else df


def broadcast_reduced(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """:func:`maybe_broadcast` for a side that an aggregate, a DISTINCT or a rank may have made small.

    The optimizer's estimate of such a side is about that of its input, so it
    is always counted (up to the bound): one more scan of the columns it needs,
    against a shuffle of the whole other side, on keys of few values too.
    """
    return maybe_broadcast(df, max_rows, sys.maxsize)


def left_join(left: DataFrame, right: DataFrame, on, *, right_filter: Column | None = None,
              small: bool = False, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left outer join.

    ``right_filter`` is a predicate on the right side that the SQL model puts in
    the ON clause (J3, ``F.PositionID = '3'``).  For a left join that is the
    same as filtering the right side first, which also lets it reach the scan.
    ``small=True`` asks for the checked broadcast of the right side.
    """
    if right_filter is not None:
        right = right.filter(right_filter)
    if small:
        right = maybe_broadcast(right, max_rows)
    return left.join(right, on, "left")


def left_join_many(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` when ``right`` holds many -- and
    possibly skewed -- rows per key (J8).

    In an outer join AQE may split only the preserved side, so a key holding a
    third of ``right`` would land in one task.  Written as the inner join
    (either side splittable, or ``left`` broadcast) plus the ``left`` rows
    without partner (anti join against the distinct keys of ``right``, a
    partial aggregate), the result is the same rows with no unsplittable
    partition.
    """
    matched = left.join(right, list(keys), "inner")
    missing = left.join(right.select(*keys).distinct(), list(keys), "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Project ``cols`` (default: all) renamed ``<prefix><col>``: one role of a
    table joined several times (J5: employees as INF, INH, M1)."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J12 membership: rows of ``left`` with a partner in ``right``."""
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J12 expected-minus-found: rows of ``left`` without a partner."""
    return left.join(right, on, "left_anti")


def only_keys(df: DataFrame, key: str, wanted: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the one column of ``wanted``, if that has at most ``max_rows``
    distinct values (counted exactly, up to the bound); otherwise ``df`` unchanged.

    For a reduction of a large history before a rank, where a join on the key
    follows anyway: the broadcast semi-join runs inside the scan's stage.
    """
    ids = wanted.select(F.col(wanted.columns[0]).alias("_wanted")).where("_wanted is not null").distinct()
    if ids.limit(max_rows + 1).count() > max_rows:
        return df
    return df.join(F.broadcast(ids), df[key] == ids["_wanted"], "left_semi")


def full_outer(left: DataFrame, right: DataFrame, cond) -> DataFrame:
    """Full outer join (both sides keep unmatched rows)."""
    return left.join(right, cond, "full")
