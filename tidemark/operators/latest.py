"""Latest row per key (``ROW_NUMBER() ... = 1`` family, R1-R8).

Plan shape.  ``latest_per_key`` is written as ``row_number`` over a window
followed by ``rank = 1``.  Catalyst rewrites that into a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so every map
task forwards at most one row per key: a hot key that holds a third of the
input still reaches its reduce task as at most one row per map task.

Every variant takes an explicit, total ordering.  ``ROW_NUMBER`` ties are
arbitrary in a warehouse; here callers append tie-breakers so a re-run (or a
retried task) yields the same winner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnLike = str | Column


def _cols(items: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def latest_per_key(df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[Column],
                   rank_col: str = "_rnk") -> DataFrame:
    """Keep the first row of each key under ``order``.

    ``keys`` may be names or expressions (``CAST(id AS STRING)``, month end of a
    parsed date); ``order`` is a list of sort expressions such as
    ``F.col("updateon").desc()``.  The rank column is dropped (``* EXCEPT``).
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def advance_latest(snapshot: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   restated: DataFrame | None = None, history: DataFrame | None = None) -> DataFrame:
    """R1-R6 from the snapshot before: yesterday's rank 1 rows and the rows that
    have become visible since, instead of the whole history.

    Both have the columns of the base table, and ``order`` is total, so rank 1
    of the union is rank 1 of the history: a row that once lost to a row still
    there cannot win later.  Late rows are part of ``delta`` whatever their own
    dates.  Where past rows have been replaced or taken back that argument does
    not hold: ``restated`` holds the keys of such rows (of the old and the new
    version), and these keys are ranked anew from ``history``, all rows visible
    now.  Only they are shuffled from it.
    """
    base = snapshot.unionByName(delta)
    if restated is not None:
        changed = restated.select(*[F.col(k).alias(f"_changed{i}") for i, k in enumerate(keys)]).distinct()
        same = lambda df: [df[k].eqNullSafe(F.col(f"_changed{i}")) for i, k in enumerate(keys)]
        base = base.join(changed, same(base), "left_anti") \
            .unionByName(history.join(changed, same(history), "left_semi"))
    return latest_per_key(base, keys, order)


def latest_after_distinct(df: DataFrame, keys: Sequence[ColumnLike],
                          order: Sequence[Column]) -> DataFrame:
    """R8 (with A4): ``SELECT DISTINCT *`` then rank.

    Rank 1 keeps one of several equal rows anyway, so the DISTINCT is not run:
    one exchange, and the partial group limit acts before it.
    """
    return latest_per_key(df, keys, order)


def latest_with_eod(df: DataFrame, keys: Sequence[ColumnLike], part_col: str,
                    tiebreak: Sequence[Column] = (), eod_col: str = "EOD_Date",
                    shift_days: int = 1) -> DataFrame:
    """Newest partition date wins; output ``EOD_Date = part - shift_days``.

    ``shift_days=0`` gives the variant whose EOD date is the partition date.
    ``tiebreak`` orders rows that share a partition date.
    """
    out = df.withColumn(eod_col, F.date_sub(F.col(part_col), shift_days))
    return latest_per_key(out, keys, [F.col(part_col).desc(), *tiebreak])


def flag_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str],
                flag_col: str, yes: str = "Yes", no: str = "No", total: bool = False,
                among: DataFrame | None = None) -> DataFrame:
    """Keep *every* row and flag the newest row of each key.

    ``order_desc`` is the newest-first ordering; rows that tie on it are ordered
    by all their other columns (largest first, nulls last), so one row per key
    is flagged unless whole rows are equal: equal rows share their flag.
    Columns without an order (maps) are left out.  ``total`` says that
    ``order_desc`` cannot tie within a key (it ends in a unique id): then only the
    order columns are aggregated and shuffled, otherwise whole rows, one per key
    and map task.  Instead of a full window
    (which would sort a hot key's rows in one task), the winner of each key is
    found with ``max(struct(order))`` -- a partial/final aggregate that sends at
    most one row per key and map task -- and joined back on the key.  The join
    back is a plain equi-join, so AQE can split a skewed key on the big side.

    ``among`` are the rows to rank where ``df`` holds them with more columns
    joined to them: those joins are then not run for the ranking as well.
    """
    among = df if among is None else among
    rest = [f.name for f in among.schema.fields if f.name not in {*keys, *order_desc}
            and "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    ordered = F.struct(*[F.col(f"`{c}`") for c in [*order_desc, *([] if total else rest)]])
    renamed = [f"_k{i}" for i in range(len(keys))]
    winners = (among.groupBy(*[F.col(k).alias(r) for k, r in zip(keys, renamed)])
                 .agg(F.max(ordered).alias("_win")))
    # NULL keys form one group under ROW_NUMBER, so match them null-safely.
    cond = [df[k].eqNullSafe(winners[r]) for k, r in zip(keys, renamed)]
    joined = df.join(winners, cond, "left")
    return (joined.withColumn(flag_col, F.when(ordered.eqNullSafe(F.col("_win")), F.lit(yes))
                                         .otherwise(F.lit(no)))
                  .drop("_win", *renamed))
