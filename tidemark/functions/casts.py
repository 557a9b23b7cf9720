"""Casts with the warehouse's semantics (traps T1-T3), as Column expressions.

All expressions are built from Spark built-ins, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def float_to_int64(c) -> Column:
    """FLOAT64 -> INT64 rounding half away from zero (T1): 2.5 -> 3, -2.5 -> -3.

    Spark's plain cast truncates; ``round`` is HALF_UP on the magnitude, which is
    the warehouse rule.
    """
    return F.round(_c(c)).cast("bigint")


def text_to_int64(c) -> Column:
    """Text -> INT64.

    Integer text is parsed exactly (no pass through FLOAT64, so values above
    2**53 keep every digit); text with a fraction goes through DECIMAL and is
    rounded half away from zero.  Anything else raises under ANSI, as a load
    job would.  Rounding needs the first digit of a fraction only, so a fraction
    of any length is cut there and not rounded twice.
    """
    s = F.trim(_c(c))
    whole = F.regexp_like(s, F.lit(r"^[+-]?[0-9]+$"))
    tenths = F.regexp_replace(s, r"^([+-]?[0-9]*\.[0-9])[0-9]*$", "$1")
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("bigint"))
             .when(whole, s.cast("bigint"))
             .otherwise(F.round(tenths.cast("decimal(38,9)")).cast("bigint")))


def text_to_boolean(c) -> Column:
    """Text -> BOOLEAN accepting only true/false, any case.

    Spark would also take 'yes'/'1'; those fail the job here.
    """
    s = F.lower(F.trim(_c(c)))
    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("boolean"))
             .when(s == "true", F.lit(True))
             .when(s == "false", F.lit(False))
             .otherwise(F.raise_error(F.concat(F.lit("invalid BOOLEAN text: "), s))
                        .cast("boolean")))


def text_to_double(c) -> Column:
    s = F.trim(_c(c))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("double")).otherwise(s.cast("double"))


def text_to_string(c) -> Column:
    return _c(c).cast("string")


def text_to_binary(c) -> Column:
    """BYTES columns arrive base64-encoded in JSON landing files."""
    return F.unbase64(_c(c))
