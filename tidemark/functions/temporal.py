"""Date/time parsing and shifting with the warehouse's rules.

Everything works on TIMESTAMP_NTZ (warehouse DATETIME) so results do not depend
on the session time zone; zone conversions name both zones explicitly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The landing-file text formats.  Temporal fields arrive as
# ISO-8601 UTC text "YYYY-MM-DDTHH:MM:SS[.fraction]Z" (0 to 9 fraction
# digits, datetime2 has 7); TIME fields as "HH:MM:SS".
FRACTION = "[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"
ISO_UTC_PATTERN = f"yyyy-MM-dd'T'HH:mm:ss{FRACTION}'Z'"
ISO_INSTANT_PATTERN = f"yyyy-MM-dd'T'HH:mm:ss{FRACTION}X"
#: Length of such a text with six fraction digits, without the Z.
ISO_MICROS = 26
TIME_PATTERN = "HH:mm:ss"
LOCAL_ZONE = "Asia/Bangkok"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut_to_micros(c) -> Column:
    """ISO text with a trailing Z, fraction digits after the sixth cut off."""
    src = _c(c)
    nanos = (F.length(src) > ISO_MICROS + 1) & F.endswith(src, F.lit("Z"))
    return F.when(nanos, F.concat(F.substring(src, 1, ISO_MICROS), F.lit("Z"))).otherwise(src)


def parse_iso_utc(c) -> Column:
    """ISO text with a trailing Z -> TIMESTAMP_NTZ (the UTC wall clock, to the microsecond)."""
    return F.to_timestamp_ntz(cut_to_micros(c), F.lit(ISO_UTC_PATTERN))


def parse_temporal(c, kind: str, nullable: bool = True) -> Column:
    """Text -> DATE / TIME / DATETIME / TIMESTAMP.

    NULLABLE fields map ``''`` to NULL; for REQUIRED fields ``''`` is a parse
    error (ANSI mode raises), as in the warehouse.
    """
    src = _c(c)
    kind = kind.upper()
    if kind == "TIME":
        parsed = F.to_time(src, F.lit(TIME_PATTERN))
    else:
        ts = parse_iso_utc(src)
        if kind == "DATE":
            parsed = F.to_date(ts)
        elif kind == "DATETIME":
            parsed = ts
        elif kind == "TIMESTAMP":
            # Warehouse TIMESTAMP is an instant; the trailing Z is read as the
            # UTC offset, so the session time zone plays no part.
            parsed = F.to_timestamp(cut_to_micros(src), ISO_INSTANT_PATTERN)
        else:
            raise ValueError(f"not a temporal kind: {kind}")
    if nullable:
        return F.when(src == "", F.lit(None).cast(parsed_type(kind))).otherwise(parsed)
    return parsed


def parsed_type(kind: str) -> str:
    return {"DATE": "date", "TIME": "time", "DATETIME": "timestamp_ntz",
            "TIMESTAMP": "timestamp"}[kind.upper()]


def truncate_to_second(c) -> Column:
    """``PARSE_DATETIME('%Y-%m-%d %H:%M:%S', LEFT(CAST(TIMESTAMP(x) AS STRING), 19))``.

    Drops the fraction and yields a DATETIME.
    """
    return F.date_trunc("second", _c(c).cast("timestamp_ntz")).cast("timestamp_ntz")


def yymmdd_int(c) -> Column:
    """DATE -> compact integer yymmdd (``2024-01-05`` -> 240105, ``2001-08-01`` -> 10801)."""
    return F.date_format(_c(c), "yyMMdd").cast("int")


def yymmdd_int_literal(d: dt.date) -> int:
    return int(d.strftime("%y%m%d"))


def parse_yymmdd(c) -> Column:
    """``PARSE_DATE('%y%m%d', CAST(x AS STRING))``.

    Five-digit values are left-padded; two-digit years 69-99 are 19xx and
    00-68 are 20xx (Spark's own ``yy`` would give 2069-2099).  Invalid dates
    raise under ANSI.
    """
    v = _c(c).cast("int")
    yy = F.floor(v / 10000).cast("int")
    mm = (F.floor(v / 100) % 100).cast("int")
    dd = (v % 100).cast("int")
    year = yy + F.when(yy >= 69, F.lit(1900)).otherwise(F.lit(2000))
    return F.make_date(year, mm, dd)


def parse_ddmmyyyy_prefix(c) -> Column:
    """``PARSE_DATE('%d%m%Y', SUBSTRING(s, 0, 8))``: first eight characters."""
    return F.to_date(F.substring(_c(c), 1, 8), "ddMMyyyy")


def local_date(c, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> calendar date in ``zone``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(c).cast("timestamp_ntz")))


def local_run_dates(now_utc: dt.datetime, zone: str = LOCAL_ZONE,
                    report_offset: int = 1) -> tuple[dt.date, dt.date]:
    """[report_date, run_date] for a scheduler tick: run date is the local date
    of ``now_utc``; the report date is ``report_offset`` days earlier."""
    from zoneinfo import ZoneInfo

    local = now_utc.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).date()
    return local - dt.timedelta(days=report_offset), local


def month_end_of_digits(c, fmt: str = "yyyyMMdd") -> Column:
    """R6 key: ``LAST_DAY(PARSE_DATE('%Y%m%d', REGEXP_REPLACE(s, '[^0-9]+', '')))``."""
    digits = F.regexp_replace(_c(c).cast("string"), r"[^0-9]+", "")
    return F.last_day(F.to_date(digits, fmt))


def epoch_ms_to_utc(c) -> Column:
    """Epoch milliseconds -> UTC wall clock."""
    return _epoch_to_ntz(_c(c), 1000)


def epoch_s_to_utc(c) -> Column:
    return _epoch_to_ntz(_c(c), 1)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _epoch_to_ntz(c: Column, per_second: int) -> Column:
    # TIMESTAMP_NTZ at the UTC wall clock: add the epoch offset to 1970-01-01
    # without consulting the session time zone.
    micros = c.cast("bigint") * F.lit(1_000_000 // per_second)
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def utc_to_epoch_ms(c) -> Column:
    """UTC wall clock -> epoch milliseconds (exact, session-zone free)."""
    return F.timestamp_diff("MILLISECOND", _epoch(),
                            _c(c).cast("timestamp_ntz"))


def utc_instant(c) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> TIMESTAMP instant, session-zone free
    (event-time columns for watermarks must be TIMESTAMP)."""
    micros = F.timestamp_diff("MICROSECOND", _epoch(), _c(c).cast("timestamp_ntz"))
    return F.timestamp_micros(micros)


def instant_to_utc(c) -> Column:
    """TIMESTAMP instant -> UTC wall clock (TIMESTAMP_NTZ), session-zone free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), _epoch())
