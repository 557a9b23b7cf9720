"""Latest-row-per-key snapshots (models M2-M13) as stand-in queries.

Each query runs the same operator composition as a snapshot model, on the test
tables: a cut-off predicate that reaches the Parquet scan, then a group-limited
``row_number`` rank.  Orders carry full tie-breakers (T18).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.functions import temporal as tf
from tidemark.operators.latest import (flag_latest, latest_after_distinct, latest_per_key,
                                       latest_with_eod)
from tidemark.functions.casts import float_to_int64
from tidemark.plans.registry import query

ORDERS_CUTOFF = dt.date(1998, 6, 30)
EVENTS_CUTOFF = dt.date(2024, 1, 20)


def on_or_before(col: str, cutoff: dt.date):
    """P4 on a DATETIME column: ``CAST(col AS DATE) <= cutoff``; Catalyst turns
    it into ``col < cutoff + 1`` and pushes it to Parquet."""
    return F.to_date(F.col(col)) <= F.lit(cutoff)


@query("latest_order_per_customer", ("P4", "R1", "P2", "M5", "M12"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rnk
  FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def latest_order_per_customer(spark, sf_dir, cutoff: dt.date = ORDERS_CUTOFF):
    o = Tables(spark, sf_dir).orders.filter(on_or_before("o_orderdate", cutoff))
    return latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


_LINEITEM_TIEBREAK = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                      "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query("latest_by_composite_key", ("R2", "M7", "M8"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
               l_linestatus DESC) AS rnk
  FROM lineitem) t
WHERE rnk = 1
""")
def latest_by_composite_key(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    order = [F.col("l_shipdate").desc()] + [F.col(c).desc() for c in _LINEITEM_TIEBREAK]
    return latest_per_key(li, ["l_partkey", "l_suppkey"], order)


@query("latest_two_order_keys", ("R3", "M2"), oracle="""
SELECT * EXCLUDE (rnk, partition_date) FROM (
  SELECT *, CAST(ts AS DATE) AS partition_date,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) AS rnk
  FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20') t
WHERE rnk = 1
""")
def latest_two_order_keys(spark, sf_dir, cutoff: dt.date = EVENTS_CUTOFF):
    ev = (Tables(spark, sf_dir).events
          .filter(on_or_before("ts", cutoff))
          .withColumn("partition_date", F.to_date("ts")))
    out = latest_per_key(ev, ["user_id", "event_type"],
                         [F.col("partition_date").desc(), F.col("ts").desc(), F.col("event_id").desc()])
    return out.drop("partition_date")


@query("latest_key_expression", ("R4", "M11"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY CAST(o_custkey AS VARCHAR), o_orderpriority
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rnk
  FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1999-12-31') t
WHERE rnk = 1
""")
def latest_key_expression(spark, sf_dir, cutoff: dt.date = dt.date(1999, 12, 31)):
    o = Tables(spark, sf_dir).orders.filter(on_or_before("o_orderdate", cutoff))
    return latest_per_key(o, [F.col("o_custkey").cast("string"), F.col("o_orderpriority")],
                          [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("latest_with_eod_date", ("P5", "R5", "M6", "M9"), oracle="""
SELECT * EXCLUDE (rnk, part_date) FROM (
  SELECT *, CAST(ts AS DATE) AS part_date,
         CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS EOD_Date,
         row_number() OVER (PARTITION BY user_id, event_type
                            ORDER BY CAST(ts AS DATE) DESC, ts DESC, event_id DESC) AS rnk
  FROM events
  WHERE CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) <= DATE '2024-01-20') t
WHERE rnk = 1
""")
def latest_with_eod_date(spark, sf_dir, cutoff: dt.date = EVENTS_CUTOFF):
    # P5: DATE_SUB(part, 1) <= d is written as part <= d + 1 so it reaches the scan.
    ev = (Tables(spark, sf_dir).events
          .filter(F.to_date("ts") <= F.lit(cutoff + dt.timedelta(days=1)))
          .withColumn("part_date", F.to_date("ts")))
    # R5 orders by the partition date; ts and event_id make the winner unique.
    out = latest_with_eod(ev, ["user_id", "event_type"], "part_date",
                          [F.col("ts").desc(), F.col("event_id").desc()])
    return out.drop("part_date")


@query("latest_month_end", ("R6", "LAST_DAY", "REGEXP_REPLACE", "PARSE_DATE"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, month_end
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rnk
  FROM (SELECT *, last_day(CAST(strptime(regexp_replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
                                          '[^0-9]+', '', 'g'), '%Y%m%d') AS DATE)) AS month_end
        FROM orders) o) t
WHERE rnk = 1
""")
def latest_month_end(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.withColumn(
        "month_end", tf.month_end_of_digits(F.to_date("o_orderdate")))
    return latest_per_key(o, ["o_custkey", "month_end"],
                          [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("last_action_flag", ("R7",), oracle="""
SELECT event_id, user_id, ts, event_type,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
            THEN 'Yes' ELSE 'No' END AS ISLastAction
FROM events
""")
def last_action_flag(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "event_type")
    return flag_latest(ev, ["user_id"], ["ts", "event_id"], "ISLastAction", total=True)  # event_id is unique


@query("distinct_then_latest", ("A4", "R8", "P7", "M13", "T1", "CAST"), oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(round(l_quantity) AS BIGINT) AS quantity,
       CAST(round(l_extendedprice) AS BIGINT) AS extendedprice,
       l_returnflag, date_trunc('second', l_shipdate) AS l_shipdate
FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
               l_linestatus DESC) AS rnk
  FROM (SELECT DISTINCT * FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'
          AND CAST(l_shipdate AS DATE) <= DATE '2000-12-31') d) t
WHERE rnk = 1
""")
def distinct_then_latest(spark, sf_dir):
    li = (Tables(spark, sf_dir).lineitem
          .filter((F.col("l_shipdate") >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
                  & on_or_before("l_shipdate", dt.date(2000, 12, 31))))
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                                       "l_extendedprice", "l_discount", "l_tax",
                                       "l_returnflag", "l_linestatus")]
    ranked = latest_after_distinct(li, ["l_orderkey", "l_linenumber"], order)
    return ranked.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        float_to_int64("l_quantity").alias("quantity"),
        float_to_int64("l_extendedprice").alias("extendedprice"),
        "l_returnflag",
        tf.truncate_to_second("l_shipdate").alias("l_shipdate"))


def _with_intrnd(spark, sf_dir):
    return Tables(spark, sf_dir).orders.withColumn("INTRND", tf.yymmdd_int(F.to_date("o_orderdate")))


@query("cutoff_compact_int", ("P10", "R3", "M4"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY INTRND DESC, o_orderdate DESC, o_orderkey DESC) AS rnk
  FROM (SELECT *, CAST(strftime(CAST(o_orderdate AS DATE), '%y%m%d') AS INTEGER) AS INTRND
        FROM orders) o
  WHERE INTRND <= 980630) t
WHERE rnk = 1
""")
def cutoff_compact_int(spark, sf_dir, cutoff: dt.date = ORDERS_CUTOFF):
    # P10 compares the yymmdd integer as the model does: 2000+ dates are small
    # numbers and therefore pass the cut-off (kept on purpose).
    o = _with_intrnd(spark, sf_dir).filter(F.col("INTRND") <= tf.yymmdd_int_literal(cutoff))
    return latest_per_key(o, ["o_custkey"], [F.col("INTRND").desc(), F.col("o_orderdate").desc(),
                                             F.col("o_orderkey").desc()])


@query("cutoff_parsed_text", ("P11", "T6", "R3", "M3"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY INTRND DESC, o_orderdate DESC, o_orderkey DESC) AS rnk
  FROM (SELECT *, CAST(strftime(CAST(o_orderdate AS DATE), '%y%m%d') AS INTEGER) AS INTRND
        FROM orders) o
  WHERE CAST(strptime(lpad(CAST(INTRND AS VARCHAR), 6, '0'), '%y%m%d') AS DATE)
        <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def cutoff_parsed_text(spark, sf_dir, cutoff: dt.date = ORDERS_CUTOFF):
    o = _with_intrnd(spark, sf_dir).filter(tf.parse_yymmdd("INTRND") <= F.lit(cutoff))
    return latest_per_key(o, ["o_custkey"], [F.col("INTRND").desc(), F.col("o_orderdate").desc(),
                                             F.col("o_orderkey").desc()])


@query("latest_eod_partition_date", ("R5", "M10"), oracle="""
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, CAST(o_orderdate AS DATE) AS EOD_Date,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                            ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rnk
  FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def latest_eod_partition_date(spark, sf_dir, cutoff: dt.date = ORDERS_CUTOFF):
    o = (Tables(spark, sf_dir).orders.filter(on_or_before("o_orderdate", cutoff))
         .withColumn("part_date", F.to_date("o_orderdate")))
    out = latest_with_eod(o, ["o_custkey", "o_orderpriority"], "part_date",
                          [F.col("o_orderkey").desc()], shift_days=0)
    return out.drop("part_date")
