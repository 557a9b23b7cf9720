"""Reconciliation stand-ins: control vs data (M1/Q1), environment compare (Q2),
counts by date (Q3/Q4), wildcard table sets (S11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.operators.aggregates import count_by, distinct_values
from tidemark.operators.quality import control_vs_data, count_by_date, env_row_compare
from tidemark.operators.unions import aligned, table_set, union_all
from tidemark.plans.jobs import comparison_run
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sinks.partitions import replace_partitions


def control_file_rows(t: Tables):
    """Control records as a source system declares them: one per (interface,
    batch day), the 7 string fields of the control layout.  ``orders`` declares its rows per order
    day; ``lineitem`` declares lines per *order* day, while the loaded lineitem
    rows are dated by ship day -- so the reconciliation has real mismatches."""
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    # Lines are counted per order before the join (a partial aggregate), so the
    # join and its shuffle see one row per order instead of one per line.
    per_order = count_by(t.lineitem, ["l_orderkey"], "n")
    lines = (per_order.join(o, per_order["l_orderkey"] == o["o_orderkey"], "left")
             .filter(F.col("d").isNotNull())
             .groupBy("d").agg(F.sum("n").alias("n")))

    def ctrl(c, name):   # c: (d, n) declared rows per batch day
        return c.select(
            F.lit(name).alias("IntefaceName"), F.lit("BU01").alias("BuCode"),
            F.lit("1").alias("FileCount"), F.col("n").cast("string").alias("TotalRec"),
            F.concat(F.date_format("d", "ddMMyyyy"), F.lit("235959")).alias("BatchDate"),
            F.lit("ETL").alias("Requester"),
            F.concat(F.lit("B"), F.date_format("d", "yyyyMMdd")).alias("DIHBatchID"))

    return union_all([ctrl(count_by(o, ["d"], "n"), "orders"), ctrl(lines, "lineitem")])


_CTRL_SQL = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
ctrl AS (
  SELECT 'orders' AS IntefaceName, CAST(COUNT(*) AS VARCHAR) AS TotalRec,
         strftime(d, '%d%m%Y') || '235959' AS BatchDate
  FROM o GROUP BY d
  UNION ALL
  SELECT 'lineitem', CAST(COUNT(*) AS VARCHAR), strftime(o.d, '%d%m%Y') || '235959'
  FROM lineitem l LEFT JOIN o ON l.l_orderkey = o.o_orderkey
  WHERE o.d IS NOT NULL GROUP BY o.d),
data AS (
  SELECT 'orders' AS table_name, CAST(o_orderdate AS DATE) AS data_date, COUNT(*) AS data_row_count
  FROM orders GROUP BY 1, 2
  UNION ALL
  SELECT 'lineitem', CAST(l_shipdate AS DATE), COUNT(*) FROM lineitem GROUP BY 1, 2)
"""


@query("control_vs_data", ("Q1", "J9", "A1", "O1", "S11", "M1", "T7", "PARSE_DATE"), oracle=_CTRL_SQL + """
SELECT IntefaceName,
       CAST(strptime(substring(BatchDate, 1, 8), '%d%m%Y') AS DATE) AS ctrl_date,
       CAST(TotalRec AS BIGINT) AS ctrl_row_count,
       table_name AS table_name_frm_data, data_date, data_row_count, 'brand_a' AS brand
FROM ctrl LEFT JOIN data
  ON IntefaceName = table_name
 AND CAST(strptime(substring(BatchDate, 1, 8), '%d%m%Y') AS DATE) = data_date
ORDER BY 1, 2
""")
def control_vs_data_query(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # Wildcard data table set with its suffix, counted per (suffix, date).
    data = table_set({"orders": t.orders.select(F.to_date("o_orderdate").alias("data_date")),
                      "lineitem": t.lineitem.select(F.to_date("l_shipdate").alias("data_date"))})
    counts = count_by(data, ["table_name", "data_date"], "data_row_count")
    return control_vs_data(control_file_rows(t), counts, "brand_a")


@query("env_row_compare", ("Q2", "J10", "A1", "O1"), oracle="""
SELECT *, count_dev - count_prod AS diff, count_dev / count_prod AS dup
FROM (SELECT CAST(o_orderdate AS DATE) AS date_dev, COUNT(*) AS count_dev
      FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00' GROUP BY 1) d
FULL OUTER JOIN
     (SELECT CAST(o_orderdate AS DATE) AS date_prod, COUNT(*) AS count_prod
      FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) p
ON date_prod = date_dev
ORDER BY date_prod NULLS FIRST
""")
def env_row_compare_query(spark, sf_dir):
    """Dev holds the history before 2000; prod holds every non-pending order."""
    o = Tables(spark, sf_dir).orders
    dev = o.filter(F.col("o_orderdate") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    prod = o.filter(F.col("o_orderstatus") != "P")
    return env_row_compare(dev, prod, F.to_date("o_orderdate"), F.to_date("o_orderdate"))


@query("comparison_run", ("Q2", "Q3", "A1", "J10", "K5", "K7", "P4"), oracle="""
SELECT *, count_dev - count_prod AS diff, count_dev / count_prod AS dup
FROM (SELECT CAST(ts AS DATE) AS date_dev, COUNT(*) AS count_dev
      FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-05' AND event_id % 10 <> 0 GROUP BY 1) d
FULL OUTER JOIN
     (SELECT CAST(ts AS DATE) AS date_prod, COUNT(*) AS count_prod
      FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1) p
ON date_prod = date_dev
""")
def comparison_run_query(spark, sf_dir):
    """Events landed by day in two environments, of which one lacks rows and the
    other days; counted from file footers, and read back from the CSV."""
    ev = Tables(spark, sf_dir).events.withColumn("report_date", F.to_date("ts"))
    root = shared_dir(spark, "comparison")
    replace_partitions(ev.where("event_id % 10 <> 0"), f"{root}/dev", ["report_date"])
    replace_partitions(ev.where(F.col("report_date") <= F.lit(dt.date(2024, 1, 20))), f"{root}/prod", ["report_date"])
    comparison_run(spark, f"{root}/dev", f"{root}/prod", "report_date", f"{root}/table", f"{root}/csv", dt.date(2024, 1, 5))
    return (spark.read.option("header", True)
            .schema("date_dev date, count_dev bigint, date_prod date, count_prod bigint, diff bigint, dup double").csv(f"{root}/csv"))


@query("count_by_date", ("Q3", "Q4", "A1", "O1"), oracle="""
SELECT CAST(l_shipdate AS DATE) AS partition_date, COUNT(*) AS row_count
FROM lineitem GROUP BY 1 ORDER BY 1
""")
def count_by_date_query(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return count_by_date(li, F.to_date("l_shipdate"))


@query("partition_dates", ("A6", "O1"), oracle="""
SELECT DISTINCT CAST(ts AS DATE) AS partition_date FROM events ORDER BY 1
""")
def partition_dates(spark, sf_dir):
    """The dates that a migration goes through."""
    return distinct_values(Tables(spark, sf_dir).events, F.to_date("ts"), "partition_date").orderBy("partition_date")


@query("table_set_with_suffix", ("S11", "A1"), oracle="""
SELECT table_name, COUNT(*) AS n_rows, COUNT(mktsegment) AS n_segment,
       MAX(nationkey) AS max_nation, MAX(party_key) AS max_key
FROM (SELECT 'customer' AS table_name, c_custkey AS party_key, c_nationkey AS nationkey,
             c_mktsegment AS mktsegment FROM customer
      UNION ALL
      SELECT 'supplier', s_suppkey, s_nationkey, NULL FROM supplier
      UNION ALL
      SELECT 'orders_parties', o_custkey, NULL, NULL FROM orders) u
GROUP BY table_name
""")
def table_set_with_suffix(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = {
        "customer": aligned(t.customer, {"party_key": "c_custkey", "nationkey": "c_nationkey",
                                         "mktsegment": "c_mktsegment"}),
        "supplier": aligned(t.supplier, {"party_key": "s_suppkey", "nationkey": "s_nationkey"}),
        "orders_parties": aligned(t.orders, {"party_key": "o_custkey"}),
    }
    u = table_set(parts)
    return u.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("mktsegment").alias("n_segment"),
        F.max("nationkey").alias("max_nation"), F.max("party_key").alias("max_key"))
