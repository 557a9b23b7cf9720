"""Many cut-offs at once (G6) and snapshots advanced day by day."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.operators.latest import advance_latest, latest_per_key
from tidemark.plans import models as M
from tidemark.plans.model_runs import PW_FIRST_RUN, _acstk, _product_inputs, _pw, _pw_sql
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sinks.partitions import partition_dir, replace_listed_partitions, replace_partition

#: The first lies before all rows: its partition has to be emptied.
CUTOFFS = [dt.date(1970, 1, 1), dt.date(1996, 6, 30), dt.date(1998, 6, 30), dt.date(2000, 12, 31)]
_CUTS = ", ".join(f"(DATE '{c}')" for c in CUTOFFS)


@query("accounting_stock_backfill", ("G6", "M2", "R2", "T12", "K1"), oracle=f"""
WITH acstk AS (
  SELECT l_suppkey AS INSTOR, l_partkey AS INSKU, CAST(l_shipdate AS DATE) AS d, l_orderkey AS INORD, l_linenumber AS INLINE,
         l_quantity AS INQTY
  FROM lineitem),
ranked AS (
  SELECT cutoff, a.*, row_number() OVER (PARTITION BY cutoff, INSTOR, INSKU
    ORDER BY CAST(strftime(d, '%y%m%d') AS INTEGER) DESC, d DESC, INORD DESC, INLINE DESC, INQTY DESC) AS r
  FROM acstk AS a JOIN (VALUES {_CUTS}) AS c(cutoff) ON a.d <= c.cutoff)
SELECT cutoff, INSTOR, COUNT(*) AS n_skus, CAST(SUM(INORD) AS BIGINT) AS sum_order, round(SUM(INQTY), 2) AS quantity
FROM ranked WHERE r = 1 GROUP BY 1, 2
""")
def accounting_stock_backfill(spark, sf_dir):
    """M2 for every cut-off in one plan, written as one job; the partition of
    the cut-off without rows, which holds some, is emptied."""
    inputs = {"acstk": _acstk(Tables(spark, sf_dir))}
    path = f"{shared_dir(spark, 'stock-backfill')}/stock"
    out = M.accounting_stock_balance_at(inputs, CUTOFFS)
    replace_partition(out.limit(5).drop("cutoff"), path, "cutoff", CUTOFFS[0])
    replace_listed_partitions(out, path, "cutoff", CUTOFFS)
    return spark.read.parquet(path).groupBy("cutoff", "INSTOR").agg(
        F.count(F.lit(1)).alias("n_skus"), F.sum("INORD").alias("sum_order"), F.round(F.sum("INQTY"), 2).alias("quantity"))


@query("product_warehouse_backfill", ("G6", "M13", "R8", "T1"), oracle=f"""
WITH {_pw_sql()},
ranked AS (
  SELECT c.cutoff, pw.*, row_number() OVER (PARTITION BY c.cutoff, pid, storeid, whid ORDER BY updateon DESC, amt DESC, onpw DESC, onrd DESC,
    onrt DESC, unit DESC, onpic DESC, onplt DESC, onpru DESC, pname DESC, onsale DESC, onhand DESC, whname DESC, avgcost DESC, createby DESC,
    createon DESC, updateby DESC, ordertype DESC, storename DESC, lastrcvdate DESC, createbyname DESC, updatebyname DESC,
    report_date DESC, run_date DESC) AS r
  FROM pw JOIN (VALUES {_CUTS}) AS c(cutoff) ON report_date <= c.cutoff WHERE run_date >= DATE '{PW_FIRST_RUN}')
SELECT cutoff, storeid, COUNT(*) AS n_rows, CAST(SUM(CAST(round(onhand) AS BIGINT)) AS BIGINT) AS onhand, round(SUM(amt), 2) AS amt,
       max(date_trunc('second', updateon)) AS newest
FROM ranked WHERE r = 1 GROUP BY 1, 2
""")
def product_warehouse_backfill(spark, sf_dir):
    out = M.product_warehouse_snapshot_at({"productwarehouse": _pw(Tables(spark, sf_dir))}, CUTOFFS, PW_FIRST_RUN)
    return out.groupBy("cutoff", "storeid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("onhand").alias("onhand"), F.round(F.sum("amt"), 2).alias("amt"), F.max("updateon").alias("newest"))


#: Days of the detail backfill; nothing is shipped on the last.
DETAIL_DAYS = [dt.date(1996, 3, 13), dt.date(1998, 6, 30), dt.date(1999, 1, 5), dt.date(2031, 1, 1)]
_DAYS = ", ".join(f"DATE '{d}'" for d in DETAIL_DAYS)


@query("product_detail_backfill", ("G6", "M14", "U1", "R1", "J1"), oracle=f"""
WITH base AS (
  SELECT p_partkey AS PID, CAST(p_size AS VARCHAR) AS PIDOD, CAST(p_size AS VARCHAR) AS DEPT_ID, CAST(p_size AS VARCHAR) AS SUBDEPT_ID,
         CAST(p_size AS VARCHAR) AS CLASS, CAST(p_size AS VARCHAR) AS SUB_CLASS, p_type AS CATEGORY_ID, p_brand AS SUB_CATEGORY_ID,
         p_brand AS BRAND_ID, CAST(NULL AS VARCHAR) AS SUPPLIER_ID, DATE '1994-12-31' AS TRANS_DATE
  FROM part
  UNION ALL
  SELECT l_partkey, CAST(l_linenumber AS VARCHAR), l_returnflag, l_linestatus, l_returnflag, l_linestatus, 'CAT', 'SUB', 'BR',
         CAST(l_suppkey AS VARCHAR), CAST(l_shipdate AS DATE)
  FROM lineitem),
t AS (SELECT CAST(l_shipdate AS DATE) AS cutoff, l_orderkey AS RDNo, l_linenumber AS Seqno, l_partkey AS pid, CAST(l_shipdate AS DATE) AS createon
      FROM lineitem WHERE CAST(l_shipdate AS DATE) IN ({_DAYS})),
ranked AS (
  SELECT t.*, base.* EXCLUDE (PID, TRANS_DATE), row_number() OVER (PARTITION BY cutoff, RDNo, Seqno, t.pid ORDER BY TRANS_DATE DESC, PIDOD DESC,
    DEPT_ID DESC, SUBDEPT_ID DESC, CLASS DESC, SUB_CLASS DESC, CATEGORY_ID DESC, SUB_CATEGORY_ID DESC, BRAND_ID DESC, SUPPLIER_ID DESC) AS r
  FROM t LEFT JOIN base ON base.PID = t.pid AND base.TRANS_DATE <= t.cutoff)
SELECT * EXCLUDE (r) FROM ranked WHERE r = 1
""")
def product_detail_backfill(spark, sf_dir):
    return M.product_detail_at(_product_inputs(Tables(spark, sf_dir)), DETAIL_DAYS, ["RDNo", "Seqno", "pid", "createon"])


#: Ends of the periods by which the order snapshot is advanced.
STEPS = [dt.date(1996, 12, 31), dt.date(1997, 12, 31), dt.date(1998, 12, 31), dt.date(1999, 12, 31)]
#: The step at which wrong rows of earlier periods are replaced.
CORRECTED_AT = 2


def order_versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders with the day on which they arrive: every tenth 45 days late.
    In the first version every fiftieth order has a date far in the future."""
    late = F.when(F.col("o_orderkey") % 10 == 3, 45).otherwise(0)
    right = t.orders.withColumn("arrived", F.date_add(F.to_date("o_orderdate"), late))
    wrong = right.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 50 == 7, F.col("o_orderdate") + F.expr("INTERVAL 4000 DAYS"))
                             .otherwise(F.col("o_orderdate")))
    return wrong, right


@query("incremental_snapshot", ("R1", "P4", "M12", "K1"), oracle=f"""
SELECT * EXCLUDE (r) FROM (
  SELECT cutoff, o.*, row_number() OVER (PARTITION BY cutoff, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
  FROM (SELECT *, CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 10 = 3 THEN 45 ELSE 0 END AS arrived FROM orders) AS o
  JOIN (VALUES {", ".join(f"(DATE '{c}')" for c in STEPS[CORRECTED_AT:])}) AS c(cutoff) ON arrived <= cutoff)
WHERE r = 1
""")
def incremental_snapshot(spark, sf_dir):
    """The newest order per customer, advanced period by period from the stored
    snapshot before and the rows that arrived in between.  Some rows are wrong
    until a later step replaces them: the customers concerned are ranked anew.
    Returned are the snapshots from that step on; they equal the full rank."""
    wrong, right = order_versions(Tables(spark, sf_dir))
    path = f"{shared_dir(spark, 'incremental')}/snapshot"
    keys, order = ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    for step, cutoff in enumerate(STEPS):
        rows = wrong if step < CORRECTED_AT else right
        if step == 0:
            out = latest_per_key(rows.filter(F.col("arrived") <= F.lit(cutoff)), keys, order)
        else:
            before = spark.read.parquet(partition_dir(path, "cutoff", STEPS[step - 1]))
            delta = rows.filter((F.col("arrived") > F.lit(STEPS[step - 1])) & (F.col("arrived") <= F.lit(cutoff)))
            restated = {}
            if step == CORRECTED_AT:
                restated = {"restated": rows.filter((F.col("o_orderkey") % 50 == 7) & (F.col("arrived") <= F.lit(STEPS[step - 1]))),
                            "history": rows.filter(F.col("arrived") <= F.lit(cutoff))}
            out = advance_latest(before, delta, keys, order, **restated)
        replace_partition(out, path, "cutoff", cutoff)
    kept = [spark.read.parquet(partition_dir(path, "cutoff", c)).withColumn("cutoff", F.lit(c)) for c in STEPS[CORRECTED_AT:]]
    return reduce(DataFrame.unionByName, kept)
