"""The model functions of ``tidemark.plans.models`` run on the test tables.

Each query renames test-table columns to the source columns a model reads
(e.g. lineitem as a stock extract: supplier = store, part = SKU, ship
date = ingestion date) and calls the model unchanged.  The oracle SQL is the
model's SQL over the same renamed input, with the model's full tie-break.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.functions import temporal as tf
from tidemark.plans import models as M
from tidemark.plans.registry import query

CUTOFF = dt.date(1998, 6, 30)


def _acstk(t: Tables):
    return t.lineitem.select(
        F.col("l_suppkey").alias("INSTOR"), F.col("l_partkey").alias("INSKU"),
        tf.yymmdd_int(F.to_date("l_shipdate")).alias("INTRND"),
        F.to_date("l_shipdate").alias("_partition_date"),
        F.col("l_orderkey").alias("INORD"), F.col("l_linenumber").alias("INLINE"),
        F.col("l_quantity").alias("INQTY"))


_ACSTK_SQL = """
WITH acstk AS (
  SELECT l_suppkey AS INSTOR, l_partkey AS INSKU,
         CAST(strftime(CAST(l_shipdate AS DATE), '%y%m%d') AS INTEGER) AS INTRND,
         CAST(l_shipdate AS DATE) AS _partition_date, l_orderkey AS INORD,
         l_linenumber AS INLINE, l_quantity AS INQTY
  FROM lineitem)
SELECT * EXCLUDE (rnk, _partition_date) FROM (
  SELECT *, row_number() OVER (PARTITION BY INSTOR, INSKU ORDER BY INTRND DESC,
            _partition_date DESC, INORD DESC, INLINE DESC, INQTY DESC) AS rnk
  FROM acstk WHERE {where}) t
WHERE rnk = 1
"""


@query("model_accounting_stock", ("M2", "P4", "R3", "S12"),
       oracle=_ACSTK_SQL.format(where="_partition_date <= DATE '1998-06-30'"))
def model_accounting_stock(spark, sf_dir):
    return M.accounting_stock_balance({"acstk": _acstk(Tables(spark, sf_dir))}, CUTOFF)


@query("model_accounting_stock_compact", ("M4", "P10", "R3"),
       oracle=_ACSTK_SQL.format(where="INTRND <= 980630"))
def model_accounting_stock_compact(spark, sf_dir):
    return M.accounting_stock_balance({"acstk": _acstk(Tables(spark, sf_dir))}, CUTOFF, "compact")


def _stock_extract(t: Tables, names: dict[str, str]):
    li = t.lineitem
    cols = {"store": F.col("l_suppkey"), "sku": F.col("l_partkey"),
            "eod": F.date_format("l_shipdate", "yyyyMMdd").cast("int"),
            "part": F.to_date("l_shipdate"), "qty": F.col("l_quantity"),
            "ord": F.col("l_orderkey"), "line": F.col("l_linenumber")}
    return li.select(*[cols[k].alias(v) for k, v in names.items()])


_EXTRACT_CTE = """
WITH src AS (
  SELECT l_suppkey AS {store}, l_partkey AS {sku},
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS {eod},
         CAST(l_shipdate AS DATE) AS _partition_date, l_quantity AS {qty},
         l_orderkey AS {ord}, l_linenumber AS {line}
  FROM lineitem)
"""


@query("model_stock_balance_shifted", ("M8", "P5", "R2"), oracle=_EXTRACT_CTE.format(
    store="XSTORE", sku="XSKU", eod="EODDAT", qty="XQTY", ord="XORD", line="XLINE") + """
SELECT * EXCLUDE (rnk, _partition_date) FROM (
  SELECT *, row_number() OVER (PARTITION BY XSTORE, XSKU ORDER BY EODDAT DESC, _partition_date DESC,
            XQTY DESC, XORD DESC, XLINE DESC) AS rnk
  FROM src WHERE CAST(_partition_date - INTERVAL 1 DAY AS DATE) <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_stock_balance_shifted(spark, sf_dir):
    stk = _stock_extract(Tables(spark, sf_dir), {"store": "XSTORE", "sku": "XSKU", "eod": "EODDAT",
                                              "part": "_partition_date", "qty": "XQTY",
                                              "ord": "XORD", "line": "XLINE"})
    return M.stock_balance({"stk": stk}, CUTOFF, shifted=True)


@query("model_stock_balance_plain", ("M7", "P4", "R2"), oracle=_EXTRACT_CTE.format(
    store="XSTORE", sku="XSKU", eod="EODDAT", qty="XQTY", ord="XORD", line="XLINE") + """
SELECT * EXCLUDE (rnk, _partition_date) FROM (
  SELECT *, row_number() OVER (PARTITION BY XSTORE, XSKU ORDER BY EODDAT DESC, _partition_date DESC,
            XQTY DESC, XORD DESC, XLINE DESC) AS rnk
  FROM src WHERE _partition_date <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_stock_balance_plain(spark, sf_dir):
    stk = _stock_extract(Tables(spark, sf_dir), {"store": "XSTORE", "sku": "XSKU", "eod": "EODDAT",
                                              "part": "_partition_date", "qty": "XQTY",
                                              "ord": "XORD", "line": "XLINE"})
    return M.stock_balance({"stk": stk}, CUTOFF)


@query("model_sku_snapshot", ("M5", "P4", "R1"), oracle=_EXTRACT_CTE.format(
    store="ISUPP", sku="INUMBR", eod="EODDAT", qty="IQTY", ord="IORD", line="ILINE") + """
SELECT * EXCLUDE (rnk, _partition_date) FROM (
  SELECT *, row_number() OVER (PARTITION BY INUMBR ORDER BY EODDAT DESC, _partition_date DESC,
            ISUPP DESC, IQTY DESC, IORD DESC, ILINE DESC) AS rnk
  FROM src WHERE _partition_date <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_sku_snapshot(spark, sf_dir):
    sku = _stock_extract(Tables(spark, sf_dir), {"store": "ISUPP", "sku": "INUMBR", "eod": "EODDAT",
                                              "part": "_partition_date", "qty": "IQTY",
                                              "ord": "IORD", "line": "ILINE"})
    return M.sku_snapshot({"sku": sku}, CUTOFF)


@query("model_sku_snapshot_shifted", ("M6", "P5", "R1"), oracle=_EXTRACT_CTE.format(
    store="ISUPP", sku="INUMBR", eod="EODDAT", qty="IQTY", ord="IORD", line="ILINE") + """
SELECT * EXCLUDE (rnk, _partition_date) FROM (
  SELECT *, row_number() OVER (PARTITION BY INUMBR ORDER BY EODDAT DESC, _partition_date DESC,
            ISUPP DESC, IQTY DESC, IORD DESC, ILINE DESC) AS rnk
  FROM src WHERE CAST(_partition_date - INTERVAL 1 DAY AS DATE) <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_sku_snapshot_shifted(spark, sf_dir):
    sku = _stock_extract(Tables(spark, sf_dir), {"store": "ISUPP", "sku": "INUMBR", "eod": "EODDAT",
                                              "part": "_partition_date", "qty": "IQTY",
                                              "ord": "IORD", "line": "ILINE"})
    return M.sku_snapshot({"sku": sku}, CUTOFF, shifted=True)


@query("model_replenishment", ("M9", "R5", "P5"), oracle=_EXTRACT_CTE.format(
    store="ISTORE", sku="INUMBR", eod="IEOD", qty="IQTY", ord="IORD", line="ILINE") + """
SELECT * EXCLUDE (rnk, _partition_date) FROM (
  SELECT *, CAST(_partition_date - INTERVAL 1 DAY AS DATE) AS EOD_Date,
         row_number() OVER (PARTITION BY INUMBR, ISTORE ORDER BY _partition_date DESC,
            IEOD DESC, IQTY DESC, IORD DESC, ILINE DESC) AS rnk
  FROM src WHERE CAST(_partition_date - INTERVAL 1 DAY AS DATE) <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_replenishment(spark, sf_dir):
    r = _stock_extract(Tables(spark, sf_dir), {"store": "ISTORE", "sku": "INUMBR", "eod": "IEOD",
                                            "part": "_partition_date", "qty": "IQTY",
                                            "ord": "IORD", "line": "ILINE"})
    return M.replenishment_profile({"rplprf": r}, CUTOFF)


def _allocate(t: Tables):
    return t.orders.select(
        F.col("o_orderpriority").alias("allocate_type"), F.col("o_custkey").alias("product_id"),
        F.year("o_orderdate").alias("sale_channel_id"), F.col("o_orderdate").alias("update_date"),
        F.to_date("o_orderdate").alias("report_date"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderkey").alias("order_key"))


@query("model_allocate_bychannel", ("M11", "R4", "P4"), oracle="""
WITH allocate AS (
  SELECT o_orderpriority AS allocate_type, o_custkey AS product_id,
         CAST(year(o_orderdate) AS INTEGER) AS sale_channel_id, o_orderdate AS update_date,
         CAST(o_orderdate AS DATE) AS report_date, o_totalprice AS amount, o_orderkey AS order_key
  FROM orders)
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY allocate_type, product_id, CAST(sale_channel_id AS VARCHAR)
            ORDER BY update_date DESC, report_date DESC, amount DESC, order_key DESC) AS rnk
  FROM allocate WHERE report_date <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_allocate_bychannel(spark, sf_dir):
    return M.allocate_stock_bychannel({"allocate": _allocate(Tables(spark, sf_dir))}, CUTOFF)


@query("model_product_master", ("M12", "R1", "P4"), oracle="""
WITH pm AS (
  SELECT o_custkey AS pid, o_orderdate AS updateon, CAST(o_orderdate AS DATE) AS report_date,
         o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS amount
  FROM orders)
SELECT * EXCLUDE (rnk) FROM (
  SELECT *, row_number() OVER (PARTITION BY pid ORDER BY updateon DESC, report_date DESC,
            order_key DESC, status DESC, amount DESC) AS rnk
  FROM pm WHERE report_date <= DATE '1998-06-30') t
WHERE rnk = 1
""")
def model_product_master(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    pm = o.select(F.col("o_custkey").alias("pid"), F.col("o_orderdate").alias("updateon"),
                  F.to_date("o_orderdate").alias("report_date"), F.col("o_orderkey").alias("order_key"),
                  F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    return M.product_master_snapshot({"productmaster": pm}, CUTOFF)


def _product_inputs(t: Tables):
    hist = t.part.select(
        F.col("p_partkey").alias("PID"), F.col("p_size").cast("bigint").alias("PIdOD"),
        F.col("p_size").cast("bigint").alias("DEPT_ID"), F.col("p_size").cast("bigint").alias("SUBDEPT_ID"),
        F.col("p_size").cast("bigint").alias("CLASS"), F.col("p_size").cast("bigint").alias("SUB_CLASS"),
        F.col("p_type").alias("CATEGORY_ID"), F.col("p_brand").alias("SUB_CATEGORY_ID"),
        F.col("p_brand").alias("BRAND_ID"), F.lit(None).cast("string").alias("SUPPLIER_ID"),
        F.lit(dt.date(1994, 12, 31)).alias("TRANS_DATE"))
    li = t.lineitem
    master = li.select(
        F.col("l_partkey").alias("pid"), F.col("l_linenumber").cast("string").alias("pidod"),
        F.col("l_returnflag").alias("dept"), F.col("l_linestatus").alias("sub_dpt"),
        F.col("l_returnflag").alias("class"), F.col("l_linestatus").alias("sub_cls"),
        F.lit("CAT").alias("catid"), F.lit("SUB").alias("subcatid"), F.lit("BR").alias("brandid"),
        F.col("l_suppkey").cast("string").alias("lastsupplierid"),
        F.col("l_shipdate").alias("updateon"), F.col("l_shipdate").alias("createon"))
    detail = li.select(F.col("l_orderkey").alias("RDNo"), F.col("l_linenumber").alias("Seqno"),
                       F.col("l_partkey").alias("pid"), F.col("l_shipdate").alias("createon"))
    return {"product_history": hist, "productmaster": master, "detail": detail}


_PRODUCT_DETAIL_SQL = """
WITH product_base AS (
  SELECT p_partkey AS PID, CAST(p_size AS VARCHAR) AS PIDOD, CAST(p_size AS VARCHAR) AS DEPT_ID,
         CAST(p_size AS VARCHAR) AS SUBDEPT_ID, CAST(p_size AS VARCHAR) AS CLASS,
         CAST(p_size AS VARCHAR) AS SUB_CLASS, p_type AS CATEGORY_ID, p_brand AS SUB_CATEGORY_ID,
         p_brand AS BRAND_ID, CAST(NULL AS VARCHAR) AS SUPPLIER_ID, DATE '1994-12-31' AS TRANS_DATE
  FROM part
  UNION ALL
  SELECT l_partkey, CAST(l_linenumber AS VARCHAR), l_returnflag, l_linestatus, l_returnflag,
         l_linestatus, 'CAT', 'SUB', 'BR', CAST(l_suppkey AS VARCHAR), {master_date}
  FROM lineitem WHERE {master_date} <= DATE '1998-06-30'),
latest AS (
  SELECT * EXCLUDE (rnk) FROM (
    SELECT *, row_number() OVER (PARTITION BY PID ORDER BY TRANS_DATE DESC, PIDOD DESC,
              DEPT_ID DESC, SUBDEPT_ID DESC, CLASS DESC, SUB_CLASS DESC, CATEGORY_ID DESC,
              SUB_CATEGORY_ID DESC, BRAND_ID DESC, SUPPLIER_ID DESC) AS rnk
    FROM product_base) WHERE rnk = 1),
t AS (SELECT l_orderkey AS RDNo, l_linenumber AS Seqno, l_partkey AS pid,
             CAST(l_shipdate AS DATE) AS createon
      FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-06-30')
SELECT t.*, p.PIDOD, p.DEPT_ID, p.SUBDEPT_ID, p.CLASS, p.SUB_CLASS, p.CATEGORY_ID,
       p.SUB_CATEGORY_ID, p.BRAND_ID, p.SUPPLIER_ID
FROM t LEFT JOIN latest p ON p.PID = t.pid
"""


@query("model_product_detail", ("M14", "U1", "R1", "P6", "J1", "P3"),
       oracle=_PRODUCT_DETAIL_SQL.format(master_date="CAST(l_shipdate AS DATE)"))
def model_product_detail(spark, sf_dir):
    return M.product_detail(_product_inputs(Tables(spark, sf_dir)), CUTOFF,
                            ["RDNo", "Seqno", "pid", "createon"])


@query("model_product_detail_createon", ("M14", "U1", "R1"),
       oracle=_PRODUCT_DETAIL_SQL.format(master_date="CAST(CAST(l_shipdate AS DATE) + INTERVAL 40 DAY AS DATE)"))
def model_product_detail_createon(spark, sf_dir):
    """The variant whose product master is dated by ``createon``, here 40 days after ``updateon``."""
    inputs = _product_inputs(Tables(spark, sf_dir))
    inputs["productmaster"] = inputs["productmaster"].withColumn("createon", F.date_add(F.to_date("updateon"), 40))
    return M.product_detail(inputs, CUTOFF, ["RDNo", "Seqno", "pid", "createon"], master_date_col="createon")


def _dim_inputs(t: Tables):
    sku = F.col("p_partkey").cast("string")
    skucodes = t.part.select(sku.alias("sku_id"), F.col("p_name").alias("code"),
                             F.col("p_type").alias("type"), F.col("p_size").alias("create_info_timestamp"),
                             (F.col("p_size") * 2).alias("update_info_timestamp"),
                             F.lit(dt.date(2024, 1, 31)).alias("report_date"),
                             F.lit(dt.date(2024, 2, 1)).alias("run_date"))
    channels = t.lineitem.select(F.col("l_partkey").cast("string").alias("sku_id"),
                                 F.col("l_suppkey").alias("channel_id"),
                                 F.col("l_returnflag").alias("channel_display_name_th"),
                                 F.col("l_linestatus").alias("channel_display_name_en"))
    images = t.part.select(sku.alias("sku_id"), F.col("p_size").cast("string").alias("size"),
                           F.col("p_brand").alias("url"), F.col("p_name").alias("cdn_url"))
    price = t.part.select(sku.alias("sku_id"), F.col("p_type").alias("price_type"),
                          F.col("p_retailprice").alias("price_exclude_vat"),
                          F.round(F.col("p_retailprice") * 1.07, 2).alias("price_include_vat"))
    return {"skucodes": skucodes, "channels": channels, "images": images, "price": price}


_DIM_SQL = """
WITH s AS (SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_name AS code, p_type AS type,
                  p_size AS create_info_timestamp, p_size * 2 AS update_info_timestamp,
                  DATE '2024-01-31' AS report_date, DATE '2024-02-01' AS run_date FROM part),
c AS (SELECT CAST(l_partkey AS VARCHAR) AS sku_id, l_suppkey AS channel_id,
             l_returnflag AS channel_display_name_th, l_linestatus AS channel_display_name_en
      FROM lineitem),
i AS (SELECT CAST(p_partkey AS VARCHAR) AS sku_id, CAST(p_size AS VARCHAR) AS size,
             p_brand AS url, p_name AS cdn_url FROM part),
p AS (SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_type AS price_type,
             p_retailprice AS price_exclude_vat, round(p_retailprice * 1.07, 2) AS price_include_vat
      FROM part)
"""


@query("model_dim_product_attribute", ("M16", "J8", "A2", "P9"), oracle=_DIM_SQL + """
SELECT s.sku_id, s.code, s.type, s.create_info_timestamp, s.update_info_timestamp, c.channel_id,
       c.channel_display_name_th, c.channel_display_name_en, i.size, i.url, i.cdn_url,
       p.price_type, p.price_exclude_vat, p.price_include_vat,
       MAX(s.report_date) AS report_date, MAX(s.run_date) AS run_date
FROM s LEFT JOIN c ON s.sku_id = c.sku_id LEFT JOIN i ON s.sku_id = i.sku_id
LEFT JOIN p ON s.sku_id = p.sku_id
WHERE s.sku_id IS NOT NULL
GROUP BY 1,2,3,4,5,6,7,8,9,10,11,12,13,14
""")
def model_dim_product_attribute(spark, sf_dir):
    return M.dim_product_attribute(_dim_inputs(Tables(spark, sf_dir)))


@query("model_dim_product_attribute_v2", ("M17", "J8", "A3"), oracle=_DIM_SQL + """
SELECT s.sku_id, s.code, s.type, c.channel_id, c.channel_display_name_th,
       c.channel_display_name_en, i.size, i.url, i.cdn_url, p.price_type, p.price_exclude_vat,
       p.price_include_vat
FROM s LEFT JOIN c ON s.sku_id = c.sku_id LEFT JOIN i ON s.sku_id = i.sku_id
LEFT JOIN p ON s.sku_id = p.sku_id
WHERE s.sku_id IS NOT NULL
GROUP BY ALL
""")
def model_dim_product_attribute_v2(spark, sf_dir):
    return M.dim_product_attribute_v2(_dim_inputs(Tables(spark, sf_dir)))


@query("model_data_vs_ctrl", ("M1", "Q1", "S11"), oracle="""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
ctrl AS (
  SELECT 'orders' AS IntefaceName, CAST(COUNT(*) AS VARCHAR) AS TotalRec, d FROM o GROUP BY d
  UNION ALL
  SELECT 'lineitem', CAST(COUNT(*) AS VARCHAR), o.d
  FROM lineitem l LEFT JOIN o ON l.l_orderkey = o.o_orderkey WHERE o.d IS NOT NULL GROUP BY o.d),
data AS (
  SELECT 'orders' AS table_name, CAST(o_orderdate AS DATE) AS data_date, COUNT(*) AS data_row_count
  FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-30' GROUP BY 1, 2
  UNION ALL
  SELECT 'lineitem', CAST(l_shipdate AS DATE), COUNT(*) FROM lineitem
  WHERE CAST(l_shipdate AS DATE) = DATE '1998-06-30' GROUP BY 1, 2)
SELECT IntefaceName, d AS ctrl_date, CAST(TotalRec AS BIGINT) AS ctrl_row_count,
       table_name AS table_name_frm_data, data_date, data_row_count, 'brand_b' AS brand
FROM ctrl LEFT JOIN data ON IntefaceName = table_name AND d = data_date
WHERE d = DATE '1998-06-30'
""")
def model_data_vs_ctrl(spark, sf_dir):
    """Control files are ingested on their batch day; data tables on their row day."""
    from tidemark.operators.unions import table_set
    from tidemark.plans.reconcile import control_file_rows

    t = Tables(spark, sf_dir)
    ctrl = control_file_rows(t).withColumn("_partition_date", tf.parse_ddmmyyyy_prefix("BatchDate"))
    data = table_set({"orders": t.orders.select(F.to_date("o_orderdate").alias("_partition_date")),
                      "lineitem": t.lineitem.select(F.to_date("l_shipdate").alias("_partition_date"))})
    return M.data_vs_ctrl({"ctrl": ctrl, "data": data}, CUTOFF, "brand_b")


# ------------------------------------------------------------ M13, M15 ------

PW_FIRST_RUN = dt.date(1996, 1, 1)   # the model's first run date, moved into the test data's range

_PW_COLUMNS = [  # (name, Spark expression builder, SQL expression) of the product-warehouse extract
    ("amt", lambda: F.col("l_extendedprice"), "l_extendedprice"),
    ("pid", lambda: F.col("l_partkey"), "l_partkey"),
    ("onpw", lambda: F.col("l_quantity"), "l_quantity"),
    ("onrd", lambda: F.col("l_discount") * 100, "l_discount * 100"),
    ("onrt", lambda: F.col("l_tax") * 100, "l_tax * 100"),
    ("unit", lambda: F.col("l_linestatus"), "l_linestatus"),
    ("whid", lambda: F.col("l_suppkey"), "l_suppkey"),
    ("onpic", lambda: F.col("l_quantity") / 2, "l_quantity / 2"),
    ("onplt", lambda: F.col("l_linenumber"), "l_linenumber"),
    ("onpru", lambda: F.col("l_quantity") + 0.5, "l_quantity + 0.5"),
    ("pname", lambda: F.col("l_returnflag"), "l_returnflag"),
    ("onsale", lambda: F.col("l_extendedprice") / 100, "l_extendedprice / 100"),
    ("onhand", lambda: F.col("l_quantity") * 3, "l_quantity * 3"),
    ("whname", lambda: F.concat(F.lit("WH"), F.col("l_suppkey").cast("string")), "'WH' || CAST(l_suppkey AS STRING)"),
    ("avgcost", lambda: F.col("l_extendedprice") / F.col("l_quantity"), "l_extendedprice / l_quantity"),
    ("storeid", lambda: F.col("l_linestatus"), "l_linestatus"),
    ("createby", lambda: F.concat(F.lit("u"), F.col("l_orderkey").cast("string")), "'u' || CAST(l_orderkey AS STRING)"),
    ("createon", lambda: F.col("l_shipdate"), "l_shipdate"),
    ("updateby", lambda: F.concat(F.lit("v"), F.col("l_linenumber").cast("string")), "'v' || CAST(l_linenumber AS STRING)"),
    ("updateon", lambda: F.col("l_shipdate"), "l_shipdate"),
    ("ordertype", lambda: F.col("l_returnflag"), "l_returnflag"),
    ("storename", lambda: F.concat(F.lit("store "), F.col("l_linestatus")), "'store ' || l_linestatus"),
    ("lastrcvdate", lambda: F.col("l_shipdate"), "l_shipdate"),
    ("createbyname", lambda: F.lit("creator"), "'creator'"),
    ("updatebyname", lambda: F.lit("updater"), "'updater'"),
    ("report_date", lambda: F.to_date("l_shipdate"), "CAST(l_shipdate AS DATE)"),
    ("run_date", lambda: F.date_add(F.to_date("l_shipdate"), 1), "CAST(CAST(l_shipdate AS DATE) + INTERVAL 1 DAY AS DATE)"),
]
_PW_INT = ("onpw", "onrd", "onrt", "onpic", "onplt", "onpru", "onsale", "onhand")
_PW_TS = ("createon", "updateon", "lastrcvdate")


def _pw(t: Tables):
    return t.lineitem.select(*[e().alias(n) for n, e, _ in _PW_COLUMNS])


def _pw_sql() -> str:
    return "pw AS (SELECT " + ", ".join(f"{s} AS {n}" for n, _, s in _PW_COLUMNS) + " FROM lineitem)"


def _pw_select() -> str:
    out = []
    for n, _, _ in _PW_COLUMNS:
        if n in _PW_INT:
            out.append(f"CAST(round({n}) AS BIGINT) AS {n}")
        elif n in _PW_TS:
            out.append(f"date_trunc('second', {n}) AS {n}")
        else:
            out.append(n)
    return ", ".join(out)


_PW_TIEBREAK = ", ".join(f"{n} DESC" for n, _, _ in _PW_COLUMNS if n not in ("pid", "storeid", "whid", "updateon"))


@query("model_product_warehouse", ("M13", "A4", "R8", "P7", "T1", "CAST"), oracle=f"""
WITH {_pw_sql()},
tmp AS (SELECT DISTINCT * FROM pw WHERE run_date >= DATE '1996-01-01' AND report_date <= DATE '1998-06-30'),
tmp2 AS (SELECT *, row_number() OVER (PARTITION BY pid, storeid, whid ORDER BY updateon DESC, {_PW_TIEBREAK}) AS rnk
         FROM tmp)
SELECT {_pw_select()} FROM tmp2 WHERE rnk = 1
""")
def model_product_warehouse(spark, sf_dir):
    return M.product_warehouse_snapshot({"productwarehouse": _pw(Tables(spark, sf_dir))}, CUTOFF,
                                        first_run=PW_FIRST_RUN)


@query("model_productwarehouse_detail", ("M15", "U1", "U2", "R6", "R1", "J1"), oracle="""
WITH product_base AS (
  SELECT p_partkey AS PID, CAST(p_size AS STRING) AS PIDOD, CAST(p_size AS STRING) AS DEPT_ID,
         CAST(p_size AS STRING) AS SUBDEPT_ID, CAST(p_size AS STRING) AS CLASS,
         CAST(p_size AS STRING) AS SUB_CLASS, p_type AS CATEGORY_ID, p_brand AS SUB_CATEGORY_ID,
         p_brand AS BRAND_ID, CAST(NULL AS STRING) AS SUPPLIER_ID, DATE '1994-12-31' AS TRANS_DATE
  FROM part
  UNION ALL
  SELECT l_partkey, CAST(l_linenumber AS STRING), l_returnflag, l_linestatus, l_returnflag,
         l_linestatus, 'CAT', 'SUB', 'BR', CAST(l_suppkey AS STRING), CAST(l_shipdate AS DATE)
  FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1998-06-30'),
latest AS (
  SELECT * EXCLUDE (rnk) FROM (
    SELECT *, row_number() OVER (PARTITION BY PID ORDER BY TRANS_DATE DESC, PIDOD DESC,
              DEPT_ID DESC, SUBDEPT_ID DESC, CLASS DESC, SUB_CLASS DESC, CATEGORY_ID DESC,
              SUB_CATEGORY_ID DESC, BRAND_ID DESC, SUPPLIER_ID DESC) AS rnk
    FROM product_base) WHERE rnk = 1),
hist AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS ymdata, l_partkey AS pid, l_linestatus AS storeid,
         l_suppkey AS whid, l_shipdate AS updateon, l_quantity AS qty,
         last_day(CAST(strptime(regexp_replace(strftime(l_shipdate, '%Y-%m'), '[^0-9]+', '', 'g') || '01',
                                '%Y%m%d') AS DATE)) AS file_date
  FROM lineitem),
t AS (
  SELECT l_partkey AS pid, l_linestatus AS StoreID, l_suppkey AS WHID, CAST(l_shipdate AS DATE) AS file_date
  FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-06-30'
  UNION ALL
  SELECT pid, storeid, whid, file_date FROM (
    SELECT *, row_number() OVER (PARTITION BY pid, storeid, file_date
                                 ORDER BY updateon DESC, ymdata DESC, whid DESC, qty DESC) AS rnk
    FROM hist WHERE file_date = DATE '1998-06-30') WHERE rnk = 1)
SELECT t.*, p.PIDOD, p.DEPT_ID, p.SUBDEPT_ID, p.CLASS, p.SUB_CLASS, p.CATEGORY_ID,
       p.SUB_CATEGORY_ID, p.BRAND_ID, p.SUPPLIER_ID
FROM t LEFT JOIN latest p ON p.PID = t.pid
""")
def model_productwarehouse_detail(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem
    snapshot = li.select(F.col("l_partkey").alias("pid"), F.col("l_linestatus").alias("storeid"),
                         F.col("l_suppkey").alias("whid"), F.to_date("l_shipdate").alias("_partition_date"))
    history = li.select(F.date_format("l_shipdate", "yyyy-MM").alias("ymdata"), F.col("l_partkey").alias("pid"),
                        F.col("l_linestatus").alias("storeid"), F.col("l_suppkey").alias("whid"),
                        F.col("l_shipdate").alias("updateon"), F.col("l_quantity").alias("qty"))
    inputs = dict(_product_inputs(t), pw_snapshot=snapshot, pw_history=history)
    return M.productwarehouse_product_detail(inputs, CUTOFF)
