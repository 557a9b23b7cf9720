"""Enrichment, dimension and fact models (M14-M18) as stand-in queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.operators.aggregates import count_by, group_distinct, group_max
from tidemark.operators.joins import anti, broadcast_reduced, left_join, maybe_broadcast, prefixed, semi
from tidemark.operators.latest import flag_latest, latest_per_key
from tidemark.operators.unions import aligned, union_all
from tidemark.plans.registry import query

RUN_DATE = dt.date(1998, 6, 30)
#: Suppliers that may be broadcast (two numbers and a name each).
SUPPLIER_ROWS = 1_000_000


def latest_product_info(t: Tables, cutoff: dt.date):
    """U1 + R1: product history UNION ALL current master, newest TRANS_DATE per PID.

    History is the one-time load (``part``, casts on that side); the current
    master is the stream of shipments carrying the part's latest supplier.
    The rank comes before any join, so each map task sends at most one row per
    PID.
    """
    history = aligned(t.part, {
        "PID": "p_partkey", "BRAND_ID": "p_brand", "CLASS": "p_type",
        "SIZE_CODE": F.col("p_size").cast("string"),
        "SUPPLIER_ID": F.lit(None).cast("bigint"),
        "TRANS_DATE": F.lit(dt.date(1994, 12, 31))})
    current = aligned(
        t.lineitem.filter(F.to_date("l_shipdate") <= F.lit(cutoff)), {
            "PID": "l_partkey", "BRAND_ID": "l_returnflag", "CLASS": "l_linestatus",
            "SIZE_CODE": F.col("l_linenumber").cast("string"),
            "SUPPLIER_ID": "l_suppkey",
            "TRANS_DATE": F.to_date("l_shipdate")})
    base = union_all([history.filter(F.col("TRANS_DATE") <= F.lit(cutoff)), current])
    return latest_per_key(base, ["PID"], [F.col(c).desc_nulls_last() for c in
                                          ("TRANS_DATE", "SUPPLIER_ID", "BRAND_ID", "CLASS",
                                           "SIZE_CODE")])


@query("enrich_detail_latest_dim", ("U1", "R1", "P6", "J1", "P3", "M14"), oracle="""
WITH product_base AS (
  SELECT p_partkey AS PID, p_brand AS BRAND_ID, p_type AS CLASS,
         CAST(p_size AS VARCHAR) AS SIZE_CODE, CAST(NULL AS BIGINT) AS SUPPLIER_ID,
         DATE '1994-12-31' AS TRANS_DATE
  FROM part WHERE DATE '1994-12-31' <= DATE '1998-06-30'
  UNION ALL
  SELECT l_partkey, l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR), l_suppkey,
         CAST(l_shipdate AS DATE)
  FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1998-06-30'),
latest_product_info AS (
  SELECT * EXCLUDE (rnk) FROM (
    SELECT *, row_number() OVER (PARTITION BY PID ORDER BY TRANS_DATE DESC NULLS LAST,
             SUPPLIER_ID DESC NULLS LAST, BRAND_ID DESC NULLS LAST, CLASS DESC NULLS LAST,
             SIZE_CODE DESC NULLS LAST) AS rnk
    FROM product_base) WHERE rnk = 1),
transaction_table AS (
  SELECT l_orderkey AS RDNo, l_linenumber AS Seqno, l_partkey AS pid,
         CAST(l_shipdate AS DATE) AS createon
  FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-06-30')
SELECT t.*, p.BRAND_ID, p.CLASS, p.SIZE_CODE, p.SUPPLIER_ID
FROM transaction_table t LEFT JOIN latest_product_info p ON p.PID = t.pid
""")
def enrich_detail_latest_dim(spark, sf_dir, run_date: dt.date = RUN_DATE):
    t = Tables(spark, sf_dir)
    detail = (t.lineitem.filter(F.to_date("l_shipdate") == F.lit(run_date))
              .select(F.col("l_orderkey").alias("RDNo"), F.col("l_linenumber").alias("Seqno"),
                      F.col("l_partkey").alias("pid"), F.to_date("l_shipdate").alias("createon")))
    # Spark names are case-insensitive, so the dimension key is renamed.
    dim = latest_product_info(t, run_date).select(
        F.col("PID").alias("dim_pid"), "BRAND_ID", "CLASS", "SIZE_CODE", "SUPPLIER_ID")
    return (detail.join(dim, detail["pid"] == dim["dim_pid"], "left")
            .select("RDNo", "Seqno", "pid", "createon", "BRAND_ID", "CLASS", "SIZE_CODE",
                    "SUPPLIER_ID"))


@query("snapshot_union_history", ("U2", "R6", "R1", "J1", "M15"), oracle="""
WITH daily AS (
  SELECT user_id AS entity_id, CAST(ts AS DATE) AS snap_date, value AS amount,
         'daily' AS source
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rnk
        FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20') WHERE rnk = 1),
month_end AS (
  SELECT o_custkey AS entity_id, month_end AS snap_date, o_totalprice AS amount,
         'month_end' AS source
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, month_end
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rnk
        FROM (SELECT *, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders))
  WHERE rnk = 1)
SELECT u.*, c.c_name, c.c_mktsegment
FROM (SELECT * FROM daily UNION ALL SELECT * FROM month_end) u
LEFT JOIN customer c ON u.entity_id = c.c_custkey
""")
def snapshot_union_history(spark, sf_dir, cutoff: dt.date = dt.date(2024, 1, 20)):
    t = Tables(spark, sf_dir)
    daily = latest_per_key(t.events.filter(F.to_date("ts") <= F.lit(cutoff)), ["user_id"],
                           [F.col("ts").desc(), F.col("event_id").desc()])
    daily = aligned(daily, {"entity_id": "user_id", "snap_date": F.to_date("ts"),
                            "amount": "value", "source": F.lit("daily")})
    monthly = latest_per_key(t.orders.withColumn("month_end", F.last_day(F.to_date("o_orderdate"))),
                             ["o_custkey", "month_end"],
                             [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    monthly = aligned(monthly, {"entity_id": "o_custkey", "snap_date": "month_end",
                                "amount": "o_totalprice", "source": F.lit("month_end")})
    cust = t.customer.select(F.col("c_custkey"), "c_name", "c_mktsegment")
    u = union_all([daily, monthly])
    return (u.join(cust, u["entity_id"] == cust["c_custkey"], "left")
             .select("entity_id", "snap_date", "amount", "source", "c_name", "c_mktsegment"))


@query("multi_left_join_fact", ("J1", "J2", "J3", "J4", "J5", "J6", "J7", "J11", "R7", "A5",
                                "T9", "T10", "T11", "M18"), oracle="""
WITH A AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                      l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                      l_linestatus DESC) AS r1
  FROM lineitem
  WHERE l_returnflag IS NOT NULL AND LEFT(l_linestatus, 2) <> 'SDO'),
PS AS (
  SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, l_shipdate AS last_ship,
         l_quantity AS last_qty
  FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
               ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
        FROM lineitem) WHERE rn = 1),
W AS (SELECT CAST(l_shipdate AS DATE) AS ship_date, COUNT(*) AS n_shipped
      FROM lineitem GROUP BY 1)
SELECT DISTINCT
  A.l_orderkey AS BillDelivery, A.l_linenumber, A.l_partkey, A.l_suppkey,
  ZZ.o_orderdate AS DeliveryDate, ZZ.o_orderstatus AS Status, ZZ.o_totalprice AS TotalAmount,
  YY.c_name AS CustomerName,
  IFNULL(PS.last_qty, A.l_quantity) AS LastQuantity,
  CASE WHEN ZZ.o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'No' ELSE 'Yes' END AS IsCrossSale,
  IFNULL(C.p_brand, 'No') AS hamper_flag,
  LEFT(ZZ.o_orderpriority, 1) AS Doc_Type,
  CASE WHEN IFNULL(YY.c_mktsegment, '') = '' THEN 'Silver' ELSE YY.c_mktsegment END AS account_segment,
  CASE WHEN YY.c_nationkey = 2 THEN 'Store' ELSE 'Callcenter' END AS ASSaleChannel,
  IFNULL(SR.r_name, '') AS ReasonName,
  CASE WHEN ZZ.o_orderstatus IN ('F') THEN 'Yes' ELSE 'No' END AS IsOntime,
  CN.n_name AS CustomerNation, SN.n_name AS SupplierNation, M2.r_name AS CustomerRegion,
  B.s_name AS ProviderName, C.p_type AS ServiceName,
  W.n_shipped AS DayShipments,
  CASE WHEN r1 = 1 THEN 'Yes' ELSE 'No' END AS ISLastAction
FROM A
LEFT JOIN orders ZZ ON A.l_orderkey = ZZ.o_orderkey
LEFT JOIN customer YY ON ZZ.o_custkey = YY.c_custkey
LEFT JOIN supplier B ON A.l_suppkey = B.s_suppkey
LEFT JOIN (SELECT p_partkey, p_brand, p_type FROM part) C ON A.l_partkey = C.p_partkey
LEFT JOIN PS ON A.l_partkey = PS.ps_partkey AND A.l_suppkey = PS.ps_suppkey
LEFT JOIN events IN1 ON YY.c_custkey = IN1.user_id
LEFT JOIN nation CN ON YY.c_nationkey = CN.n_nationkey
LEFT JOIN nation SN ON B.s_nationkey = SN.n_nationkey
LEFT JOIN region M2 ON CN.n_regionkey = M2.r_regionkey
LEFT JOIN region SR ON SN.n_regionkey = SR.r_regionkey AND SR.r_name = 'EUROPE'
LEFT JOIN W ON CAST(A.l_shipdate AS DATE) = W.ship_date
""")
def multi_left_join_fact(spark, sf_dir):
    """Left joins from A to sides that do not depend on each other commute, so
    the order here is one in which few and narrow rows are shuffled: the
    dimensions of an order are joined to the orders, A goes through three
    exchanges, its narrow columns first, and the last, on the order, serves the
    flag, the orders and the DISTINCT."""
    t = Tables(spark, sf_dir)
    # A: delivery heads (the last-action flag, R7, comes with the orders), T9 predicate kept as written.
    A = t.lineitem.filter(F.col("l_returnflag").isNotNull()
                          & (F.substring("l_linestatus", 1, 2) != F.lit("SDO")))
    # De-duplicated subquery on two keys.
    PS = latest_per_key(t.lineitem, ["l_partkey", "l_suppkey"],
                        [F.col("l_shipdate").desc(), F.col("l_orderkey").desc(),
                         F.col("l_linenumber").desc()]).select(
        F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey"),
        F.col("l_quantity").alias("last_qty"))
    # J4 + J9: join on a derived date to a COUNT subquery.
    W = broadcast_reduced(count_by(t.lineitem, [F.to_date("l_shipdate").alias("ship_date")], "n_shipped"))
    ZZ = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                         "o_totalprice", "o_orderpriority")
    YY = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    B = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    C = t.part.select("p_partkey", "p_brand", "p_type")            # J7 pruned subquery
    # Each dimension is size-checked once; both of its roles reuse the result
    # (the broadcast hint survives the renaming projection).
    nation, region = maybe_broadcast(t.nation), maybe_broadcast(t.region)
    CN = prefixed(nation, "cn_")                                    # J5 roles of nation
    SN = prefixed(nation, "sn_")
    M2 = prefixed(region, "m2_")
    SR = prefixed(region, "sr_")
    # IN1 (events per customer) is never selected; under DISTINCT it cannot
    # change the result, so it is not joined.
    x = A.join(PS, (A["l_partkey"] == PS["ps_partkey"]) & (A["l_suppkey"] == PS["ps_suppkey"]), "left") \
        .drop("ps_partkey", "ps_suppkey")
    x = x.join(C, x["l_partkey"] == C["p_partkey"], "left").drop("p_partkey")
    x = flag_latest(x, ["l_orderkey"],
                    ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_linestatus"], "ISLastAction", among=A)
    # Null-safe as the flag's join, for the same partitioning; orders without a key are matched by none.
    ZZ = ZZ.filter(F.col("o_orderkey").isNotNull()).join(YY, ZZ["o_custkey"] == YY["c_custkey"], "left")
    x = x.join(ZZ, x["l_orderkey"].eqNullSafe(ZZ["o_orderkey"]), "left")
    # A few hundred thousand narrow rows: broadcast up to a bound of its own.
    x = left_join(x, B, x["l_suppkey"] == B["s_suppkey"], small=True, max_rows=SUPPLIER_ROWS)
    x = left_join(x, CN, x["c_nationkey"] == CN["cn_n_nationkey"])
    x = left_join(x, SN, x["s_nationkey"] == SN["sn_n_nationkey"])
    x = left_join(x, M2, x["cn_n_regionkey"] == M2["m2_r_regionkey"])
    # Constant predicate of the ON clause applied to the right side first.
    x = left_join(x, SR, x["sn_n_regionkey"] == SR["sr_r_regionkey"],
                  right_filter=F.col("sr_r_name") == "EUROPE")
    x = x.join(W, F.to_date(x["l_shipdate"]) == W["ship_date"], "left")
    out = x.select(
        F.col("l_orderkey").alias("BillDelivery"), "l_linenumber", "l_partkey", "l_suppkey",
        F.col("o_orderdate").alias("DeliveryDate"), F.col("o_orderstatus").alias("Status"),
        F.col("o_totalprice").alias("TotalAmount"), F.col("c_name").alias("CustomerName"),
        F.coalesce("last_qty", "l_quantity").alias("LastQuantity"),
        F.when(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "No").otherwise("Yes")
         .alias("IsCrossSale"),
        F.coalesce("p_brand", F.lit("No")).alias("hamper_flag"),
        F.substring("o_orderpriority", 1, 1).alias("Doc_Type"),
        F.when(F.coalesce("c_mktsegment", F.lit("")) == "", "Silver")
         .otherwise(F.col("c_mktsegment")).alias("account_segment"),
        F.when(F.col("c_nationkey") == 2, "Store").otherwise("Callcenter").alias("ASSaleChannel"),
        F.coalesce("sr_r_name", F.lit("")).alias("ReasonName"),
        F.when(F.col("o_orderstatus").isin("F"), "Yes").otherwise("No").alias("IsOntime"),
        F.col("cn_n_name").alias("CustomerNation"), F.col("sn_n_name").alias("SupplierNation"),
        F.col("m2_r_name").alias("CustomerRegion"), F.col("s_name").alias("ProviderName"),
        F.col("p_type").alias("ServiceName"), F.col("n_shipped").alias("DayShipments"),
        "ISLastAction",
        # the keys of the last exchange, functions of BillDelivery: with them DISTINCT needs no other
        F.coalesce("l_orderkey", F.lit(0).cast("bigint")).alias("_key"), F.isnull("l_orderkey").alias("_keyless"))
    return out.distinct().drop("_key", "_keyless")


@query("role_join_constant_predicate", ("J3", "J5", "R2"), oracle="""
WITH Ctl AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT user_id, event_type, CAST(ts AS DATE) AS ev_date, event_id, value,
           row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                              ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1)
SELECT A.event_id, A.user_id, A.ts,
       F.event_id AS click_event_id, F.value AS click_value,
       H.event_id AS view_event_id, IFNULL(H.value, 0) AS view_value,
       INF.c_name AS navigator_name,
       CASE WHEN IFNULL(INH.c_mktsegment, '') = '' THEN INH.c_name ELSE INH.c_mktsegment END AS staff_crc,
       M1.n_name AS dm_nation
FROM events A
LEFT JOIN Ctl F ON A.user_id = F.user_id AND CAST(A.ts AS DATE) = F.ev_date AND F.event_type = 'click'
LEFT JOIN customer INF ON F.user_id = INF.c_custkey
LEFT JOIN Ctl H ON A.user_id = H.user_id AND CAST(A.ts AS DATE) = H.ev_date AND H.event_type = 'view'
LEFT JOIN customer INH ON H.user_id = INH.c_custkey
LEFT JOIN nation M1 ON INF.c_nationkey = M1.n_nationkey
WHERE A.event_type = 'purchase'
""")
def role_join_constant_predicate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = t.events
    ctl = latest_per_key(ev.withColumn("ev_date", F.to_date("ts")),
                         ["user_id", "event_type", "ev_date"],
                         [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", "event_type", "ev_date", "event_id", "value")
    A = ev.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", F.to_date("ts").alias("a_date"))
    Fr = prefixed(ctl.filter(F.col("event_type") == "click"), "f_")   # J3
    Hr = prefixed(ctl.filter(F.col("event_type") == "view"), "h_")
    cust = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    INF, INH = prefixed(cust, "inf_"), prefixed(cust, "inh_")        # J5: one input, two roles
    M1 = prefixed(t.nation, "m1_")
    x = A.join(Fr, (A["user_id"] == Fr["f_user_id"]) & (A["a_date"] == Fr["f_ev_date"]), "left")
    x = x.join(INF, x["f_user_id"] == INF["inf_c_custkey"], "left")
    x = x.join(Hr, (x["user_id"] == Hr["h_user_id"]) & (x["a_date"] == Hr["h_ev_date"]), "left")
    x = x.join(INH, x["h_user_id"] == INH["inh_c_custkey"], "left")
    x = left_join(x, M1, x["inf_c_nationkey"] == M1["m1_n_nationkey"], small=True)
    return x.select(
        "event_id", "user_id", "ts",
        F.col("f_event_id").alias("click_event_id"), F.col("f_value").alias("click_value"),
        F.col("h_event_id").alias("view_event_id"),
        F.coalesce("h_value", F.lit(0.0)).alias("view_value"),
        F.col("inf_c_name").alias("navigator_name"),
        F.when(F.coalesce("inh_c_mktsegment", F.lit("")) == "", F.col("inh_c_name"))
         .otherwise(F.col("inh_c_mktsegment")).alias("staff_crc"),
        F.col("m1_n_name").alias("dm_nation"))


@query("join_on_derived_date", ("J4", "J9", "A1"), oracle="""
SELECT o.o_orderkey, o.o_orderdate, w.n_shipped
FROM orders o
LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS ship_date, COUNT(*) AS n_shipped
           FROM lineitem GROUP BY 1) w
ON CAST(o.o_orderdate AS DATE) = w.ship_date
""")
def join_on_derived_date(spark, sf_dir):
    t = Tables(spark, sf_dir)
    w = count_by(t.lineitem, [F.to_date("l_shipdate").alias("ship_date")], "n_shipped")
    o = t.orders.select("o_orderkey", "o_orderdate")
    return (o.join(w, F.to_date(o["o_orderdate"]) == w["ship_date"], "left")
             .select("o_orderkey", "o_orderdate", "n_shipped"))


def _dimension_inputs(t: Tables):
    s = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # ``c`` has many rows per part and would be the unsplittable side of the
    # left join; since the other sides are one row per part, pre-aggregating
    # ``c`` to its grouping grain first gives the same groups and maxima, and
    # a hot part is reduced in every map task before any shuffle.
    c = (t.lineitem.groupBy("l_partkey", "l_returnflag", "l_linestatus")
         .agg(F.max("l_shipdate").alias("l_shipdate"), F.max("l_quantity").alias("l_quantity")))
    i = latest_per_key(t.lineitem, ["l_partkey"],
                       [F.col("l_shipdate").desc(), F.col("l_suppkey").desc(),
                        F.col("l_orderkey").desc(), F.col("l_linenumber").desc()]).select(
        F.col("l_partkey").alias("i_partkey"), F.col("l_suppkey").alias("last_suppkey"))
    p = t.part.select(F.col("p_partkey").alias("pr_partkey"), F.col("p_retailprice").alias("price"))
    return s, c, i, p


_DIM_KEYS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "l_returnflag",
             "l_linestatus", "last_suppkey", "price"]

_DIM_SQL_FROM = """
FROM (SELECT * FROM part {where}) s
LEFT JOIN lineitem c ON s.p_partkey = c.l_partkey
LEFT JOIN (SELECT l_partkey AS i_partkey, l_suppkey AS last_suppkey
           FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC,
                        l_suppkey DESC, l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem)
           WHERE rn = 1) i ON s.p_partkey = i.i_partkey
LEFT JOIN (SELECT p_partkey AS pr_partkey, p_retailprice AS price FROM part) p
  ON s.p_partkey = p.pr_partkey
WHERE s.p_partkey IS NOT NULL
GROUP BY s.p_partkey, s.p_name, s.p_brand, s.p_type, s.p_size, c.l_returnflag, c.l_linestatus,
         i.last_suppkey, p.price
"""


@query("dimension_group_max", ("P8", "P9", "J8", "A2", "M16"), oracle="""
SELECT s.p_partkey, s.p_name, s.p_brand, s.p_type, s.p_size, c.l_returnflag, c.l_linestatus,
       i.last_suppkey, p.price, MAX(c.l_shipdate) AS last_shipdate,
       MAX(c.l_quantity) AS max_quantity
""" + _DIM_SQL_FROM.format(where="WHERE p_type IN ('ECONOMY', 'PROMO', 'STANDARD')"))
def dimension_group_max(spark, sf_dir):
    s, c, i, p = _dimension_inputs(Tables(spark, sf_dir))
    s = s.filter(F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD") & F.col("p_partkey").isNotNull())
    # Parallel left joins on one key.  ``c`` arrives pre-aggregated to the
    # grouping grain and ``i``/``p`` are one row per part, so no join fans out
    # and no hot part reaches a single task unreduced.
    x = (s.join(c, s["p_partkey"] == c["l_partkey"], "left")
          .join(i, s["p_partkey"] == i["i_partkey"], "left")
          .join(p, s["p_partkey"] == p["pr_partkey"], "left"))
    return group_max(x, _DIM_KEYS, {"last_shipdate": "l_shipdate", "max_quantity": "l_quantity"})


@query("dimension_distinct", ("J8", "A3", "M17"), oracle="""
SELECT s.p_partkey, s.p_name, s.p_brand, s.p_type, s.p_size, c.l_returnflag, c.l_linestatus,
       i.last_suppkey, p.price
""" + _DIM_SQL_FROM.format(where=""))
def dimension_distinct(spark, sf_dir):
    s, c, i, p = _dimension_inputs(Tables(spark, sf_dir))
    s = s.filter(F.col("p_partkey").isNotNull())
    x = (s.join(c, s["p_partkey"] == c["l_partkey"], "left")
          .join(i, s["p_partkey"] == i["i_partkey"], "left")
          .join(p, s["p_partkey"] == p["pr_partkey"], "left"))
    return group_distinct(x, _DIM_KEYS)


@query("predicates_membership", ("P1", "P8", "P9", "J12"), oracle="""
WITH active AS (
  SELECT o_custkey FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')
    AND o_totalprice IS NOT NULL AND o_orderstatus <> 'X')
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
       'active' AS membership
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM active)
UNION ALL
SELECT c_custkey, c_name, c_mktsegment, 'inactive'
FROM customer WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.o_custkey = customer.c_custkey)
""")
def predicates_membership(spark, sf_dir):
    t = Tables(spark, sf_dir)
    active = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                             & ~F.col("o_orderstatus").isin("P")
                             & F.col("o_totalprice").isNotNull()
                             & (F.col("o_orderstatus") != "X")).select(
        F.col("o_custkey").alias("c_custkey"))
    cust = t.customer.select(F.col("c_custkey"), F.col("c_name").alias("customer_name"),
                             F.col("c_mktsegment").alias("segment"))
    yes = semi(cust, active, "c_custkey").withColumn("membership", F.lit("active"))
    no = anti(cust, active, "c_custkey").withColumn("membership", F.lit("inactive"))
    return union_all([yes, no]).withColumnRenamed("c_custkey", "customer_id")

