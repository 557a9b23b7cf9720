"""The snapshot / mart models (M1-M18) over reference-shaped inputs.

Each model is ``model(inputs, cutoff, ...) -> DataFrame`` where ``inputs`` maps
input names to DataFrames carrying the source column names.  Ingestion-time
partitioned sources carry an explicit ``_partition_date`` DATE column, which
(like the warehouse pseudo-column) is not part of the model output.  The run
date is a typed ``datetime.date`` argument -- no SQL text substitution.

Write a result with ``tidemark.sinks.partitions.replace_partition`` to replace
the cut-off's day partition; ``backfill`` runs a model over a range of
cut-offs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import temporal as tf
from tidemark.functions.casts import float_to_int64
from tidemark.operators.aggregates import count_by, group_distinct, group_max
from tidemark.operators.joins import broadcast_reduced, left_join, only_keys, prefixed
from tidemark.operators.latest import flag_latest, latest_per_key
from tidemark.operators.migrate import backfill_latest
from tidemark.operators.quality import control_vs_data
from tidemark.operators.unions import aligned, union_all

PART = "_partition_date"
Inputs = Mapping[str, DataFrame]
#: Rows of the delivery fact (M18) in a task of its DISTINCT, about.
FACT_ROWS_PER_TASK = 100_000


def _desc(*cols: str) -> list[Column]:
    return [F.col(c).desc() for c in cols]


def _tiebreak(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Remaining columns, descending: makes ROW_NUMBER winners deterministic."""
    return [F.col(c).desc() for c in df.columns if c not in used]


def _to_int64(df: DataFrame, c: str) -> Column:
    t = dict(df.dtypes)[c]
    return float_to_int64(c) if t in ("double", "float") else F.col(c).cast("bigint")


# --------------------------------------------------------------- M1 --------

def data_vs_ctrl(inputs: Inputs, cutoff: dt.date, brand: str) -> DataFrame:
    """M1: control rows of the load day left-joined to loaded row counts.

    inputs: ``ctrl`` (table set of control files: JDA layout + ``_partition_date``),
    ``data`` (table set of data tables: ``table_name`` suffix + ``_partition_date``).
    """
    ctrl = inputs["ctrl"].filter(F.col(PART) == F.lit(cutoff))
    data = inputs["data"].filter(F.col(PART) == F.lit(cutoff))
    counts = count_by(data, [F.col("table_name"), F.col(PART).alias("data_date")], "data_row_count")
    return control_vs_data(ctrl, counts, brand)


# ---------------------------------------------------------- M2-M10 ---------

def accounting_stock_balance(inputs: Inputs, cutoff: dt.date, cut: str = "partition") -> DataFrame:
    """M2 (``cut='partition'``), M3 (``'parsed'``: PARSE_DATE('%y%m%d', INTRND)),
    M4 (``'compact'``: INTRND <= yymmdd).  Latest per (INSTOR, INSKU) by
    INTRND then partition date."""
    df = inputs["acstk"]
    if cut == "partition":
        df = df.filter(F.col(PART) <= F.lit(cutoff))
    elif cut == "parsed":
        df = df.filter(tf.parse_yymmdd("INTRND") <= F.lit(cutoff))
    elif cut == "compact":
        df = df.filter(F.col("INTRND") <= F.lit(tf.yymmdd_int_literal(cutoff)))
    else:
        raise ValueError(cut)
    order = _desc("INTRND", PART) + _tiebreak(df, ["INSTOR", "INSKU", "INTRND", PART])
    return latest_per_key(df, ["INSTOR", "INSKU"], order).drop(PART)


def _partition_cut(df: DataFrame, cutoff: dt.date, shifted: bool) -> DataFrame:
    # P5: DATE_SUB(part, 1) <= d  <=>  part <= d + 1 (prunes partitions either way)
    bound = cutoff + dt.timedelta(days=1) if shifted else cutoff
    return df.filter(F.col(PART) <= F.lit(bound))


def sku_snapshot(inputs: Inputs, cutoff: dt.date, shifted: bool = False) -> DataFrame:
    """M5 / M6: latest SKU row per INUMBR by EODDAT (shifted cut-off for M6)."""
    df = _partition_cut(inputs["sku"], cutoff, shifted)
    order = _desc("EODDAT", PART) + _tiebreak(df, ["INUMBR", "EODDAT", PART])
    return latest_per_key(df, ["INUMBR"], order).drop(PART)


def stock_balance(inputs: Inputs, cutoff: dt.date, shifted: bool = False) -> DataFrame:
    """M7 / M8: latest stock row per (XSTORE, XSKU) by EODDAT."""
    df = _partition_cut(inputs["stk"], cutoff, shifted)
    order = _desc("EODDAT", PART) + _tiebreak(df, ["XSTORE", "XSKU", "EODDAT", PART])
    return latest_per_key(df, ["XSTORE", "XSKU"], order).drop(PART)


def replenishment_profile(inputs: Inputs, cutoff: dt.date, eod_shift: int = 1) -> DataFrame:
    """M9 (``eod_shift=1``: EOD_Date = part - 1, shifted cut-off) and M10
    (``eod_shift=0``: EOD_Date = part, plain cut-off).  Latest per
    (INUMBR, ISTORE) by partition date."""
    df = _partition_cut(inputs["rplprf"], cutoff, shifted=eod_shift == 1)
    df = df.withColumn("EOD_Date", F.date_sub(F.col(PART), eod_shift))
    order = _desc(PART) + _tiebreak(df, ["INUMBR", "ISTORE", PART, "EOD_Date"])
    return latest_per_key(df, ["INUMBR", "ISTORE"], order).drop(PART)


# --------------------------------------------------------- M11-M13 ---------

def allocate_stock_bychannel(inputs: Inputs, cutoff: dt.date) -> DataFrame:
    """Latest per (allocate_type, product_id, CAST(sale_channel_id AS STRING))."""
    df = inputs["allocate"].filter(F.col("report_date") <= F.lit(cutoff))
    keys = [F.col("allocate_type"), F.col("product_id"), F.col("sale_channel_id").cast("string")]
    order = _desc("update_date") + _tiebreak(df, ["allocate_type", "product_id", "sale_channel_id",
                                                  "update_date"])
    return latest_per_key(df, keys, order)


def product_master_snapshot(inputs: Inputs, cutoff: dt.date) -> DataFrame:
    """Latest product master row per pid by updateon."""
    df = inputs["productmaster"].filter(F.col("report_date") <= F.lit(cutoff))
    order = _desc("updateon") + _tiebreak(df, ["pid", "updateon"])
    return latest_per_key(df, ["pid"], order)


PW_INT_COLS = ("onpw", "onrd", "onrt", "onpic", "onplt", "onpru", "onsale", "onhand")
PW_OUTPUT = ("amt", "pid", "onpw", "onrd", "onrt", "unit", "whid", "onpic", "onplt", "onpru",
             "pname", "onsale", "onhand", "whname", "avgcost", "storeid", "createby", "createon",
             "updateby", "updateon", "ordertype", "storename", "lastrcvdate", "createbyname",
             "updatebyname", "report_date", "run_date")


def _pw_output(ranked: DataFrame) -> list[Column]:
    cols = []
    for c in PW_OUTPUT:
        if c in PW_INT_COLS:
            cols.append(_to_int64(ranked, c).alias(c))
        elif c in ("createon", "updateon", "lastrcvdate"):
            cols.append(tf.truncate_to_second(c).alias(c))
        else:
            cols.append(F.col(c))
    return cols


def product_warehouse_snapshot(inputs: Inputs, cutoff: dt.date,
                               first_run: dt.date = dt.date(2022, 3, 10)) -> DataFrame:
    """Rows of a run-date window, latest per (PID, StoreID, WHID) by
    updateon, counts cast to INT64, datetimes truncated to seconds.  The order
    covers all columns, so rank 1 is the same row with or without the model's
    DISTINCT, which is left out: one shuffle, behind the partial group limit."""
    df = (inputs["productwarehouse"]
          .filter((F.col("run_date") >= F.lit(first_run)) & (F.col("report_date") <= F.lit(cutoff))))
    order = _desc("updateon") + _tiebreak(df, ["pid", "storeid", "whid", "updateon"])
    ranked = latest_per_key(df, ["pid", "storeid", "whid"], order)
    return ranked.select(*_pw_output(ranked))


# --------------------------------------------------------- M14-M15 ---------

PRODUCT_ATTRS = ("PIDOD", "DEPT_ID", "SUBDEPT_ID", "CLASS", "SUB_CLASS", "CATEGORY_ID",
                 "SUB_CATEGORY_ID", "BRAND_ID", "SUPPLIER_ID")


def product_base(inputs: Inputs, cutoff: dt.date, master_date_col: str = "updateon") -> DataFrame:
    """Product history UNION ALL the current master, up to the cut-off."""
    hist = inputs["product_history"].filter(F.col("TRANS_DATE") <= F.lit(cutoff))
    history = aligned(hist, {
        "PID": "PID", "PIDOD": F.col("PIdOD").cast("string"),
        "DEPT_ID": F.col("DEPT_ID").cast("string"), "SUBDEPT_ID": F.col("SUBDEPT_ID").cast("string"),
        "CLASS": F.col("CLASS").cast("string"), "SUB_CLASS": F.col("SUB_CLASS").cast("string"),
        "CATEGORY_ID": "CATEGORY_ID", "SUB_CATEGORY_ID": "SUB_CATEGORY_ID", "BRAND_ID": "BRAND_ID",
        "SUPPLIER_ID": "SUPPLIER_ID", "TRANS_DATE": F.to_date("TRANS_DATE")})
    master = inputs["productmaster"].filter(F.to_date(master_date_col) <= F.lit(cutoff))
    current = aligned(master, {
        "PID": "pid", "PIDOD": F.col("pidod").cast("string"), "DEPT_ID": F.col("dept").cast("string"),
        "SUBDEPT_ID": F.col("sub_dpt").cast("string"), "CLASS": F.col("class").cast("string"),
        "SUB_CLASS": F.col("sub_cls").cast("string"), "CATEGORY_ID": "catid",
        "SUB_CATEGORY_ID": "subcatid", "BRAND_ID": "brandid", "SUPPLIER_ID": "lastsupplierid",
        "TRANS_DATE": F.to_date(master_date_col)})
    return union_all([history, current.select(*history.columns)])


def latest_product_info(inputs: Inputs, cutoff: dt.date, master_date_col: str = "updateon",
                        pids: DataFrame | None = None) -> DataFrame:
    """U1 + R1: product history UNION ALL the current master, newest TRANS_DATE
    per PID.  The rank comes before any join, so each map task sends at most
    one row per PID; with ``pids`` (one column) only those products are ranked,
    as long as their number is proven small enough to be broadcast."""
    base = product_base(inputs, cutoff, master_date_col)
    if pids is not None:
        base = only_keys(base, "PID", pids)
    order = [F.col("TRANS_DATE").desc()] + [F.col(c).desc() for c in PRODUCT_ATTRS]
    return latest_per_key(base, ["PID"], order)


def _enrich(detail: DataFrame, dim: DataFrame) -> DataFrame:
    d = dim.select(F.col("PID").alias("_dim_pid"), *PRODUCT_ATTRS)
    return (detail.join(d, detail["pid"] == d["_dim_pid"], "left")
                  .select(*[detail[c] for c in detail.columns], *PRODUCT_ATTRS))


def product_detail(inputs: Inputs, cutoff: dt.date, detail_cols: Sequence[str],
                   detail_date_col: str = "createon", master_date_col: str = "updateon") -> DataFrame:
    """M14 (7 models): the day's document detail rows (``CAST(date_col AS DATE)
    = cutoff``) enriched with the latest product attributes (P3: ``t.*`` plus
    the product columns).  ``soivdelt`` uses ``master_date_col='createon'``."""
    det = inputs["detail"]
    detail = (det.filter(F.to_date(detail_date_col) == F.lit(cutoff))
              .select(*[F.col(c) for c in detail_cols if c != detail_date_col],
                      F.to_date(detail_date_col).alias(detail_date_col)))
    return _enrich(detail, latest_product_info(inputs, cutoff, master_date_col, detail.select("pid")))


def month_end_of_ym(c: str) -> Column:
    """``LAST_DAY(PARSE_DATE('%Y%m%d', CONCAT(REGEXP_REPLACE(ym, '[^0-9]+', ''), '01')))``."""
    digits = F.concat(F.regexp_replace(F.col(c).cast("string"), r"[^0-9]+", ""), F.lit("01"))
    return F.last_day(F.to_date(digits, "yyyyMMdd"))


def productwarehouse_product_detail(inputs: Inputs, cutoff: dt.date) -> DataFrame:
    """The day's product-warehouse snapshot (M13 output, ingestion day =
    cutoff) UNION ALL the month-end history (latest per pid, storeid, month end
    by updateon; R6 key without WHID), enriched with latest product info."""
    snap = inputs["pw_snapshot"].filter(F.col(PART) == F.lit(cutoff)).select(
        F.col("pid").alias("PID"), F.col("storeid").alias("StoreID"), F.col("whid").alias("WHID"),
        F.col(PART).alias("file_date"))
    hist = inputs["pw_history"].withColumn("file_date", month_end_of_ym("ymdata"))
    hist = hist.filter(F.col("file_date") == F.lit(cutoff))
    order = _desc("updateon") + _tiebreak(hist, ["pid", "storeid", "file_date", "updateon"])
    month_end = latest_per_key(hist, ["pid", "storeid", "file_date"], order).select(
        F.col("pid").alias("PID"), F.col("storeid").alias("StoreID"), F.col("whid").alias("WHID"),
        "file_date")
    detail = union_all([snap, month_end]).withColumnRenamed("PID", "pid")
    return _enrich(detail, latest_product_info(inputs, cutoff, "updateon"))  # a warehouse holds most products


# --------------------------------------------------------- M16-M17 ---------

DIM_KEYS_V1 = ("sku_id", "code", "type", "create_info_timestamp", "update_info_timestamp",
               "channel_id", "channel_display_name_th", "channel_display_name_en", "size", "url",
               "cdn_url", "price_type", "price_exclude_vat", "price_include_vat")
DIM_KEYS_V2 = tuple(k for k in DIM_KEYS_V1 if k not in ("create_info_timestamp",
                                                        "update_info_timestamp"))


def _dim_sides(inputs: Inputs, skus: DataFrame) -> DataFrame:
    """``skus`` left joined with channels, images and prices on sku_id.

    Each side is made distinct first (a partial aggregate, so repeated rows of
    a hot sku are united in the map tasks); the outputs below are distinct
    anyway, and distinct sides joined to distinct skus stay distinct.
    """
    sides = {"channels": ("channel_id", "channel_display_name_th", "channel_display_name_en"),
             "images": ("size", "url", "cdn_url"),
             "price": ("price_type", "price_exclude_vat", "price_include_vat")}
    for name, cols in sides.items():
        skus = skus.join(inputs[name].select("sku_id", *cols).distinct(), "sku_id", "left")
    return skus


def dim_product_attribute(inputs: Inputs, sku_ids: Sequence[str] | None = None) -> DataFrame:
    """Three parallel left joins on sku_id, GROUP BY 14 columns,
    MAX(report_date), MAX(run_date).  The original restricts to a list of
    sku ids (pass ``sku_ids``).  The maxima come from the sku rows alone, so
    they are taken before the joins."""
    s = inputs["skucodes"].filter(F.col("sku_id").isNotNull())
    if sku_ids is not None:
        s = s.filter(F.col("sku_id").isin(*sku_ids))
    s = group_max(s, DIM_KEYS_V1[:5], {"report_date": "report_date", "run_date": "run_date"})
    return _dim_sides(inputs, s).select(*DIM_KEYS_V1, "report_date", "run_date")


def dim_product_attribute_v2(inputs: Inputs) -> DataFrame:
    """Same joins, GROUP BY 12 columns and no aggregate (distinct)."""
    s = inputs["skucodes"].filter(F.col("sku_id").isNotNull())
    s = group_distinct(s, DIM_KEYS_V2[:3])
    return _dim_sides(inputs, s).select(*DIM_KEYS_V2)


# ---------------------------------------------------------------- M18 ------

def fact_transport_daily(inputs: Inputs) -> DataFrame:
    """The delivery fact -- 17 left joins from the delivery heads, CASE /
    IFNULL columns, DISTINCT.  Inputs: deliveryhead, ssohead, sohead, provider,
    service, deliveryconfirm, jobreason, deliverycontrol, employee, groupservice,
    vehicle_master, vehicle, fleet, account (``usermaster`` is accepted but, as
    no column of it is selected, it cannot change the DISTINCT result -- J11)."""
    i = inputs
    ctl = latest_per_key(i["deliverycontrol"], ["company", "VehicleID", "PositionID", "DeliveryDate"],
                         _desc("UpdateOn") + _tiebreak(i["deliverycontrol"],
                                                       ["company", "VehicleID", "PositionID",
                                                        "DeliveryDate", "UpdateOn"]))
    heads = i["deliveryhead"].filter(F.col("TrackingNo").isNotNull()
                                     & (F.substring("DocumentNo", 1, 2) != F.lit("SDO")))
    # r1 = 1 for the newest delivery of each DocumentNo (order made unique).
    A = flag_latest(heads, ["DocumentNo"], ["DeliveryDate", "TrackingNo"], "ISLastAction")
    ZZ = prefixed(i["ssohead"].select("SSONo", "company", "sono", "WHID"), "zz_")
    YY = prefixed(i["sohead"], "yy_")
    B = prefixed(i["provider"].select("ProviderID", "ProviderName", "ProviderShortName"), "b_")
    C = prefixed(i["service"].select("ServiceID", "GroupID", "serviceName", "DeliveryType"), "c_")
    D = prefixed(i["deliveryconfirm"].select("TrackingNo", "company", "ReasonID", "ReasonName"), "d_")
    E = prefixed(i["jobreason"].select("ReasonID", "ReasonFrom", "ReasonName"), "e_")
    emp = i["employee"].select("EmployeeID", "CRCID")
    INF, INH, M1 = prefixed(emp, "inf_"), prefixed(emp, "inh_"), prefixed(emp, "m1_")
    M2 = prefixed(i["groupservice"].select("GroupID", "GroupName"), "m2_")
    G = prefixed(latest_per_key(i["vehicle_master"], ["VehicleID"],
                                _desc("Effective_Date") + _tiebreak(i["vehicle_master"],
                                                                    ["VehicleID", "Effective_Date"]))
                 .select("VehicleID", "sub_cluster"), "g_")
    V = prefixed(i["vehicle"].select("LicenseNo", "VehicleID", "VehicleName", "VehicleType"), "v_")
    W = prefixed(i["fleet"].select("DeliveryDate", "LicenseNo", "VehicleID",
                                   F.col("FleetName").alias("VehicleName"),
                                   F.col("FleetContract").alias("VehicleType")), "w_")
    AM = prefixed(i["account"].select("account_id", "account_segment"), "am_")

    # What hangs on a looked-up row is joined to that row, not to the heads: the same rows, and the
    # heads go through an exchange only for sides too large to broadcast.  On keys of few values
    # (vehicle, provider, service) an exchange would bring a large share of them into one task.
    ZZ = ZZ.join(YY, (ZZ["zz_sono"] == YY["yy_so_no"]) & (ZZ["zz_company"] == YY["yy_company"]), "left")
    C = C.join(M2, C["c_GroupID"] == M2["m2_GroupID"], "left")
    D = left_join(D, broadcast_reduced(E), D["d_ReasonID"] == E["e_ReasonID"])
    F_ = prefixed(ctl.filter(F.col("PositionID") == "3"), "f_")              # J3 + J5
    H_ = prefixed(ctl.filter(F.col("PositionID") == "4"), "h_")
    F_ = F_.join(INF, F_["f_EmployeeID"] == INF["inf_EmployeeID"], "left")
    F_ = F_.join(M1, F_["f_DMEmployeeID"] == M1["m1_EmployeeID"], "left")
    H_ = H_.join(INH, H_["h_EmployeeID"] == INH["inh_EmployeeID"], "left")
    F_, H_ = (side.select(*[c for c in side.columns if c[2:] not in ("PositionID", "UpdateOn")]) for side in (F_, H_))

    x = A.join(ZZ, (A["DocumentNo"] == ZZ["zz_SSONo"]) & (A["company"] == ZZ["zz_company"]), "left")
    x = x.join(AM, x["CustomerID"] == AM["am_account_id"], "left")
    # The last exchange also serves the DISTINCT, whose hash tables hold a task's rows at full width,
    # so its tasks are bounded by rows and not by their (compressed, narrow) bytes.
    tasks = max(int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-heads.count() // FACT_ROWS_PER_TASK))
    x = x.repartition(tasks, "TrackingNo", "company")
    x = x.join(D, (x["TrackingNo"] == D["d_TrackingNo"]) & (x["company"] == D["d_company"]), "left")
    x = left_join(x, broadcast_reduced(B), x["ProviderID"] == B["b_ProviderID"])
    x = left_join(x, broadcast_reduced(C), x["ServiceType"] == C["c_ServiceID"])
    x = left_join(x, broadcast_reduced(F_), (x["VehicleID"] == F_["f_VehicleID"]) & (x["DeliveryDate"] == F_["f_DeliveryDate"])
                  & (x["company"] == F_["f_company"]))
    x = left_join(x, broadcast_reduced(H_), (x["VehicleID"] == H_["h_VehicleID"]) & (x["DeliveryDate"] == H_["h_DeliveryDate"])
                  & (x["company"] == H_["h_company"]))
    x = left_join(x, broadcast_reduced(G), x["VehicleID"] == G["g_VehicleID"])
    x = left_join(x, broadcast_reduced(V), x["VehicleID"] == V["v_VehicleID"])
    x = left_join(x, broadcast_reduced(W), (x["VehicleID"] == W["w_VehicleID"])
                  & (F.to_date(x["DeliveryDate"]) == F.to_date(W["w_DeliveryDate"])))

    def crc(p: str) -> Column:
        return (F.when(F.coalesce(F.col(f"{p}_CRCID"), F.lit("")) == "", F.col(f"{p}_EmployeeID"))
                 .otherwise(F.col(f"{p}_CRCID")))

    out = x.select(
        F.col("company").alias("COMPANYNAME"), F.col("TrackingNo").alias("BillDelivery"),
        "DocumentNo", "DeliveryDate", "RefDocumentNo", "RefDocumentNo2", "RefDocumentNo3",
        "CustomerID", "CustomerName", F.col("JobRemark").alias("Remark"), "TotalAmount",
        F.col("yy_reptsale_id").alias("reptsale_id"), "Status", "ClusterID", "SubClusterID",
        "VehicleID",
        F.coalesce("w_LicenseNo", "v_LicenseNo").alias("LicenseNo"),
        F.coalesce("w_VehicleName", "v_VehicleName").alias("VehicleName"),
        F.coalesce("w_VehicleType", "v_VehicleType").alias("VehicleType"),
        F.col("c_GroupID").alias("GroupID"), F.col("m2_GroupName").alias("GroupName"),
        F.col("c_serviceName").alias("serviceName"), "ReDeliveryFlag", "ISCustVIP", "IsShipWithINV",
        F.when(~F.col("yy_reptsale_id").isin("BU3", "BU4"), "No").otherwise("Yes").alias("IsCrossSale"),
        F.coalesce("yy_hamper_flag", F.lit("No")).alias("hamper_flag"),
        "VehiclePlanID", F.col("VehicleID").alias("Truck"),
        F.col("b_ProviderName").alias("ProviderName"),
        F.col("b_ProviderShortName").alias("ProviderShortName"), "ServiceType",
        F.col("c_DeliveryType").alias("DeliveryType"), F.col("yy_order_type").alias("order_type"),
        F.substring("DocumentNo", 1, 2).alias("Doc_Type"),
        F.when(F.coalesce("am_account_segment", F.lit("")) == "", "Silver")
         .otherwise(F.col("am_account_segment")).alias("account_segment"),
        F.when(F.col("yy_sale_channel_id") == 2, "Store").otherwise("Callcenter").alias("ASSaleChannel"),
        F.col("yy_sale_channel_name").alias("sale_channel_name"),
        F.col("yy_sale_method_name").alias("sale_method_name"),
        F.coalesce("e_ReasonFrom", F.lit("")).alias("ReasonFrom"),
        F.coalesce("e_ReasonName", F.lit("")).alias("ReasonName"),
        crc("inf").alias("NavigatorCRC"), F.col("f_EmployeeName").alias("NavigatorName"),
        crc("inh").alias("StaffCRC"), F.coalesce("h_EmployeeName", F.lit("")).alias("StaffName"),
        F.col("f_DMEmployeeID").alias("DMEmployeeID"), F.col("m1_CRCID").alias("DMCRCID"),
        F.col("f_DMEmployeeName").alias("DMEmployeeName"),
        F.when(F.col("Status").isin("Completed", "CompletedPartial"), "Yes").otherwise("No").alias("IsOntime"),
        F.when(F.col("g_sub_cluster") == "BDC", "BDC").otherwise("").alias("BDC"),
        F.col("zz_WHID").alias("WHID"), "ISLastAction",
        F.col("yy_telesale_id").alias("telesale_id"), F.col("yy_telesale_name").alias("telesale_name"),
        F.col("ParkCode").alias("ShipArea"), F.col("ZoneID").alias("ShipSubArea"), "ParkCode",
        F.col("yy_ship_sub_area").alias("ship_sub_area"), F.col("yy_payment_code").alias("payment_code"),
        F.col("yy_payment_type").alias("payment_type"), F.col("yy_payment_name").alias("payment_name"),
        F.col("d_ReasonID").alias("ReasonID"), F.col("d_ReasonName").alias("TMSReasonName"),
        F.col("yy_franchise_order_type").alias("franchise_order_type"))
    return out.distinct()


# ------------------------------------------------- many cut-offs at once ---

def _at_cutoffs(df: DataFrame, keys: Sequence[str], visible: Column, order: Sequence[str],
                cutoffs: Sequence[dt.date], drop: Sequence[str] = ()) -> DataFrame:
    """Rank 1 per key at every cut-off, as ``cutoff`` and the rows' columns.

    Ties go to the largest other columns, as in the one-day models."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    out = backfill_latest(df.withColumn("__visible", visible), keys, "__visible", [*order, *rest], cutoffs)
    return out.select("cutoff", *(c for c in df.columns if c not in drop))


def accounting_stock_balance_at(inputs: Inputs, cutoffs: Sequence[dt.date], cut: str = "partition") -> DataFrame:
    """M2-M4 at every cut-off, in one pass over the history."""
    visible = {"partition": F.col(PART), "parsed": tf.parse_yymmdd("INTRND"),
               "compact": _compact_date("INTRND", cutoffs)}[cut]
    return _at_cutoffs(inputs["acstk"], ["INSTOR", "INSKU"], visible, ["INTRND", PART], cutoffs, [PART])


def _compact_date(c: str, cutoffs: Sequence[dt.date]) -> Column:
    """M4 compares integers: the first cut-off whose yymmdd is not below the column."""
    first = F.lit(None).cast("date")
    for day in sorted(cutoffs, reverse=True):
        first = F.when(F.col(c) <= F.lit(tf.yymmdd_int_literal(day)), F.lit(day)).otherwise(first)
    return first


def product_warehouse_snapshot_at(inputs: Inputs, cutoffs: Sequence[dt.date], first_run: dt.date = dt.date(2022, 3, 10)) -> DataFrame:
    """M13 at every cut-off, in one pass over the history."""
    df = inputs["productwarehouse"].filter(F.col("run_date") >= F.lit(first_run))
    ranked = _at_cutoffs(df, ["pid", "storeid", "whid"], F.col("report_date"), ["updateon"], cutoffs)
    return ranked.select("cutoff", *_pw_output(ranked))


def product_detail_at(inputs: Inputs, cutoffs: Sequence[dt.date], detail_cols: Sequence[str],
                      detail_date_col: str = "createon", master_date_col: str = "updateon") -> DataFrame:
    """M14 at every cut-off: each day's detail rows with the product as it was
    known on that day.  Each product is ranked once for all cut-offs, and only
    those that the days' details name, if they are few enough."""
    days = [F.lit(c) for c in cutoffs]
    detail = (inputs["detail"].filter(F.to_date(detail_date_col).isin(days))
              .select(F.to_date(detail_date_col).alias("cutoff"), *[F.col(c) for c in detail_cols if c != detail_date_col],
                      F.to_date(detail_date_col).alias(detail_date_col)))
    base = only_keys(product_base(inputs, max(cutoffs), master_date_col), "PID", detail.select("pid"))
    known = backfill_latest(base, ["PID"], "TRANS_DATE", ["TRANS_DATE", *PRODUCT_ATTRS], cutoffs)
    known = known.select(F.col("cutoff").alias("_dim_day"), F.col("PID").alias("_dim_pid"), *PRODUCT_ATTRS)
    return (detail.join(known, (detail["pid"] == known["_dim_pid"]) & (detail["cutoff"] == known["_dim_day"]), "left")
                  .select(*[detail[c] for c in detail.columns], *PRODUCT_ATTRS))


# ------------------------------------------------------------ backfill -----

def backfill(model: Callable[..., DataFrame], inputs: Inputs, run_date: dt.date, start: int,
             end: int, write: Callable[[DataFrame, dt.date], None], **kwargs) -> list[dt.date]:
    """Run ``model`` for cut-offs ``run_date - start`` ... ``run_date - end``
    (offsets in days, in either order), oldest first, each replacing its own partition via
    ``write(df, cutoff)``.  For latest-per-key models over many cut-offs,
    ``tidemark.operators.migrate.backfill_latest`` does all cut-offs in one pass."""
    cutoffs = [run_date - dt.timedelta(days=o) for o in range(max(start, end), min(start, end) - 1, -1)]
    for c in cutoffs:
        write(model(inputs, c, **kwargs), c)
    return cutoffs
