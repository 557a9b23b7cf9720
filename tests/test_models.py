import datetime as dt

from tidemark.plans import models as M

D = dt.date


def test_accounting_stock_variants(spark):  # M2, M3, M4
    acstk = spark.createDataFrame([
        ("S1", "K1", 240103, D(2024, 1, 3), 1.0), ("S1", "K1", 240105, D(2024, 1, 5), 2.0),
        ("S1", "K1", 991231, D(2024, 1, 4), 9.0)],
        "INSTOR string, INSKU string, INTRND int, _partition_date date, qty double")
    inputs = {"acstk": acstk}
    assert M.accounting_stock_balance(inputs, D(2024, 1, 4)).first().qty == 9.0          # INTRND 991231 wins
    # parsed: 991231 is 1999-12-31, visible, and has the largest INTRND
    assert M.accounting_stock_balance(inputs, D(2024, 1, 4), "parsed").first().qty == 9.0
    assert M.accounting_stock_balance(inputs, D(2024, 1, 4), "compact").first().qty == 1.0
    assert "_partition_date" not in M.accounting_stock_balance(inputs, D(2024, 1, 4)).columns


def test_replenishment_eod(spark):  # M9, M10
    r = spark.createDataFrame([("A", "1", D(2024, 1, 5)), ("A", "1", D(2024, 1, 6))],
                              "INUMBR string, ISTORE string, _partition_date date")
    assert M.replenishment_profile({"rplprf": r}, D(2024, 1, 5)).first().EOD_Date == D(2024, 1, 5)
    assert M.replenishment_profile({"rplprf": r}, D(2024, 1, 5), eod_shift=0).first().EOD_Date == D(2024, 1, 5)


def test_product_detail_enrichment(spark):  # M14
    hist = spark.createDataFrame([(1, 10, 1, 2, 3, 4, "c", "sc", "b", "s0", D(2020, 1, 1))],
                                 "PID long, PIdOD long, DEPT_ID long, SUBDEPT_ID long, CLASS long, SUB_CLASS long, "
                                 "CATEGORY_ID string, SUB_CATEGORY_ID string, BRAND_ID string, SUPPLIER_ID string, TRANS_DATE date")
    master = spark.createDataFrame([(1, "11", "d", "sd", "cl", "scl", "c", "sc", "b", "s1",
                                     dt.datetime(2024, 1, 4, 8), dt.datetime(2024, 1, 1)),
                                    (1, "12", "d", "sd", "cl", "scl", "c", "sc", "b", "s2",
                                     dt.datetime(2024, 1, 9, 8), dt.datetime(2024, 1, 1))],
                                   "pid long, pidod string, dept string, sub_dpt string, class string, sub_cls string, "
                                   "catid string, subcatid string, brandid string, lastsupplierid string, "
                                   "updateon timestamp_ntz, createon timestamp_ntz")
    detail = spark.createDataFrame([("RD1", 1, 1, dt.datetime(2024, 1, 5, 9))],
                                   "RDNo string, Seqno int, pid long, createon timestamp_ntz")
    out = M.product_detail({"product_history": hist, "productmaster": master, "detail": detail},
                           D(2024, 1, 5), ["RDNo", "Seqno", "pid", "createon"]).first()
    assert (out.RDNo, out.PIDOD, out.SUPPLIER_ID, out.createon) == ("RD1", "11", "s1", D(2024, 1, 5))


def test_dim_product_attribute(spark):  # M16, M17
    s = spark.createDataFrame([("Y1", "c", "t", 1, 2, D(2024, 1, 1), D(2024, 1, 2)),
                               ("Y1", "c", "t", 1, 2, D(2024, 1, 3), D(2024, 1, 4))],
                              "sku_id string, code string, type string, create_info_timestamp int, "
                              "update_info_timestamp int, report_date date, run_date date")
    c = spark.createDataFrame([("Y1", 1, "th", "en"), ("Y1", 2, "th2", "en2")],
                              "sku_id string, channel_id int, channel_display_name_th string, channel_display_name_en string")
    i = spark.createDataFrame([("Y1", "s", "u", "cdn")], "sku_id string, size string, url string, cdn_url string")
    p = spark.createDataFrame([("Y1", "n", 1.0, 1.07)], "sku_id string, price_type string, price_exclude_vat double, price_include_vat double")
    inputs = {"skucodes": s, "channels": c, "images": i, "price": p}
    v1 = M.dim_product_attribute(inputs, ["Y1"]).collect()
    assert len(v1) == 2 and {r.report_date for r in v1} == {D(2024, 1, 3)}
    assert M.dim_product_attribute_v2(inputs).count() == 2


def test_fact_transport_daily(spark):  # M18
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)
    ts = dt.datetime(2024, 1, 5, 10)
    head = df([("C", "TR1", "DOC1", ts, "r1", "r2", "r3", "CU1", "Cust", "rem", 10.0, "Completed", "cl", "scl",
                "V1", "N", "Y", "Y", "VP1", "P1", "S1", "PK", "Z1")],
              "company string, TrackingNo string, DocumentNo string, DeliveryDate timestamp_ntz, RefDocumentNo string, "
              "RefDocumentNo2 string, RefDocumentNo3 string, CustomerID string, CustomerName string, JobRemark string, "
              "TotalAmount double, Status string, ClusterID string, SubClusterID string, VehicleID string, "
              "ReDeliveryFlag string, ISCustVIP string, IsShipWithINV string, VehiclePlanID string, ProviderID string, "
              "ServiceType string, ParkCode string, ZoneID string")
    inputs = {
        "deliveryhead": head,
        "ssohead": df([("DOC1", "C", "SO1", "W1")], "SSONo string, company string, sono string, WHID string"),
        "sohead": df([("SO1", "C", None, "Y", "ord", 2, "scn", "smn", "T1", "TN", "ssa", "pc", "pt", "pn", "fot")],
                     "so_no string, company string, reptsale_id string, hamper_flag string, order_type string, "
                     "sale_channel_id int, sale_channel_name string, sale_method_name string, telesale_id string, "
                     "telesale_name string, ship_sub_area string, payment_code string, payment_type string, "
                     "payment_name string, franchise_order_type string"),
        "provider": df([("P1", "Prov", "Pv")], "ProviderID string, ProviderName string, ProviderShortName string"),
        "service": df([("S1", "G1", "svc", "dt")], "ServiceID string, GroupID string, serviceName string, DeliveryType string"),
        "deliveryconfirm": df([("TR1", "C", "R1", "rn")], "TrackingNo string, company string, ReasonID string, ReasonName string"),
        "jobreason": df([("R1", "from", "why")], "ReasonID string, ReasonFrom string, ReasonName string"),
        "deliverycontrol": df([("C", "V1", "3", ts, ts, "E1", "Nav", "E3", "DM"),
                               ("C", "V1", "3", ts, ts - dt.timedelta(hours=1), "E9", "Old", "E3", "DM")],
                              "company string, VehicleID string, PositionID string, DeliveryDate timestamp_ntz, "
                              "UpdateOn timestamp_ntz, EmployeeID string, EmployeeName string, DMEmployeeID string, "
                              "DMEmployeeName string"),
        "employee": df([("E1", ""), ("E3", "CRC3")], "EmployeeID string, CRCID string"),
        "groupservice": df([("G1", "grp")], "GroupID string, GroupName string"),
        "vehicle_master": df([("V1", "BDC", D(2024, 1, 1))], "VehicleID string, sub_cluster string, Effective_Date date"),
        "vehicle": df([("L1", "V1", "vn", "vt")], "LicenseNo string, VehicleID string, VehicleName string, VehicleType string"),
        "fleet": df([(ts, "L2", "V1", "fn", "fc")], "DeliveryDate timestamp_ntz, LicenseNo string, VehicleID string, FleetName string, FleetContract string"),
        "account": df([("CU1", "")], "account_id string, account_segment string"),
    }
    r = M.fact_transport_daily(inputs).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.IsCrossSale, r.LicenseNo, r.NavigatorCRC, r.NavigatorName, r.StaffName, r.DMCRCID) == \
        ("Yes", "L2", "E1", "Nav", "", "CRC3")
    assert (r.account_segment, r.ASSaleChannel, r.IsOntime, r.BDC, r.ISLastAction, r.Doc_Type) == \
        ("Silver", "Store", "Yes", "BDC", "Yes", "DO")


def test_backfill_writes_each_cutoff(spark, tmp_shared):  # G6
    from tidemark.sinks.partitions import replace_partition

    pm = spark.createDataFrame([(1, dt.datetime(2024, 1, d), D(2024, 1, d), d) for d in (1, 3, 5)],
                               "pid int, updateon timestamp_ntz, report_date date, v int")
    written = M.backfill(M.product_master_snapshot, {"productmaster": pm}, D(2024, 1, 6), 4, 1,
                         lambda df, c: replace_partition(df.drop("report_date"), tmp_shared, "cutoff", c))
    assert written == [D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)]
    got = {r.cutoff: r.v for r in spark.read.parquet(tmp_shared).collect()}
    assert got == {D(2024, 1, 2): 1, D(2024, 1, 3): 3, D(2024, 1, 4): 3, D(2024, 1, 5): 5}
