"""The full delivery fact model (M18) run on inputs derived from ``orders`` and
``customer``.

Each input is defined once as a small SQL template valid in both engines.
Spark evaluates it with ``spark.sql(template, orders=df, ...)`` (DataFrame
arguments), DuckDB with the table views.  The oracle states the model's rules
over the same inputs in another form than the model: one relation per looked-up
thing, winners by ``max`` of a struct.
"""

from __future__ import annotations

from tidemark.catalog import Tables
from tidemark.plans import models as M
from tidemark.plans.registry import query

P = "substr(o_orderpriority, 1, 1)"

INPUTS = {
    "deliveryhead": f"""
SELECT o_orderstatus AS company, 'TR' || CAST(o_orderkey AS STRING) AS TrackingNo,
       'SO' || CAST(o_custkey AS STRING) AS DocumentNo, o_orderdate AS DeliveryDate,
       CAST(o_orderkey AS STRING) AS RefDocumentNo, o_orderpriority AS RefDocumentNo2,
       CAST(NULL AS STRING) AS RefDocumentNo3, 'C' || CAST(o_custkey AS STRING) AS CustomerID,
       'Cust' || CAST(o_custkey AS STRING) AS CustomerName, o_orderpriority AS JobRemark,
       o_totalprice AS TotalAmount,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'CompletedPartial' ELSE 'Open' END AS Status,
       {P} AS ClusterID, o_orderstatus AS SubClusterID, 'V' || {P} AS VehicleID,
       'N' AS ReDeliveryFlag, CASE WHEN o_totalprice > 300000 THEN 'Y' ELSE 'N' END AS ISCustVIP,
       'Y' AS IsShipWithINV, 'VP' || CAST(year(o_orderdate) AS STRING) AS VehiclePlanID,
       'P' || {P} AS ProviderID, 'S' || o_orderstatus AS ServiceType, 'PK' || {P} AS ParkCode,
       'Z' || o_orderstatus AS ZoneID
FROM {{orders}}""",
    "ssohead": """
SELECT DISTINCT 'SO' || CAST(o_custkey AS STRING) AS SSONo, o_orderstatus AS company,
       'S' || CAST(o_custkey AS STRING) || o_orderstatus AS sono, 'W' || o_orderstatus AS WHID
FROM {orders}""",
    "sohead": """
SELECT DISTINCT 'S' || CAST(o_custkey AS STRING) || o_orderstatus AS so_no, o_orderstatus AS company,
       CASE o_orderstatus WHEN 'F' THEN 'BU3' WHEN 'O' THEN 'BU1' END AS reptsale_id,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'Y' END AS hamper_flag,
       'OT' || o_orderstatus AS order_type,
       CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END AS sale_channel_id,
       'channel ' || o_orderstatus AS sale_channel_name, 'method ' || o_orderstatus AS sale_method_name,
       'T' || CAST(o_custkey AS STRING) AS telesale_id, 'Tele ' || CAST(o_custkey AS STRING) AS telesale_name,
       'SSA' || o_orderstatus AS ship_sub_area, 'PC' || o_orderstatus AS payment_code,
       'PT' || o_orderstatus AS payment_type, 'PN' || o_orderstatus AS payment_name,
       'FOT' || o_orderstatus AS franchise_order_type
FROM {orders}""",
    "provider": f"""
SELECT DISTINCT 'P' || {P} AS ProviderID, 'Provider ' || {P} AS ProviderName,
       'Pv' || {P} AS ProviderShortName
FROM {{orders}} WHERE {P} <> '5'""",
    "service": """
SELECT DISTINCT 'S' || o_orderstatus AS ServiceID, 'G' || o_orderstatus AS GroupID,
       'service ' || o_orderstatus AS serviceName, 'DT' || o_orderstatus AS DeliveryType
FROM {orders}""",
    "deliveryconfirm": f"""
SELECT 'TR' || CAST(o_orderkey AS STRING) AS TrackingNo, o_orderstatus AS company,
       'R' || {P} AS ReasonID, 'confirm ' || {P} AS ReasonName
FROM {{orders}} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "jobreason": f"""
SELECT DISTINCT 'R' || {P} AS ReasonID, 'from ' || {P} AS ReasonFrom, 'reason ' || {P} AS ReasonName
FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "deliverycontrol": f"""
SELECT o_orderstatus AS company, 'V' || {P} AS VehicleID,
       CASE WHEN o_totalprice > 150000 THEN '3' ELSE '4' END AS PositionID,
       o_orderdate AS DeliveryDate, o_orderdate AS UpdateOn,
       'E' || CAST(o_custkey AS STRING) AS EmployeeID, 'Emp ' || CAST(o_custkey AS STRING) AS EmployeeName,
       'E' || CAST(o_custkey + 1 AS STRING) AS DMEmployeeID, 'DM ' || CAST(o_custkey AS STRING) AS DMEmployeeName
FROM {{orders}}""",
    "employee": """
SELECT 'E' || CAST(c_custkey AS STRING) AS EmployeeID,
       CASE WHEN c_acctbal > 5000 THEN 'CRC' || CAST(c_custkey AS STRING) ELSE '' END AS CRCID
FROM {customer}""",
    "groupservice": """
SELECT DISTINCT 'G' || o_orderstatus AS GroupID, 'group ' || o_orderstatus AS GroupName
FROM {orders} WHERE o_orderstatus <> 'P'""",
    "vehicle_master": f"""
SELECT 'V' || {P} AS VehicleID, CASE WHEN o_orderstatus = 'F' THEN 'BDC' ELSE 'X' END AS sub_cluster,
       CAST(o_orderdate AS DATE) AS Effective_Date
FROM {{orders}}""",
    "vehicle": f"""
SELECT DISTINCT 'L' || {P} AS LicenseNo, 'V' || {P} AS VehicleID, 'vehicle ' || {P} AS VehicleName,
       'type ' || {P} AS VehicleType
FROM {{orders}}""",
    "fleet": f"""
SELECT DISTINCT o_orderdate AS DeliveryDate, 'LF' || {P} AS LicenseNo, 'V' || {P} AS VehicleID,
       'fleet ' || {P} AS FleetName, 'contract ' || {P} AS FleetContract
FROM {{orders}} WHERE o_orderstatus = 'O'""",
    "account": """
SELECT 'C' || CAST(c_custkey AS STRING) AS account_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS account_segment
FROM {customer}""",
}


def _cte() -> str:
    return "WITH " + ",\n".join(
        f"{name} AS ({sql.format(orders='orders', customer='customer')})" for name, sql in INPUTS.items())


ORACLE = _cte() + """,
-- one relation per looked-up thing, then one row per delivery head with its lookups
newest AS (
  SELECT DocumentNo AS doc, max({'day': DeliveryDate, 'no': TrackingNo}) AS head
  FROM deliveryhead
  WHERE TrackingNo IS NOT NULL AND NOT starts_with(DocumentNo, 'SDO') GROUP BY doc),
sale AS (
  SELECT link.SSONo, link.company AS sale_company, link.WHID, so.* EXCLUDE (company, so_no)
  FROM ssohead link LEFT JOIN sohead so ON (so.so_no, so.company) = (link.sono, link.company)),
trip_kind AS (
  SELECT service.*, groupservice.GroupName
  FROM service LEFT JOIN groupservice USING (GroupID)),
outcome AS (
  SELECT dc.TrackingNo, dc.company AS at_company, dc.ReasonID, dc.ReasonName AS TMSReasonName,
         coalesce(jr.ReasonFrom, '') AS ReasonFrom, coalesce(jr.ReasonName, '') AS ReasonName
  FROM deliveryconfirm dc LEFT JOIN jobreason jr USING (ReasonID)),
crew_pick AS (
  SELECT company, VehicleID, PositionID, DeliveryDate,
         max({'at': UpdateOn, 'id': EmployeeID, 'name': EmployeeName, 'dm': DMEmployeeID, 'dm_name': DMEmployeeName}) AS p
  FROM deliverycontrol WHERE PositionID IN ('3', '4') GROUP BY ALL),
person AS (SELECT EmployeeID, CRCID, coalesce(nullif(CRCID, ''), EmployeeID) AS code FROM employee),
crew AS (
  SELECT k.company, k.VehicleID, k.DeliveryDate, k.PositionID, k.p.name AS who, own.code,
         k.p.dm AS dm_id, k.p.dm_name AS dm_name, boss.CRCID AS dm_code
  FROM crew_pick k LEFT JOIN person own ON own.EmployeeID = k.p.id
       LEFT JOIN person boss ON boss.EmployeeID = k.p.dm),
home AS (
  SELECT VehicleID, max({'since': Effective_Date, 'sub': sub_cluster}).sub AS sub FROM vehicle_master GROUP BY VehicleID),
hired AS (
  SELECT VehicleID, DeliveryDate::DATE AS on_day, LicenseNo AS plate, FleetName AS label, FleetContract AS kind FROM fleet),
segment AS (SELECT account_id, coalesce(nullif(account_segment, ''), 'Silver') AS tier FROM account)
SELECT DISTINCT
  -- the delivery itself
  head.company AS COMPANYNAME, head.TrackingNo AS BillDelivery, head.DocumentNo, head.DeliveryDate,
  substr(head.DocumentNo, 1, 2) AS Doc_Type, head.RefDocumentNo, head.RefDocumentNo2, head.RefDocumentNo3,
  head.JobRemark AS Remark, head.TotalAmount, head.Status, head.ClusterID, head.SubClusterID,
  head.ReDeliveryFlag, head.ISCustVIP, head.IsShipWithINV, head.VehiclePlanID, head.ServiceType,
  head.ParkCode, head.ParkCode AS ShipArea, head.ZoneID AS ShipSubArea,
  if(starts_with(head.Status, 'Completed'), 'Yes', 'No') AS IsOntime,
  if(newest.head.no = head.TrackingNo, 'Yes', 'No') AS ISLastAction,
  -- customer and sale
  head.CustomerID, head.CustomerName, coalesce(segment.tier, 'Silver') AS account_segment,
  sale.WHID, sale.reptsale_id, if(coalesce(sale.reptsale_id IN ('BU3', 'BU4'), true), 'Yes', 'No') AS IsCrossSale,
  coalesce(sale.hamper_flag, 'No') AS hamper_flag, sale.order_type, sale.franchise_order_type,
  if(coalesce(sale.sale_channel_id, 0) = 2, 'Store', 'Callcenter') AS ASSaleChannel,
  sale.sale_channel_name, sale.sale_method_name, sale.telesale_id, sale.telesale_name,
  sale.ship_sub_area, sale.payment_code, sale.payment_type, sale.payment_name,
  -- vehicle, carrier and kind of trip
  head.VehicleID, head.VehicleID AS Truck, coalesce(hired.plate, vehicle.LicenseNo) AS LicenseNo,
  coalesce(hired.label, vehicle.VehicleName) AS VehicleName, coalesce(hired.kind, vehicle.VehicleType) AS VehicleType,
  if(coalesce(home.sub, '') = 'BDC', 'BDC', '') AS BDC, provider.ProviderName, provider.ProviderShortName,
  trip_kind.GroupID, trip_kind.GroupName, trip_kind.serviceName, trip_kind.DeliveryType,
  -- outcome and crew
  outcome.ReasonID, outcome.TMSReasonName, coalesce(outcome.ReasonFrom, '') AS ReasonFrom,
  coalesce(outcome.ReasonName, '') AS ReasonName,
  navigator.code AS NavigatorCRC, navigator.who AS NavigatorName, navigator.dm_id AS DMEmployeeID,
  navigator.dm_name AS DMEmployeeName, navigator.dm_code AS DMCRCID,
  helper.code AS StaffCRC, coalesce(helper.who, '') AS StaffName
FROM deliveryhead head
JOIN newest ON newest.doc = head.DocumentNo
LEFT JOIN segment ON segment.account_id = head.CustomerID
LEFT JOIN sale ON (sale.SSONo, sale.sale_company) = (head.DocumentNo, head.company)
LEFT JOIN outcome ON (outcome.TrackingNo, outcome.at_company) = (head.TrackingNo, head.company)
LEFT JOIN trip_kind ON trip_kind.ServiceID = head.ServiceType
LEFT JOIN provider ON provider.ProviderID = head.ProviderID
LEFT JOIN vehicle ON vehicle.VehicleID = head.VehicleID
LEFT JOIN home ON home.VehicleID = head.VehicleID
LEFT JOIN hired ON (hired.VehicleID, hired.on_day) = (head.VehicleID, head.DeliveryDate::DATE)
LEFT JOIN crew navigator ON navigator.PositionID = '3' AND navigator.DeliveryDate = head.DeliveryDate
      AND (navigator.company, navigator.VehicleID) = (head.company, head.VehicleID)
LEFT JOIN crew helper ON helper.PositionID = '4' AND helper.DeliveryDate = head.DeliveryDate
      AND (helper.company, helper.VehicleID) = (head.company, head.VehicleID)
WHERE head.TrackingNo IS NOT NULL
"""


@query("model_fact_transport_daily", ("M18", "J1", "J2", "J3", "J4", "J5", "J6", "J7", "R2", "R7",
                                      "A5", "T9", "T10", "T11"), oracle=ORACLE)
def model_fact_transport_daily(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders, customer = t.orders, t.customer
    inputs = {name: spark.sql(sql, orders=orders, customer=customer) for name, sql in INPUTS.items()}
    return M.fact_transport_daily(inputs)
