"""Schemas of landed tables, staging that widens (S13, D6, K3), and compaction by size (K8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sinks.compaction import compact
from tidemark.sources.schema_facts import observed_fields, read_staged, stage_drop


def _lines(df: DataFrame, members: dict[str, Column]) -> DataFrame:
    """Landing lines whose payload has the given JSON texts; a NULL leaves the member out."""
    body = F.concat_ws(",", *(F.concat(F.lit(f'"{name}":'), json) for name, json in members.items()))
    return df.select(F.concat(F.lit('{"_airbyte_ab_id":"a","_airbyte_emitted_at":1706745600000,"_airbyte_data":{'), body,
                              F.lit("}}")).alias("value"))


def _number(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _text(col) -> Column:
    return F.concat(F.lit('"'), col, F.lit('"'))


@query("landed_schema_facts", ("S13", "S15", "D6", "T4"), oracle="""
WITH seen AS (
  SELECT 'supplier' AS table_name, 's_suppkey' AS field, 'INT64' AS t FROM supplier
  UNION ALL SELECT 'supplier', 's_acctbal', CASE WHEN s_suppkey % 3 = 0 THEN 'INT64' ELSE 'FLOAT64' END FROM supplier
  UNION ALL SELECT 'supplier', 'note', CASE WHEN s_suppkey % 2 = 0 THEN 'STRING' ELSE 'INT64' END FROM supplier
  UNION ALL SELECT 'supplier', 'rare', 'BOOLEAN' FROM supplier WHERE s_suppkey % 10 = 0
  UNION ALL SELECT 'supplier', 'gone', NULL FROM supplier WHERE s_suppkey % 5 = 0
  UNION ALL SELECT 'customer', 'c_custkey', 'STRING' FROM customer
  UNION ALL SELECT 'customer', 'address', CASE WHEN c_nationkey % 2 = 0 THEN 'RECORD' END FROM customer
  UNION ALL SELECT 'customer', 'c_acctbal', 'FLOAT64' FROM customer),
totals AS (SELECT 'supplier' AS table_name, COUNT(*) AS n_rows FROM supplier UNION ALL SELECT 'customer', COUNT(*) FROM customer),
facts AS (
  SELECT table_name, field, COUNT(t) AS n_present, COUNT(*) - COUNT(t) AS n_null,
         COALESCE(string_agg(DISTINCT t, ',' ORDER BY t), '') AS types FROM seen GROUP BY 1, 2)
SELECT table_name, field,
       CASE WHEN types = '' THEN NULL WHEN types = 'FLOAT64,INT64' THEN 'FLOAT64' WHEN contains(types, ',') THEN 'STRING' ELSE types END
         AS inferred_type,
       n_rows, n_present, n_null, types, contains(types, ',') AND types <> 'FLOAT64,INT64' AS conflict
FROM facts JOIN totals USING (table_name)
""")
def landed_schema_facts(spark, sf_dir):
    """Two landing folders, read in one scan: keys in mixed case, numbers with
    and without a fraction, a field that is text or a number, a rare one, one
    that is only ever null, and a nested one."""
    t = Tables(spark, sf_dir)
    root = shared_dir(spark, "schema-facts")
    key = F.col("s_suppkey")
    _lines(t.supplier, {
        "S_SUPPKEY": _number("s_suppkey"),
        "s_acctbal": F.when(key % 3 == 0, _number(F.floor("s_acctbal"))).otherwise(F.concat(_number(F.floor("s_acctbal")), F.lit(".25"))),
        "note": F.when(key % 2 == 0, _text(F.lit("even"))).otherwise(F.lit("1")),
        "rare": F.when(key % 10 == 0, F.lit("true")),
        "gone": F.when(key % 5 == 0, F.lit("null"))}).write.text(f"{root}/supplier")
    _lines(t.customer, {
        "C_CustKey": _text(_number("c_custkey")),
        "address": F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit('{"nation":'), _number("c_nationkey"), F.lit("}")))
        .otherwise(F.lit("null")),
        "c_acctbal": F.concat(_number(F.floor("c_acctbal")), F.lit(".5"))}).write.text(f"{root}/customer")
    return observed_fields(spark, [f"{root}/supplier", f"{root}/customer"]).withColumn("types", F.array_join("types", ","))


@query("staging_versions", ("K3", "D6", "K1"), oracle="""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN floor(abs(c_acctbal)) ELSE floor(abs(c_acctbal)) + 0.25 END AS c_acctbal,
       CASE WHEN c_custkey % 3 = 2 THEN 'N' || c_nationkey ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
       CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS segment,
       'run' || (c_custkey % 3) AS run
FROM customer
""")
def staging_versions(spark, sf_dir):
    """Three drops of customer: the second brings a field and fractions, the
    third sends a number as text.  Then the first run is repeated.  All drops
    read back with the newest schema of the ledger."""
    c = Tables(spark, sf_dir).customer
    root = shared_dir(spark, "staging-versions")
    whole = _number(F.floor(F.abs("c_acctbal")))
    drops = [{"C_CUSTKEY": _number("c_custkey"), "c_acctbal": whole, "c_nationkey": _number("c_nationkey")},
             {"c_custkey": _number("c_custkey"), "C_ACCTBAL": F.concat(whole, F.lit(".25")), "c_nationkey": _number("c_nationkey"),
              "segment": _text(F.col("c_mktsegment"))},
             {"c_custkey": _number("c_custkey"), "c_acctbal": F.concat(whole, F.lit(".25")),
              "c_nationkey": _text(F.concat(F.lit("N"), _number("c_nationkey")))}]
    for i, members in enumerate(drops):
        _lines(c.where(F.col("c_custkey") % 3 == i), members).write.text(f"{root}/landing/drop{i}/customer")
    for i in (0, 1, 2, 0):
        stage_drop(spark, f"{root}/landing/drop{i}/customer", f"{root}/stage", f"{root}/ledger", "customer", f"run{i}")
    return read_staged(spark, f"{root}/stage", f"{root}/ledger", "customer")


@query("compact_small_files", ("K8",), oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderstatus, COUNT(*) AS n_rows, CAST(SUM(o_orderkey) AS BIGINT) AS sum_key,
       round(SUM(o_totalprice), 2) AS total,
       CAST(SUM(CASE WHEN o_orderkey % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_checked
FROM orders GROUP BY 1, 2
""")
def compact_small_files(spark, sf_dir):
    """A table partitioned by year that two appending loads have left in small
    files, the second with a column of its own; compacted twice."""
    orders = Tables(spark, sf_dir).orders.withColumn("order_year", F.year("o_orderdate"))
    path = f"{shared_dir(spark, 'compaction')}/orders"
    for i, part in enumerate((orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1").withColumn("checked", F.lit(True)))):
        part.repartition(6).write.mode("append" if i else "errorifexists").partitionBy("order_year").parquet(path)
    compact(spark, path)
    compact(spark, path)
    back = spark.read.option("mergeSchema", True).parquet(path)
    return back.groupBy("order_year", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_key"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count("checked").alias("n_checked"))
