"""Plan properties that matter at scale: filters reach the scan, scans read
only the columns used, and partial work happens before the shuffle."""

import os
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(p):
    return re.findall(r"ReadSchema: struct<([^>]*)>", p)


def test_cutoff_reaches_the_scan(spark):
    p = plan(spark, "latest_order_per_customer")
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate", p)


def test_narrow_queries_read_narrow_schemas(spark):
    assert read_schemas(plan(spark, "count_by_date")) == ["l_shipdate:timestamp_ntz"]
    cols = {c.split(":")[0] for s in read_schemas(plan(spark, "env_row_compare")) for c in s.split(",")}
    assert cols == {"o_orderdate", "o_orderstatus"}


def test_counts_aggregate_before_the_shuffle(spark):
    p = plan(spark, "join_on_derived_date")
    # partial aggregate below the exchange, final above it
    assert p.count("HashAggregate") >= 2


def test_j8_many_side_is_pre_aggregated(spark):
    p = plan(spark, "dimension_group_max")
    assert "CartesianProduct" not in p and p.count("HashAggregate") >= 4


def test_multi_left_join_shuffles_no_row_after_its_last_join(spark):  # F3
    """The DISTINCT uses the partitioning of the join on the order; A is shuffled three times."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        p = plan(spark, "multi_left_join_fact")
    finally:
        spark.conf.set(limit, before)
    above = p.split("SortMergeJoin")[0]
    assert "HashAggregate" in above and "Exchange" not in above
    assert p.count("SortMergeJoin") == 5


def test_delivery_fact_joins_on_few_values_by_broadcast(spark):  # F4
    """No exchange on vehicle, provider or service, whose few values would each bring many heads into one task."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        p = plan(spark, "model_fact_transport_daily")
    finally:
        spark.conf.set(limit, before)
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", p)
    assert not [j for j in joins if re.match("(VehicleID|ProviderID|ServiceType|d_ReasonID)#", j)]
    assert len(re.findall("BroadcastHashJoin .*LeftOuter", p)) >= 8
