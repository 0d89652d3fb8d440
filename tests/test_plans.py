"""What the plans look like: pushed filters, pruned columns, one scan, no cross product."""

import re

import pytest

from __spark_entry__ import SMOKE_TABLES
from panelkit.registry import QUERIES


def executed(spark, name):
    df = QUERIES[name](spark, SMOKE_TABLES)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(spark, name):
    return QUERIES[name](spark, SMOKE_TABLES)._jdf.queryExecution().executedPlan().toString()


def item_scan(plan):
    return next(line for line in plan.split("\n") if "FileScan" in line and "lineitem" in line)


def test_month_filter_reaches_the_scan(spark):
    scan = planned(spark, "f3_filter_month")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", scan)


def test_unused_columns_are_not_read(spark):
    spark.conf.set("spark.sql.maxMetadataValueLength", "1000")
    scan = item_scan(planned(spark, "a1_total_per_entity"))
    assert scan.endswith("ReadSchema: struct<l_suppkey:bigint,l_quantity:double>")


def test_the_population_is_not_computed_unless_asked_for(spark):
    assert "s_acctbal" not in planned(spark, "a1_total_per_entity")
    assert "s_acctbal" in planned(spark, "a6_rate_per_100k")


def test_top_n_keeps_n_rows_per_task(spark):
    assert "TakeOrderedAndProject" in planned(spark, "t1_top_15_entities")


@pytest.mark.parametrize("name", ["t3_top_20_ratio", "t4_top_15_rate", "a15_latest_month", "k6_summarize_result", "c7_map_frames"])
def test_subqueries_share_the_scan(spark, name):
    final = executed(spark, name).split("\n== Initial Plan")[0]
    assert "ReusedExchange" in final


@pytest.mark.parametrize(("name", "scans", "exchanges"), [("a21_run_summary", 1, 0), ("a24_workload_medians", 1, 0), ("a25_time_boxes", 2, 1)])
def test_run_statistics_come_from_brackets(spark, name, scans, exchanges):
    """Quartiles are read from the table of brackets; whiskers take one more scan of the runs, and no window."""
    final = executed(spark, name).split("\n+- == Initial Plan")[0]
    assert final.count("FileScan") == scans and "Window" not in final
    assert len(re.findall(r"(?<!Broadcast)Exchange ", final)) == exchanges


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "ajtwf"])
def test_no_cross_products(spark, name):
    plan = planned(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_partitions_follow_the_size_of_the_tables(spark, monkeypatch):
    from panelkit import session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        monkeypatch.setattr(session, "_fitted", set())
        session.fit_shuffles(spark, SMOKE_TABLES)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        monkeypatch.setattr(session, "_fitted", set())
        monkeypatch.setattr(session, "PARTITION_BYTES", 1_000)
        session.fit_shuffles(spark, SMOKE_TABLES)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_latest_month_is_a_filter_of_the_scan(spark):
    scans = [line for line in planned(spark, "a15_latest_month").split("\n") if "FileScan" in line and "l_shipdate" in line]
    assert any(re.search(r"DataFilters: \[[^\]]*>= .*ubquery", line) for line in scans)


def test_a_plain_area_beside_subareas_reaches_the_territories(spark):
    plan = planned(spark, "f2_filter_area_beside_subareas")
    filters = [line for line in plan.split("\n") if "Filter" in line and "array_contains" in line]
    assert filters and any("r_name" in line for line in filters)
