"""The physical plans are what the scale of the data asks for."""

import re

import pytest

from checks import queries
from tempspan import COLDWAVE, HEATWAVE, daily_extremes, detect
from tempspan.operators.periods import detect_kinds
from tempspan.operators.daily import from_start_year, station_day_readings, station_days

SF = "/root/testdata/sf0.001"
PERIOD_QUERIES = ["heatwaves", "coldwaves", "periods_hot", "periods_cold", "both_kinds",
                  "summary_heatwaves", "summary", "heatwaves_station"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PERIOD_QUERIES)
def test_no_window_without_keys_and_no_cross_join(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF))
    for window in re.findall(r"windowspecdefinition\(([^)]*)", plan):
        assert "#" in window.split(" ASC")[0].rsplit(",", 1)[0]
    assert "SinglePartition" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("rule", [HEATWAVE, COLDWAVE])
def test_two_hash_exchanges_from_observations_to_periods(spark, rule):
    tn = None if rule.warm else "tn"
    days = daily_extremes(queries.events(spark, SF), ["user_id"], "day", "tx", tn)
    plan = plan_of(detect(days, rule, ["user_id"], "day", "tx", tn))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange") == 2


def test_both_kinds_share_one_scan_and_two_exchanges(spark):
    days = station_days(queries.events(spark, SF), ["user_id"], "day", "tx", "tn")
    readings = {r.kind: station_day_readings(r) for r in (HEATWAVE, COLDWAVE)}
    plan = plan_of(detect_kinds(from_start_year(days, 2003, "day"), [HEATWAVE, COLDWAVE],
                                readings, ["user_id"], "day"))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2
    assert "partial_count(1)" not in plan and "partial_sum" not in plan


def test_scan_reads_three_columns_and_pushes_the_start_year(spark):
    plan = plan_of(queries.QUERIES["heatwaves"](spark, SF))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>", plan)
    assert "GreaterThanOrEqual(ts,2003-01-01T00:00)" in plan and "IsNotNull(value)" in plan


def test_quality_report_is_one_scan_and_one_aggregation(spark):
    plan = plan_of(queries.QUERIES["quality_report"](spark, SF))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_main_path_has_no_python(spark):
    for name in PERIOD_QUERIES + ["quality_report", "derive_date", "union_sources"]:
        plan = plan_of(queries.QUERIES[name](spark, SF))
        assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_text_path_has_one_broadcast_join_and_no_shuffle_of_lines(spark):
    plan = plan_of(queries.QUERIES["derive_date"](spark, SF))
    assert plan.count("BroadcastHashJoin") == 1 and "Exchange hashpartitioning" not in plan
    assert plan.count("FileScan text") == 1
