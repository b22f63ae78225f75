import dataclasses
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempspan import COLDWAVE, HEATWAVE, consecutive_periods, daily_extremes, detect, present
from tempspan.operators.daily import (
    from_start_year, only_station, station_day_readings, station_days,
)
from tempspan.operators.periods import detect_kinds, flag_days, of_kind, periods_of, run_ids

D0 = dt.date(2020, 2, 25)
SCHEMA = "LOCATION string, DATE date, TX_DRYB_10 double, TN_DRYB_10 double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def series(values, start=D0, station="a", tn=None):
    """Rows of consecutive days; None leaves the day out."""
    tn = tn or values
    return [(station, start + dt.timedelta(i), x, n)
            for i, (x, n) in enumerate(zip(values, tn)) if x is not None]


def hot(spark, values, **kw):
    days = frame(spark, series(values, **kw))
    return [tuple(r) for r in detect(days, HEATWAVE).orderBy("start_date").collect()]


def cold(spark, tx, tn):
    days = frame(spark, series(tx, tn=tn))
    return [tuple(r) for r in detect(days, COLDWAVE).orderBy("start_date").collect()]


def test_heatwave_bounds_are_inclusive(spark):
    assert hot(spark, [25.0, 25.0, 30.0, 30.0, 30.0]) == [
        ("a", D0, D0 + dt.timedelta(4), 5, 3, 30.0)]
    assert hot(spark, [24.9, 25.0, 30.0, 30.0, 30.0]) == []
    assert hot(spark, [25.0, 25.0, 29.9, 30.0, 30.0]) == []


def test_heatwave_needs_five_days_and_three_tropical(spark):
    assert hot(spark, [31.0] * 4) == []
    assert hot(spark, [31.0] * 2 + [26.0] * 6) == []
    assert len(hot(spark, [31.0] * 5)) == 1


def test_extreme_days_count_over_the_whole_run(spark):
    found = hot(spark, [30.0, *[25.0] * 6, 30.0, *[25.0] * 6, 33.3])
    assert [(r[3], r[4], r[5]) for r in found] == [(15, 3, 33.3)]


def test_coldwave_bounds_are_strict(spark):
    assert cold(spark, [-0.1] * 5, [-10.1, -10.1, -10.1, -10.0, -10.0]) == [
        ("a", D0, D0 + dt.timedelta(4), 5, 3, -10.1)]
    assert cold(spark, [0.0] + [-0.1] * 4, [-12.0] * 5) == []
    assert cold(spark, [-0.1] * 5, [-10.1, -10.1, -10.0, -10.0, -10.0]) == []


@pytest.mark.parametrize("gap", [None, 24.9])
def test_missing_and_mild_days_end_a_run(spark, gap):
    found = hot(spark, [30.0] * 5 + [gap] + [31.0] * 6)
    assert [(r[3], r[5]) for r in found] == [(5, 30.0), (6, 31.0)]
    assert hot(spark, [30.0] * 3 + [gap] + [30.0] * 3) == []


@pytest.mark.parametrize("start", [dt.date(2019, 12, 29), dt.date(2020, 2, 26),
                                   dt.date(2021, 2, 26), dt.date(1969, 12, 29)])
def test_runs_over_month_leap_day_year_and_epoch(spark, start):
    found = hot(spark, [30.0] * 8, start=start)
    assert [(r[1], r[2], r[3]) for r in found] == [(start, start + dt.timedelta(7), 8)]


def test_stations_do_not_mix(spark):
    days = frame(spark, series([30.0] * 3) + series([30.0] * 9, station="b")
                 + series([30.0] * 2, start=D0 + dt.timedelta(3), station="c"))
    assert [(r.LOCATION, r.duration) for r in detect(days, HEATWAVE).collect()] == [("b", 9)]


def test_empty_input(spark):
    assert detect(frame(spark, []), HEATWAVE).collect() == []
    assert present(detect(frame(spark, []), COLDWAVE), COLDWAVE).collect() == []


def test_result_rows_are_in_start_order_with_formatted_dates(spark):
    days = frame(spark, series([30.0] * 5, start=dt.date(2004, 8, 2))
                 + series([30.0] * 5, start=dt.date(2003, 12, 30)))
    rows = present(detect(days, HEATWAVE), HEATWAVE, keys=()).collect()
    assert [tuple(r) for r in rows] == [
        ("30 Dec 2003", "03 Jan 2004", 5, 5, 30.0), ("02 Aug 2004", "06 Aug 2004", 5, 5, 30.0)]
    assert rows[0].asDict().keys() == {
        "start_date_formatted", "end_date_formatted", "duration", "tropical_days",
        "max_temperature"}


def test_repeated_days(spark):
    days = frame(spark, series([30.0, 31.0, 26.0]) + series([29.0, 32.0, 27.0]))
    runs = run_ids(days).select("group_id").distinct()
    assert runs.count() == 1
    hot_day, very_hot = F.col("TX_DRYB_10") >= 25, F.col("TX_DRYB_10") >= 30
    got = consecutive_periods(days, hot_day, very_hot, F.col("TX_DRYB_10"), repeated_days=True)
    row = got.first()
    assert (row.duration, row.extreme_days, row.highest, row.lowest) == (3, 2, 32.0, 26.0)


def test_repeated_rows_of_a_day_count_once(spark):
    rows = series([26.0] * 6 + [31.0]) * 3
    assert detect(frame(spark, rows), HEATWAVE).count() == 0
    rows = series([26.0, 31.0, 31.0, 31.0, 26.0]) * 3
    got = detect(frame(spark, rows), HEATWAVE).first()
    assert (got.duration, got.tropical_days) == (5, 3)


def test_rows_without_a_day_are_in_no_run(spark):
    days = frame(spark, series([30.0] * 5) + [("a", None, 40.0, 40.0)])
    assert [(r.duration, r.max_temperature) for r in periods_of(days, HEATWAVE).collect()] == [
        (5, 30.0)]


def test_hot_station_among_many(spark):
    """A third of all observations at one station, and the same periods as by hand."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            (F.col("id") % 97).cast("string")).alias("LOCATION"),
        F.date_add(F.lit(D0), F.pmod(F.hash("id"), F.lit(100))).alias("DATE"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(320)) / 10.0).alias("TX_DRYB_10"))
    rule = dataclasses.replace(HEATWAVE, temp_threshold=25.0, extreme_temp_threshold=30.0)
    got = {tuple(r)[:6] for r in detect(daily_extremes(rows), rule, tn=None).collect()}
    best = {}
    for r in rows.collect():
        key = (r.LOCATION, r.DATE)
        best[key] = max(best.get(key, -99.0), r.TX_DRYB_10)
    expected = set()
    for station in {s for s, _ in best}:
        values = [best.get((station, D0 + dt.timedelta(i))) for i in range(100)]
        expected |= {(station, *run) for run in runs_by_hand(values, rule)
                     if run[2] >= 5 and run[3] >= 3}
    assert got == expected and len(expected) > 20
    assert any(station == "hot" for station, *_ in expected)


def test_flags(spark):
    days = frame(spark, [("a", D0, 25.0, 3.0), ("a", D0, None, None), ("a", D0, -1.0, -11.0)])
    flags = flag_days(days, HEATWAVE, "is_hot", "is_tropical")
    flags = flag_days(flags, COLDWAVE, "is_cold", "is_high_frost", tn="TN_DRYB_10")
    assert [tuple(r)[4:] for r in flags.collect()] == [(1, 0, 0, 0), (0, 0, 0, 0), (0, 0, 1, 1)]


def test_daily_values_of_the_two_kinds_use_different_observations(spark):
    rows = [("a", D0, 30.0, None), ("a", D0, 20.0, 10.0), ("a", D0, None, 5.0),
            ("a", D0 + dt.timedelta(1), None, 5.0), ("b", D0, 1.0, None),
            ("a", None, 40.0, 40.0)]
    one = daily_extremes(frame(spark, rows)).orderBy("LOCATION").collect()
    both = daily_extremes(frame(spark, rows), tn="TN_DRYB_10").collect()
    assert [tuple(r) for r in one] == [("a", D0, 30.0), ("b", D0, 1.0)]
    assert [tuple(r) for r in both] == [("a", D0, 20.0, 10.0)]


def test_start_year_is_inclusive_and_drops_unknown_days(spark):
    rows = [("a", d, 1.0, 1.0) for d in (dt.date(2002, 12, 31), dt.date(2003, 1, 1), None)]
    assert [r.DATE for r in from_start_year(frame(spark, rows), 2003).collect()] == [
        dt.date(2003, 1, 1)]
    assert daily_extremes(frame(spark, rows), start_year=None).count() == 3


def test_station_filter(spark):
    days = frame(spark, series([1.0], station="260_T_a") + series([1.0], station="b"))
    assert only_station(days, "260_T_a").count() == 1


DAY_VALUES = st.lists(st.one_of(
    st.none(), st.sampled_from([-15.0, -10.1, -10.0, -0.1, 0.0, 24.9, 25.0, 29.9, 30.0, 35.0])),
    min_size=1, max_size=60)


def runs_by_hand(values, rule):
    runs, current = [], []
    for i, v in enumerate([*values, None]):
        inside = v is not None and (v >= rule.temp_threshold if rule.warm
                                    else v < rule.temp_threshold)
        if inside:
            current.append((i, v))
        elif current:
            graded = [v for _, v in current if (
                v >= rule.extreme_temp_threshold if rule.warm
                else v < rule.extreme_temp_threshold)]
            pick = max if rule.warm else min
            runs.append((D0 + dt.timedelta(current[0][0]), D0 + dt.timedelta(current[-1][0]),
                         len(current), len(graded), pick(v for _, v in current)))
            current = []
    return runs


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(DAY_VALUES, min_size=1, max_size=4))
def test_runs_equal_a_plain_scan_of_each_series(spark, lists):
    rows = [r for i, v in enumerate(lists) for r in series(v, station=str(i))]
    days = frame(spark, rows)
    for rule in (HEATWAVE, COLDWAVE):
        tn = None if rule.warm else "TN_DRYB_10"
        got = sorted(tuple(r) for r in periods_of(days, rule, tn=tn).drop("group_id").collect())
        assert got == sorted((str(i), *run) for i, v in enumerate(lists)
                             for run in runs_by_hand(v, rule))


def test_runs_equal_session_windows(spark):
    stations, length = 20, 400
    days = spark.range(stations * length).select(
        (F.col("id") % stations).cast("string").alias("LOCATION"),
        F.date_add(F.lit(D0), (F.col("id") / stations).cast("int")).alias("DATE"),
        (F.pmod(F.hash("id"), F.lit(40))).cast("double").alias("TX_DRYB_10"))
    ours = periods_of(days, HEATWAVE).select("LOCATION", "start_date", "duration")
    theirs = (
        days.filter("TX_DRYB_10 >= 25")
        .groupBy("LOCATION", F.session_window(F.col("DATE").cast("timestamp"), "25 hours"))
        .agg(F.min("DATE").alias("start_date"), F.count("*").alias("duration"))
        .select("LOCATION", "start_date", "duration"))
    assert ours.count() == theirs.count() > 1000
    assert ours.exceptAll(theirs).count() == 0


def test_one_pass_for_both_kinds_equals_two(spark):
    rows = [(str(i % 3), D0 + dt.timedelta(i // 9),
             None if i % 11 == 0 else float((i * 37) % 80 - 30),
             None if i % 7 == 0 else float((i * 53) % 80 - 40)) for i in range(2000)]
    observations = frame(spark, rows)
    easy = {"min_duration": 2, "extreme_days_required": 1}
    rules = [dataclasses.replace(HEATWAVE, **easy, temp_threshold=20.0),
             dataclasses.replace(COLDWAVE, **easy, temp_threshold=38.0)]
    readings = {rule.kind: station_day_readings(rule) for rule in rules}
    together = detect_kinds(station_days(observations), rules, readings)
    for rule in rules:
        tn = None if rule.warm else "TN_DRYB_10"
        alone = detect(daily_extremes(observations, tn=tn, start_year=None), rule)
        got = of_kind(together, rule)
        assert got.columns == alone.columns and alone.count() > 10
        assert got.exceptAll(alone).count() == 0 and alone.exceptAll(got).count() == 0
