import dataclasses
import datetime as dt
import json
import tarfile
from pathlib import Path

import pytest

from tempspan import (
    COLDWAVE, HEATWAVE, list_periods, present, quality_report, read_periods, read_results_csv,
    report_lines, summary_json, write_periods, write_results_csv, yearly_summary,
)
from tempspan.operators.daily import fold_other_stations, station_days
from tempspan.operators.quality import quality_totals_of_days, report_rows
from tempspan.operators.periods import as_kind, of_kind
from tempspan.operators.views import parse_year, result_records, yearly
from tempspan.plans import job
from tempspan.runtime import fresh_folder, shared_folder, write_shared
from tempspan.sinks.report import print_report, quality_lines
from tests.files import (
    FIELDS, GOLDEN_COLD, GOLDEN_HOT, document, golden_observations, observation,
    write,
)

OBSERVATIONS = "LOCATION string, DATE date, TX_DRYB_10 double, TN_DRYB_10 double"
PERIODS = ("LOCATION string, kind string, start_date date, end_date date, duration long, "
           "extreme_days long, extreme_temperature double")
# The published headings.
HOT_HEADING = "From date,To date (inc.),Duration (in days),Number of tropical days,Max temperature"
COLD_HEADING = ("From date,To date (inc.),Duration (in days),Number of high frost days,"
                "Min temperature")


def date(text):
    return dt.datetime.strptime(text, "%d %b %Y").date()


def golden_periods(spark):
    rows = [("260_T_a", kind, date(a), date(b), n, e, t)
            for kind, golden in (("heatwaves", GOLDEN_HOT), ("coldwaves", GOLDEN_COLD))
            for a, b, n, e, t in golden]
    return spark.createDataFrame(rows[::-1], PERIODS)


def hot_periods(spark):
    frame = golden_periods(spark).filter("kind = 'heatwaves'").drop("kind")
    return frame.toDF("LOCATION", "start_date", "end_date", "duration", "tropical_days",
                      "max_temperature")


def text_of(folder):
    parts = sorted(folder.glob("part-*.csv"))
    assert len(parts) == 1
    return parts[0].read_text().splitlines()


# Quality report

def test_quality_report(spark):
    day = dt.date(2020, 1, 1)
    rows = [("260_T_a", day, 1.0, None), ("260_T_a", day, 2.0, -3.0), ("260_T_a", None, None, 4.5),
            ("b", day, 99.0, -99.0), ("b", None, None, None), ("b", day, None, None)]
    frame = spark.createDataFrame(rows, OBSERVATIONS)
    expected = [
        ("Total Records", 6, None, None, None, None),
        ("De Bilt Station Records", 3, 50.0, None, None, None),
        ("LOCATION - Null Values", 0, 0.0, None, None, None),
        ("TX_DRYB_10 - Null Values", 1, 100 / 3, None, None, None),
        ("TX_DRYB_10 - Statistics", None, None, 1.0, 2.0, 1.5),
        ("TN_DRYB_10 - Null Values", 1, 100 / 3, None, None, None),
        ("TN_DRYB_10 - Statistics", None, None, -3.0, 4.5, 0.75),
        ("DATE - Null Values", 1, 100 / 3, None, None, None),
    ]
    of_days = report_rows(quality_totals_of_days(station_days(frame)))
    folded = station_days(fold_other_stations(frame, "260_T_a"))
    assert folded.count() == 3
    of_folded = report_rows(quality_totals_of_days(folded))
    for report in (quality_report(frame), of_days, of_folded):
        assert report.columns == ["metric", "count", "percentage", "min", "max", "avg"]
        got = [tuple(r) for r in report.collect()]
        assert got == [tuple(pytest.approx(v) if isinstance(v, float) else v for v in row)
                       for row in expected]


@pytest.mark.parametrize("rows", [[], [("b", None, 1.0, 1.0)], [("260_T_a", None, None, None)]])
def test_quality_report_without_readings(spark, rows):
    frame = spark.createDataFrame(rows, OBSERVATIONS)
    here = sum(r[0] == "260_T_a" for r in rows)
    of_days = report_rows(quality_totals_of_days(station_days(frame)))
    for report in (quality_report(frame), of_days):
        got = {r.metric: r for r in report.collect()}
        assert got["Total Records"]["count"] == len(rows)
        assert got["TX_DRYB_10 - Null Values"]["count"] == here
        assert got["TX_DRYB_10 - Null Values"].percentage == 100.0 * here
        assert tuple(got["TX_DRYB_10 - Statistics"])[1:] == (None,) * 5


def test_quality_lines(spark):
    rows = [("260_T_a", None, 1.0, None), ("260_T_a", None, 2.5, None), ("b", None, 1.0, 1.0)]
    report = quality_report(spark.createDataFrame(rows, OBSERVATIONS))
    lines = [r.line.rstrip() for r in quality_lines(report).collect()]
    assert lines[0] == "Total Records                  3"
    assert lines[1].split() == ["De", "Bilt", "Station", "Records", "2", "66.67%"]
    assert lines[4].split(None, 3)[3].startswith("Min: 1.00, Max: 2.50")
    assert lines[4].endswith("Avg: 1.75") and lines[6].endswith("Statistics")


# Views

def test_year_argument(spark):
    assert [parse_year(y) for y in (None, "", "2003", 2003)] == [None, None, 2003, 2003]
    with pytest.raises(ValueError, match="Invalid year: x"):
        parse_year("x")
    periods = hot_periods(spark)
    assert list_periods(periods, HEATWAVE).count() == 9
    assert [r.start_date_formatted for r in list_periods(periods, HEATWAVE, "2006").collect()] == [
        "30 Jun 2006", "15 Jul 2006"]
    for year in (1999, 0, -5, 10**12):
        assert list_periods(periods, HEATWAVE, year).collect() == []


def test_period_over_new_year_counts_in_its_first_year(spark):
    rows = [("a", "coldwaves", dt.date(2011, 12, 29), dt.date(2012, 1, 8), 11, 4, -12.5)]
    got = yearly_summary(spark.createDataFrame(rows, PERIODS)).collect()
    assert [tuple(r) for r in got] == [("coldwaves", 2011, 1, -12.5)]


def test_yearly_summary_and_json(spark):
    summary = yearly_summary(golden_periods(spark))
    got = {(r.kind, r.year): (r["count"], r.extreme_temperature) for r in summary.collect()}
    assert got[("heatwaves", 2006)] == (2, 35.7) and got[("coldwaves", 2012)] == (1, -18.9)
    one_kind = {r.year: (r["count"], r.max_temperature)
                for r in yearly(hot_periods(spark), HEATWAVE).collect()}
    assert one_kind == {year: v for (kind, year), v in got.items() if kind == "heatwaves"}
    text = summary_json(summary).first().summary
    parsed = json.loads(text)
    assert list(parsed) == ["heatwaves", "coldwaves"]
    assert list(parsed["heatwaves"]) == ["2003", "2004", "2005", "2006", "2013", "2015", "2018"]
    assert parsed["heatwaves"]["2018"] == {"count": 2, "max_temperature": 35.7}
    assert parsed["coldwaves"] == {"2012": {"count": 1, "min_temperature": -18.9}}


def test_records_and_summary_from_result_files(spark, tmp_path):
    parts = []
    for rule in (HEATWAVE, COLDWAVE):
        results = present(of_kind(golden_periods(spark), rule), rule, keys=())
        records = [json.loads(r.record) for r in result_records(results, rule).collect()]
        assert list(records[0]) == list(rule.result_titles().values())
        write_results_csv(results, str(tmp_path / rule.kind), rule)
        back = read_results_csv(spark, str(tmp_path / rule.kind), rule, keys=())
        parts.append(as_kind(back, rule))
    assert records == [{"From date": "30 Jan 2012", "To date (inc.)": "08 Feb 2012",
                        "Duration (in days)": 10, "Number of high frost days": 5,
                        "Min temperature": -18.9}]
    from_files = yearly_summary(parts[0].unionByName(parts[1]))
    assert sorted(from_files.collect()) == sorted(yearly_summary(golden_periods(spark)).collect())


def test_summary_of_nothing(spark):
    nothing = yearly_summary(spark.createDataFrame([], PERIODS))
    assert summary_json(nothing).first().summary == '{"heatwaves":{},"coldwaves":{}}'


# Sinks

def test_csv_text_and_round_trip(spark, tmp_path):
    results = present(hot_periods(spark), HEATWAVE, keys=())
    write_results_csv(results, str(tmp_path / "hot"), HEATWAVE)
    assert text_of(tmp_path / "hot") == [HOT_HEADING, *(",".join(map(str, g)) for g in GOLDEN_HOT)]
    back = read_results_csv(spark, str(tmp_path / "hot"), HEATWAVE, keys=())
    assert sorted(map(tuple, back.collect())) == sorted(
        (date(a), date(b), n, e, t) for a, b, n, e, t in GOLDEN_HOT)
    again = present(back, HEATWAVE, keys=())
    assert [tuple(r) for r in again.collect()] == GOLDEN_HOT


def test_csv_without_rows_has_the_heading(spark, tmp_path):
    results = present(hot_periods(spark).filter("false"), HEATWAVE, keys=())
    write_results_csv(results, str(tmp_path / "hot"), HEATWAVE)
    assert text_of(tmp_path / "hot") == [HOT_HEADING]
    assert read_results_csv(spark, str(tmp_path / "hot"), HEATWAVE, keys=()).count() == 0


def test_csv_parts_together_are_in_order(spark, tmp_path, set_conf):
    set_conf("spark.sql.adaptive.enabled", "false")
    write_results_csv(present(hot_periods(spark), HEATWAVE, keys=()), str(tmp_path / "h"), HEATWAVE)
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "h").glob("part-*.csv"))]
    assert len(parts) > 1 and all(p[0] == HOT_HEADING for p in parts)
    assert [line for p in parts for line in p[1:]] == [",".join(map(str, g)) for g in GOLDEN_HOT]


def test_period_store_by_kind(spark, tmp_path):
    store = str(tmp_path / "periods")
    periods = golden_periods(spark)
    for rule in (HEATWAVE, COLDWAVE):
        write_periods(periods, store, rule)
    write_periods(periods.filter("false"), store, HEATWAVE)
    assert sorted(p.name for p in (tmp_path / "periods").iterdir()) == [
        "kind=coldwaves", "kind=heatwaves"]
    back = read_periods(spark, store)
    assert [(r.kind, r.duration) for r in back.collect()] == [("coldwaves", 10)]
    plan = back.filter("kind = 'coldwaves'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    one_year = list_periods(of_kind(back, COLDWAVE), COLDWAVE, 2012)
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_date,2012-01-01)" in plan and one_year.count() == 1


def test_report_lines(spark, capsys):
    results = present(hot_periods(spark), HEATWAVE, keys=())
    lines = [r.line for r in report_lines(results).collect()]
    assert lines[0] == "31 Jul 2003  | 13 Aug 2003  | 14              | 7               | 35.0        "
    print_report(results, "Title", HEATWAVE.report_titles(), rows=2)
    shown = capsys.readouterr().out.splitlines()
    assert shown[1:3] == ["Title", "=" * 80]
    assert shown[3] == ("From date    | To date (inc.) | Duration (days) | Tropical days   | "
                        "Max temp (°C)  ")
    assert shown[5:] == lines[:2]
    print_report(results, "Title", HEATWAVE.report_titles())
    assert capsys.readouterr().out.splitlines()[5:] == lines
    print_report(results.filter("false"), "Title", HEATWAVE.report_titles(), rows=2)
    assert capsys.readouterr().out.splitlines()[-1] == "No results found."


# Shared storage

def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x").startswith(shared_folder(spark))
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    table = write_shared(spark.range(5), "numbers")
    assert table.count() == 5 and shared_folder(spark) in table.inputFiles()[0]


# The whole job

@pytest.fixture(scope="module")
def golden_input(tmp_path_factory):
    """The golden observations over differently laid out files, with junk among them."""
    root = tmp_path_factory.mktemp("raw")
    rows = golden_observations()
    spread = [rows[i::4] for i in range(4)]
    few = ["DTG", "LOCATION", "TN_DRYB_10", "TX_DRYB_10"]
    write(root / "a" / "one.txt", document(spread[0]))
    write(root / "a" / "b" / "two.txt",
          document(spread[1], [FIELDS[0], *FIELDS[:0:-1]], newline="\r\n"))
    write(root / "three.dat", document(spread[2], few))
    write(root / "four", document(spread[3], default=33))
    write(root / "none.txt", document(rows, head=False))
    junk = [{"DTG": "2018-07-28 12:00", "LOCATION": "260_T_a", "TX_DRYB_10": "31.0"},
            {"DTG": "2018-07-28 12:00:00", "LOCATION": "", "TX_DRYB_10": "31.0"},
            {"DTG": "2018-07-28 12:00:00", "LOCATION": "260_T_a", "TX_DRYB_10": "3l.0"},
            {"DTG": "2018-07-28 12:00:00", "LOCATION": "260_T_a", "TX_DRYB_10": "NaN"},
            {"DTG": "2018-07-28 12:00:00", "LOCATION": "260_T_b", "TX_DRYB_10": "31.0"}]
    write(root / "junk.txt", document(junk))
    return root


def test_job_gives_the_golden_files(spark, golden_input, tmp_path, capsys, caplog):
    caplog.set_level("INFO", "tempspan")
    assert job.check_input(spark, str(golden_input))
    job.run(spark, str(golden_input), "both", str(tmp_path), check_data_quality=True)
    assert text_of(tmp_path / "heatwaves") == [
        HOT_HEADING, *(",".join(map(str, g)) for g in GOLDEN_HOT)]
    assert text_of(tmp_path / "coldwaves") == [
        COLD_HEADING, *(",".join(map(str, g)) for g in GOLDEN_COLD)]
    assert read_periods(spark, str(tmp_path / "periods")).count() == 10
    out = capsys.readouterr().out
    assert "De Bilt Station Records" in out
    assert "Heatwaves (De Bilt) from 2003 onwards:" in out
    assert "30 Jan 2012  | 08 Feb 2012  | 10              | 5               | -18.9" in out
    records = len(golden_observations()) + 4
    assert f"loaded {records} records" in caplog.text
    assert "found 9 heatwaves" in caplog.text and "found 1 coldwaves" in caplog.text
    assert "193 daily records for coldwaves" in caplog.text
    assert "left out 1 inputs: no header" in caplog.text and "6 files" in caplog.text
    left_out = spark.read.option("header", True).csv(str(tmp_path / "rejects")).collect()
    assert [(r.source.rsplit("/", 1)[1], r.reason) for r in left_out] == [("none.txt", "no header")]


def test_job_modes_and_all_stations(spark, golden_input, tmp_path, capsys):
    job.run(spark, str(golden_input), "coldwaves", str(tmp_path))
    assert not (tmp_path / "heatwaves").exists()
    job.run(spark, str(golden_input), "heatwaves", str(tmp_path), station=None)
    assert text_of(tmp_path / "heatwaves")[0] == f"Station,{HOT_HEADING}"
    back = read_results_csv(spark, str(tmp_path / "heatwaves"), HEATWAVE)
    assert {r.LOCATION for r in back.collect()} == {"260_T_a"}
    assert {r.kind for r in read_periods(spark, str(tmp_path / "periods")).collect()} == {
        "heatwaves", "coldwaves"}


def test_job_lists_every_input_it_leaves_out(spark, tmp_path, capsys):
    rows = golden_observations()
    write(tmp_path / "in" / "good.txt", document(rows))
    for i in range(50):
        write(tmp_path / "in" / f"bad{i}.txt", document(rows[:2], head=False))
    job.run(spark, str(tmp_path / "in"), "heatwaves", str(tmp_path / "out"))
    left_out = spark.read.option("header", True).csv(str(tmp_path / "out" / "rejects")).collect()
    assert len({r.source for r in left_out}) == 50 and {r.reason for r in left_out} == {"no header"}


def test_job_prints_all_rows_of_a_station(spark, tmp_path, capsys):
    start, rows = dt.date(2003, 1, 1), []
    for wave in range(150):
        for day in range(5):
            at = dt.datetime.combine(start + dt.timedelta(7 * wave + day), dt.time(12))
            rows.append(observation(at, 31.0))
    write(tmp_path / "in" / "a.txt", document(rows))
    job.run(spark, str(tmp_path / "in"), "heatwaves", str(tmp_path / "out"))
    printed = [x for x in capsys.readouterr().out.splitlines() if "31.0" in x]
    assert len(printed) == 150
    job.run(spark, str(tmp_path / "in"), "heatwaves", str(tmp_path / "out"), rows_shown=3)
    assert len([x for x in capsys.readouterr().out.splitlines() if "31.0" in x]) == 3


def test_job_removes_its_shared_tables(spark, golden_input, tmp_path):
    shared = Path(shared_folder(spark)) / "tempspan"
    before = {p for p in shared.glob("*/*")}
    job.run(spark, str(golden_input), "both", str(tmp_path))
    assert {p for p in shared.glob("*/*")} == before
    with pytest.raises(ValueError):
        write(tmp_path / "bad" / "x.txt", document([], head=False) + "x\n")
        job.run(spark, str(tmp_path / "bad"), "both", str(tmp_path))
    assert {p for p in shared.glob("*/*")} == before


def test_job_runs_a_rule_of_the_callers_own(spark, golden_input, tmp_path):
    mild = dataclasses.replace(HEATWAVE, kind="mild", temp_threshold=24.0)
    job.run(spark, str(golden_input), "heatwaves", str(tmp_path), rules=[HEATWAVE, COLDWAVE, mild])
    assert len(text_of(tmp_path / "mild")) > 1 and not (tmp_path / "coldwaves").exists()


def test_result_files_with_other_headings_fail(spark, tmp_path):
    write(tmp_path / "r" / "a.csv", "To date (inc.),From date,Duration (in days),"
          "Number of tropical days,Max temperature\n13 Aug 2003,31 Jul 2003,14,7,35.0\n")
    with pytest.raises(Exception, match="CSV header|column"):
        read_results_csv(spark, str(tmp_path / "r"), HEATWAVE, keys=()).collect()


def test_job_without_results(spark, golden_input, tmp_path, capsys):
    job.run(spark, str(golden_input), "both", str(tmp_path), station="nowhere",
            check_data_quality=True)
    assert text_of(tmp_path / "heatwaves") == [HOT_HEADING]
    assert capsys.readouterr().out.count("No results found.") == 2


def test_job_without_input(spark, tmp_path):
    assert not job.check_input(spark, str(tmp_path / "nothing"))
    assert not job.check_input(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        job.run(spark, str(tmp_path / "nothing"))


def test_job_on_archives(spark, golden_input, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    with tarfile.open(tmp_path / "in" / "data.tgz", "w:gz") as archive:
        archive.add(golden_input, arcname="data")
    job.run(spark, None, "both", str(tmp_path / "out"), archives=str(tmp_path / "in"))
    assert len(text_of(tmp_path / "out" / "heatwaves")) == 10
    assert len(text_of(tmp_path / "out" / "coldwaves")) == 2


def test_arguments():
    options = job.parse_arguments([])
    assert (options.mode, options.data_dir, options.check_data_quality, options.log_level) == (
        "both", "extracted_data", False, "INFO")
    assert options.station == "260_T_a" and options.start_year == 2003
    with pytest.raises(SystemExit):
        job.parse_arguments(["--mode", "rain"])
