"""Whole runs over the sample log."""

import csv
import glob
import os
from dataclasses import replace
from datetime import date

import pytest

from __spark_entry__ import SETTINGS, queries
from lagscope import jobs
from lagscope.operators import views
from lagscope.plans import weekly
from lagscope.plans.reports import DAILY, WEEKLY
from lagscope.settings import dates_in
from lagscope.sinks.shared import shared_root
from lagscope.sources.exports import in_window, read_days
from lagscope.sources.sample_log import exported_log
from tests.micro import at, micro_log

SF_DIR = "/root/testdata/sf0.001"


def read(out, name):
    (part,) = glob.glob(glob.escape(f"{out}/{name}") + "/part-*.csv")
    with open(part, encoding="utf-8-sig", newline="") as file:
        return list(csv.reader(file))[1:]


def text(row, number=None):
    number = number or "{:f}".format
    return ["" if v is None else number(v) if isinstance(v, float) else str(v) for v in row]


@pytest.fixture(scope="module")
def log(spark):
    return exported_log(spark, SF_DIR)


def test_daily_and_weekly(spark, log, tmp_path):
    out, store = str(tmp_path / "out"), str(tmp_path / "store")
    jobs.run_weekly(log, SETTINGS, f"{out}/weekly", store)
    jobs.run_daily(log, SETTINGS, f"{out}/daily", store)
    jobs.run_weekly_from_store(spark, SETTINGS, f"{out}/again", store)
    # One more holds the counts of log rows.
    assert len(os.listdir(f"{out}/daily")) == len(DAILY) + 1
    assert len(os.listdir(f"{out}/weekly")) == len(WEEKLY) + 1
    own = ("daily-", "weekly-", "points-", "stored-")
    root = shared_root(spark).removeprefix("file:")
    assert not [f for f in os.listdir(root) if f.startswith(own)]

    def name(report):
        return report.title.format(date=SETTINGS.report_date, week=SETTINGS.week_label())

    for key in ("daily_lag_by_cdn", "daily_worst_nodes", "daily_first_matrix", "daily_total_lag"):
        show = str if DAILY[key].full else None
        expected = [text(r, show) for r in queries()[key](spark, SF_DIR).collect()]
        assert read(f"{out}/daily", name(DAILY[key])) == expected, key
    for key, report in WEEKLY.items():
        rows = [text(r) for r in queries()[key](spark, SF_DIR).collect()]
        assert read(f"{out}/weekly", name(report)) == rows, key
        assert read(f"{out}/again", name(report)) == rows, key


def test_points(spark, log, tmp_path):
    out = str(tmp_path)
    jobs.run_points(log, SETTINGS, out, SETTINGS.this_week())
    for folder, suffix in (("points", ""), ("points_noip", "_noip")):
        expected = sum(
            queries()[f"points_{k}{suffix}"](spark, SF_DIR).count() for k in ("connect_lag", "first")
        )
        assert spark.read.json(f"{out}/{folder}").count() == expected


def test_command_line(spark, log, tmp_path):
    day = log.filter("event_date = DATE '2017-04-14'").drop("event_date")
    day.write.parquet(f"{tmp_path}/export_2017-04-14-000")
    jobs.main(
        ["daily", "--date", "2017-04-14", "--exports", str(tmp_path), "--out", f"{tmp_path}/out"]
        + ["--block", "192.0.2.1", "--show-schema"]
    )
    name = DAILY["daily_lag_by_cdn"].title.format(date="2017-04-14")
    expected = queries()["daily_lag_by_cdn"](spark, SF_DIR).collect()
    assert read(f"{tmp_path}/out", name) == [text(r) for r in expected]


def test_a_daily_run_needs_a_log():
    with pytest.raises(SystemExit):
        jobs.main(["daily", "--date", "2017-04-14", "--out", "x"])


def exported(spark, folder, day, *rows):
    micro_log(spark, *rows).write.parquet(f"{folder}/export_2017-04-{day:02d}-000")


def test_rows_stamped_outside_their_export_count(spark, tmp_path):
    stalled = {"v4": 1, "v2": "n1"}
    rows = [{"time": at(14), **stalled}, {"time": at(15, 0), "v4": 0}, {"time": None, "v4": 0}]
    exported(spark, tmp_path, 14, *rows, {"time": at(13, 23), "v4": 1})
    log = read_days(spark, str(tmp_path), [SETTINGS.report_date])
    out = f"{tmp_path}/out"
    jobs.run_daily(log, SETTINGS, out, f"{tmp_path}/store")
    assert read(out, "2017-04-14_卡顿次数比率-平台总卡顿率") == [["0.5"]]
    assert read(out, "2017-04-14_日志行数") == [["2017-04-14", "4", "1", "2"]]
    # No other day of the store was touched.
    assert os.listdir(f"{tmp_path}/store/rollup") and {
        f for f in os.listdir(f"{tmp_path}/store/rollup") if f.startswith("export_day")
    } == {"export_day=2017-04-14"}
    s = replace(SETTINGS, point_node_min_rows=0)
    facts = views.point_facts(in_window(log, s.day()), s)
    nodes = {r[0]: r[1] for r in facts.groupBy("cdn_ip").sum("row_n").collect()}
    assert sum(nodes.values()) == 4


def test_weeks_are_weeks_of_exports(spark, tmp_path):
    for day in range(1, 15):
        exported(spark, tmp_path, day, {"time": at(day), "v4": 0})
    stray = [{"time": at(8), "v4": 0}, {"time": at(1, 5), "v4": 1}]
    micro_log(spark, *stray).write.parquet(f"{tmp_path}/export_2017-04-08-001")
    log = read_days(spark, str(tmp_path), dates_in(SETTINGS.both_weeks()))
    facts = views.stall_facts(in_window(log, SETTINGS.both_weeks()), SETTINGS)
    (row,) = weekly.total_trend(facts, SETTINGS).collect()
    # The stray row is a day of its own: one of eight days of this week has a ratio of 1.
    assert (row.lag_ratio_this, row.lag_ratio_last) == (0.125, 0.0)


def test_a_week_with_quiet_days(spark, tmp_path):
    for day in range(1, 15):
        exported(spark, tmp_path, day, {"time": at(day), "v4": 1, "room_id": 7 if day % 2 else -1})
    log = read_days(spark, str(tmp_path), dates_in(SETTINGS.both_weeks()))
    jobs.run_weekly(log, SETTINGS, f"{tmp_path}/out")
    week = SETTINGS.week_label()
    assert read(f"{tmp_path}/out", f"卡顿率-平台总卡顿率（{week}）")[0][:2] == ["1.000000", "1.000000"]
    assert len(read(f"{tmp_path}/out", f"日志行数（{week}）")) == 14


def test_a_day_without_kept_rows(spark, tmp_path):
    exported(spark, tmp_path, 14, {"time": at(14), "room_id": -1})
    log = read_days(spark, str(tmp_path), [SETTINGS.report_date])
    jobs.run_daily(log, SETTINGS, f"{tmp_path}/out")
    assert len(read(f"{tmp_path}/out", "2017-04-14_卡顿率-各家分平台卡顿率")) == 8


def test_earlier_outputs_stay(spark, log, tmp_path):
    before = replace(SETTINGS, report_date=date(2017, 4, 13))
    for s in (before, SETTINGS, SETTINGS):
        jobs.run_points(log, s, str(tmp_path), SETTINGS.this_week())
    for folder in ("points", "points_noip"):
        dates = {r[0]: r[1] for r in spark.read.json(f"{tmp_path}/{folder}").groupBy("date").count().collect()}
        assert set(dates) == {date(2017, 4, 13), date(2017, 4, 14)} and len(set(dates.values())) == 1
    titles = {r.title.format(week=s.week_label(), date="") for s in (before, SETTINGS) for r in WEEKLY.values()}
    assert len(titles) == 2 * len(WEEKLY)


def test_minima_on_the_command_line(spark, log, tmp_path):
    day = log.filter("event_date = DATE '2017-04-14'").drop("event_date")
    day.write.parquet(f"{tmp_path}/export_2017-04-14-000")
    title = DAILY["daily_worst_nodes"].title.format(date="2017-04-14")
    sizes = []
    for least in ("0", "1000000"):
        jobs.main(
            ["daily", "--date", "2017-04-14", "--exports", str(tmp_path)]
            + ["--out", f"{tmp_path}/{least}", "--node-min-rows", least]
        )
        sizes.append(len(read(f"{tmp_path}/{least}", title)))
    assert sizes[0] > sizes[1] == 0
