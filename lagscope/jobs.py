"""End-to-end runs: read the log once, answer every report, write the outputs.

    python -m lagscope.jobs daily --exports DIR --date 2017-04-14 --out DIR --store DIR
    python -m lagscope.jobs weekly --store DIR --date 2017-04-14 --out DIR
    python -m lagscope.jobs points --exports DIR --date 2017-04-14 --out DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lagscope.operators import rollup, views
from lagscope.plans import daily, points, weekly
from lagscope.plans.reports import DAILY, LOG_ROWS, WEEKLY, Report
from lagscope.session import build_session
from lagscope.settings import Settings, dates_in
from lagscope.sinks.csv_report import write_report
from lagscope.sinks.point_log import all_points, write_points
from lagscope.sinks.shared import scratch, written
from lagscope.sources.exports import in_window, read_days, read_log, row_counts


@dataclass(frozen=True)
class Rollups:
    """Facts of one run, split by what the reports group by."""

    stalls: DataFrame
    nodes: DataFrame
    firsts: DataFrame

    @classmethod
    def of(cls, rolled: DataFrame) -> Rollups:
        return cls(
            stalls=rollup.level(rolled, "dims", views.STALL),
            nodes=rollup.level(rolled, "node", views.STALL),
            firsts=rollup.level(rolled, "dims", views.FIRST),
        )


def daily_reports(rolled: Rollups, viewers: DataFrame, s: Settings) -> dict[str, DataFrame]:
    """All tables of the daily report."""
    worst = daily.worst_provinces(rolled.stalls, s)
    return {
        "daily_lag_requests": daily.lag_requests(rolled.stalls),
        "daily_lag_viewers": daily.lag_viewers(viewers),
        "evening_lag_requests": daily.evening_lag_requests(rolled.stalls),
        "evening_lag_viewers": daily.evening_lag_viewers(viewers),
        "daily_worst_provinces": daily.worst_provinces_side_by_side(worst),
        "daily_worst_nodes": daily.worst_nodes(rolled.nodes, s),
        "daily_total_lag": daily.total_lag(rolled.stalls),
        "daily_lag_by_cdn": daily.lag_by_cdn(rolled.stalls),
        "daily_lag_by_isp_class": daily.lag_by_isp_class(rolled.stalls),
        "daily_lag_matrix": daily.lag_matrix(rolled.stalls),
        "daily_first_matrix": daily.first_matrix(rolled.firsts),
    }


def weekly_reports(rolled: Rollups, s: Settings) -> dict[str, DataFrame]:
    """All tables of the weekly report."""
    return {
        "weekly_total_trend": weekly.total_trend(rolled.stalls, s),
        "weekly_edu_trend": weekly.edu_trend(rolled.stalls, s),
        "weekly_cdn_trend": weekly.cdn_trend(rolled.stalls, s),
        "weekly_lag_matrix": weekly.lag_matrix(rolled.stalls, s),
        "weekly_isp_class": weekly.isp_class(rolled.stalls, s),
        "weekly_first_matrix": weekly.first_matrix(rolled.firsts, s),
        "weekly_worst_provinces": weekly.worst_provinces(rolled.stalls, s),
        "weekly_best_provinces": weekly.best_provinces(rolled.stalls, s),
        "weekly_best_provinces_by_cdn": weekly.best_provinces_by_cdn(rolled.stalls, s),
        "weekly_worst_provinces_by_cdn": weekly.worst_provinces_by_cdn(rolled.stalls, s),
    }


def _store_days(log: DataFrame, s: Settings, window: tuple[date, date], store: str) -> None:
    """Rolls up the days of a window of the log and keeps them in the store."""
    rows = in_window(log, window)
    rolled = rollup.report_rollup(views.report_facts(rows, s))
    rollup.write_days(rolled, row_counts(rows), s, window, store)


def run_daily(log: DataFrame, s: Settings, out: str, store: str | None = None) -> None:
    """The daily report. Two passes over the day: the rollup and the viewers. A third
    one reads its times alone, to count the rows stamped outside the day.

    With ``store`` the day's rollup is kept there for the weekly report.
    """
    spark = log.sparkSession
    with scratch(spark, "daily") as own:
        store = store or f"{own}/store"
        _store_days(log, s, s.day(), store)
        day = views.stall_facts(in_window(log, s.day()), s)
        viewers = written(rollup.viewer_counts(day), f"{own}/viewers")
        with views.held(rollup.read_store(spark, store, s.day(), s)) as rolled:
            _write_all(daily_reports(Rollups.of(rolled), viewers, s), DAILY, s, out)
        counts = rollup.read_records(spark, store, s.day())
        _write_counts(counts, f"{out}/{s.report_date}_日志行数")


def run_weekly(log: DataFrame, s: Settings, out: str, store: str | None = None) -> None:
    """The weekly report from one pass over the fourteen days of the log."""
    with scratch(log.sparkSession, "weekly") as own:
        store = store or f"{own}/store"
        _store_days(log, s, s.both_weeks(), store)
        run_weekly_from_store(log.sparkSession, s, out, store)


def run_weekly_from_store(spark: SparkSession, s: Settings, out: str, store: str) -> None:
    """The weekly report from the rollups of daily runs. The log is not read.

    A day without rows is left out of the means. Daily runs with another blocklist,
    latency bound or evening hour are refused.
    """
    with views.held(rollup.read_store(spark, store, s.both_weeks(), s)) as rolled:
        _write_all(weekly_reports(Rollups.of(rolled), s), WEEKLY, s, out)
    counts = rollup.read_records(spark, store, s.both_weeks())
    _write_counts(counts, f"{out}/日志行数（{s.week_label()}）")


def run_points(
    log: DataFrame, s: Settings, out: str, window: tuple[date, date] | None = None
) -> None:
    """The metric points of a window, by default the report day: one pass.

    Points of other dates stay where they are. The valid nodes are a written table,
    whose size is known when joins are planned.
    """
    rows = in_window(log, window or s.day())
    with scratch(log.sparkSession, "points") as own:
        groups = written(rollup.point_groups(views.point_facts(rows, s)), f"{own}/groups")
        nodes = written(points.valid_nodes(groups, s), f"{own}/nodes")
        for folder, by_node in (("points", True), ("points_noip", False)):
            both = all_points(
                points.connect_lag(groups, nodes, s, by_node),
                points.first(groups, nodes, s, by_node),
            )
            write_points(both, f"{out}/{folder}/date={s.report_date}", mode="overwrite")


def _write_counts(records: DataFrame, path: str) -> None:
    counts = records.select(*LOG_ROWS).orderBy("export_day")
    write_report(counts, path, LOG_ROWS, mode="overwrite")


def _write_all(
    tables: Mapping[str, DataFrame], reports: Mapping[str, Report], s: Settings, out: str
) -> None:
    """Writes the tables. Each is a few small Spark jobs, so several run at a time."""

    def write(key: str) -> None:
        report = reports[key]
        title = report.title.format(date=s.report_date, week=s.week_label())
        write_report(
            tables[key], f"{out}/{title}", report.headings, mode="overwrite", full=report.full
        )

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, reports))


#: Thresholds a run may set, as options of the command line.
_MINIMA = {
    "province_min_rows": "rows a day of a province that is ranked",
    "node_min_rows": "rows a day of a node that is ranked",
    "weekly_province_min_rows": "rows a week of a province that is ranked",
    "point_node_min_rows": "rows of a node that has points",
}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lagscope.jobs")
    parser.add_argument("report", choices=["daily", "weekly", "points"])
    parser.add_argument("--date", type=date.fromisoformat, required=True, help="last day covered")
    parser.add_argument("--out", required=True)
    parser.add_argument("--exports", help="folder with the parts of each day")
    parser.add_argument("--log", help="one parquet log of all days")
    parser.add_argument("--store", help="folder that keeps daily rollups")
    parser.add_argument("--block", nargs="*", default=[], help="client addresses to leave out")
    parser.add_argument("--zone", default="UTC", help="time zone of hours, days and points")
    for name, meaning in _MINIMA.items():
        option = f"--{name.replace('_', '-')}"
        parser.add_argument(option, type=int, metavar="N", help=f"more than N {meaning}")
    parser.add_argument("--show-schema", action="store_true")
    given = parser.parse_args(args)

    spark = build_session(f"lagscope-{given.report}", zone=given.zone)
    minima = {n: v for n in _MINIMA if (v := getattr(given, n)) is not None}
    s = Settings(report_date=given.date, blocked_ips=tuple(given.block), **minima)
    window = s.both_weeks() if given.report == "weekly" else s.day()
    log = None
    if given.exports:
        log = read_days(spark, given.exports, dates_in(window))
    elif given.log:
        log = read_log(spark, given.log)
    elif given.report != "weekly" or not given.store:
        parser.error("give --exports or --log; a weekly report may use --store alone")
    if given.show_schema and log is not None:
        log.printSchema()

    if given.report == "daily":
        run_daily(log, s, given.out, given.store)
    elif given.report == "points":
        run_points(log, s, given.out)
    elif log is None:
        run_weekly_from_store(spark, s, given.out, given.store)
    else:
        run_weekly(log, s, given.out, given.store)


if __name__ == "__main__":
    main()
