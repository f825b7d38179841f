"""Parameters of the reports: dates, thresholds, blocklist."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


@dataclass(frozen=True)
class Settings:
    """One report run.

    ``report_date`` is the last day covered, i.e. the day before the run.
    """

    report_date: date
    blocked_ips: tuple[str, ...] = ()
    country: str = "中国"
    evening_hour: int = 19
    first_max_ms: int = 10_000
    point_max_ms: int = 30_000
    province_min_rows: int = 500
    province_top: int = 5
    node_min_rows: int = 3_000
    node_top: int = 10
    weekly_province_min_rows: int = 100_000
    weekly_top: int = 5
    point_node_min_rows: int = 1_000
    point_hour: int = 8

    def day(self) -> tuple[date, date]:
        """The report day as a half-open window."""
        return self.report_date, self.report_date + timedelta(days=1)

    def this_week(self) -> tuple[date, date]:
        """The seven days that end with the report day, half-open."""
        end = self.report_date + timedelta(days=1)
        return end - timedelta(days=7), end

    def last_week(self) -> tuple[date, date]:
        """The seven days before :meth:`this_week`, half-open."""
        end, _ = self.this_week()
        return end - timedelta(days=7), end

    def both_weeks(self) -> tuple[date, date]:
        return self.last_week()[0], self.this_week()[1]

    def week_label(self) -> str:
        first, end = self.this_week()
        return f"{first:%Y-%m-%d}-{end - timedelta(days=1):%Y-%m-%d}"


def dates_in(window: tuple[date, date]) -> list[date]:
    """The days of a half-open window."""
    start, end = window
    return [start + timedelta(days=i) for i in range((end - start).days)]
