"""Epochs, zones, date keys and re-processing windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import as_column

DAY_KEY = "yyyyMMdd"


def day_key(c: str | Column) -> Column:
    """``yyyyMMdd`` text of a date or timestamp."""
    return F.date_format(as_column(c), DAY_KEY)


def day_from_key(c: str | Column) -> Column:
    return F.to_date(as_column(c), DAY_KEY)


def dashless(c: str | Column) -> Column:
    """``yyyy-MM-dd`` text as a ``yyyyMMdd`` key."""
    return F.replace(as_column(c), F.lit("-"), F.lit(""))


def from_micros(c: str | Column) -> Column:
    return F.timestamp_micros(as_column(c).cast("long"))


def epoch_day(c: str | Column) -> Column:
    """UTC date of epoch seconds."""
    return F.to_date(F.timestamp_seconds(as_column(c)))


def shift_zone(ts: str | Column, zone: str, mode: str = "relabel") -> Column:
    """``relabel`` reads the UTC wall time as local time of ``zone`` (the stored form);
    ``convert`` gives the local wall time."""
    if mode == "relabel":
        return F.to_utc_timestamp(as_column(ts), zone)
    if mode == "convert":
        return F.from_utc_timestamp(as_column(ts), zone)
    raise ValueError(f"unknown zone mode {mode!r}")


def micros_text(ts: str | Column) -> Column:
    """Fixed-width timestamp text, for use inside hashes."""
    return F.date_format(as_column(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_text(epoch: str | Column) -> Column:
    """Epoch seconds as ISO text in UTC."""
    return F.date_format(F.timestamp_seconds(as_column(epoch)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def iso_epoch(text: str | Column) -> Column:
    """ISO text, with ``Z`` or an offset, as epoch seconds."""
    return F.unix_timestamp(F.to_timestamp(as_column(text)))


def day_path(ts: str | Column, missing: str = "unknown") -> Column:
    """``yyyy/MM/dd`` folder of a timestamp, or ``unknown``."""
    return F.coalesce(F.date_format(as_column(ts), "yyyy/MM/dd"), F.lit(missing))


@dataclass(frozen=True)
class DayRange:
    """Closed range of days that a run re-processes."""

    first: date
    last: date

    @property
    def first_key(self) -> str:
        return self.first.strftime("%Y%m%d")

    @property
    def last_key(self) -> str:
        return self.last.strftime("%Y%m%d")

    def holds_day(self, c: str | Column) -> Column:
        return as_column(c).between(F.lit(self.first), F.lit(self.last))

    def holds_key(self, c: str | Column) -> Column:
        """For ``yyyyMMdd`` partition columns: prunes folders."""
        return as_column(c).between(self.first_key, self.last_key)

    def holds_ts(self, c: str | Column) -> Column:
        """Half-open bounds on the bare column, so that row-group statistics apply."""
        col = as_column(c)
        return (col >= F.lit(self.first).cast("timestamp")) & (
            col < F.lit(self.last + timedelta(days=1)).cast("timestamp")
        )

    def holds_epoch(self, c: str | Column) -> Column:
        """Half-open bounds on epoch seconds."""
        col = as_column(c)
        start = F.unix_timestamp(F.lit(self.first).cast("timestamp"))
        end = F.unix_timestamp(F.lit(self.last + timedelta(days=1)).cast("timestamp"))
        return (col >= start) & (col < end)

    def days(self) -> list[date]:
        return [self.first + timedelta(days=i) for i in range((self.last - self.first).days + 1)]


def lookback(as_of: date, days_from: int, days_to: int, swap_ok: bool = False) -> DayRange:
    """``[as_of - days_from, as_of - days_to]``; empty when ``days_from < days_to``
    unless ``swap_ok``."""
    if swap_ok and days_from < days_to:
        days_from, days_to = days_to, days_from
    return DayRange(as_of - timedelta(days=days_from), as_of - timedelta(days=days_to))


def day_list(as_of: str | Column, days_from: int, days_to: int, swap_ok: bool = False) -> Column:
    """The days of a lookback as an array column, oldest first."""
    if swap_ok and days_from < days_to:
        days_from, days_to = days_to, days_from
    base = as_column(as_of)
    if days_from < days_to:
        return F.array().cast("array<date>")
    return F.sequence(F.date_sub(base, days_from), F.date_sub(base, days_to))


def _month_start(d: date) -> date:
    return d.replace(day=1)


def named_range(text: str, as_of: date) -> DayRange:
    """An explicit ``a,b`` range or one of the usual report range names."""
    if "," in text:
        first, last = (date.fromisoformat(part.strip()) for part in text.split(",", 1))
        return DayRange(first, last)
    monday = as_of - timedelta(days=as_of.weekday())
    sunday = as_of - timedelta(days=(as_of.weekday() + 1) % 7)
    month = _month_start(as_of)
    ranges = {
        "TODAY": (as_of, as_of),
        "YESTERDAY": (as_of - timedelta(days=1), as_of - timedelta(days=1)),
        "LAST_7_DAYS": (as_of - timedelta(days=7), as_of - timedelta(days=1)),
        "LAST_14_DAYS": (as_of - timedelta(days=14), as_of - timedelta(days=1)),
        "LAST_30_DAYS": (as_of - timedelta(days=30), as_of - timedelta(days=1)),
        "THIS_WEEK_MON_TODAY": (monday, as_of),
        "THIS_WEEK_SUN_TODAY": (sunday, as_of),
        "LAST_WEEK_MON_SUN": (monday - timedelta(days=7), monday - timedelta(days=1)),
        "LAST_WEEK_SUN_SAT": (sunday - timedelta(days=7), sunday - timedelta(days=1)),
        "LAST_BUSINESS_WEEK": (monday - timedelta(days=7), monday - timedelta(days=3)),
        "THIS_MONTH": (month, as_of),
        "LAST_MONTH": (_month_start(month - timedelta(days=1)), month - timedelta(days=1)),
    }
    try:
        return DayRange(*ranges[text.strip().upper()])
    except KeyError:
        raise ValueError(f"unknown date range {text!r}") from None
