"""Calendar bins on DATE arithmetic, so results do not depend on the session zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: Column) -> Column:
    return ts.cast("date")


def week(ts: Column) -> Column:
    """ISO Monday as DATE."""
    return F.trunc(day(ts), "week")


def month_label(ts: Column) -> Column:
    """Month start + 14 days, the label used for monthly rows."""
    return F.date_add(F.trunc(day(ts), "month"), 14).cast("timestamp_ntz")


def epoch_seconds(date: Column) -> Column:
    """Seconds since 1970 of a DATE, as INT."""
    return (F.unix_date(date) * F.lit(86400)).cast("int")


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a day-grained value, as LONG."""
    return F.unix_date(day(ts)).cast("long") * F.lit(86_400_000)


def month_start(run_date: dt.date) -> dt.date:
    return run_date.replace(day=1)


def trailing_month_start(run_date: dt.date, days: int = 90) -> dt.date:
    """Start of the month that lies ``days`` before the run date."""
    return month_start(run_date - dt.timedelta(days=days))
