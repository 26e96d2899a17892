"""Calendar helpers: accrual month, quarter locking dates, renewal windows.

Helpers take column names and build one SQL expression each (see ``functions.text``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import q


def month_start(c: str | Column) -> Column:
    """``DATEFROMPARTS(YEAR(c), MONTH(c), 1)`` as a DATE."""
    if isinstance(c, str):
        return F.expr(month_start_sql(c))
    return F.trunc(c.cast("date"), "month")


def month_start_sql(name: str) -> str:
    return f"trunc(CAST({q(name)} AS DATE), 'month')"


def quarter_lock_sql(name: str) -> str:
    c = q(name)
    return (f"CASE WHEN month({c}) <= 3 THEN make_date(year({c}), 5, 15) "
            f"WHEN month({c}) <= 6 THEN make_date(year({c}), 8, 15) "
            f"WHEN month({c}) <= 9 THEN make_date(year({c}), 11, 15) "
            f"ELSE make_date(year({c}) + 1, 2, 15) END")


def quarter_lock(c: str) -> Column:
    """Date on which the quarter of ``c`` is locked: the 15th of the second month
    after the quarter ends (Q1 -> 15 May, Q2 -> 15 Aug, Q3 -> 15 Nov, Q4 -> 15 Feb
    of the next year). NULL stays NULL."""
    return F.expr(quarter_lock_sql(c))


def qtr_locking_date(booking: str) -> Column:
    """Lock date of a booking's quarter. Bookings with no date fall into the last arm
    in the reference (``else``), which yields NULL there as well."""
    return quarter_lock(booking)


def renewal_locking_date(prev_end: str, booked: str) -> Column:
    """Lock date of the quarter in which the prior policy ended, or NULL when the
    renewal was booked after that lock. ``booked`` keeps its time of day: a booking
    at 10:00 on the lock day is late."""
    return F.expr(renewal_lock_sql(prev_end, booked))


def renewal_lock_sql(prev_end: str, booked: str) -> str:
    lock = quarter_lock_sql(prev_end)
    return f"CASE WHEN {q(booked)} <= CAST({lock} AS TIMESTAMP_NTZ) THEN {lock} END"


def quarter_label(c: str) -> Column:
    m = f"month({q(c)})"
    return F.expr(f"CASE WHEN {m} IN (1, 2, 3) THEN 'Q1-JFM' WHEN {m} IN (4, 5, 6) THEN 'Q2-AMJ' "
                  f"WHEN {m} IN (7, 8, 9) THEN 'Q3-JAS' ELSE 'Q4-OND' END")


def ts_literal(d: dt.date | dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{_ts(d).isoformat(sep=' ')}'"


def in_window(c: str, lo: dt.date | dt.datetime, hi: dt.date | dt.datetime) -> Column:
    """Half-open ``lo <= c < hi`` with literal bounds (pushed down to the scan)."""
    return F.expr(window_sql(c, lo, hi))


def window_sql(c: str, lo: dt.date | dt.datetime, hi: dt.date | dt.datetime) -> str:
    return f"{q(c)} >= {ts_literal(lo)} AND {q(c)} < {ts_literal(hi)}"


def _ts(d: dt.date | dt.datetime) -> dt.datetime:
    return d if isinstance(d, dt.datetime) else dt.datetime(d.year, d.month, d.day)


def add_months(d: dt.date, n: int) -> dt.date:
    """Driver-side month arithmetic on a literal date (day clamped to month end)."""
    y, m = divmod(d.month - 1 + n, 12)
    y += d.year
    m += 1
    import calendar

    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))
