"""Date rules (DAT1-5, PRJ6-7, PRJ11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from tillstack.functions.text import _c


def to_naive_ts(c) -> Column:
    """PRJ6: text → timestamp without zone (ANSI: garbage raises)."""
    return _c(c).cast("timestamp_ntz")


def date_key(d) -> Column:
    """PRJ7: yyyymmdd as int, by arithmetic (no string round-trip)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def report_date(ds) -> _dt.date:
    """DAT4: the report a run picks up is the one for the day before ``ds``."""
    if isinstance(ds, str):
        ds = _dt.date.fromisoformat(ds)
    return ds - _dt.timedelta(days=1)


def local_today(tz: str, now_utc: _dt.datetime | None = None) -> Column:
    """PRJ11: today's date in ``tz`` (``now_utc`` pins it for tests)."""
    now = F.lit(now_utc).cast("timestamp") if now_utc is not None else F.current_timestamp()
    return F.to_date(F.from_utc_timestamp(now, tz))
