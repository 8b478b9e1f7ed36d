"""Date and time helpers on ``yyyyMMdd`` / ``yyyyMMddHH`` partition strings and epoch values.

Jobs take the reference date as an argument (``as_of``) and never read the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_shift(ymd, days: int) -> Column:
    """``yyyyMMdd`` string moved back by ``days`` days."""
    return F.date_format(F.date_sub(F.to_date(_col(ymd), "yyyyMMdd"), days), "yyyyMMdd")


def hour_shift(ymdh, hours: int) -> Column:
    """``yyyyMMddHH`` string moved back by ``hours`` hours (no time-zone involved)."""
    ts = F.to_timestamp_ntz(_col(ymdh), F.lit("yyyyMMddHH"))
    return F.date_format(ts - F.make_interval(hours=F.lit(hours)), "yyyyMMddHH")


def window_start(as_of: str, days: int) -> str:
    """First ``yyyyMMdd`` of a ``days``-long look-back ending at ``as_of`` (a plain parameter)."""
    d = _dt.datetime.strptime(as_of, "%Y%m%d").date() - _dt.timedelta(days=days)
    return d.strftime("%Y%m%d")


def window_start_seconds(as_of: str, days: int) -> int:
    """Epoch seconds (UTC midnight) of :func:`window_start`."""
    d = _dt.datetime.strptime(window_start(as_of, days), "%Y%m%d").replace(tzinfo=_dt.timezone.utc)
    return int(d.timestamp())


def window_filter(df, col: str, days: int, as_of: str, end: str | None = None):
    """Rows whose ``yyyyMMdd`` column lies in the look-back window (string compare prunes partitions)."""
    cond = F.col(col) >= F.lit(window_start(as_of, days))
    if end is not None:
        cond = cond & (F.col(col) <= F.lit(end))
    return df.where(cond)


def epoch_millis(ts) -> Column:
    """Milliseconds since 1970-01-01 of a timestamp without time zone (no session-zone dependence)."""
    return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _col(ts))


def epoch_seconds_int(event_time_ms) -> Column:
    """``cast(event_time / 1000 as int)``: milliseconds truncated to whole seconds."""
    return (_col(event_time_ms) / 1000).cast("int")


def age_days(time_s, start_s: int) -> Column:
    """Whole days from a window start to an epoch-seconds time (truncated), 0 when time is 0."""
    t = _col(time_s).cast("bigint")
    return F.when(t == 0, F.lit(0).cast("bigint")).otherwise(trunc_div(t - F.lit(start_s), 86400))


def trunc_div(num: Column, den: int) -> Column:
    """Integer division truncating toward zero, as bigint."""
    return (F.signum(num) * F.floor(F.abs(num) / F.lit(den))).cast("bigint")
