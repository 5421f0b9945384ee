"""Time helpers that stay inside codegen and never depend on the session time zone.

Event times are wall-clock times of the logging server, so every event column
is ``timestamp_ntz``.  Bounds are emitted as literals, which lets Catalyst push
them into the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = str | datetime


def as_datetime(as_of: AsOf) -> datetime:
    return as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))


def ts_literal(value: AsOf) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{as_datetime(value).isoformat(sep=' ')}'")


def date_literal(value: AsOf | date) -> Column:
    day = value if type(value) is date else as_datetime(value).date()
    return F.expr(f"DATE'{day.isoformat()}'")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_start(ts: str | Column) -> Column:
    """Start of the hour.  ``date_trunc`` would turn an NTZ input into a zoned
    timestamp, so the hour is added back onto the date instead."""
    ts = col(ts)
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def second_start(ts: str | Column) -> Column:
    ts = col(ts)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.timestamp_add("SECOND", seconds, F.to_date(ts).cast("timestamp_ntz"))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp, as BIGINT."""
    ts = col(ts)
    minutes = F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    micros = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return minutes * 60_000_000 + micros


def from_epoch_micros(micros: Column) -> Column:
    """Inverse of :func:`epoch_micros`."""
    day_micros = 86_400_000_000
    day = F.floor(micros / day_micros).cast("int")
    return F.timestamp_add("MICROSECOND", F.pmod(micros, F.lit(day_micros)), F.date_from_unix_date(day).cast("timestamp_ntz"))


def as_instant(ts: str | Column) -> Column:
    """Wall-clock time as the UTC instant with the same digits, for operators that need a zoned type."""
    return F.timestamp_micros(epoch_micros(ts))


def from_instant(instant: Column) -> Column:
    """Inverse of :func:`as_instant`."""
    return from_epoch_micros(F.unix_micros(instant))


def within(
    df: DataFrame,
    column: str,
    as_of: AsOf,
    *,
    hours: int | None = None,
    days: int | None = None,
    today: bool = False,
    from_hour: int | None = None,
) -> DataFrame:
    """Rows of the look-back window that ends at ``as_of``.

    ``hours`` / ``days`` on a timestamp column are exact spans; ``days`` on a
    date column counts calendar days before today.  ``from_hour=k`` starts at the
    beginning of the hour ``k`` hours before the current one.
    """
    end = as_datetime(as_of)
    on_date = dict(df.dtypes)[column] == "date"
    if today:
        start = datetime(end.year, end.month, end.day)
    elif from_hour is not None:
        start = end.replace(minute=0, second=0, microsecond=0) - timedelta(hours=from_hour)
    else:
        start = end - timedelta(hours=hours or 0, days=days or 0)
    if on_date:
        return df.filter((F.col(column) >= date_literal(start)) & (F.col(column) <= date_literal(end)))
    return df.filter((F.col(column) >= ts_literal(start)) & (F.col(column) <= ts_literal(end)))


def is_weekend(day: str | Column) -> Column:
    return F.when(F.weekday(col(day)) >= 5, 1).otherwise(0)


def is_work_hour(hour: str | Column) -> Column:
    return F.when(col(hour).between(9, 18), 1).otherwise(0)


def calendar_flags(df: DataFrame, day: str = "event_date", hour: str = "event_hour") -> DataFrame:
    return df.withColumns({"is_weekend": is_weekend(day), "is_work_hour": is_work_hour(hour)})
