"""Time columns and time-range filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def day(ts: Column) -> Column:
    return F.to_date(ts)


def half_hour(ts: Column) -> Column:
    """Start of the 30-minute bucket."""
    return F.window(ts, "30 minutes").getField("start")


def month_number(ts: Column) -> Column:
    """202505 for any time in May 2025."""
    return F.year(ts) * 100 + F.month(ts)


def epoch_millis(text: Column) -> Column:
    """Epoch milliseconds, as a number or as text, to a timestamp.

    NULL when the text is no integer or lies outside the years 1 to 9999.
    """
    millis = F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
    first, last = -62_135_596_800_000, 253_402_300_799_999
    return F.when(millis.between(first, last), F.timestamp_millis(millis))


def as_date(value: str | dt.date) -> dt.date:
    """Parse a report parameter; anything but a calendar day is an error."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def time_range(
    df: DataFrame,
    start: dt.date | dt.datetime | None = None,
    before: dt.date | dt.datetime | None = None,
    column: str = "transaction_time",
) -> DataFrame:
    """Rows with ``start <= column < before``; times without a zone mean UTC.

    A predicate on the time column alone never prunes the month partitions, so the
    same bounds are repeated on ``yyyymm`` where the table has that column.
    """
    months = "yyyymm" in df.columns
    kind = df.schema[column].dataType
    if start is not None:
        first = _instant(start)
        df = df.where(F.col(column) >= _literal(first, kind))
        if months:
            df = df.where(F.col("yyyymm") >= first.year * 100 + first.month)
    if before is not None:
        end = _instant(before)
        last = end - dt.timedelta(microseconds=1)
        df = df.where(F.col(column) < _literal(end, kind))
        if months:
            df = df.where(F.col("yyyymm") <= last.year * 100 + last.month)
    return df


def day_range(df: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Rows of the days ``start`` to ``end``, the whole end day included."""
    return time_range(df, as_date(start), as_date(end) + dt.timedelta(days=1))


def _instant(value: dt.date | dt.datetime) -> dt.datetime:
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    if value.tzinfo:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _literal(value: dt.datetime, kind: T.DataType) -> Column:
    # A literal of the column's own type, or the filter would not reach the scan.
    text = F.lit(value.isoformat(sep=" "))
    if isinstance(kind, T.TimestampNTZType):
        return text.cast("timestamp_ntz")
    return F.concat(text, F.lit("+00:00")).cast("timestamp")
