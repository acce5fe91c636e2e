"""The five parameterised reports.  Each returns a lazy, ordered DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallylake.functions.timeparts import day_range
from tallylake.operators import aggregates
from tallylake.operators.ordering import order_report

# Defaults of the date-range reports.
START_DATE = "2025-05-01"
END_DATE = "2025-06-01"
TOP_USERS = 20


def daily_count(df: DataFrame, sort_by: str = "day", descending: bool = False) -> DataFrame:
    """Transactions per day: (day, total_count)."""
    allowed = ("day", "total_count")
    _single(sort_by, allowed)
    return order_report(aggregates.daily_count(df), sort_by, allowed, descending, ["day"])


def daily_amount(df: DataFrame, sort_by: str = "day", descending: bool = False) -> DataFrame:
    """Amount per day: (day, total_amount)."""
    allowed = ("day", "total_amount")
    _single(sort_by, allowed)
    return order_report(aggregates.daily_amount(df), sort_by, allowed, descending, ["day"])


def daily_currency_count(
    df: DataFrame,
    sort_by: str | Sequence[str] = ("day", "currency_code"),
    descending: bool = False,
) -> DataFrame:
    """Transactions per day and currency: (day, currency_code, total_count)."""
    return order_report(
        aggregates.daily_currency_count(df),
        sort_by,
        ("day", "currency_code", "total_count"),
        descending,
        ["day", "currency_code"],
    )


def top_users(
    df: DataFrame,
    start: str | dt.date = START_DATE,
    end: str | dt.date = END_DATE,
    sort_by: str = "username",
    descending: bool = False,
) -> DataFrame:
    """The first 20 of (username, total_amount) over the days start to end.

    The order is by name unless ``sort_by="total_amount"`` is asked for.
    """
    allowed = ("username", "total_amount")
    _single(sort_by, allowed)
    totals = aggregates.user_amount(day_range(df, start, end))
    return order_report(totals, sort_by, allowed, descending, ["username"]).limit(TOP_USERS)


def daily_unique_users(
    df: DataFrame,
    start: str | dt.date = START_DATE,
    end: str | dt.date = END_DATE,
    by_site: bool = False,
    approx: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """Distinct users per day, or per day and site, ordered by those columns."""
    keys = ["day", "site_id"] if by_site else ["day"]
    counts = aggregates.daily_users(day_range(df, start, end), by_site, approx, rsd)
    return order_report(counts, keys, keys)


def _single(sort_by: str, allowed: Sequence[str]) -> None:
    if sort_by not in allowed:
        raise ValueError(f"sort_by must be one of {', '.join(allowed)}, not {sort_by!r}")
