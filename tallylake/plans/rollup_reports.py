"""Reports answered from the stored rollups, equal to a scan of all transactions.

The answer is the sum of three parts: the stored rollup, the rows that came too late for it, and
the loads that no run has seen yet.  Only the last are transactions, and only those commits are
read.  A rollup counts every row that was loaded; after a compaction that drops rows build it anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions.timeparts import as_date, day_range, time_range
from tallylake.operators import aggregates
from tallylake.operators.ordering import order_report
from tallylake.plans import rollups
from tallylake.plans.reports import END_DATE, START_DATE, TOP_USERS
from tallylake.schema import AMOUNT_SUM
from tallylake.sources import tables
from tallylake.sources.tables import Table

Days = tuple[str | dt.date, str | dt.date] | None


def _unseen(spark: SparkSession, root: str, rollup: Table) -> DataFrame:
    """Transactions of the loads the rollup has not seen: all of them before its first run."""
    facts = tables.transactions(root)
    seen = tables.seen_batch(spark, rollup) if tables.last_seq(spark, rollup) >= 0 else None
    return tables.read_table(spark, facts) if seen is None else tables.read_after(spark, facts, seen)


def _parts(
    spark: SparkSession,
    root: str,
    rollup: Table,
    stored: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    days: Days,
) -> DataFrame:
    """Rows of the rollup's shape that together hold every transaction of the days once."""
    late, fresh = rollups.late_rows(spark, rollup), _unseen(spark, root, rollup)
    parts = [p for p in (stored, late) if p is not None]
    if days:
        fresh = day_range(fresh, *days)
        parts = [_of_days(p, rollup.month_of, days) for p in parts]
    return reduce(DataFrame.unionByName, [*parts, build(fresh)])


def _of_days(rows: DataFrame, bucket: str, days: tuple[str | dt.date, str | dt.date]) -> DataFrame:
    start, end = map(as_date, days)
    if bucket == "day":
        return rows.where(F.col(bucket).between(F.lit(start), F.lit(end)))
    return time_range(rows, start, end + dt.timedelta(days=1), bucket)


def _by_day(spark: SparkSession, root: str, days: Days, measure: Column) -> DataFrame:
    stored = rollups.read_site_daily(spark, root)
    rows = _parts(spark, root, tables.site_daily(root), stored, aggregates.site_daily, days)
    return order_report(rows.groupBy("day").agg(measure), "day", ["day"])


def _amount() -> Column:
    return F.sum("total_amount").cast(AMOUNT_SUM).alias("total_amount")


def daily_count(spark: SparkSession, root: str, days: Days = None) -> DataFrame:
    """Transactions per day, of all days or of a closed range: (day, total_count)."""
    return _by_day(spark, root, days, F.sum("txn_count").alias("total_count"))


def daily_amount(spark: SparkSession, root: str, days: Days = None) -> DataFrame:
    """Amount per day, of all days or of a closed range: (day, total_amount)."""
    return _by_day(spark, root, days, _amount())


def top_users(
    spark: SparkSession,
    root: str,
    start: str | dt.date = START_DATE,
    end: str | dt.date = END_DATE,
    sort_by: str = "username",
    descending: bool = False,
) -> DataFrame:
    """The first 20 of (username, total_amount) over the days start to end."""
    stored = rollups.read_user_30min(spark, root)
    rollup = tables.user_30min(root)
    rows = _parts(spark, root, rollup, stored, aggregates.user_30min, (start, end))
    totals = rows.groupBy("username").agg(_amount())
    allowed = ("username", "total_amount")
    return order_report(totals, sort_by, allowed, descending, ["username"]).limit(TOP_USERS)
