"""Distinct users from stored sketches.

Each run sketches the users of the loads since the last one, by day and site, whatever days
their rows are of.  Sketches of one day merge into that of all its rows, so late rows need no
rule of their own, and a report never reads transactions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions.timeparts import as_date, day
from tallylake.plans.reports import END_DATE, START_DATE
from tallylake.operators.ordering import order_report
from tallylake.sources import tables

#: Base two logarithm of a sketch's registers, and with it the relative error.
LOG_REGISTERS = 12
RELATIVE_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
_KEYS = ["day", "site_id"]


def refresh_user_sketches(spark: SparkSession, root: str) -> int:
    """Sketch the loads since the last run; returns the number of the last run, -1 for none."""
    table, facts = tables.user_sketches(root), tables.transactions(root)
    last, through = tables.last_seq(spark, table), tables.last_seq(spark, facts)
    seen = tables.seen_batch(spark, table) if last >= 0 else -1
    if through <= seen:
        return last
    rows = tables.read_after(spark, facts, seen) if last >= 0 else tables.read_table(spark, facts)
    rows = rows.where(F.col("batch_id") <= through).withColumn("day", day(F.col("transaction_time")))
    users = F.hll_sketch_agg("username", LOG_REGISTERS).alias("users")
    sketches = rows.groupBy(*_KEYS).agg(users)
    noted = spark.range(0, 1, 1, 1).select(
        F.lit(through).cast("bigint").alias("through_batch"), F.lit(0).alias("late_rows")
    )
    # Before the rows, whose marker commits both.
    tables.write_commit(noted, tables.rollup_audit(table), last + 1)
    tables.write_commit(sketches.sortWithinPartitions(*_KEYS), table, last + 1)
    return last + 1


def compact_user_sketches(spark: SparkSession, root: str) -> int | None:
    """Merge the runs' sketches into one for each day and site of the months that changed."""

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_KEYS).agg(F.hll_union_agg("users").alias("users"))

    return tables.compact(spark, tables.user_sketches(root), merged)


def _between(spark: SparkSession, root: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    rows = tables.read_table(spark, tables.user_sketches(root))
    return rows.where(F.col("day").between(F.lit(as_date(start)), F.lit(as_date(end))))


def _estimate() -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg("users")).alias("total_count")


def daily_unique_users_sketch(
    spark: SparkSession,
    root: str,
    start: str | dt.date = START_DATE,
    end: str | dt.date = END_DATE,
    by_site: bool = False,
) -> DataFrame:
    """Distinct users per day, or per day and site, within ``RELATIVE_ERROR``."""
    keys = _KEYS if by_site else ["day"]
    return order_report(_between(spark, root, start, end).groupBy(*keys).agg(_estimate()), keys, keys)


def unique_users_sketch(
    spark: SparkSession,
    root: str,
    start: str | dt.date = START_DATE,
    end: str | dt.date = END_DATE,
) -> DataFrame:
    """Distinct users of all the days together: one row."""
    return _between(spark, root, start, end).agg(_estimate())
