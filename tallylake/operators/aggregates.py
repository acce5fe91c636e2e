"""Grouped measures over transactions.

Counts and sums combine inside each task before the shuffle, so one day, user or site
holding a large share of all rows costs no more than the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.functions.timeparts import day, half_hour
from tallylake.schema import AMOUNT, AMOUNT_SUM

ROLLUP_MEASURES = ("txn_count", "total_amount")


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", day(F.col("transaction_time")))


def _amount() -> Column:
    return F.sum("transfer_amount").cast(AMOUNT_SUM).alias("total_amount")


def daily_count(df: DataFrame) -> DataFrame:
    return _with_day(df).groupBy("day").agg(F.count("*").alias("total_count"))


def daily_amount(df: DataFrame) -> DataFrame:
    return _with_day(df).groupBy("day").agg(_amount())


def daily_currency_count(df: DataFrame) -> DataFrame:
    return _with_day(df).groupBy("day", "currency_code").agg(F.count("*").alias("total_count"))


def user_amount(df: DataFrame) -> DataFrame:
    return df.groupBy("username").agg(_amount())


def daily_users(
    df: DataFrame, by_site: bool = False, approx: bool = False, rsd: float = 0.05
) -> DataFrame:
    """Distinct users per day, or per day and site.

    Exact counting shuffles one row per distinct (group, user) and task, never the rows
    themselves; ``approx`` shuffles one fixed-size sketch per group and task.
    """
    users = F.approx_count_distinct("username", rsd) if approx else F.count_distinct("username")
    keys = ["day", "site_id"] if by_site else ["day"]
    return _with_day(df).groupBy(*keys).agg(users.alias("total_count"))


def _rollup_measures() -> list[Column]:
    # The stored column is narrower than the sum; a value that does not fit raises.
    return [
        F.count("*").alias("txn_count"),
        F.sum("transfer_amount").cast(AMOUNT).alias("total_amount"),
    ]


def user_30min(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("window_start", half_hour(F.col("transaction_time")))
        .groupBy("window_start", "site_id", "username")
        .agg(*_rollup_measures())
    )


def site_daily(df: DataFrame) -> DataFrame:
    return _with_day(df).groupBy("day", "site_id").agg(*_rollup_measures())
