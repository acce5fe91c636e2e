"""Order, ties, limits, parameters and plans of the reports."""

from __future__ import annotations

import pytest
from conftest import SMALL

from tallylake import fixtures
from tallylake.plans import reports
from tallylake.sources import tables
from tallylake.functions.timeparts import day_range


@pytest.fixture(scope="module")
def txns(spark):
    return fixtures.event_transactions(spark, SMALL, raw_users=True).cache()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize(
    "report, measure", [(reports.daily_count, "total_count"), (reports.daily_amount, "total_amount")]
)
def test_single_column_order(txns, report, measure, descending):
    by_day = rows(report(txns, descending=descending))
    assert by_day == sorted(by_day, key=lambda r: r[0], reverse=descending)
    by_measure = rows(report(txns, measure, descending))
    assert by_measure == sorted(by_day, key=lambda r: (-r[1] if descending else r[1], r[0]))


def test_currency_order(txns):
    default = rows(reports.daily_currency_count(txns))
    assert default == sorted(default, key=lambda r: r[:2])
    by_count = rows(reports.daily_currency_count(txns, "total_count, currency_code", True))
    keyed = [(r[2], r[1]) for r in by_count]
    assert keyed == sorted(keyed, reverse=True)
    ties = rows(reports.daily_currency_count(txns, ["total_count"]))
    assert ties == sorted(default, key=lambda r: (r[2], r[0], r[1]))


def test_top_users(txns):
    days = ("2024-01-01", "2024-01-31")
    by_name = rows(reports.top_users(txns, *days))
    assert len(by_name) <= 20 and by_name == sorted(by_name)
    everyone = rows(reports.top_users(txns, *days, sort_by="total_amount", descending=True))
    assert everyone == sorted(everyone, key=lambda r: (-r[1], r[0]))
    assert "TakeOrderedAndProject" in plan(reports.top_users(txns, *days))


def test_end_day_is_included(spark):
    texts = ["2025-05-31 23:59:59.999", "2025-06-01 00:00:00", "2025-06-01 23:59:59.999",
             "2025-06-02 00:00:00", "2025-04-30 23:59:59.999"]
    df = spark.createDataFrame([(t, "u") for t in texts], "t string, username string")
    df = df.selectExpr(
        "username", "cast(t AS timestamp) AS transaction_time", "1.00BD AS transfer_amount"
    )
    counted = rows(reports.daily_unique_users(df))
    assert [str(r[0]) for r in counted] == ["2025-05-31", "2025-06-01"]
    assert rows(reports.top_users(df))[0][1] == 3


def test_unique_users_order(txns):
    by_site = rows(reports.daily_unique_users(txns, "2024-01-01", "2024-01-31", by_site=True))
    assert by_site == sorted(by_site) and len(by_site[0]) == 3


@pytest.mark.parametrize(
    "call",
    [
        lambda df: reports.daily_count(df, "total_amount"),
        lambda df: reports.daily_amount(df, "username"),
        lambda df: reports.daily_currency_count(df, ["day", "username"]),
        lambda df: reports.top_users(df, sort_by="day"),
        lambda df: reports.top_users(df, start="2025-05-01' OR 1=1"),
    ],
)
def test_unknown_parameters(txns, call):
    with pytest.raises(ValueError):
        call(txns)


def test_range_prunes_months_and_reaches_the_scan(spark, lake):
    tables.write_transactions(fixtures.lineitem_transactions(spark, SMALL), lake, 0)
    stored = tables.read_table(spark, tables.transactions(lake))
    scan = plan(day_range(stored, "1996-01-15", "1996-02-20"))
    assert "(yyyymm#" in scan and ">= 199601)" in scan and "<= 199602)" in scan
    assert "GreaterThanOrEqual(transaction_time,1996-01-15" in scan
    report = reports.top_users(stored, "1996-01-15", "1996-02-20")
    read = plan(report).split("ReadSchema:")[1]
    assert "username" in read and "site_id" not in read and "source_file" not in read


def test_distinct_users_combine_before_the_shuffle(txns):
    text = plan(reports.daily_unique_users(txns, "2024-01-01", "2024-01-31"))
    first_exchange = text[text.rindex("Exchange hashpartitioning"):]
    assert "username" in first_exchange.split("\n")[0]
    assert "HashAggregate" in first_exchange
