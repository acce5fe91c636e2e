"""Reports from rollups and sketches equal, or are close to, a scan of all transactions."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import spark_bag
from pyspark.sql import functions as F
from test_rollups import cuts, plan

from tallylake import fixtures
from tallylake.plans import reports, rollup_reports, rollups, sketches
from tallylake.sources import tables

DAYS = ("2024-01-05", "2024-01-20")


def facts(spark, lake):
    return tables.read_table(spark, tables.transactions(lake))


def rows(df):
    return [tuple(r) for r in df.collect()]


def same_reports(spark, lake):
    stored = facts(spark, lake)
    assert rows(rollup_reports.daily_count(spark, lake)) == rows(reports.daily_count(stored))
    assert rows(rollup_reports.daily_amount(spark, lake)) == rows(reports.daily_amount(stored))
    for by in ("username", "total_amount"):
        assert rows(rollup_reports.top_users(spark, lake, *DAYS, by, True)) == rows(
            reports.top_users(stored, *DAYS, by, True)
        )


def test_reports_before_and_after_runs(spark, lake):
    """Without a run, with late rows, with loads no run has seen, after compactions."""
    for i, arrived in enumerate(cuts(spark)):
        tables.write_transactions(arrived, lake, i)
        same_reports(spark, lake)
        rollups.refresh_all(spark, lake)
        same_reports(spark, lake)
    tables.compact(spark, tables.transactions(lake), tables.with_month_layout)
    rollups.compact_user_30min(spark, lake)
    rollups.compact_site_daily(spark, lake)
    same_reports(spark, lake)


def test_a_range_of_days(spark, lake):
    for i, arrived in enumerate(cuts(spark)):
        tables.write_transactions(arrived, lake, i)
        if i < 3:
            rollups.refresh_all(spark, lake)
    wanted = [r for r in rows(reports.daily_count(facts(spark, lake))) if DAYS[0] <= str(r[0]) <= DAYS[1]]
    assert wanted and rows(rollup_reports.daily_count(spark, lake, DAYS)) == wanted


def test_only_unseen_loads_are_read(spark, lake):
    for i, arrived in enumerate(cuts(spark)):
        tables.write_transactions(arrived, lake, i)
        if i < 3:
            rollups.refresh_all(spark, lake)
    read = [f for f in rollup_reports.daily_count(spark, lake).inputFiles() if "/transactions/" in f]
    assert read and all("/delta/batch_id=3/" in f for f in read)


def test_sketches_merge(spark, lake):
    users = fixtures.event_transactions(spark, SMALL, raw_users=True)
    assert sketches.refresh_user_sketches(spark, lake) == -1
    for batch in range(3):
        # Every load has rows of all days.
        tables.write_transactions(users.where(f"transaction_id % 3 = {batch}"), lake, batch)
        assert sketches.refresh_user_sketches(spark, lake) == batch
        assert sketches.refresh_user_sketches(spark, lake) == batch
    exact = {r[0]: r[1] for r in rows(reports.daily_unique_users(users, *DAYS))}
    by_site = {r[:2]: r[2] for r in rows(reports.daily_unique_users(users, *DAYS, by_site=True))}
    whole = users.where(F.to_date("transaction_time").between(*DAYS)).select("username").distinct()

    def check():
        bound = lambda n: max(1, 3 * sketches.RELATIVE_ERROR * n)
        found = dict(rows(sketches.daily_unique_users_sketch(spark, lake, *DAYS)))
        assert found.keys() == exact.keys()
        assert all(abs(found[d] - n) <= bound(n) for d, n in exact.items())
        sites = rows(sketches.daily_unique_users_sketch(spark, lake, *DAYS, by_site=True))
        assert all(abs(n - by_site[d, s]) <= bound(n) for d, s, n in sites)
        total = sketches.unique_users_sketch(spark, lake, *DAYS).first()[0]
        assert abs(total - whole.count()) <= bound(total)

    check()
    before = tables.read_table(spark, tables.user_sketches(lake)).count()
    sketches.compact_user_sketches(spark, lake)
    assert tables.read_table(spark, tables.user_sketches(lake)).count() < before
    check()
    tables.write_transactions(users.limit(10), lake, 3)
    sketches.refresh_user_sketches(spark, lake)
    check()


def test_sketches_read_no_transactions(spark, lake):
    tables.write_transactions(fixtures.event_transactions(spark, SMALL, raw_users=True), lake, 0)
    sketches.refresh_user_sketches(spark, lake)
    found = sketches.daily_unique_users_sketch(spark, lake, *DAYS)
    assert not any("/transactions/" in f for f in found.inputFiles())
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day" in plan(found)


def test_loads_no_sketch_has_seen_are_kept(spark, lake):
    df = fixtures.event_transactions(spark, SMALL, raw_users=True)
    tables.write_transactions(df.where("transaction_id % 2 = 0"), lake, 0)
    sketches.refresh_user_sketches(spark, lake)
    tables.write_transactions(df.where("transaction_id % 2 = 1"), lake, 1)
    table = tables.transactions(lake)
    tables.compact(spark, table, tables.with_month_layout)
    assert tables.remove_covered(spark, table) == 1
    sketches.refresh_user_sketches(spark, lake)
    total = sketches.unique_users_sketch(spark, lake, "2000-01-01", "2100-01-01").first()[0]
    exact = df.select("username").distinct().count()
    assert abs(total - exact) <= max(1, 3 * sketches.RELATIVE_ERROR * exact)
    assert spark_bag(facts(spark, lake).select("transaction_id")) == spark_bag(df.select("transaction_id"))


def test_bad_dates(spark, lake):
    with pytest.raises(ValueError):
        sketches.daily_unique_users_sketch(spark, lake, "2024-13-01", "2024-01-01")
