"""Incremental rollups: repeated runs, crashes, stream, compaction, plans."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import SMALL
from oracle import spark_bag
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tallylake import fixtures
from tallylake.operators import aggregates
from tallylake.operators.dedup import last_inserted
from tallylake.plans import rollups
from tallylake.plans.views import register_views
from tallylake.sources import tables
from tallylake.streaming.rollup_stream import stream_user_30min


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def cuts(spark):
    """Four arrivals in time order, each with some rows of earlier days."""
    df = fixtures.event_transactions(spark, SMALL)
    days = ["2024-01-08", "2024-01-15", "2024-01-22", "2024-02-10"]
    out, late = [], "transaction_id % 7 = 3"
    for i, day in enumerate(days):
        upto = f"transaction_time < timestamp_ntz '{day} 10:10:00'"
        earlier = f"transaction_time >= timestamp_ntz '{days[i - 1]} 10:10:00'" if i else "true"
        fresh = df.where(f"{upto} AND {earlier} AND NOT {late}")
        held = df.where(f"transaction_id % 28 = {3 + 7 * i}")
        out.append(fresh.unionByName(held))
    return out


def grouped(spark, table, keys):
    """The plain rule: the last run wins for every key."""
    rows = tables.read_table(spark, table)
    return last_inserted(rows, keys, aggregates.ROLLUP_MEASURES).select(*table.columns.names)


def test_reading_merges_runs(spark, lake):
    user, site = tables.user_30min(lake), tables.site_daily(lake)
    for i, rows in enumerate(cuts(spark)):
        tables.write_transactions(rows, lake, i)
        rollups.refresh_all(spark, lake)
        rollups.refresh_site_daily(spark, lake, mode="refresh")
        stream_user_30min(spark, lake)
        assert spark_bag(rollups.read_user_30min(spark, lake)) == spark_bag(
            grouped(spark, user, rollups.USER_KEYS)
        )
        assert spark_bag(rollups.read_user_30min_stream(spark, lake)) == spark_bag(
            rollups.read_user_30min(spark, lake)
        )
        assert spark_bag(rollups.read_site_daily(spark, lake)) == spark_bag(
            grouped(spark, site, rollups.SITE_KEYS)
        )
    # Another run, and compactions, change nothing.
    want = spark_bag(rollups.read_user_30min(spark, lake))
    want_site = spark_bag(rollups.read_site_daily(spark, lake))
    rollups.refresh_all(spark, lake)
    stream_user_30min(spark, lake)
    assert spark_bag(rollups.read_user_30min(spark, lake)) == want
    assert spark_bag(rollups.read_user_30min_stream(spark, lake)) == want
    for _ in range(2):
        rollups.compact_user_30min(spark, lake)
        rollups.compact_site_daily(spark, lake)
        rollups.compact_user_30min_stream(spark, lake)
        for table in (user, site, tables.user_30min_stream(lake)):
            tables.remove_covered(spark, table)
        assert spark_bag(rollups.read_user_30min_stream(spark, lake)) == want
        assert spark_bag(rollups.read_user_30min(spark, lake)) == want
        assert spark_bag(rollups.read_site_daily(spark, lake)) == want_site
    rollups.refresh_all(spark, lake)
    assert spark_bag(rollups.read_user_30min(spark, lake)) == want
    assert spark_bag(rollups.read_site_daily(spark, lake)) == want_site


def test_empty_table_means_full_build(spark, lake):
    rollups.refresh_all(spark, lake)
    assert tables.read_table(spark, tables.user_30min(lake)).isEmpty()
    df = fixtures.event_transactions(spark, SMALL)
    tables.write_transactions(df, lake, 0)
    rollups.refresh_all(spark, lake)
    stored = tables.read_table(spark, tables.transactions(lake))
    assert spark_bag(rollups.read_user_30min(spark, lake)) == spark_bag(aggregates.user_30min(stored))
    assert spark_bag(rollups.read_site_daily(spark, lake)) == spark_bag(aggregates.site_daily(stored))


def test_crashed_run_is_not_seen(spark, lake, monkeypatch):
    first, second = fixtures.arrivals(spark, SMALL)
    tables.write_transactions(first, lake, 0)
    rollups.refresh_user_30min(spark, lake)
    before = spark_bag(rollups.read_user_30min(spark, lake))
    tables.write_transactions(second, lake, 1)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_commit", fail)
        with pytest.raises(RuntimeError):
            rollups.refresh_user_30min(spark, lake)
    assert spark_bag(rollups.read_user_30min(spark, lake)) == before


def test_incremental_plans(spark, lake):
    first, second = fixtures.arrivals(spark, SMALL)
    for i, rows in enumerate((first, second)):
        tables.write_transactions(rows, lake, i)
        rollups.refresh_all(spark, lake)
    current = plan(rollups.read_user_30min(spark, lake))
    # Only the windows at a floor are grouped, by hash, and the filter reaches the scan.
    assert current.count("Exchange") == 1 and "SortAggregate" not in current
    assert "PushedFilters: [IsNotNull(window_start), EqualTo(window_start" in current
    stored = tables.read_table(spark, tables.site_daily(lake))
    new = aggregates.site_daily(second).join(
        stored.select("day", "site_id"), ["day", "site_id"], "left_anti"
    )
    assert "LeftAnti" in plan(new) and "NestedLoop" not in plan(new)


def test_views(spark, lake):
    tables.write_transactions(fixtures.event_transactions(spark, SMALL), lake, 0)
    rollups.refresh_all(spark, lake)
    register_views(spark, lake)
    counts = spark.sql(
        """SELECT (SELECT count(*) FROM transactions) AS a,
                  (SELECT sum(txn_count) FROM agg_username_30min) AS b,
                  (SELECT sum(txn_count) FROM agg_site_daily) AS c"""
    ).first()
    assert counts.a == counts.b == counts.c


def test_many_floors_are_a_table(spark, lake, monkeypatch):
    """Beyond some floors the plan holds no literal per run, and the result is the same."""
    for i, rows in enumerate(cuts(spark)):
        tables.write_transactions(rows, lake, i)
        rollups.refresh_user_30min(spark, lake)
    few = rollups.read_user_30min(spark, lake)
    monkeypatch.setattr(rollups, "MAX_LITERALS", 0)
    many = rollups.read_user_30min(spark, lake)
    assert spark_bag(many) == spark_bag(few)
    table = tables.user_30min(lake)
    rows = tables.read_table(spark, table)
    sizes = [
        len(plan(rollups._current(table, rollups.USER_KEYS, rows, list(range(n)))))
        for n in (2, 2000)
    ]
    assert sizes[1] < sizes[0] + 200


def test_late_rows_repair_the_rollups(spark, lake):
    """Stored rows and late ones are the rollup of all rows, after every run."""
    for i, rows in enumerate(cuts(spark)):
        tables.write_transactions(rows, lake, i)
        rollups.refresh_all(spark, lake)
        stored = tables.read_table(spark, tables.transactions(lake))
        assert spark_bag(rollups.read_user_30min(spark, lake, repaired=True)) == spark_bag(
            aggregates.user_30min(stored)
        )
        assert spark_bag(rollups.read_site_daily(spark, lake, repaired=True)) == spark_bag(
            aggregates.site_daily(stored)
        )
    # A mode that recomputes the newest day, runs without loads and compactions change nothing.
    extra = fixtures.event_transactions(spark, SMALL).where("transaction_id % 3 = 1")
    tables.write_transactions(extra, lake, 4)
    rollups.refresh_site_daily(spark, lake, mode="refresh")
    rollups.refresh_user_30min(spark, lake)
    for _ in range(2):
        stored = tables.read_table(spark, tables.transactions(lake))
        assert spark_bag(rollups.read_site_daily(spark, lake, repaired=True)) == spark_bag(
            aggregates.site_daily(stored)
        )
        assert spark_bag(rollups.read_user_30min(spark, lake, repaired=True)) == spark_bag(
            aggregates.user_30min(stored)
        )
        rollups.refresh_all(spark, lake)
        rollups.compact_user_30min(spark, lake)
        rollups.compact_site_daily(spark, lake)


def test_a_stopped_run_leaves_no_late_rows(spark, lake, monkeypatch):
    first, second = fixtures.arrivals(spark, SMALL)
    tables.write_transactions(first, lake, 0)
    rollups.refresh_user_30min(spark, lake)
    tables.write_transactions(second, lake, 1)
    before = spark_bag(rollups.read_user_30min(spark, lake, repaired=True))

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rollups, "commit_run", fail)
        with pytest.raises(RuntimeError):
            rollups.refresh_user_30min(spark, lake)
    assert spark_bag(rollups.read_user_30min(spark, lake, repaired=True)) == before
    rollups.refresh_user_30min(spark, lake)
    stored = tables.read_table(spark, tables.transactions(lake))
    assert spark_bag(rollups.read_user_30min(spark, lake, repaired=True)) == spark_bag(
        aggregates.user_30min(stored)
    )


def test_unknown_mode(spark, lake):
    with pytest.raises(ValueError):
        rollups.refresh_site_daily(spark, lake, mode="merge")


def test_stream_waits_for_a_failed_load(spark, lake):
    first, second = fixtures.arrivals(spark, SMALL)
    tables.write_transactions(first, lake, 0)
    stream_user_30min(spark, lake)
    tables.write_transactions(second, lake, 1)
    marker = Path(lake) / "transactions/delta/batch_id=1/_SUCCESS"
    marker.rename(Path(lake) / "moved")
    with pytest.raises(RuntimeError):
        stream_user_30min(spark, lake)
    tables.write_transactions(second, lake, 1)
    stream_user_30min(spark, lake)
    total = rollups.read_user_30min_stream(spark, lake).selectExpr("max(window_start)").first()[0]
    assert total is not None
    # Rows of the newest window of the first load and later ones are all counted.
    rollups.refresh_user_30min(spark, lake)
    stored = tables.read_table(spark, tables.transactions(lake))
    newest = first.selectExpr("max(transaction_time)").first()[0]
    fresh = f"window_start > timestamp '{newest}'"
    assert spark_bag(rollups.read_user_30min_stream(spark, lake).where(fresh)) == spark_bag(
        aggregates.user_30min(stored).where(fresh)
    )


def test_a_sum_that_does_not_fit_raises(spark):
    df = fixtures.event_transactions(spark, SMALL).selectExpr(
        "* EXCEPT (transfer_amount)",
        "cast(9999999999999999.99 AS decimal(18,2)) AS transfer_amount",
    )
    with pytest.raises(ArithmeticException):
        aggregates.site_daily(df).collect()


def test_a_load_during_a_run_is_left_to_the_next(spark, lake, monkeypatch):
    first, second = fixtures.arrivals(spark, SMALL)
    tables.write_transactions(first, lake, 0)
    write = tables.write_commit

    def load_then_write(df, table, *args, **kwargs):
        if table == tables.user_30min(lake) and not tables.is_committed(
            spark, tables.transactions(lake), 1
        ):
            tables.write_transactions(second, lake, 1)
        write(df, table, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_commit", load_then_write)
        rollups.refresh_user_30min(spark, lake)
    rollups.refresh_user_30min(spark, lake)
    audit = tables.read_table(spark, tables.rollup_audit(tables.user_30min(lake)))
    seen = {r.run_id: (r.through_batch, r.late_rows > 0) for r in audit.collect()}
    assert seen == {0: (0, False), 1: (1, True)}


def _late_rows(spark, lake):
    audit = tables.rollup_audit(tables.user_30min(lake))
    rows = tables.read_table(spark, audit).orderBy("run_id").collect()
    return [r.late_rows for r in rows]


def _truth(spark, lake, second):
    mark = rollups.high_water(spark, tables.user_30min(lake), "window_start")
    return second.where(F.unix_micros(F.col("transaction_time").cast("timestamp")) < mark).count()


def test_late_rows_after_a_stop_between_count_and_rows(spark, lake, monkeypatch):
    first, second = fixtures.arrivals(spark, SMALL)
    tables.write_transactions(first, lake, 0)
    rollups.refresh_user_30min(spark, lake)
    tables.write_transactions(second, lake, 1)
    truth = _truth(spark, lake, second)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rollups, "commit_run", fail)
        with pytest.raises(RuntimeError):
            rollups.refresh_user_30min(spark, lake)
    rollups.refresh_user_30min(spark, lake)
    assert truth and _late_rows(spark, lake) == [0, truth]
    rollups.refresh_user_30min(spark, lake)
    assert _late_rows(spark, lake) == [0, truth, 0]


def test_late_rows_after_compaction_and_removal(spark, lake):
    first, second = fixtures.arrivals(spark, SMALL)
    tables.write_transactions(first, lake, 0)
    rollups.refresh_user_30min(spark, lake)
    tables.write_transactions(second, lake, 1)
    truth = _truth(spark, lake, second)
    facts = tables.transactions(lake)
    tables.compact(spark, facts, tables.with_month_layout)
    assert tables.remove_covered(spark, facts) == 1
    rollups.refresh_user_30min(spark, lake)
    assert truth and _late_rows(spark, lake) == [0, truth]
    assert tables.remove_covered(spark, facts) == 1
    assert spark_bag(tables.read_table(spark, facts).select("transaction_id")) == spark_bag(
        first.unionByName(second).select("transaction_id")
    )
