"""Spans of files: a report opens only the files that hold its rows."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import spark_bag
from pyspark.sql import functions as F

from tallylake import fixtures
from tallylake.functions.timeparts import day_range
from tallylake.sources import spans, tables

DAYS = ("1997-03-10", "1997-03-12")


@pytest.fixture
def many_files(spark, monkeypatch):
    """Files of some kilobytes, as a large load has large ones."""
    monkeypatch.setattr(tables, "SMALL_BYTES", 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _folded(df):
    """All rows in one month, many to a day."""
    day = (F.dayofmonth("transaction_time") - 1).cast("int")
    time = F.timestamp_add("DAY", day, F.expr("timestamp_ntz '1997-03-01 00:00:00'"))
    return df.withColumn("transaction_time", time)


def _same(spark, lake, days=DAYS, **more):
    stored = day_range(tables.read_table(spark, tables.transactions(lake)), *days)
    for column, value in more.items():
        stored = stored.where(F.col(column) == value)
    found = spans.read_days(spark, lake, *days, **more)
    assert found.columns == stored.columns
    assert spark_bag(found) == spark_bag(stored)
    return found


def test_a_day_opens_only_its_files(spark, lake, many_files):
    df = _folded(fixtures.lineitem_transactions(spark, SMALL))
    tables.write_transactions(df.repartition(8), lake, 0)
    whole = _same(spark, lake)
    assert len(whole.inputFiles()) == 8
    assert spans.refresh_spans(spark, lake) == 8
    some = _same(spark, lake)
    assert 0 < len(some.inputFiles()) <= 3
    # Exactly the files whose span holds one of the days.
    path = F.regexp_replace(F.input_file_name(), ".*/", "")
    rows = tables.read_table(spark, tables.transactions(lake)).select("transaction_time", path.alias("f"))
    wanted = {r.f for r in day_range(rows, *DAYS).select("f").distinct().collect()}
    assert wanted <= {f.rsplit("/", 1)[1] for f in some.inputFiles()}
    assert _same(spark, lake, ("1990-01-01", "1990-01-02")).inputFiles() == []
    user = df.select("username").first()[0]
    assert len(_same(spark, lake, DAYS, site_id=1).inputFiles()) <= len(some.inputFiles())
    assert len(_same(spark, lake, DAYS, username=user).inputFiles()) <= len(some.inputFiles())


def test_commits_without_spans_are_read_whole(spark, lake, many_files):
    df = _folded(fixtures.lineitem_transactions(spark, SMALL))
    for batch in range(3):
        tables.write_transactions(df.where(f"transaction_id % 3 = {batch}").repartition(4), lake, batch)
        if batch < 2:
            spans.refresh_spans(spark, lake)
    opened = _same(spark, lake).inputFiles()
    assert sum("batch_id=2/" in f for f in opened) == 8
    assert sum("batch_id=0/" in f for f in opened) <= 3
    spans.refresh_spans(spark, lake)
    assert len(_same(spark, lake).inputFiles()) < len(opened)


def test_spans_after_compaction(spark, lake):
    df = fixtures.lineitem_transactions(spark, SMALL)
    table = tables.transactions(lake)
    tables.write_transactions(df, lake, 0)
    spans.refresh_spans(spark, lake)
    tables.compact(spark, table, tables.with_month_layout)
    # The spans are those of replaced files: none of them is read.
    assert all("/base/" in f for f in _same(spark, lake).inputFiles())
    before = spans.refresh_spans(spark, lake)
    late = df.where("transaction_time >= timestamp_ntz '2001-01-01 00:00:00'")
    tables.write_transactions(late, lake, 1)
    tables.compact(spark, table, tables.with_month_layout)
    tables.remove_covered(spark, table)
    _same(spark, lake)
    # Months that were kept keep their spans.
    assert spans.refresh_spans(spark, lake) == spans.refresh_spans(spark, lake) <= before + 1
    _same(spark, lake, ("2001-02-01", "2001-03-01"))
    assert len(_same(spark, lake).inputFiles()) == 1


def test_empty_tables_and_odd_names(spark, tmp_path):
    lake = str(tmp_path / "lake [x] {a} b")
    assert spans.refresh_spans(spark, lake) == 0
    assert spans.read_days(spark, lake, *DAYS).isEmpty()
    tables.write_transactions(fixtures.lineitem_transactions(spark, SMALL), lake, 0)
    assert spans.refresh_spans(spark, lake) > 0
    _same(spark, lake)
