"""Commits, compaction, layout and replacement."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import SMALL
from oracle import spark_bag
from pyspark.sql import functions as F

from tallylake import fixtures
from tallylake.operators import dedup
from tallylake.sources import tables

ORDER = ("transaction_time", "item_id", "site_id", "transfer_amount")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_missing_table_reads_empty(spark, lake):
    table = tables.transactions(lake)
    assert tables.read_table(spark, table).isEmpty()
    assert tables.read_table(spark, table).schema == table.schema
    tables.write_transactions(fixtures.event_transactions(spark, SMALL).where("false"), lake, 0)
    assert tables.read_table(spark, table).isEmpty()
    tables.write_transactions(fixtures.event_transactions(spark, SMALL), lake, 1)
    assert not tables.read_table(spark, table).isEmpty()


def test_unmarked_commits_are_not_read(spark, lake):
    df = fixtures.event_transactions(spark, SMALL)
    tables.write_transactions(df, lake, 0)
    tables.write_transactions(df, lake, 1)
    (Path(lake) / "transactions/delta/batch_id=1/_SUCCESS").rename(Path(lake) / "moved")
    table = tables.transactions(lake)
    assert tables.read_table(spark, table).count() == df.count()
    tables.write_transactions(df, lake, 1)
    tables.write_transactions(df, lake, 1)
    assert tables.read_table(spark, table).count() == 2 * df.count()


def test_compaction(spark, lake):
    table = tables.transactions(lake)
    df = fixtures.lineitem_transactions(spark, SMALL)

    def fold(rows):
        return tables.with_month_layout(dedup.replace_latest(rows, ["transaction_id"], ORDER))

    columns = df.columns
    tables.write_transactions(df, lake, 0)
    tables.write_transactions(df, lake, 1)
    assert tables.compact(spark, table, fold) == 1
    want = spark_bag(dedup.replace_latest(df, ["transaction_id"], ORDER).select(columns))
    assert spark_bag(tables.read_table(spark, table).select(columns)) == want
    # Nothing new, and a replay of a covered batch: no change.
    assert tables.compact(spark, table, fold) == 1
    tables.write_transactions(df, lake, 1)
    assert spark_bag(tables.read_table(spark, table).select(columns)) == want
    assert tables.remove_covered(spark, table) == 2
    assert not list(Path(lake).glob("transactions/delta/*"))
    assert tables.is_committed(spark, table, 1) and not tables.is_committed(spark, table, 2)
    assert spark_bag(tables.read_table(spark, table).select(columns)) == want
    # A later batch is seen next to the base and folded into the next one.
    tables.write_transactions(df.where("site_id = 1"), lake, 2)
    extra = df.where("site_id = 1").count()
    assert tables.read_table(spark, table).count() == sum(want.values()) + extra
    assert tables.compact(spark, table, fold) == 2
    assert spark_bag(tables.read_table(spark, table).select(columns)) == want


def write_small_files(spark, df, lake) -> None:
    """Write with files of some kilobytes, as a large load does with large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    small, tables.SMALL_BYTES = tables.SMALL_BYTES, 0
    try:
        tables.write_transactions(df.repartition(8), lake, 0)
    finally:
        tables.SMALL_BYTES = small
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_small_load_is_read_once(spark, lake):
    """Dealt out by month, without a sample: one shuffle, one file a month."""
    df = fixtures.lineitem_transactions(spark, SMALL)
    assert "hashpartitioning(yyyymm" in plan(tables.with_month_layout(df))
    tables.write_transactions(df, lake, 0)
    files = list(Path(lake).glob("transactions/delta/batch_id=0/*/*.parquet"))
    assert len(files) == len({f.parent for f in files}) > 10


def test_files_of_a_cut_month_hold_few_days(spark, lake):
    """Spans of days hardly overlap, and a day of a third of all rows is several files."""
    number = F.col("transaction_id").cast("bigint")
    day = F.when(number % 3 == 0, 9).otherwise(number % 30)
    df = fixtures.lineitem_transactions(spark, SMALL).withColumn(
        "transaction_time", F.make_timestamp_ntz(F.lit(2024), F.lit(1), (day + 1).cast("int"), *[F.lit(0)] * 3)
    )
    write_small_files(spark, df, lake)
    stored = tables.read_table(spark, tables.transactions(lake))
    spans = (
        stored.groupBy(F.input_file_name().alias("f"))
        .agg(F.min(F.dayofmonth("transaction_time")).alias("a"), F.max(F.dayofmonth("transaction_time")).alias("b"))
        .orderBy("a", "b")
        .collect()
    )
    assert len(spans) == 8 and all(x.b <= y.a for x, y in zip(spans, spans[1:]))
    assert sum(s.a <= 10 <= s.b for s in spans) >= 3


def test_a_large_month_is_cut(spark, lake):
    """All rows in one month still spread over several files and tasks."""
    df = fixtures.lineitem_transactions(spark, SMALL).withColumn(
        "transaction_time", F.expr("timestamp_ntz '2024-01-01 00:00:00'")
    )
    write_small_files(spark, df, lake)
    files = list(Path(lake).glob("transactions/delta/batch_id=0/yyyymm=202401/*.parquet"))
    assert len(files) > 4
    assert tables.read_table(spark, tables.transactions(lake)).count() == df.count()


@pytest.mark.parametrize("keys", [dedup.BY_TRANSACTION_ID, ("site_id",)])
def test_replace_latest_does_not_depend_on_partitions(spark, keys):
    df = fixtures.lineitem_transactions(spark, SMALL)
    order = (*ORDER, "transaction_id")
    bags = [
        spark_bag(dedup.replace_latest(df.repartition(n), keys, order)) for n in (1, 3, 16)
    ]
    assert bags[0] == bags[1] == bags[2]


def test_replace_latest_limits_groups_before_the_shuffle(spark):
    df = fixtures.event_transactions(spark, SMALL)
    text = plan(dedup.replace_latest(df, ["site_id"], ["transaction_time", "transaction_id"]))
    after_exchange = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in after_exchange and "Partial" in after_exchange


def test_replace_latest_needs_an_order(spark):
    df = fixtures.event_transactions(spark, SMALL)
    with pytest.raises(ValueError):
        dedup.replace_latest(df, ["site_id"], [])


def test_one_key_holding_all_rows(spark):
    df = fixtures.lineitem_transactions(spark, SMALL).withColumn("site_id", F.lit(1))
    kept = dedup.replace_latest(df, ["site_id"], (*ORDER, "transaction_id"))
    best = df.orderBy(*[F.col(c).desc() for c in (*ORDER, "transaction_id")]).limit(1)
    assert spark_bag(kept.select(df.columns)) == spark_bag(best)


def test_odd_folder_names(spark, tmp_path):
    lake = str(tmp_path / "lake [x] {a}")
    df = fixtures.event_transactions(spark, SMALL)
    tables.write_transactions(df, lake, 0)
    assert tables.read_table(spark, tables.transactions(lake)).count() == df.count()
