"""Compaction rewrites the months that change and leaves all others as they are."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import SMALL
from oracle import spark_bag
from pyspark.sql import functions as F

from tallylake import fixtures
from tallylake.operators import dedup
from tallylake.operators.bloom import maybe_among
from tallylake.plans import compaction, rollups
from tallylake.plans.compaction import compact_transactions
from tallylake.schema import CELLS
from tallylake.sources import tables

ORDER = ("transaction_time", "item_id", "site_id", "transfer_amount", "_version")


def files(lake: str, name: str = "transactions") -> dict[str, tuple[int, int]]:
    """Size and time of change of the data files of the bases."""
    found = Path(lake).glob(f"{name}/base/**/*.parquet")
    return {str(f.relative_to(lake)): (f.stat().st_size, f.stat().st_mtime_ns) for f in found}


def months(paths) -> set[int]:
    return {int(p.split("yyyymm=")[1].split("/")[0]) for p in paths}


def stamped(df, version):
    return df.withColumn("_version", F.lit(version))


def stored(spark, lake):
    rows = tables.read_table(spark, tables.transactions(lake))
    return spark_bag(rows.select(*CELLS, "_version"))


def test_months_without_new_rows_keep_their_files(spark, lake):
    df = stamped(fixtures.lineitem_transactions(spark, SMALL), 1)
    tables.write_transactions(df, lake, 0)
    compact_transactions(spark, lake, dedup.BY_STORED_KEY, (*dedup.STORED_ORDER,))
    before = files(lake)
    some = df.where("transaction_time < timestamp_ntz '1996-03-01 00:00:00'")
    tables.write_transactions(stamped(some, 2), lake, 1)
    want_rows = dedup.replace_latest(
        df.unionByName(stamped(some, 2)), dedup.BY_STORED_KEY, dedup.STORED_ORDER
    )
    assert compact_transactions(spark, lake, dedup.BY_STORED_KEY, dedup.STORED_ORDER) == 1
    after = files(lake)
    assert before.items() <= after.items()
    new = months(set(after) - set(before))
    assert new and max(new) <= 199602 and min(months(before)) in new
    want = spark_bag(want_rows.select(*CELLS, "_version"))
    assert stored(spark, lake) == want
    # What a base has replaced goes, and nothing that it refers to.
    assert tables.remove_covered(spark, tables.transactions(lake)) > 2
    assert stored(spark, lake) == want
    left = files(lake)
    assert months(left) == months(before) and len(left) < len(after)
    # The table may be moved as a whole.
    Path(lake).rename(f"{lake}-moved")
    assert stored(spark, f"{lake}-moved") == want
    Path(f"{lake}-moved").rename(lake)
    # A third compaction carries the kept months on.
    tables.write_transactions(stamped(some, 3), lake, 2)
    compact_transactions(spark, lake, dedup.BY_STORED_KEY, dedup.STORED_ORDER)
    tables.remove_covered(spark, tables.transactions(lake))
    kept = {p: s for p, s in left.items() if months([p]).isdisjoint(new)}
    assert kept and kept.items() <= files(lake).items()
    assert len(stored(spark, lake)) > len(want)


def test_an_id_that_moves_to_another_month_leaves_the_old_one(spark, lake):
    df = stamped(fixtures.lineitem_transactions(spark, SMALL), 1)
    ids = df.select("transaction_id").distinct().orderBy("transaction_id")
    df = df.where("transaction_time < timestamp_ntz '1997-01-01 00:00:00'")
    tables.write_transactions(df, lake, 0)
    compact_transactions(spark, lake, dedup.BY_TRANSACTION_ID, ORDER)
    before = files(lake)
    moved = (
        df.join(ids.limit(200), "transaction_id", "left_semi")
        .where("transaction_time < timestamp_ntz '1996-01-01 00:00:00'")
        .withColumn("transaction_time", F.expr("timestamp_ntz '1999-05-05 00:00:00'"))
    )
    moved = stamped(moved, 2)
    assert not moved.isEmpty()
    tables.write_transactions(moved, lake, 1)
    compact_transactions(spark, lake, dedup.BY_TRANSACTION_ID, ORDER)
    want = dedup.replace_latest(df.unionByName(moved), dedup.BY_TRANSACTION_ID, ORDER)
    assert stored(spark, lake) == spark_bag(want.select(*CELLS, "_version"))
    new = months(set(files(lake)) - set(before))
    # The new month, and old ones that held such an id; the others are untouched.
    assert 199905 in new and len(new) > 1
    assert any(m >= 199601 for m in months(before) - new)


def test_a_month_that_becomes_empty_does_not_come_back(spark, lake):
    df = stamped(fixtures.lineitem_transactions(spark, SMALL), 1).limit(50).cache()
    early = df.withColumn("transaction_time", F.expr("timestamp_ntz '2001-01-05 00:00:00'"))
    late = stamped(df, 2).withColumn(
        "transaction_time", F.expr("timestamp_ntz '2001-02-05 00:00:00'")
    )
    table = tables.transactions(lake)
    for batch, rows in enumerate((early, late)):
        tables.write_transactions(rows, lake, batch)
        compact_transactions(spark, lake, dedup.BY_TRANSACTION_ID, ORDER)
    assert list(tables.base_months(spark, table, tables.live_commits(spark, table)[0])) == [200102]
    rows = tables.read_table(spark, table)
    assert rows.where("yyyymm = 200101").isEmpty()
    assert rows.count() == df.select("transaction_id").distinct().count()


def test_rows_without_a_time_stay(spark, lake):
    df = stamped(fixtures.lineitem_transactions(spark, SMALL), 1).limit(40).cache()
    none = df.withColumn("transaction_time", F.lit(None).cast("timestamp"))
    table = tables.transactions(lake)
    for batch, rows in enumerate((none.limit(5), df, none.limit(3))):
        tables.write_transactions(rows, lake, batch)
        tables.compact(spark, table, tables.with_month_layout)
        tables.remove_covered(spark, table)
    found = tables.read_table(spark, table)
    assert found.count() == 48 and found.where("transaction_time IS NULL").count() == 8


def test_a_stopped_compaction_changes_nothing(spark, lake, monkeypatch):
    df = stamped(fixtures.lineitem_transactions(spark, SMALL), 1)
    tables.write_transactions(df, lake, 0)
    compact_transactions(spark, lake)
    tables.write_transactions(stamped(df.limit(20), 2), lake, 1)
    want = stored(spark, lake)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_commit", fail)
        with pytest.raises(RuntimeError):
            compact_transactions(spark, lake)
    # The list of kept months is there, but not the rows whose marker makes it hold.
    assert stored(spark, lake) == want
    compact_transactions(spark, lake)
    assert len(stored(spark, lake)) == len(want)


def test_rollup_compaction_keeps_closed_months(spark, lake):
    df = fixtures.event_transactions(spark, SMALL)
    shifted = df.withColumn("transaction_time", F.expr("transaction_time - interval 62 days"))
    tables.write_transactions(shifted, lake, 0)
    rollups.refresh_all(spark, lake)
    rollups.compact_user_30min(spark, lake)
    rollups.compact_site_daily(spark, lake)
    name = "agg_username_30min"
    before = files(lake, name)
    for batch, rows in enumerate(fixtures.arrivals(spark, SMALL), 1):
        tables.write_transactions(rows, lake, batch)
        rollups.refresh_all(spark, lake)
    want = spark_bag(rollups.read_user_30min(spark, lake))
    want_site = spark_bag(rollups.read_site_daily(spark, lake))
    for _ in range(2):
        rollups.compact_user_30min(spark, lake)
        rollups.compact_site_daily(spark, lake)
        assert spark_bag(rollups.read_user_30min(spark, lake)) == want
        assert spark_bag(rollups.read_site_daily(spark, lake)) == want_site
        for table in (tables.user_30min(lake), tables.site_daily(lake)):
            tables.remove_covered(spark, table)
    last = max(months(before))
    assert {p for p in before if months([p]) != {last}} <= set(files(lake, name))
    rollups.refresh_all(spark, lake)
    assert spark_bag(rollups.read_user_30min(spark, lake)) == want


def test_the_filter_keeps_all_and_few_more(spark, monkeypatch):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    keys = spark.range(0, 20_000, 40).withColumnRenamed("id", "k")
    found = {r.k for r in maybe_among(rows, keys, "k").collect()}
    assert set(range(0, 20_000, 40)) <= found and len(found) < 2_500
    assert maybe_among(rows, keys.limit(0), "k").isEmpty()
    monkeypatch.setattr("tallylake.operators.bloom.MAX_BYTES", 16)
    assert maybe_among(rows, keys, "k").count() == 20_000


def test_a_large_load_gets_more_ranges(spark, lake, monkeypatch):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    tables.write_transactions(fixtures.event_transactions(spark, SMALL), lake, 0)
    rows = tables.read_table(spark, tables.transactions(lake))
    with tables.enough_ranges(rows):
        assert spark.conf.get(name, None) is None
    monkeypatch.setattr(tables, "RANGE_BYTES", 1000)
    with tables.enough_ranges(rows):
        assert int(spark.conf.get(name)) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(name, None) is None


def counted(df, counter):
    """``df``, adding up each time one of its rows is made."""

    def count(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def many(spark, times, sites=7):
    """2,000 rows of the given times (SQL of id)."""
    return spark.range(2000).selectExpr(
        "cast(id as decimal(20,0)) transaction_id",
        "cast(id as decimal(20,0)) bill_id",
        f"id % {sites} site_id",
        "concat('u', id % 50) username",
        "id item_id",
        "'A' currency_code",
        "cast(id as decimal(18,2)) transfer_amount",
        f"cast({times} as timestamp) transaction_time",
        "cast(id % 2 as bigint) _version",
    )


DAYS = "date_add(date'2024-01-01', cast(id * 7919 % 90 as int))"


def test_the_latest_rows_are_made_once(spark, lake, monkeypatch):
    """The bounds of files come from the stored rows, so none is de-duplicated for a sample."""
    monkeypatch.setattr(tables, "SMALL_BYTES", 0)
    df = many(spark, DAYS)
    for batch in (0, 1):
        tables.write_transactions(df, lake, batch)
    made = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(
        compaction, "replace_latest", lambda *args: counted(dedup.replace_latest(*args), made)
    )
    compact_transactions(spark, lake, dedup.BY_TRANSACTION_ID, ORDER)
    assert made.value == 2000
    assert stored(spark, lake) == spark_bag(df.select(*CELLS, "_version"))


def test_a_load_with_known_places_is_made_once(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_BYTES", 0)
    df, made = many(spark, DAYS), spark.sparkContext.accumulator(0)
    tables.write_transactions(counted(df, made), lake, 0, like=df)
    assert made.value == 2000
    assert stored(spark, lake) == spark_bag(df.select(*CELLS, "_version"))
    # Ranges follow one another: only the day at a bound lies in two of them.
    rows = tables.read_table(spark, tables.transactions(lake))
    task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
    spans = rows.groupBy(task.alias("task")).agg(
        F.min("transaction_time").alias("a"), F.max("transaction_time").alias("b")
    )
    spans = spans.orderBy("task").collect()
    assert len(spans) > 4 and all(x.b <= y.a for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("times", ["date'2024-01-05'", "null", f"if(id % 3 = 0, null, {DAYS})"])
def test_days_and_sites_of_any_weight(spark, lake, monkeypatch, times):
    """All rows on one day of a site are several files; rows without a time stay."""
    monkeypatch.setattr(tables, "SMALL_BYTES", 0)
    df = many(spark, times, sites=1)
    tables.write_transactions(df, lake, 0, like=df)
    compact_transactions(spark, lake, dedup.BY_TRANSACTION_ID, ORDER)
    assert stored(spark, lake) == spark_bag(df.select(*CELLS, "_version"))
    if times.startswith("date"):
        assert len(list(Path(lake).glob("transactions/base/*/yyyymm=202401/*.parquet"))) > 4


def test_the_first_key_of_the_layout_keeps_its_order(spark):
    """By month, day and site, nulls first, also for sites that one number cannot hold."""
    sites = "element_at(array(null, -5L, -1L, 0L, 3L, 4294967295L, 4294967296L, 1L << 60), cast(id % 8 + 1 as int))"
    days = "if(id % 11 = 0, null, timestamp'1969-12-25 05:00:00' + make_dt_interval(cast(id % 13 as int)))"
    df = many(spark, days).withColumn("site_id", F.expr(sites.replace("id %", "item_id %")))
    laid = tables.with_month_layout(df.coalesce(1))
    text = laid._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [yyyymm" not in text
    names = ["yyyymm", "day", "site_id", "username", "transaction_time", "transaction_id"]
    rows = laid.withColumn("day", F.to_date("transaction_time"))
    for part in rows.select(*names).rdd.glom().collect():
        got = [tuple((v is not None, v) for v in row) for row in part]
        assert got == sorted(got, key=lambda r: [(there, v if there else 0) for there, v in r])
