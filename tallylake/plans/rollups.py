"""Incremental maintenance and reading of the two rollups.

A run never changes a bucket older than the newest stored one.  Rows that come too late for
their bucket are summed up by bucket into a table of their own, ``<rollup>_late``: counts and
amounts only add up, so stored rows and late ones together are the rollup of all rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.functions.timeparts import time_range
from tallylake.operators import aggregates
from tallylake.operators.dedup import last_inserted
from tallylake.schema import AMOUNT
from tallylake.sources import tables
from tallylake.sources.tables import Table

EPOCH = dt.datetime(1970, 1, 1)
# Floor of a full build: below every bucket.
NO_FLOOR = -(2**62)

# With more floors than this, buckets are compared with a table of them.
MAX_LITERALS = 32

USER_KEYS = ("window_start", "site_id", "username")
SITE_KEYS = ("day", "site_id")


def _micros(bucket: Column) -> Column:
    return F.unix_micros(bucket.cast("timestamp"))


def high_water(
    spark: SparkSession, table: Table, bucket: str, before_run: int | None = None
) -> int | None:
    """Largest stored bucket in microseconds, or None for a missing or empty table.

    Every run rewrites from the stored maximum on, so the maximum is in the last run,
    or, should that run be empty, it is that run's floor: one run is read, not the table.
    """
    base, deltas = tables.live_commits(spark, table)
    commits = [c for c in base + deltas if before_run is None or c.seq < before_run]
    if not commits:
        return None
    last = commits[-1]
    rows = tables.read_table(spark, table).where(F.col(table.seq) == last.seq)
    stored = rows.agg(F.max(_micros(F.col(bucket)))).first()[0]
    if stored is not None:
        return stored
    return None if last.tag == NO_FLOOR else last.tag


def _facts(spark: SparkSession, root: str, mark: int | None) -> tuple[DataFrame, int]:
    """Transactions from the mark on, and the last batch among them.

    A load that commits while the rollup is being built is left to the next run.
    """
    table = tables.transactions(root)
    through = tables.last_seq(spark, table)
    facts = tables.read_table(spark, table, through)
    return (facts if mark is None else time_range(facts, _datetime(mark))), through


def commit_run(
    df: DataFrame, table: Table, keys: tuple[str, ...], run: int, mark: int | None
) -> None:
    # Sorted files let a filter on the bucket skip row groups.
    floor = NO_FLOOR if mark is None else mark
    tables.write_commit(df.sortWithinPartitions(*keys), table, run, floor)


def _arrived(spark: SparkSession, root: str, table: Table, through: int) -> DataFrame | None:
    """The rows of the loads since the last run; None if that is not known or there are none."""
    seen = tables.seen_batch(spark, table)
    if seen is None or seen >= through:
        return None
    rows = tables.read_after(spark, tables.transactions(root), seen)
    return rows.where(F.col("batch_id") <= through)


def _audit(
    spark: SparkSession, table: Table, run: int, mark: int | None, through: int, late: DataFrame | None
) -> None:
    """Store what came too late for the run's buckets, and how many rows lie below its mark.

    Only the loads since the last run are read.  Written before the run's rows, whose marker
    commits both: a run that stops in between is repeated under its number and counts again.
    """
    count = 0
    if late is not None:
        held = tables.rollup_late(table)
        tables.write_commit(late, held, run)
        below = F.col(table.month_of) < F.lit(_datetime(mark))
        stored = tables.read_table(spark, held).where((F.col("run_id") == run) & below)
        count = stored.agg(F.coalesce(F.sum("txn_count"), F.lit(0))).first()[0]
    row = spark.range(0, 1, 1, 1).select(
        F.lit(through).cast("bigint").alias("through_batch"),
        F.lit(count).cast("bigint").alias("late_rows"),
    )
    tables.write_commit(row, tables.rollup_audit(table), run)


def refresh_user_30min(spark: SparkSession, root: str) -> int:
    """Build the per-user rollup, or recompute it from its newest window on.

    Rows older than the newest stored window are not looked at; the window itself is
    recomputed and replaces the stored one.  Returns the run number.
    """
    table = tables.user_30min(root)
    mark = high_water(spark, table, "window_start")
    facts, through = _facts(spark, root, mark)
    run = tables.last_seq(spark, table) + 1
    arrived = None if mark is None else _arrived(spark, root, table, through)
    late = None
    if arrived is not None:
        late = aggregates.user_30min(time_range(arrived, before=_datetime(mark)))
    _audit(spark, table, run, mark, through, late)
    commit_run(aggregates.user_30min(facts), table, USER_KEYS, run, mark)
    return run


def refresh_site_daily(spark: SparkSession, root: str, mode: str = "insert_new") -> int:
    """Build the per-site rollup, or extend it from its newest day on.

    ``insert_new`` adds (day, site) pairs that are not stored and never changes a stored
    one, so a day built half-way stays as it is.  ``refresh`` recomputes the newest day.
    """
    if mode not in ("insert_new", "refresh"):
        raise ValueError(f"unknown mode {mode!r}")
    table = tables.site_daily(root)
    mark = high_water(spark, table, "day")
    facts, through = _facts(spark, root, mark)
    run = tables.last_seq(spark, table) + 1
    new = aggregates.site_daily(facts)
    arrived = None if mark is None else _arrived(spark, root, table, through)
    late = None
    if arrived is not None:
        late = aggregates.site_daily(time_range(arrived, before=_datetime(mark)))
    if mark is not None and mode == "refresh":
        late = _with_recomputed(spark, table, late, mark)
    if mark is not None and mode == "insert_new":
        # New rows start at the newest stored day, so only that day can hold their keys.
        newest = F.lit(_datetime(mark).date())
        stored = tables.read_table(spark, table).where(F.col("day") >= newest)
        stored = stored.select(*SITE_KEYS).distinct()
        new = new.join(stored, list(SITE_KEYS), "left_anti")
        if late is not None:
            # What is new of a stored pair of that day is not added to it, and so is late.
            start = _datetime(mark)
            on_day = time_range(arrived, start, start + dt.timedelta(days=1))
            same = aggregates.site_daily(on_day).join(stored, list(SITE_KEYS), "left_semi")
            late = late.unionByName(same)
    _audit(spark, table, run, mark, through, late)
    commit_run(new, table, SITE_KEYS, run, mark)
    return run


def _with_recomputed(
    spark: SparkSession, table: Table, late: DataFrame | None, mark: int
) -> DataFrame | None:
    """Late rows, and less what earlier runs held late of the day that is now computed anew."""
    held = late_rows(spark, table)
    if held is None:
        return late
    held = held.where(F.col("day") == F.lit(_datetime(mark).date()))
    held = add_up(held, SITE_KEYS).withColumns(
        {m: (-F.col(m)).cast(table.columns[m].dataType) for m in aggregates.ROLLUP_MEASURES}
    )
    return held if late is None else late.unionByName(held)


def refresh_all(spark: SparkSession, root: str) -> None:
    """Both rollups, in order."""
    refresh_user_30min(spark, root)
    refresh_site_daily(spark, root)


def read_user_30min(spark: SparkSession, root: str, repaired: bool = False) -> DataFrame:
    """The per-user rollup; ``repaired`` adds the rows that came too late for their window."""
    return _read(spark, tables.user_30min(root), USER_KEYS, repaired)


def read_user_30min_stream(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, tables.user_30min_stream(root), USER_KEYS)


def read_site_daily(spark: SparkSession, root: str, repaired: bool = False) -> DataFrame:
    """The per-site rollup; ``repaired`` adds the rows that came too late for their day."""
    return _read(spark, tables.site_daily(root), SITE_KEYS, repaired)


def _read(
    spark: SparkSession, table: Table, keys: tuple[str, ...], repaired: bool = False
) -> DataFrame:
    rows = _current(table, keys, tables.read_table(spark, table), _floors(spark, table))
    late = late_rows(spark, table) if repaired else None
    if late is None:
        return rows
    # Only keys with late rows are grouped; all others pass through.
    late_keys = late.select(*keys).distinct()
    alone = rows.join(late_keys, list(keys), "left_anti")
    touched = rows.join(late_keys, list(keys), "left_semi").unionByName(late)
    return alone.unionByName(add_up(touched, keys)).select(*table.columns.names)


def late_rows(spark: SparkSession, table: Table) -> DataFrame | None:
    """What came too late for the committed runs, by bucket, once for each run; None if nothing."""
    held = tables.rollup_late(table)
    if tables.last_seq(spark, held) < 0:
        return None
    rows = tables.read_table(spark, held, tables.last_seq(spark, table))
    return rows.select(*table.columns.names)


def add_up(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Measures of rollup rows, summed by key."""
    return rows.groupBy(*keys).agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("total_amount").cast(AMOUNT).alias("total_amount"),
    )


def _floors(spark: SparkSession, table: Table) -> list[int]:
    """Floors of the live runs but the first, which has nothing before it to replace."""
    base, deltas = tables.live_commits(spark, table)
    return sorted({c.tag for c in (base + deltas)[1:]} - {NO_FLOOR})


def _current(
    table: Table, keys: tuple[str, ...], rows: DataFrame, floors: list[int]
) -> DataFrame:
    """Stored rows with the last run winning for each key.

    A run writes no bucket below its floor, and its floor is the largest bucket stored
    before it.  So two runs can share a key only where a bucket equals a floor.  All
    other rows pass through unshuffled; only the floor buckets are grouped, in the same way
    for any number of runs since the last compaction.
    """
    names = table.columns.names
    if not floors:
        return rows.select(*names)
    bucket = F.col(keys[0])
    kind = table.columns[keys[0]].dataType
    if len(floors) <= MAX_LITERALS:
        # Literals reach the scan.
        contested = bucket.isin(*[_instant_of(F.lit(f), kind) for f in floors])
        shared, alone = rows.where(contested), rows.where(~contested)
    else:
        listed = rows.sparkSession.createDataFrame([(f,) for f in floors], "floor bigint")
        listed = listed.select(_instant_of(F.col("floor"), kind).alias("floor"))
        shared = rows.join(listed, bucket == F.col("floor"), "left_semi")
        alone = rows.join(listed, bucket == F.col("floor"), "left_anti")
    latest = last_inserted(shared, keys, aggregates.ROLLUP_MEASURES, table.seq)
    return alone.select(*names).unionByName(latest.select(*names))


def _datetime(mark: int) -> dt.datetime:
    return EPOCH + dt.timedelta(microseconds=mark)


def _instant_of(mark: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(mark).cast(kind)


def compact_user_30min(spark: SparkSession, root: str) -> int | None:
    return _compact(spark, tables.user_30min(root), USER_KEYS)


def compact_user_30min_stream(spark: SparkSession, root: str) -> int | None:
    return _compact(spark, tables.user_30min_stream(root), USER_KEYS)


def compact_site_daily(spark: SparkSession, root: str) -> int | None:
    return _compact(spark, tables.site_daily(root), SITE_KEYS)


def _compact(spark: SparkSession, table: Table, keys: tuple[str, ...]) -> int | None:
    """Fold the runs into one, and their late rows; months without new buckets stay as they are."""
    floors = _floors(spark, table)
    done = tables.compact(
        spark, table, lambda rows: _current(table, keys, rows, floors).sortWithinPartitions(*keys)
    )
    # What a run that has not committed yet holds late is left alone.
    last = tables.last_seq(spark, table)
    tables.compact(spark, tables.rollup_late(table), lambda rows: add_up(rows, keys), through=last)
    return done
