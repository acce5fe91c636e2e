"""Parquet tables that grow by numbered commits.

A table is a folder::

    delta/<seq>=<n>/...          one folder per load or rollup run
    base/<seq>=<n>/yyyymm=<m>    months a compaction has written
    kept/<seq>=<n>/...           months of earlier bases it has left as they were

Spark's own ``_SUCCESS`` marker is the commit point: readers use the newest marked
base, the months it kept, and the marked deltas after it.  A retried load writes the same
folder again, a half-written one is not seen, and a compaction takes effect with its marker,
so no folder is ever rewritten while a plan reads it.  One writer per table at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake import schema
from tallylake.functions.timeparts import day, month_number
from tallylake.sources.paths import delete_folder, glob_paths, literal_path

MONTH = T.StructField("yyyymm", T.IntegerType())
KEPT = T.StructType([MONTH, T.StructField("folder", T.StringType())])
#: Bytes of a range of the layout, before compression; more rows make more ranges.
RANGE_BYTES = 1 << 28
# Up to this size a load is dealt out by month, without a sample of its keys.
SMALL_BYTES = 1 << 24
MOST_RANGES = 100_000
# Months one task may write side by side; the rows of further ones are sorted by Spark.
OPEN_FILES, MOST_OPEN = "spark.sql.maxConcurrentOutputFileWriters", 100
# Sites that the first key of the layout tells apart; the others follow by the second.
MOST_SITES = (1 << 32) - 1
# Bytes for each range, of files, whose rows bounds are taken from.
SEEN_BYTES = 1 << 18
# Before every day: where rows without a time go.
FIRST = -(1 << 62)


@dataclass(frozen=True)
class Table:
    path: str
    columns: T.StructType
    seq: str = "batch_id"
    # A number stored in the folder name of each commit, next to its sequence.
    tag: str | None = None
    partitions: tuple[T.StructField, ...] = ()
    # The time by whose month a base is cut into folders; a table without is never compacted.
    month_of: str | None = None

    @property
    def schema(self) -> T.StructType:
        names = [self.seq] + ([self.tag] if self.tag else [])
        numbers = [T.StructField(n, T.LongType()) for n in names]
        return T.StructType([*self.columns.fields, *numbers, *self.partitions])


@dataclass(frozen=True)
class Commit:
    seq: int
    tag: int | None = field(compare=False)
    path: str = field(compare=False)


def transactions(root: str) -> Table:
    return Table(
        f"{root}/transactions",
        schema.TRANSACTION,
        partitions=(MONTH,),
        month_of="transaction_time",
    )


def user_30min(root: str) -> Table:
    path = f"{root}/agg_username_30min"
    return Table(path, schema.USER_30MIN, "run_id", "floor_us", month_of="window_start")


def user_30min_stream(root: str) -> Table:
    """The same rollup kept by the stream; its run number is the stream's batch."""
    path = f"{root}/agg_username_30min_stream"
    return Table(path, schema.USER_30MIN, "run_id", "floor_us", month_of="window_start")


def site_daily(root: str) -> Table:
    path = f"{root}/agg_site_daily"
    return Table(path, schema.SITE_DAILY, "run_id", "floor_us", month_of="day")


def rejects(root: str) -> Table:
    return Table(f"{root}/rejects", schema.REJECT)


def ingest_audit(root: str) -> Table:
    return Table(f"{root}/ingest_audit", schema.AUDIT)


def rollup_audit(rollup: Table) -> Table:
    return Table(f"{rollup.path}_audit", schema.ROLLUP_AUDIT, "run_id")


def rollup_late(rollup: Table) -> Table:
    """Rows that came too late for a run of the rollup, summed up by its keys."""
    return Table(f"{rollup.path}_late", rollup.columns, "run_id", month_of=rollup.month_of)


def user_sketches(root: str) -> Table:
    return Table(f"{root}/agg_daily_users_hll", schema.USER_SKETCH, "run_id", month_of="day")


def _marked(spark: SparkSession, table: Table, part: str) -> list[Commit]:
    tag = f"/{table.tag}=*" if table.tag else ""
    pattern = f"{literal_path(table.path)}/{part}/{table.seq}=*{tag}/_SUCCESS"
    shape = rf"/{table.seq}=(\d+)" + (rf"/{table.tag}=(-?\d+)$" if table.tag else "$")
    found = []
    for marker in glob_paths(spark, pattern):
        folder = marker.rsplit("/", 1)[0]
        numbers = re.search(shape, folder).groups()
        found.append(Commit(int(numbers[0]), int(numbers[1]) if table.tag else None, folder))
    return sorted(found, key=lambda c: c.seq)


def live_commits(spark: SparkSession, table: Table) -> tuple[list[Commit], list[Commit]]:
    """The newest base (none or one) and the deltas after it."""
    base = _marked(spark, table, "base")[-1:]
    through = base[0].seq if base else -1
    return base, [c for c in _marked(spark, table, "delta") if c.seq > through]


def is_committed(spark: SparkSession, table: Table, seq: int) -> bool:
    base, deltas = live_commits(spark, table)
    return any(c.seq >= seq for c in base) or any(c.seq == seq for c in deltas)


def last_seq(spark: SparkSession, table: Table) -> int:
    """The newest commit, -1 if there is none."""
    base, deltas = live_commits(spark, table)
    return max((c.seq for c in base + deltas), default=-1)


def _folders(spark: SparkSession, table: Table, part: str) -> dict[int, str]:
    found = glob_paths(spark, f"{literal_path(table.path)}/{part}/{table.seq}=*")
    return {int(f.rsplit("=", 1)[1]): f for f in found}


def unfinished(spark: SparkSession, table: Table) -> list[str]:
    """Folders of deltas a failed writer left without a marker."""
    done = {c.seq for c in _marked(spark, table, "delta")}
    return [f for seq, f in _folders(spark, table, "delta").items() if seq not in done]


def read_folders(spark: SparkSession, table: Table, part: str, folders: list[str]) -> DataFrame:
    """Rows of some folders or files of the deltas or the bases."""
    rows = (
        spark.read.schema(table.schema)
        .option("basePath", f"{table.path}/{part}")
        .parquet(*[literal_path(f) for f in folders])
    )
    # A base of a table without partitions has its months as another column.
    return rows.select(*table.schema.names)


def _kept_path(table: Table, seq: int) -> str:
    return f"{table.path}/kept/{table.seq}={seq}"


def _kept(spark: SparkSession, table: Table, base: Commit) -> dict[int | None, str]:
    """The months a compaction left in earlier bases, and their folders below ``base``."""
    path = literal_path(_kept_path(table, base.seq))
    if not glob_paths(spark, f"{path}/_SUCCESS"):
        return {}
    return {r.yyyymm: r.folder for r in spark.read.schema(KEPT).parquet(path).collect()}


def base_months(spark: SparkSession, table: Table, base: list[Commit]) -> dict[int | None, str]:
    """The live months of the newest base and the folder of each."""
    if not base:
        return {}
    written = glob_paths(spark, f"{literal_path(base[0].path)}/{MONTH.name}=*")
    found = _kept(spark, table, base[0]) | {_folder_month(f): _below_base(f) for f in written}
    return {month: f"{table.path}/base/{folder}" for month, folder in found.items()}


def _folder_month(folder: str) -> int | None:
    """Rows without a time are in a folder of their own, whose name is no number."""
    number = folder.rsplit("=", 1)[1]
    return int(number) if number.isdigit() else None


def _below_base(folder: str) -> str:
    """What a list of kept months holds: a table may be moved as a whole."""
    return folder.rpartition("/base/")[2]


def _base_folders(spark: SparkSession, table: Table, base: list[Commit]) -> list[str]:
    if not base:
        return []
    kept = _kept(spark, table, base[0]).values()
    return [base[0].path, *[f"{table.path}/base/{folder}" for folder in kept]]


def _no_rows(spark: SparkSession, table: Table) -> DataFrame:
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    return spark.range(0).select(*nothing)


def read_table(spark: SparkSession, table: Table, through: int | None = None) -> DataFrame:
    """All committed rows under the declared schema; no rows if nothing was committed.

    ``through`` leaves out deltas that were committed later.
    """
    base, deltas = live_commits(spark, table)
    deltas = [c.path for c in deltas if through is None or c.seq <= through]
    return _union(spark, table, _base_folders(spark, table, base), deltas)


def read_paths(spark: SparkSession, table: Table, paths: list[str]) -> DataFrame:
    """Rows of some folders or files, of deltas and bases."""
    base = [p for p in paths if f"/base/{table.seq}=" in p]
    return _union(spark, table, base, [p for p in paths if p not in set(base)])


def _union(
    spark: SparkSession, table: Table, base: list[str], deltas: list[str]
) -> DataFrame:
    parts = [read_folders(spark, table, p, f) for p, f in (("base", base), ("delta", deltas)) if f]
    return reduce(DataFrame.unionByName, parts) if parts else _no_rows(spark, table)


def rejected(spark: SparkSession, root: str) -> DataFrame:
    """Rejects of the loads that were committed, not of one that is under way or failed."""
    return read_table(spark, rejects(root), last_seq(spark, transactions(root)))


def audited_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of the loads that were committed."""
    return read_table(spark, ingest_audit(root), last_seq(spark, transactions(root)))


def latest_audit(spark: SparkSession, root: str) -> DataFrame:
    """Each file as it was seen last: its status, counts, size and time of change."""
    rows = audited_files(spark, root)
    names = [c for c in rows.columns if c != "file"]
    last = rows.groupBy("file").agg(F.max_by(F.struct(*names), "batch_id").alias("last"))
    return last.select("file", "last.*")


def remove_uncommitted_notes(spark: SparkSession, root: str) -> None:
    """Delete rejects and audit of a load that failed, before another takes a later number."""
    last = last_seq(spark, transactions(root))
    for table in (rejects(root), ingest_audit(root)):
        for seq, folder in _folders(spark, table, "delta").items():
            if seq > last:
                delete_folder(spark, folder)


def read_after(spark: SparkSession, table: Table, seq: int) -> DataFrame:
    """Rows of the commits after ``seq``, whether or not a compaction covers them."""
    deltas = [c for c in _marked(spark, table, "delta") if c.seq > seq]
    if not deltas:
        return _no_rows(spark, table)
    return read_folders(spark, table, "delta", [c.path for c in deltas])


def write_commit(
    df: DataFrame, table: Table, seq: int, tag: int | None = None, part: str = "delta"
) -> None:
    """Write one commit, replacing what an earlier attempt at it left behind."""
    folder = f"{table.path}/{part}/{table.seq}={seq}"
    if table.tag:
        folder = f"{folder}/{table.tag}={tag}"
    partitions = [p.name for p in table.partitions]
    if part == "base" and not partitions:
        df, partitions = df.withColumn(MONTH.name, _month(table)), [MONTH.name]
    rows = df.select(*table.columns.names, *partitions)
    # Rows laid out by month come month after month, and Spark need not sort them by it again.
    with _setting(df.sparkSession, OPEN_FILES, str(MOST_OPEN) if table.partitions else None):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            # An id hardly repeats in a file: a dictionary of ids is made in vain.
            .option("parquet.enable.dictionary#transaction_id", "false")
            .partitionBy(*partitions)
            .parquet(folder)
        )


@contextmanager
def _setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """A setting of the session for a while; without a value it stays as it is."""
    if value is None:
        yield
        return
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _month(table: Table) -> Column:
    if MONTH in table.partitions:
        return F.col(MONTH.name)
    return month_number(F.col(table.month_of)).cast("int")


def with_month_layout(df: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """Spread and sort rows for the month-partitioned transactions table.

    Ranges of (month, day, site, user, ...) go to one task each.  So a file holds a narrow
    span of days, which its statistics show to every report that filters by day; a month
    or a day holding a third of all rows is cut into many files, down to the place of a
    row in its input; and small months share a task.  The bounds come from a sample of
    the key columns, for which the input is read twice; rows of small files are spared that,
    and go by month.

    Where the rows are dear to make, ``like`` names rows of about the same days and sites
    that are read from files: the bounds of days and sites then come from these, the rows are
    made once, and those of a site and day too many for one range are dealt out by hash.
    """
    ordered = df.withColumn(MONTH.name, month_number(F.col("transaction_time")).cast("int"))
    last = [F.col(c) for c in ("source_file", "source_pos") if c in df.columns]
    users = [F.col(c) for c in ("username", "transaction_time", "transaction_id")] + last
    keys = [_day_and_site(), F.col("site_id"), *users]
    if 0 < _input_bytes(df) <= SMALL_BYTES:
        dealt = ordered.repartition(MONTH.name)
    elif like is None:
        dealt = ordered.repartitionByRange(*keys)
    else:
        dealt = _dealt_like(ordered, like, users)
    return dealt.sortWithinPartitions(*keys)


def _dealt_like(df: DataFrame, like: DataFrame, users: list[Column]) -> DataFrame:
    """``df`` in ranges of day and site that hold about as many rows of ``like`` each."""
    ranges = _ranges(df)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    part = min(1.0, ranges * SEEN_BYTES / (_input_bytes(like) or 1))
    seen = like.sample(part, seed=0) if part < 1 else like
    found = seen.agg(F.percentile_approx(_day_and_site(), shares, 20 * ranges)).first()[0]
    # A bound that is found several times begins as many ranges, and its rows are dealt out.
    times = Counter(found or [0])
    bounds = sorted(times)
    parts = [1, *[times[b] for b in bounds]]
    firsts = [0, *accumulate(parts[:-1])]
    numbered = Bucketizer(
        splits=[-math.inf, *map(float, bounds), math.inf], inputCol="_at", outputCol="_bucket"
    ).transform(df.withColumn("_at", F.coalesce(_day_and_site(), F.lit(FIRST)).cast("double")))
    bucket = F.col("_bucket").cast("int")
    dealt = F.pmod(F.xxhash64(*users), F.get(F.lit(parts), bucket)).cast("int")
    return (
        numbered.withColumn("_range", F.get(F.lit(firsts), bucket) + dealt)
        .drop("_at", "_bucket")
        .repartitionById(sum(parts), "_range")
        .drop("_range")
    )


def _ranges(df: DataFrame) -> int:
    """How many ranges AQE would leave of the session's shuffle partitions, or more by size."""
    spark, size = df.sparkSession, _input_bytes(df)
    wanted = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    wanted = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(wanted)
    useful = max(size // wanted + 1, spark.sparkContext.defaultParallelism)
    useful = min(useful, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(MOST_RANGES, max(useful, size // RANGE_BYTES + 1))


def _day_and_site() -> Column:
    """One number that orders rows by day, and within a day by site.

    A sort compares the first key in place and looks up a row only where that is equal: by
    month it would do so for nearly every pair of rows of a range.
    """
    site = F.least(F.greatest(F.coalesce("site_id", F.lit(0)), F.lit(0)), F.lit(MOST_SITES))
    return F.unix_date(day(F.col("transaction_time"))) * F.lit(MOST_SITES + 1) + site


def write_transactions(
    df: DataFrame, root: str, batch_id: int, like: DataFrame | None = None
) -> None:
    """Add one batch to the transactions table; for ``like`` see ``with_month_layout``."""
    present = set(df.columns)
    filled = df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.TRANSACTION.fields
        ]
    )
    with enough_ranges(filled):
        write_commit(with_month_layout(filled, like), transactions(root), batch_id)


@contextmanager
def enough_ranges(df: DataFrame) -> Iterator[None]:
    """While rows of this size are laid out, ranges of some hundred megabytes.

    The session's number of shuffle partitions is the least; AQE joins small ranges.  What
    counts is the size of the files that are read, which for staged rows is their own.
    """
    spark, name = df.sparkSession, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = min(MOST_RANGES, _input_bytes(df) // RANGE_BYTES + 1)
    least = int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    with _setting(spark, name, str(wanted) if wanted > least else None):
        yield


def _input_bytes(df: DataFrame) -> int:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        size = int(str(leaves.next().stats().sizeInBytes()))
        # Rows that come from no file have no size but the largest number.
        total += size if size < 1 << 60 else 0
    return total


def compact(
    spark: SparkSession,
    table: Table,
    transform: Callable[[DataFrame], DataFrame],
    touched: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    through: int | None = None,
) -> int | None:
    """Fold the live deltas into the base; returns the last commit it covers.

    Only months that change are rewritten: by default those of the deltas' rows, else those
    ``touched`` names (one column yyyymm) from the rows of the base and of the deltas.  The
    folders of all other months stay as they are, and the new base refers to them.
    ``transform`` gets the rows of the base in those months and all rows of the deltas.

    Only committed loads are covered, up to ``through`` if that is given, and a replay of one
    of them stays hidden behind the base, so it cannot bring rows back.  With nothing new to
    fold in, nothing is written.
    """
    base, deltas = live_commits(spark, table)
    deltas = [c for c in deltas if through is None or c.seq <= through]
    if not deltas:
        return base[0].seq if base else None
    months, last = base_months(spark, table, base), deltas[-1].seq
    folders = [c.path for c in deltas]
    changed = set(months)
    # A base written without months is rewritten as a whole.
    if months:
        new = _union(spark, table, [], folders)
        found = new.select(_month(table).alias(MONTH.name)).distinct()
        if touched:
            found = touched(_union(spark, table, list(months.values()), []), new)
        changed = {r[0] for r in found.distinct().collect()}
    kept = [(m, _below_base(f)) for m, f in months.items() if m not in changed]
    old = [f for m, f in months.items() if m in changed] if months else [c.path for c in base]
    rows = _union(spark, table, old, folders)
    tag = min((c.tag for c in base + deltas), default=None) if table.tag else None
    # The list of what is kept comes first: the marker of the rows commits both.
    listed = spark.createDataFrame(kept, KEPT).coalesce(1)
    listed.write.mode("overwrite").parquet(_kept_path(table, last))
    with enough_ranges(rows):
        write_commit(transform(rows), table, last, tag, "base")
    return last


def seen_batch(spark: SparkSession, rollup: Table) -> int | None:
    """The last load whose late rows a committed run of the rollup has counted.

    A run writes its count before its rows; one without rows was stopped in between, and
    its count does not hold.
    """
    run = last_seq(spark, rollup)
    audit = read_table(spark, rollup_audit(rollup)).where(F.col("run_id") <= run)
    return audit.agg(F.max("through_batch")).first()[0]


def _counted_through(spark: SparkSession, table: Table) -> list[int]:
    """For transactions: how far each rollup built from them has counted."""
    root, _, name = table.path.rpartition("/")
    if name != "transactions":
        return []
    built = [user_30min(root), site_daily(root), user_sketches(root)]
    built = [t for t in built if last_seq(spark, t) >= 0]
    seen = [seen_batch(spark, t) for t in built]
    return [-1 if batch is None else batch for batch in seen]


def remove_covered(spark: SparkSession, table: Table) -> int:
    """Delete the commits a base has replaced; returns how many.

    For quiet times: no query on the table may still run, and for transactions the
    streamed rollup must have caught up.  Loads whose late rows a rollup has still to
    count stay.
    """
    base, _ = live_commits(spark, table)
    if not base:
        return 0
    through = base[0].seq
    counted = min([through, *_counted_through(spark, table)])
    kept = set(_kept(spark, table, base[0]).values())
    old = [f for seq, f in _folders(spark, table, "delta").items() if seq <= counted]
    for seq, folder in _folders(spark, table, "base").items():
        if seq >= through:
            continue
        if any(k.startswith(f"{table.seq}={seq}/") for k in kept):
            tag = f"/{table.tag}=*" if table.tag else ""
            months = glob_paths(spark, f"{literal_path(folder)}{tag}/{MONTH.name}=*")
            old += [m for m in months if _below_base(m) not in kept]
        else:
            old.append(folder)
    for folder in old:
        delete_folder(spark, folder)
    return len(old)
