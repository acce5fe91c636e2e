"""Which times, sites and users each stored file holds, so that a report opens no other file.

The spans are a table beside the transactions, one row a file, written anew by ``refresh_spans``
from what it held and the files of commits it has not seen.  They only ever spare files: a commit
without spans is read as a whole, and spans of folders that are no longer live are not looked at.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions.timeparts import as_date, day_range
from tallylake.sources import tables
from tallylake.sources.paths import delete_folder, glob_paths, literal_path
from tallylake.sources.tables import Table

#: Columns whose least and largest value in a file are kept.
SPANNED = ("transaction_time", "site_id", "username")


def _live_folders(spark: SparkSession, table: Table) -> dict[str, str]:
    """Live commits and months of the base: path below the table, and whole path."""
    base, deltas = tables.live_commits(spark, table)
    folders = [c.path for c in deltas] + list(tables.base_months(spark, table, base).values())
    return {_below(folder): folder for folder in folders}


def _below(folder: str) -> str:
    """The path below the table: its last part that begins with ``delta`` or ``base``."""
    return re.search(r"(?:delta|base)/[^/]+=[^/]+(?:/[^/]+=[^/]+)*$", folder)[0]


def _snapshots(spark: SparkSession, table: Table) -> list[tuple[int, str]]:
    found = glob_paths(spark, f"{literal_path(table.path)}/spans/number=*/_SUCCESS")
    folders = [f.rsplit("/", 1)[0] for f in found]
    return sorted((int(f.rsplit("=", 1)[1]), f) for f in folders)


def _known(spark: SparkSession, table: Table) -> DataFrame | None:
    snapshots = _snapshots(spark, table)
    return spark.read.parquet(literal_path(snapshots[-1][1])) if snapshots else None


def refresh_spans(spark: SparkSession, root: str) -> int:
    """Add the files of new commits, drop those of folders that are gone; returns their number."""
    table = tables.transactions(root)
    live, known = _live_folders(spark, table), _known(spark, table)
    seen = set() if known is None else {r[0] for r in known.select("folder").distinct().collect()}
    parts = []
    if known is not None:
        names = spark.createDataFrame([(name,) for name in live], "folder string")
        parts.append(known.join(names, "folder", "left_semi"))
    new = [name for name in live if name not in seen]
    for part in ("delta", "base"):
        folders = [live[name] for name in new if name.startswith(f"{part}/")]
        if folders:
            parts.append(_spans(tables.read_folders(spark, table, part, folders)))
    if not new and seen <= set(live):
        return known.count() if known is not None else 0
    number = max((n for n, _ in _snapshots(spark, table)), default=-1) + 1
    if not parts:
        return 0
    # Few rows, one for each file.
    rows = reduce(DataFrame.unionByName, parts)
    rows.hint("rebalance").write.parquet(f"{table.path}/spans/number={number}")
    # A reader that has just looked up the one before may still read it.
    for _, folder in _snapshots(spark, table)[:-2]:
        delete_folder(spark, folder)
    return _known(spark, table).count()


def _spans(rows: DataFrame) -> DataFrame:
    """One row for each file of the rows; only the spanned columns are read."""
    # Names below the table have no character that a path would escape.
    path = F.regexp_extract(F.col("_metadata.file_path"), r"/((?:delta|base)/[^/]+=[^/]+/.+)$", 1)
    bounds = []
    for column in SPANNED:
        bounds += [F.min(column).alias(f"least_{column}"), F.max(column).alias(f"most_{column}")]
    found = rows.groupBy(path.alias("file")).agg(F.count("*").alias("n_rows"), *bounds)
    # A commit is one folder, a base one for each month.
    folder = F.when(
        F.col("file").startswith("delta/"), F.regexp_extract("file", r"^(delta/[^/]+)/", 1)
    ).otherwise(F.regexp_extract("file", r"^(.*)/[^/]+$", 1))
    return found.withColumn("folder", folder)


def read_days(
    spark: SparkSession,
    root: str,
    start: str | dt.date,
    end: str | dt.date,
    site_id: int | None = None,
    username: str | None = None,
) -> DataFrame:
    """Transactions of the days ``start`` to ``end``, and of a site or user if one is named.

    Files whose spans hold none of them are not opened.  The names of the others come to the
    driver, as they do in Spark's own listing.
    """
    table = tables.transactions(root)
    live, known = _live_folders(spark, table), _known(spark, table)
    first, after = as_date(start), as_date(end) + dt.timedelta(days=1)
    files: list[str] = []
    seen: set[str] = set()
    if known is not None:
        names = spark.createDataFrame([(name,) for name in live], "folder string")
        known = known.join(names, "folder", "left_semi")
        seen = {r[0] for r in known.select("folder").distinct().collect()}
        # Times are compared as UTC, which is the session's zone.
        held = (F.col("least_transaction_time") < F.lit(f"{after} 00:00:00+00:00").cast("timestamp")) & (
            F.col("most_transaction_time") >= F.lit(f"{first} 00:00:00+00:00").cast("timestamp")
        )
        for column, value in (("site_id", site_id), ("username", username)):
            if value is not None:
                held &= F.lit(value).between(F.col(f"least_{column}"), F.col(f"most_{column}"))
        files = [r.file for r in known.where(held).select("file").collect()]
    whole = [folder for name, folder in live.items() if name not in seen]
    root_path = table.path.rstrip("/")
    paths = whole + [f"{root_path}/{name}" for name in files]
    rows = tables.read_paths(spark, table, paths)
    rows = day_range(rows, start, end)
    if site_id is not None:
        rows = rows.where(F.col("site_id") == site_id)
    if username is not None:
        rows = rows.where(F.col("username") == username)
    return rows
