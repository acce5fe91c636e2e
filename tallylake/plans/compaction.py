"""Folding loads into one row per key, month by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallylake.operators.bloom import maybe_among
from tallylake.operators.dedup import BY_STORED_KEY, LATEST, replace_latest
from tallylake.sources import tables


def compact_transactions(
    spark: SparkSession,
    root: str,
    keys: Sequence[str] = BY_STORED_KEY,
    order_by: Sequence[str] = LATEST,
) -> int | None:
    """Keep the latest row of each key; rewrite only the months in which a row may change.

    A key with the transaction's time has all its rows in one month, so only months with new
    rows change.  Any other key may be replaced from another month: months change that hold a
    key which was loaded since the last compaction, and these are found by a filter of the new
    keys and a semi join that reads one column.
    """

    def fold(rows: DataFrame) -> DataFrame:
        # Bounds from the stored rows: a sample of the latest would find these twice.
        return tables.with_month_layout(replace_latest(rows, keys, order_by), rows)

    def months(old: DataFrame, new: DataFrame) -> DataFrame:
        return new.select("yyyymm").union(_months_holding(old, new, keys))

    touched = None if "transaction_time" in keys else months
    return tables.compact(spark, tables.transactions(root), fold, touched)


def _months_holding(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The months of ``old`` that hold a key of ``new``."""
    fresh = new.select(*keys).distinct()
    likely = maybe_among(old.select(*keys, "yyyymm"), fresh, keys[0])
    return likely.join(fresh, list(keys), "left_semi").select("yyyymm").distinct()
