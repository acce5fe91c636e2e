"""Replacing rows that share a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The intent: one row per transaction.  Opt-in, since nothing states the id is unique.
BY_TRANSACTION_ID = ("transaction_id",)
# The declared sort key.  The version is part of it, so it cannot choose between versions.
BY_STORED_KEY = ("site_id", "username", "transaction_time", "_version")
# Of rows that share the declared sort key, version included, the choice is by their values.
STORED_ORDER = ("transaction_id", "bill_id", "item_id", "currency_code", "transfer_amount")
# Makes the choice independent of the physical order of rows.
LATEST = ("_version", "transaction_time", "source_file", "source_pos")


def replace_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that is largest in ``order_by``, which must be a total order.

    Catalyst turns the rank filter into a group limit on both sides of the shuffle, so
    each task sends at most one row per key and a key with very many copies does not
    gather in one place.
    """
    if not keys or not order_by:
        raise ValueError("replace_latest needs keys and a total order")
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_by])
    )
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_inserted(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], run: str = "run_id"
) -> DataFrame:
    """The measures of each key from its latest run.

    One ``max_by`` per fixed-width measure keeps this a hash aggregate; of a struct it
    would be a sort aggregate.
    """
    latest = [F.max_by(m, run).alias(m) for m in measures]
    return df.groupBy(*keys).agg(*latest, F.max(run).alias(run))
