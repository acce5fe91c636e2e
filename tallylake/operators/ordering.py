"""Report order: chosen columns first, remaining key columns as ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.session import scratch_dir
from tallylake.sources.paths import delete_at_exit

# Spark's increasing ids hold the partition above these bits and the row below them.
ROW_BITS = 33


def order_report(
    df: DataFrame,
    sort_by: str | Sequence[str],
    allowed: Sequence[str],
    descending: bool = False,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Sort by allow-listed columns, one direction for all of them.

    ``ties`` are the grouping columns; they follow in ascending order, which makes the
    order, and with it a limit, deterministic.
    """
    columns = [c.strip() for c in sort_by.split(",")] if isinstance(sort_by, str) else list(sort_by)
    unknown = [c for c in columns if c not in allowed]
    if unknown or not columns:
        raise ValueError(f"cannot sort by {unknown or 'nothing'}; allowed: {', '.join(allowed)}")
    chosen = [F.col(c).desc() if descending else F.col(c).asc() for c in columns]
    return df.orderBy(*chosen, *[F.col(c).asc() for c in ties if c not in columns])


def place_rows(
    df: DataFrame, order: Sequence[Column | str], column: str = "place"
) -> DataFrame:
    """``df`` with every row's place in ``order``, from 1, without one task seeing all rows.

    Rows go to ranges of the order, are sorted there and written once to the shared scratch
    folder; so counting and numbering see the same ranges.  Only one number per range comes to
    the driver.  Rows equal in ``order`` take their places in any order.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "placed")
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("_at", F.monotonically_increasing_id())
    ordered.write.parquet(path)
    delete_at_exit(spark, path)
    stored = spark.read.schema(ordered.schema).parquet(path)
    part = F.shiftright("_at", ROW_BITS)
    counts = stored.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    before, offsets = 0, []
    for number, count in counts:
        offsets.append((number, before))
        before += count
    offsets = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    inside = F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(column, F.col("_before") + inside + 1)
        .drop("_part", "_before", "_at")
    )
